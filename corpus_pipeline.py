"""Corpus pipeline: five stages over ``documents``, each written and reread.

Toxic documents go, one document of each SimHash group stays, repeated
sentence runs are cut, sources are mixed to target weights, and the rest is
packed into training windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm import mixing, packing, queries, simhash, substring, toxicity
from eventlens.session import remove_path, scratch_path, scratch_scope

TOXIC = 0.5
#: Bytes of an Arrow batch of texts, where the session names no bound of its own.
BATCH_BYTES = 4 << 20


def _free(name: str, docs: DataFrame) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name += "_"
    return name


def _bound_batches(spark: SparkSession) -> None:
    """Let no Arrow batch outgrow ``BATCH_BYTES`` by more than a row.

    The rows of a batch are bounded by default, their bytes hardly; both the
    executor and its Python workers hold whole batches.  The stages' results are
    lazy, so the setting stays with the session."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under ``TOXIC``; trained on the labels of ``sf_dir``.

    A null text counts as empty and stays unless empty texts score as toxic."""
    _bound_batches(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = toxicity.fit(toxicity.training_rows(docs, labels, "toxic"))
    out = _free("toxicity", docs)
    scored = toxicity.score(docs, model, out=out)
    empty = F.trim(F.coalesce("text", F.lit(""))) == ""
    return scored.where((F.col(out) < TOXIC) | empty).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The leading document of every SimHash group."""
    _bound_batches(spark)
    return simhash.keep_one_per_group(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated sentence runs; ``n_chars`` follows the text."""
    _bound_batches(spark)
    cut = substring.remove_repeats(docs, removed_col=_free("units_removed", docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.col("text").isNotNull()
        cut = cut.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cut.select(*(F.col(f"`{c}`") for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents mixed to the target weights; further epochs repeat rows."""
    return mixing.mix(docs, queries.mix_tree(), weights=queries.MIX_WEIGHTS).select(
        *(F.col(f"`{c}`") for c in docs.columns))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed windows with their token ids."""
    _bound_batches(spark)
    return packing.pack(docs, queries.PACKING_TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: No SQL: the classifier, the fingerprints and the tokenizer are not expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``.

    What a stage stages for itself, and the stage before it, go once its own
    output is written."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    before = None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    return docs
