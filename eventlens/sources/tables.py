"""S4 + S8: slot-partitioned feed tables.

A feed table is a Parquet directory partitioned by ``ts`` (the 14-digit slot
stamp) and ``load_file`` (the name of the landed file).  Writes use dynamic
partition overwrite, so the unit of replacement is the file: a re-delivered
file never duplicates rows, a second file of a slot adds to it whenever it
arrives, and a failed-then-retried write converges to one copy.

One directory per landed file is about 35,000 a year: ``compact`` moves the
parts of old slots into day files of a ``PartStore`` beside the table
(``<table>.compacted``), whose rows keep ``ts`` and ``load_file``.  A file that
is delivered again afterwards lands as a directory, and ``load_table`` takes a
landed part before the compacted one, so replacement works as before.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.schemas import TABLE_COLUMNS, table_schema
from eventlens.session import remove_path
from eventlens.sources.parts import PART, PartStore, landed_parts, new_batch, only_parts, part_files, staged_parts
from eventlens.sources.versions import children

log = logging.getLogger(__name__)


def with_load_columns(rows: DataFrame) -> DataFrame:
    """Add ``load_timestamp`` (= the slot stamp) next to the partition column ``ts``."""
    return rows.withColumn("load_timestamp", F.col("ts"))


def file_name(path: str) -> Column:
    """The last name of a path: ``load_file`` of the rows of a landed file."""
    return F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)


def write_slots(rows: DataFrame, table_root: str, table: str) -> None:
    """Write typed rows (with ``ts``) as the slots of one feed table.

    ``source_file`` (the landed file's path), where present, names the part of
    the slot that is replaced; without it the rows are the slot's one part."""
    cols = TABLE_COLUMNS[table] + ["load_timestamp", "ts", "load_file"]
    name = file_name("source_file") if "source_file" in rows.columns else F.lit("slot")
    (
        with_load_columns(rows)
        .withColumn("load_file", name)
        .select(*cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ts", "load_file")
        .parquet(f"{table_root.rstrip('/')}/{table}")
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop file system (works for any scheme)."""
    try:
        jvm = spark._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath)
    except Exception:  # no JVM handle (Spark Connect): let the read decide
        try:
            spark.read.format("binaryFile").load(path).limit(0).collect()
            return True
        except Exception:
            return False


def compacted_store(spark: SparkSession, table_root: str, table: str) -> PartStore:
    return PartStore(spark, f"{table_root.rstrip('/')}/{table}.compacted")


def _schema(table: str) -> T.StructType:
    return T.StructType([*table_schema(table).fields, T.StructField("load_file", T.StringType())])


def _landed(spark: SparkSession, table_root: str, table: str) -> DataFrame:
    return spark.read.schema(_schema(table)).parquet(f"{table_root.rstrip('/')}/{table}")


def _live_compacted(spark: SparkSession, table_root: str, table: str) -> tuple[PartStore, DataFrame | None]:
    """The store, and the index of its parts that have not landed anew."""
    store = compacted_store(spark, table_root, table)
    index = store.index()
    path = f"{table_root.rstrip('/')}/{table}"
    if index is not None and path_exists(spark, path):
        index = staged_parts(index.join(landed_parts(spark, path), PART, "left_anti"))
    return store, index


def table_parts(spark: SparkSession, table_root: str, table: str) -> DataFrame | None:
    """``ts, load_file, signature`` of the parts of a feed table, landed and
    compacted; None when there is no table."""
    _, index = _live_compacted(spark, table_root, table)
    path = f"{table_root.rstrip('/')}/{table}"
    landed = landed_parts(spark, path) if path_exists(spark, path) else None
    compacted = None if index is None else index.select(*PART, "signature")
    if landed is None or compacted is None:
        return landed if compacted is None else compacted
    return landed.unionByName(compacted)


def load_table(
    spark: SparkSession, table_root: str, table: str, parts: DataFrame | None = None, keep_part: bool = False,
    since: str | None = None,
) -> DataFrame | None:
    """The typed feed table, or None (with a warning) when it does not exist.

    The explicit schema makes an empty directory an empty table (no schema
    inference), and keeps ``ts`` a string rather than an inferred number.
    ``parts`` (a written table of ``ts, load_file``) limits the load to those
    parts, directories of other slots are not read; ``keep_part`` adds the
    column ``load_file``.  ``since`` (a slot stamp) says that older slots will be
    filtered out: compacted days before it are not read.
    """
    path = f"{table_root.rstrip('/')}/{table}"
    store, index = _live_compacted(spark, table_root, table)
    sources = []
    if path_exists(spark, path):
        sources.append(_landed(spark, table_root, table))
    if index is not None:
        # days that are no date are read, as retention keeps stamps that are no time
        recent = None if since is None else (F.col("day") >= since[:8]) | ~F.col("day").rlike("^[0-9]{8}$")
        sources.append(store.live(_schema(table), index=index, partition_by=("day",), where=recent))
    if not sources:
        log.warning("no data at %s", path)
        return None
    names = table_schema(table).fieldNames() + (["load_file"] if keep_part else [])
    sources = [only_parts(s, parts) if parts is not None else s for s in sources]
    rows = sources[0].select(*names)
    for more in sources[1:]:
        rows = rows.unionByName(more.select(*names))
    return rows


def compact(spark: SparkSession, table_root: str, table: str, before: str) -> int:
    """Move the landed parts of slots before the stamp ``before`` into day files;
    the number of parts moved.

    The day files and the index that names them are complete before the first
    directory goes, and a landed part is read before its compacted copy, so the
    table reads the same at every moment; a run that fails is done again.  A
    part that was replaced meanwhile stays."""
    path = f"{table_root.rstrip('/')}/{table}"
    if not path_exists(spark, path):
        return 0
    old = staged_parts(landed_parts(spark, path).where(F.col("ts") < before))
    moved = old.count()
    if not moved:
        return 0
    store = compacted_store(spark, table_root, table)
    batch = new_batch()
    rows = _landed(spark, table_root, table).where(F.col("ts") < before).join(old.select(*PART), PART, "left_semi")
    rows = rows.withColumn("day", F.substring("ts", 1, 8))
    # files of even size however many rows a day has
    rows = rows.hint("rebalance", "day").sortWithinPartitions("ts", "load_file")
    store.write_batch(rows, batch, partition_by=("day",))
    index = old.withColumn("batch", F.lit(batch))
    kept = store.index()
    if kept is not None:
        index = index.unionByName(kept.join(old.select(*PART), PART, "left_anti"))
    store.commit(index)
    unchanged = old.join(landed_parts(spark, path), [*PART, "signature"], "left_semi")
    remove_parts(spark, path, unchanged)
    _remove_empty_slots(spark, path, before)
    return moved


def remove_parts(spark: SparkSession, path: str, parts: DataFrame) -> None:
    """Delete the directories of landed parts."""
    # as they are named on disk: values in them may be escaped
    folders = part_files(spark, path).join(parts.select(*PART), PART, "left_semi").select(
        F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder")).distinct()
    for row in folders.toLocalIterator():
        remove_path(spark, row["folder"])


def _remove_empty_slots(spark: SparkSession, path: str, before: str) -> None:
    for slot in children(spark, path):
        if slot.startswith("ts=") and slot[3:] < before and not children(spark, f"{path}/{slot}"):
            remove_path(spark, f"{path}/{slot}")
