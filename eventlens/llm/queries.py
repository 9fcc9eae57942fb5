"""The registered queries of the operators, and their SQL."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm import (
    centroids, codebooks, embedding_dedup, language, licenses, mixing, packing, quality, simhash, substring,
    token_counts, topk, toxicity,
)
from eventlens.llm.shared import staged

#: Folder of the public tokenizers' vocabulary files.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS_DIR", "/opt/tokenizers")
PACKING_TOKENIZER = "word_bpe_49k.json"
UNIGRAM_VOCABULARY = "piece_bpe_32k.model"

#: Target weights of the mix: domains, then languages; sources count equally.
MIX_WEIGHTS = {
    "domain": {"web": 4.0, "books": 3.0, "news": 2.0, "forum": 1.0},
    "lang": {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 1.0},
}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_read(spark, sf_dir, "documents"), PACKING_TOKENIZER)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_read(spark, sf_dir, "documents"))


def mix_tree() -> dict:
    """Domain by the number that ends the source's name, then language, source."""
    number = F.coalesce(F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int"), F.lit(0)) % 4
    domain = F.element_at(F.array(*map(F.lit, ("web", "books", "news", "forum"))), number + 1)
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix(docs, mix_tree(), weights=MIX_WEIGHTS).select(
        "doc_id", "lang", "source", "mix_epoch", "mix_tokens", "mix_budget")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"))


def _held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    net = quality.fit(docs, _read(spark, sf_dir, "labels"))
    return quality.score(docs, net).select(
        "doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, f"{TOKENIZERS}/{UNIGRAM_VOCABULARY}")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_read(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(toxicity.training_rows(docs, _read(spark, sf_dir, "labels"), "toxic"))
    return toxicity.score(docs, model).select(
        "doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def _digest(components) -> str:
    """Lower-case sha256 of integers in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, components.ravel().tolist())).encode()).hexdigest()


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, dim = codebooks.lattice_table(_read(spark, sf_dir, "embeddings"), label=F.col("label"))
    books = codebooks.fit_codebooks(table, dim)
    coded = staged(codebooks.encode(table, books), "codes")
    # a row per label, written: the planner broadcasts it only while it is small
    by_label = staged(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    hexed = F.array_join(F.transform("code", lambda e: F.format_string("%02x", e)), "")
    return coded.join(by_label, coded["label"].eqNullSafe(by_label["label"]), "left").select(
        F.col("id").alias("vec_id"), hexed.alias("code"), "error", "label_error",
        F.lit(_digest(books)).alias("codebooks_sha256"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centers = centroids.cluster(_read(spark, sf_dir, "embeddings"))
    inertia = {r["cluster"]: r["d"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    of_cluster = F.array(*(F.struct(  # one entry per centroid
        F.lit(inertia.get(k, 0)).cast("long").alias("inertia"), F.lit(_digest(center)).alias("sha"))
        for k, center in enumerate(centers)) or [F.struct(F.lit(0).cast("long").alias("inertia"), F.lit("").alias("sha"))])
    own = F.element_at(of_cluster, F.col("cluster") + 1)
    return rows.select(
        F.col("id").alias("vec_id"), "cluster", "distance", own["inertia"].alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"), own["sha"].alias("centroid_sha256"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.fit(docs.where(~F.coalesce(held_out, F.lit(False))))
    return language.identify(docs.drop("lang"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def query_functions() -> dict:
    return {f.__name__: f for f in (
        op1_packing, op2_license_scan, op3_mixing, op4_embedding_dedup, op5_quality, op6_token_counts,
        op7_simhash, op8_substring_dedup, op9_toxicity, op10_topk, op11_vector_codes, op12_centroids,
        op13_language)}


def _license_sql() -> str:
    phrases = ", ".join(f"({p.split()!r}, '{label}')" for p, label in licenses.PHRASES)
    templates = ", ".join(
        f"('{f}', '{label}', {words!r}, {len(words)}, {need})" for f, label, words, need in licenses.template_sets())
    size, step = licenses.BLOCK_WORDS, licenses.BLOCK_STEP
    return f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
phrases(p, label) AS (VALUES {phrases}),
templates(family, label, t, s, o) AS (VALUES {templates}),
places AS (
  SELECT doc_id, label, unnest(list_filter(range(len(w) - len(p) + 1), lambda i: w[i + 1 : i + len(p)] = p)) AS place
  FROM d, phrases),
base AS (
  SELECT doc_id, count(*) AS n, min(place) AS first_word, max(place) AS last_word FROM places GROUP BY doc_id),
blocks AS (
  SELECT doc_id, b, list_distinct(w[b * {step} + 1 : b * {step} + {size}]) AS w
  FROM (SELECT doc_id, w, unnest(range(greatest(0, len(w) - {size} + {step} - 1) // {step} + 1)) AS b
        FROM d WHERE len(w) > 0)),
met AS (
  SELECT doc_id, b, family, label, s, len(list_intersect(w, t)) / s AS containment
  FROM blocks, templates WHERE len(list_intersect(w, t)) >= o),
best AS (
  SELECT * FROM met QUALIFY row_number() OVER (
    PARTITION BY doc_id, b, family ORDER BY containment DESC, s DESC, label DESC) = 1),
found AS (SELECT doc_id, max(containment) AS score FROM best GROUP BY doc_id),
own AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM places GROUP BY doc_id),
every AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS l
  FROM (SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM best) GROUP BY doc_id)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, cast(coalesce(n, 0) AS bigint) AS n_base,
  cast(first_word AS bigint) AS first_word, cast(last_word AS bigint) AS last_word,
  coalesce(own.l, '') AS base_labels, coalesce(every.l, '') AS labels,
  CASE WHEN n > 0 THEN 1.0::double ELSE coalesce(score, 0.0::double) END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)
LEFT JOIN own USING (doc_id) LEFT JOIN every USING (doc_id)"""


def _weight_sql(column: str, weights: dict) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}::double" for k, v in weights.items())
    return f"CASE {column} {cases} ELSE 1.0::double END"


def mixing_sql(docs: str = "documents") -> str:
    """Selected rows with domain, from a relation with the documents' columns."""
    epochs, seed = mixing.MAX_EPOCHS, mixing.SEED

    def level(name: str, key: str, parent: str, budget: str, weight: str) -> str:
        over = f"PARTITION BY {parent}" if parent else ""
        keys = f"{parent}, {key}" if parent else key
        join = f"JOIN (SELECT {parent}, given FROM {budget}) u USING ({parent})" if parent else ""
        up = "u.given" if parent else "(SELECT sum(tokens) FROM leaves)::double"
        return f"""
{name}_n AS (
  SELECT {keys}, sum(tokens * {epochs}::double) AS cap, {weight} AS wt FROM leaves WHERE tokens > 0 GROUP BY {keys}),
{name}_l AS (
  SELECT n.*, {up} AS up, ({up} - coalesce(sum(cap) OVER ({over} ORDER BY cap / wt, {keys}
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::double))
    / sum(wt) OVER ({over} ORDER BY cap / wt, {keys} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM {name}_n n {join}),
{name} AS (SELECT *, least(cap, wt * max(lev) OVER ({over})) AS given FROM {name}_l)"""

    return f"""
WITH rows_ AS (
  SELECT *, cast(len(regexp_extract_all(coalesce("text", ''), '[^\\x20\\x09-\\x0D]+')) AS bigint) AS mix_tokens,
    ['web', 'books', 'news', 'forum'][coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS int), 0) % 4 + 1] AS dom,
    coalesce(lang, '') AS lg, coalesce(source, '') AS src
  FROM {docs}),
leaves AS (SELECT dom, lg, src, sum(mix_tokens) AS tokens FROM rows_ GROUP BY ALL),
{level("d1", "dom", "", "", _weight_sql("dom", MIX_WEIGHTS["domain"]))},
{level("d2", "lg", "dom", "d1", _weight_sql("lg", MIX_WEIGHTS["lang"]))},
{level("d3", "src", "dom, lg", "d2", "1.0::double")},
plan AS (
  SELECT dom, lg, src, budget, budget // tokens AS whole, budget % tokens AS rest
  FROM (SELECT l.*, cast(floor(given + 1e-6) AS bigint) AS budget FROM leaves l JOIN d3 USING (dom, lg, src))),
ordered AS (
  SELECT r.*, p.budget, p.whole, p.rest, sum(mix_tokens) OVER (
    PARTITION BY dom, lg, src
    ORDER BY md5('{seed}:' || p.whole || ':' || coalesce(cast(doc_id AS varchar), 'null')), doc_id, "text"
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - mix_tokens AS reached
  FROM rows_ r JOIN plan p USING (dom, lg, src)),
picked AS (
  SELECT *, unnest(range(cast(whole + CASE WHEN reached < rest THEN 1 ELSE 0 END AS bigint))) AS epoch FROM ordered)
SELECT doc_id, lang, source, cast(epoch AS int) AS mix_epoch, mix_tokens, cast(budget AS bigint) AS mix_budget FROM picked"""


EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::double) AS e FROM embeddings),
ok AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id < b.vec_id
  WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.95),
both_ AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM v
  UNION SELECT r.node, l.b FROM reach r JOIN both_ l ON l.a = r.seen),
comp AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS n_links FROM both_ GROUP BY a)
SELECT v.vec_id, cast(coalesce(n.n_links, 0) AS bigint) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN comp ON comp.node = v.vec_id LEFT JOIN n ON n.a = v.vec_id"""

TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: cast(floor(256 * x::double) AS bigint)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    cast(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS bigint) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, cast(n AS int) AS rank, vec_id, score FROM r WHERE n <= 5"""


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """All rounds unrolled over one row per vector, part and component."""

    def assigned(name: str, book: str) -> str:
        return f"""
{name} AS MATERIALIZED (
  SELECT vec_id, label, part, x, entry, d FROM (
    SELECT v.vec_id, v.label, v.part, v.x, b.entry, list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint AS d,
      row_number() OVER (PARTITION BY v.n, v.part ORDER BY d, b.entry) AS place
    FROM v JOIN {book} b USING (part)) WHERE place = 1)"""

    steps = []
    for r in range(rounds):
        steps.append(assigned(f"a{r}", f"b{r}"))
        steps.append(f"""
b{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{r} b LEFT JOIN (
    SELECT part, entry, list(floor_sum ORDER BY i) AS x FROM (
      SELECT part, entry, i, cast((sum(c) - (sum(c) % count(*) + count(*)) % count(*)) // count(*) AS bigint) AS floor_sum
      FROM (SELECT part, entry, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY ALL) GROUP BY ALL
  ) m USING (part, entry))""")
    return f"""
WITH q AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: cast(floor({codebooks.SCALE} * x::double) AS bigint)) AS x,
    row_number() OVER (ORDER BY vec_id) AS n FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (
  SELECT vec_id, label, n, part, x[part * (len(x) // {parts}) + 1 : (part + 1) * (len(x) // {parts})] AS x
  FROM q, (SELECT unnest(range({parts})) AS part)),
b0 AS MATERIALIZED (SELECT part, n - 1 AS entry, x FROM v WHERE n <= {entries}),
{",".join(steps)},
{assigned("final", f"b{rounds}")},
sha AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds}),
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::bigint AS error
  FROM final GROUP BY vec_id, label)
SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error, codebooks_sha256
FROM coded, sha"""


def _centroids_sql(k: int = 8, rounds: int = 10) -> str:
    def assigned(name: str, centers: str) -> str:
        return f"""
{name} AS MATERIALIZED (
  SELECT vec_id, x, cluster, d FROM (
    SELECT v.vec_id, v.x, c.cluster, list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint AS d,
      row_number() OVER (PARTITION BY v.n ORDER BY d, c.cluster) AS place
    FROM v, {centers} c) WHERE place = 1)"""

    steps = []
    for r in range(rounds):
        steps.append(assigned(f"a{r}", f"c{r}"))
        steps.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT cluster, list(mean ORDER BY i) AS x FROM (
      SELECT cluster, i, cast((sum(y) - (sum(y) % count(*) + count(*)) % count(*)) // count(*) AS bigint) AS mean
      FROM (SELECT cluster, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY ALL) GROUP BY ALL
  ) m USING (cluster))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: cast(floor({centroids.SCALE} * x::double) AS bigint)) AS x,
    row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id)) AS n FROM embeddings
  WHERE len(embedding) = {centroids.DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT cast(n - 1 AS int) AS cluster, x FROM v WHERE n <= {k}),
{",".join(steps)},
{assigned("final", f"c{rounds}")}
SELECT vec_id, cluster, d AS distance, cast(sum(d) OVER (PARTITION BY cluster) AS bigint) AS cluster_inertia,
  cast(sum(d) OVER () AS bigint) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM final JOIN c{rounds} c USING (cluster)"""


def oracle_statements() -> dict[str, str]:
    return {
        "op2_license_scan": _license_sql(),
        "op3_mixing": mixing_sql(),
        "op4_embedding_dedup": EMBEDDING_SQL,
        "op10_topk": TOPK_SQL,
        "op11_vector_codes": _codes_sql(),
        "op12_centroids": _centroids_sql(),
    }
