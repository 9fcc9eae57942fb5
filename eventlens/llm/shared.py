"""Helpers shared by the operators: staged tables, text batches, components."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventlens.session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint location and read it back.

    Cuts the lineage: a lost executor later costs a re-read, not a
    recomputation.  The schema is kept, also for an empty result.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def widened(schema: StructType, *fields: tuple) -> StructType:
    """A copy of ``schema`` with more fields; ``StructType.add`` changes its own."""
    out = StructType(list(schema.fields))
    for name, kind in fields:
        out.add(name, kind)
    return out


def map_arrow(df: DataFrame, run: Callable, schema: StructType) -> DataFrame:
    """``mapInArrow`` over columns renamed by position: ``df`` may hold columns of
    any name, also several of one name or with dots."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))).mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text of an Arrow column; null counts as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


class WordMemo:
    """Values of words by ``compute``, remembered for the words met lately.

    Two generations of at most ``limit`` words each bound the memory; a word
    used again moves to the young one.  Values must not be None."""

    def __init__(self, compute: Callable, limit: int):
        self._compute, self._limit = compute, limit
        self._young: dict = {}
        self._old: dict = {}

    def _missing(self, word):
        value = self._young.get(word)
        if value is None:
            value = self._old.get(word)
            if value is None:
                value = self._compute(word)
            if len(word) <= 64:
                if len(self._young) >= self._limit:
                    self._old, self._young = self._young, {}
                self._young[word] = value
        return value

    def one(self, word):
        return self._missing(word)

    def all(self, words: list) -> list:
        values = list(map(self._young.get, words))
        if None in values:
            missing = self._missing
            for i, value in enumerate(values):
                if value is None:
                    values[i] = missing(words[i])
        return values


def sampled_ids(rows: DataFrame, id_col: str, salt: str, limit: int) -> DataFrame:
    """At most ``limit`` distinct ids of ``rows``, by a salted hash: a proven
    size, fit to be broadcast.

    A share of the hash range expected to hold twice as many is cut out first,
    so the ordering never sees more than that however many rows there are."""
    at = F.xxhash64(F.col(id_col), F.lit(salt))
    ids = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col), at.alias("__at"))
    share = 1 << 30
    n = ids.count()
    if n > 2 * limit:
        share = max(1, share * 2 * limit // n)
    picked = ids.where(F.pmod("__at", F.lit(1 << 30)) < share).dropDuplicates([id_col])
    return picked.orderBy("__at", id_col).limit(limit).select(id_col)


def min_labels(n: int, a: np.ndarray, b: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """Smallest reachable index for each of ``n`` nodes under links a-b.

    ``labels`` carries the result of earlier links on, so links can be fed in
    bounded portions.
    """
    labels = np.arange(n) if labels is None else labels
    while True:
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            return labels
        la, lb = la[differ], lb[differ]
        low = np.minimum(la, lb)
        np.minimum.at(labels, la, low)
        np.minimum.at(labels, lb, low)
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels = jumped


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    ``edges``: links between long ids.  Returns ``node, component`` for every
    node that has a link, ``component`` being the smallest reachable id.  Each
    round is grouping and joining only: minima are combined before the
    shuffle, and a hub's links are one skewed join side that AQE splits.
    """
    e = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u <> v")
        .distinct()
    )
    e = staged(e, "links")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(low, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (
            joined.select(
                F.explode(F.array(
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )).alias("s")
            )
            .select("s.u", "s.v").where("u <> v").distinct()
        )
        e = staged(small, "stars")
        state = e.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
            )
        seen = state
