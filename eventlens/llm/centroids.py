"""Centroid clustering over an incremental matrix of dot products.

Vectors are quantised to integers, ``floor(SCALE * x)``.  The squared distance
of a vector x to a centroid c is |x|^2 - 2 x.c + |c|^2, so each row carries its
exact integer dot products with all centroids.  A round does not reckon them
anew: a centroid that moved adds, for each of its components that changed, the
change times the vector's component.  The argmin is then taken again.

The matrix persists as a table in the shared checkpoint folder, one per round,
the round before it removed: a lost executor costs a re-read of one table.
Rows never move: a round is one map over the table.  Centroid sums are kept the
same way: only rows that changed cluster are added to and taken from them, by
one row of sums per task and cluster.

Centroids start as the vectors whose lower-case hexadecimal sha256 of
``<seed>:<id>`` is smallest, in that order.  After every assignment but the
last, each non-empty centroid becomes the componentwise floor(sum / count) of
its vectors; empty ones stay.

Nulls and odd rows: vectors that are null, hold null or non-finite components
or do not have ``dim`` components take no part.  A null id is assigned but
starts no centroid.  Rows sharing an id each count; their order among the
starting vectors is by their bytes.  Ties go to the smaller number.  Fewer
vectors than centroids: as many centroids; no vector that can start one: no
rows.  The driver holds the centroids and their sums alone.

Other columns are not read and may bear any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.shared import staged
from eventlens.llm.vectors import matrix, of_dim, quantised
from eventlens.session import remove_path, scratch_path

SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = "3"
DIM = 64
STRIPE = 16384
MATRIX = "id long, raw binary, norm long, dots binary, cluster int, was int, distance long"


def moved(dots: np.ndarray, x: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Dot products after the centroids changed by ``change`` (centroids x
    components); only the components that changed are read."""
    dots = dots.copy()
    for k, row in enumerate(change):
        at = np.flatnonzero(row)
        if len(at):
            dots[:, k] += x[:, at] @ row[at]
    return dots


def _next_matrix(table: DataFrame, centroids: np.ndarray, change: np.ndarray) -> DataFrame:
    """The rows with their dot products brought up to ``centroids``."""
    k, dim = centroids.shape
    squares = (centroids * centroids).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, STRIPE):
                batch = whole.slice(at, STRIPE)
                x = matrix(batch.column(1), dim)
                if batch.num_columns == 2:  # first round: from centroids at the origin
                    dots, was = np.zeros((len(x), k), dtype=np.int64), np.full(len(x), -1, dtype=np.int32)
                    norm = (x * x).sum(axis=1)
                else:
                    dots = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype="<i8").reshape(len(x), k)
                    norm, was = batch.column(2).to_numpy(), batch.column(4).to_numpy()
                dots = moved(dots, x, change)
                distance = norm[:, None] - 2 * dots + squares
                cluster = distance.argmin(axis=1)
                ends = np.arange(len(x) + 1, dtype=np.int32) * (8 * k)
                packed = pa.Array.from_buffers(
                    pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(dots.astype("<i8"))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(norm), packed, pa.array(cluster.astype(np.int32)),
                     pa.array(was), pa.array(distance[np.arange(len(x)), cluster])],
                    names=[f.split()[0] for f in MATRIX.split(", ")])

    return table.mapInArrow(run, MATRIX)


def _sum_changes(table: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """What the rows that changed cluster add to the clusters' counts and sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            x = matrix(batch.column(0), dim)
            for column, sign in ((1, 1), (2, -1)):
                cluster = batch.column(column).to_numpy()
                held = cluster >= 0
                np.add.at(total, cluster[held], sign * x[held])
                count += sign * np.bincount(cluster[held], minlength=k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k)), pa.array(count), pa.array(total.tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "total"])

    found = table.where("cluster <> was").select("raw", "cluster", "was").mapInArrow(
        run, "cluster long, n long, total array<long>")
    found = found.select("cluster", "n", F.posexplode("total").alias("axis", "total")).groupBy("cluster", "axis").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"))
    total, count = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
    for r in found.collect():  # centroids x components
        total[r["cluster"], r["axis"]], count[r["cluster"]] = r["total"], r["n"]
    return total, count


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: str = SEED,
            dim: int = DIM, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``id, cluster, distance`` of every vector that takes part, and the final
    centroids (centroids x components)."""
    spark = vectors.sparkSession
    table = staged(of_dim(quantised(
        vectors, scale, F.col(f"`{vector_col}`"), id=F.col(f"`{id_col}`").cast("long")), dim), "lattice")
    at = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    seeds = table.where("id is not null").orderBy(at, "raw").limit(k).select("raw").collect()
    centroids = np.array([np.frombuffer(bytes(r["raw"]), dtype="<i4") for r in seeds], dtype=np.int64).reshape(-1, dim)
    if not len(centroids):
        return table.where(F.lit(False)).select(
            "id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    total, count = np.zeros_like(centroids), np.zeros(len(centroids), dtype=np.int64)
    change, path = centroids, None
    for step in range(rounds + 1):
        written = scratch_path(spark, f"dots-{step}")
        _next_matrix(table, centroids, change).write.parquet(written)
        table = spark.read.schema(MATRIX).parquet(written)
        if path:
            remove_path(spark, path)
        path = written
        if step < rounds:
            more, n = _sum_changes(table, *centroids.shape)
            total, count = total + more, count + n
            moved_to = np.where(count[:, None] > 0, total // np.maximum(count, 1)[:, None], centroids)
            change, centroids = moved_to - centroids, moved_to
    return table.select("id", "cluster", "distance"), centroids
