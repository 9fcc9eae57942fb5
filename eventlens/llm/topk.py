"""Exact top-k inner products over a bit-sliced index.

Vectors are quantised to integers, floor(``SCALE`` * x).  Candidates are dealt
into blocks; a block's attributes (components) are bit-sliced: one bitmap per
component and bit, over the block's rows, of the value less the block's
smallest.  For a query the slices are added with bitmap arithmetic: slice j of
a component with weight bit i counts 2^(i+j), a negative weight uses the
complemented slices, and carry-save adders reduce the bitmaps of every power
of two to one sum slice.  From the most significant sum slice downward the
rows certainly among the best and the rows still tied with the boundary are
kept as bitmaps; rows tied to the end are taken by smaller id.  The k best of
each block meet in one ranking per query.

The stated queries are compared with all rows, block by block: a candidate row
is sent once to each block of queries, a query once to each block of
candidates, so the work grows with queries x rows and the memory of a task is
bounded by one block of each.

Vectors that are null or hold null or non-finite components, and rows with a
null id, take no part; of vectors of another dimension than the query's none
is a candidate.  Empty vectors score 0.  Rows sharing the query's id are left
out for it; other repeated rows each count.  Values whose scores cannot be
held in a long raise an error.

Other columns are not read and may bear any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm.shared import staged

SCALE = 256
TOP = 5
BLOCK_ROWS = 16384
QUERY_ROWS = 512


class BitSlices:
    """The slices of one block: ``values`` is rows x components, int64."""

    def __init__(self, values: np.ndarray):
        self.rows, self.dims = values.shape
        self.low = int(values.min()) if values.size else 0
        shifted = (values - self.low).astype(np.uint64)
        self.bits = max(1, int(shifted.max()).bit_length()) if values.size else 1
        self.words = -(-self.rows // 64)
        self.every = self._pack(np.ones((1, self.rows), dtype=np.uint8))[0]
        planes = np.empty((self.dims * self.bits, self.words), dtype=np.uint64)
        for j in range(self.bits):
            planes[j::self.bits] = self._pack(((shifted >> np.uint64(j)) & np.uint64(1)).astype(np.uint8).T)
        #: slice j of component d is row d * bits + j; its complement follows all slices
        self.planes = np.concatenate([planes, ~planes & self.every])

    def _pack(self, bits: np.ndarray) -> np.ndarray:
        packed = np.packbits(bits, axis=1, bitorder="little")
        out = np.zeros((len(bits), self.words * 8), dtype=np.uint8)
        out[:, :packed.shape[1]] = packed
        return out.view(np.uint64)

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Sum slices of the inner product, least significant first, up to a
        constant of the query."""
        at: dict[int, list[int]] = {}
        half = self.dims * self.bits
        for d, q in enumerate(query.tolist()):
            base = d * self.bits + (half if q < 0 else 0)
            q = abs(q)
            i = 0
            while q >> i:
                if q >> i & 1:
                    for j in range(self.bits):
                        at.setdefault(i + j, []).append(base + j)
                i += 1
        carried: list[np.ndarray] = []
        out: list[np.ndarray] = []
        top = max(at, default=-1)
        while len(out) <= top or carried:
            stack = [self.planes[at[len(out)]]] if len(out) in at else []
            stack = np.concatenate([*stack, *carried]) if stack or carried else np.zeros((0, self.words), np.uint64)
            carried = []
            while len(stack) > 2:
                k = len(stack) // 3
                a, b, c = stack[:k], stack[k:2 * k], stack[2 * k:3 * k]
                ab = a ^ b
                carried.append((a & b) | (ab & c))
                stack = np.concatenate([ab ^ c, stack[3 * k:]])
            if len(stack) == 2:
                carried.append(stack[:1] & stack[1:])
                stack = stack[:1] ^ stack[1:]
            out.append(stack[0] if len(stack) else np.zeros(self.words, np.uint64))
        return out

    def best(self, query: np.ndarray, k: int, among: np.ndarray) -> np.ndarray:
        """Rows of the ``k`` largest products among a bitmap, ties to lower rows."""
        sure, tied = np.zeros_like(among), among.copy()
        for plane in reversed(self.sums(query)):
            high = tied & plane
            n = int(np.bitwise_count(sure | high).sum())
            if n > k:
                tied = high
            else:
                sure |= high
                tied &= ~plane
                if n == k:
                    break
        sure, tied = (np.flatnonzero(np.unpackbits(m.view(np.uint8), bitorder="little")) for m in (sure, tied))
        return np.concatenate([sure, tied[:max(0, k - len(sure))]])


def _whole(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(fine, F.lit(False))


def top_products(vectors: DataFrame, is_query: Column, k: int = TOP, scale: int = SCALE, id_col: str = "vec_id",
                 vector_col: str = "embedding", block_rows: int = BLOCK_ROWS,
                 query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every row with ``is_query``."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"),
    ).where(F.col("id").isNotNull() & _whole(F.col("v")))

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = []
            for x in batch.column(1).to_pylist():
                scaled = np.floor(scale * np.array(x, dtype=np.float64))
                if len(x) and np.dot(scaled, scaled) + np.abs(scaled).max() * np.abs(scaled).sum() >= 2.0**62:
                    raise ValueError("vector values too large for exact integer products")
                raw.append(scaled.astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(raw, pa.binary()), batch.column(2)], names=["id", "raw", "q"])

    table = staged(rows.mapInArrow(quantise, "id long, raw binary, q boolean"), "quantised")
    sizes = table.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("q").cast("long")).alias("q")).first()
    blocks, groups = max(1, -(-sizes["n"] // block_rows)), max(1, -(-(sizes["q"] or 0) // query_rows))
    spread = F.xxhash64("id", "raw")
    candidates = table.select(
        "id", "raw", F.pmod(spread, F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"))
    queries = table.where("q").select(
        "id", "raw", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(spread, F.lit(groups)).alias("grp"))
    queries = queries.withColumn("block", F.col("block").cast("long"))
    candidates = candidates.withColumn("grp", F.col("grp").cast("long"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            ids = left["id"].to_numpy()
            raw = left["raw"].to_pylist()
            width = np.array([len(r) for r in raw])
            asked = list(zip(right["id"].to_pylist(), right["raw"].to_pylist(), strict=True))
            for size in sorted({len(r) for _, r in asked}):
                own = np.flatnonzero(width == size)
                own = own[np.argsort(ids[own], kind="stable")]
                if not len(own):
                    continue
                values = np.frombuffer(b"".join(raw[i] for i in own), dtype=np.int64).reshape(len(own), size // 8)
                index = BitSlices(values)
                at = ids[own]
                for query_id, q in asked:
                    if len(q) == size:
                        q = np.frombuffer(q, dtype=np.int64)
                        others = index.every.copy()
                        lo, hi = np.searchsorted(at, query_id), np.searchsorted(at, query_id, side="right")
                        for i in range(lo, hi):
                            others[i // 64] &= ~np.uint64(1 << (i % 64))
                        best = index.best(q, k, others)
                        found += zip([query_id] * len(best), at[best].tolist(), (values[best] @ q).tolist(), strict=True)
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    near = candidates.groupBy("block", "grp").cogroup(queries.groupBy("block", "grp")).applyInArrow(
        search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
