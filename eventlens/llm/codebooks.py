"""Vector code compression over memoised grid cells.

Vectors are quantised to integers, ``floor(SCALE * x)``, and cut into equal
consecutive parts; every part position has a codebook of a few entries, and a
vector's code names the nearest entry of each of its parts.  The codebooks
start as the parts of the vectors with the smallest ids and are refitted in
rounds: assign all parts, then replace each entry by its parts' componentwise
floored mean; an entry without parts stays.  All of it is integer arithmetic
and so the same for any partitioning.

Finding the nearest entry: a part falls into a coarse cell of a grid of side
``SIDE``.  For a cell met the first time, the smallest and the largest distance
from each entry to the cell's box are taken; an entry whose smallest exceeds
another's largest is dominated everywhere in the box.  The entries left are
remembered under the hash of the cell, and only they are evaluated exactly for
the parts in it.  The memory keeps at most ``MEMO_CELLS`` cells a part position,
and starts afresh beyond.

A round is one pass over the quantised table without a shuffle of vectors: a
task passes on one row of counts and sums per part and entry.  Codebooks
(parts x entries x width integers) are all that the driver holds.

Nulls and odd rows: vectors that are null or hold null or non-finite
components are dropped, as are those of another dimension than the commonest
(of equally common ones the largest), or of one that the parts do not divide.  A null id is coded but starts no entry.  Rows sharing an id each
count; among them the smaller vector (by its bytes) comes first.  Equal
entries: the lower index.  Fewer vectors than entries: as many entries; no
vectors: no rows.

Other columns are not read and may bear any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ShortType, LongType

from eventlens.llm.shared import map_arrow, staged, widened
from eventlens.llm.vectors import WORD, matrix, of_dim, quantised

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
SIDE = 256
MEMO_CELLS = 1 << 17
STRIPE = 8192
#: Odd multipliers that hash a cell's coordinates (a part's axes in turn).
MIX = 0x9E3779B97F4A7C15


def cell_hash(cells: np.ndarray) -> np.ndarray:
    h = np.zeros(len(cells), dtype=np.uint64)
    for axis in cells.T.astype(np.uint64):
        h = (h ^ axis) * np.uint64(MIX)
        h ^= h >> np.uint64(29)
    return h


class CellMemo:
    """Nearest entries of one part's codebook by remembered grid cells."""

    def __init__(self, book: np.ndarray, side: int = SIDE, limit: int = MEMO_CELLS):
        self.book, self.side, self.limit = book, side, limit
        self.slots: dict[int, int] = {}  # cell hash -> row of the tables below
        self.cells = np.zeros((1024, book.shape[1]), dtype=np.int64)
        self.open = np.zeros((1024, len(book)), dtype=bool)
        self.evaluated = 0

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """Which entries can be nearest somewhere in the cells' boxes."""
        low = (cells * self.side)[:, None, :]
        below, above = low - self.book, self.book - (low + self.side - 1)
        nearest = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=2)
        farthest = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=2)
        return nearest <= farthest.min(axis=1, keepdims=True)

    def _rows_of(self, hashes: list[int], cells: np.ndarray) -> np.ndarray:
        if len(self.slots) + len(hashes) > self.limit:
            self.slots = {}
        at = np.array([self.slots.get(h, -1) for h in hashes], dtype=np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            first = len(self.slots)
            while first + len(new) > len(self.cells):
                self.cells = np.concatenate([self.cells, np.zeros_like(self.cells)])
                self.open = np.concatenate([self.open, np.zeros_like(self.open)])
            at[new] = np.arange(first, first + len(new))
            self.cells[at[new]] = cells[new]
            self.open[at[new]] = self.undominated(cells[new])
            self.slots.update(zip([hashes[i] for i in new], at[new].tolist(), strict=True))
        return at

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry, ties to the lower."""
        cells = parts // self.side
        hashes, first, of_cell = np.unique(cell_hash(cells), return_index=True, return_inverse=True)
        at = self._rows_of(hashes.tolist(), cells[first])[of_cell]
        # two cells of one hash: the later one's parts are held against all entries
        open_ = self.open[at] | (self.cells[at] != cells).any(axis=1, keepdims=True)
        index = np.zeros(len(parts), dtype=np.int64)
        best = np.full(len(parts), np.iinfo(np.int64).max)
        for e, entry in enumerate(self.book):
            rows = np.flatnonzero(open_[:, e])
            distance = ((parts[rows] - entry) ** 2).sum(axis=1)
            closer = distance < best[rows]
            rows = rows[closer]
            index[rows], best[rows] = e, distance[closer]
            self.evaluated += len(closer)
        return index, best


def _stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, STRIPE):
            yield batch.slice(at, STRIPE)


def lattice_table(vectors: DataFrame, parts: int = PARTS, scale: int = SCALE, id_col: str = "vec_id",
                  vector_col: str = "embedding", **keep: Column) -> tuple[DataFrame, int]:
    """The written table ``id, raw`` and ``keep`` of the vectors that take part,
    and their dimension."""
    table = staged(quantised(vectors, scale, F.col(f"`{vector_col}`"), id=F.col(f"`{id_col}`").cast("long"), **keep), "lattice")
    commonest = table.groupBy(F.length("raw").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    dim = commonest["size"] // WORD if commonest else 0
    if dim % parts or not dim:
        return table.limit(0), dim
    return of_dim(table, dim), dim


def fit_codebooks(table: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                  side: int = SIDE) -> np.ndarray:
    """Codebooks, parts x entries x width, of a ``lattice_table``."""
    width = dim // parts
    seeds = table.where("id is not null").orderBy("id", "raw").limit(entries).select("raw").collect()
    books = np.array([np.frombuffer(bytes(r["raw"]), dtype="<i4") for r in seeds], dtype=np.int64)
    books = books.reshape(len(seeds), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(seeds) else 0):
        fixed = books.copy()

        def sums(batches: Iterator[pa.RecordBatch], fixed=fixed) -> Iterator[pa.RecordBatch]:
            memos = [CellMemo(book, side) for book in fixed]
            total, count = np.zeros_like(fixed), np.zeros(fixed.shape[:2], dtype=np.int64)
            for batch in _stripes(batches):
                x = matrix(batch.column(0), dim).reshape(-1, parts, width)
                for p, memo in enumerate(memos):
                    index, _ = memo.nearest(x[:, p])
                    np.add.at(total[p], index, x[:, p])
                    count[p] += np.bincount(index, minlength=len(fixed[p]))
            p, e = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(p), pa.array(e), pa.array(count[p, e]), pa.array(total[p, e].tolist(), pa.list_(pa.int64()))],
                names=["part", "entry", "n", "total"])

        found = table.select("raw").mapInArrow(sums, "part long, entry long, n long, total array<long>")
        found = found.select("part", "entry", "n", F.posexplode("total").alias("axis", "total")).groupBy(
            "part", "entry", "axis").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        for r in found.collect():  # parts x entries x width rows at most
            books[r["part"], r["entry"], r["axis"]] = r["total"] // r["n"]
    return books


def encode(table: DataFrame, books: np.ndarray, side: int = SIDE) -> DataFrame:
    """``table`` without ``raw``, with ``code`` (entry per part) and ``error``
    (squared distances summed over the parts)."""
    parts, _, width = books.shape
    if not books.size:
        return table.where(F.lit(False)).drop("raw").select(
            "*", F.lit(None).cast("array<smallint>").alias("code"), F.lit(None).cast("long").alias("error"))
    names = [c for c in table.columns if c != "raw"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = [CellMemo(book, side) for book in books]
        for batch in _stripes(batches):
            x = matrix(batch.column(batch.num_columns - 1), parts * width).reshape(-1, parts, width)
            found = [memo.nearest(x[:, p]) for p, memo in enumerate(memos)]
            code = np.stack([f[0] for f in found], axis=1).astype(np.int16)
            ends = np.arange(len(x) + 1, dtype=np.int32) * parts
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(code.ravel())),
                 pa.array(sum(f[1] for f in found))], names=[*names, "code", "error"])

    rows = table.select(*names, "raw")
    return map_arrow(rows, run, widened(rows.drop("raw").schema, ("code", ArrayType(ShortType())), ("error", LongType())))
