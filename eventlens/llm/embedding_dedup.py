"""Embedding near-duplicates by PCA-ordered tiled comparison.

Equal vectors are first folded into one with a count.  The rest are rotated
onto the principal axes, strongest first (an orthogonal rotation keeps every
inner product, so any sample may fit it), and dealt into tiles: leaves of a
k-d split along the leading axes, cut into chunks of ``TILE_ROWS`` rows.  A
pair of leaves whose boxes along the leading axes lie further apart than two
unit vectors of the threshold's cosine can is never compared.  Within a pair
of tiles the products of the leading axes are accumulated first, together
with the product of the suffix norms, which bounds what the other axes can
add; pairs whose bound stays under the threshold stop there.  The others go on
with as many axes again, and again, under a nearer bound each time.  What is
left is decided by the cosine of the original vectors in double precision.

A tile pair passes on link counts per vector and a spanning forest of its
links, never its pairs.  The work is quadratic in what the boxes leave, the
shuffle is rows x tiles a row is compared with.

Vectors that are null, of length zero or hold null or non-finite components
link with nothing, and vectors of different dimension never link.  A null
``vec_id`` keeps its row with null component and not kept; it links with
nothing.  Ids are expected to be unique: rows sharing one are counted as
separate vectors, each in the component of its own vector.

Other columns are not read and may bear any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.shared import components, min_labels, staged

THRESHOLD = 0.95
TILE_ROWS = 8192
FIT_ROWS = 10_000
MAX_LEAVES = 256
LEAD = 16
SLACK = 1e-4  # float32 rounding of the bound
STRIPE = 512


class Tiling:
    """Rotation and k-d split fitted on a bounded sample; any fit is exact."""

    def __init__(self, sample: np.ndarray, rows: int, tile_rows: int = TILE_ROWS):
        self.dim = sample.shape[1]
        _, axes = np.linalg.eigh(sample.T @ sample)
        self.axes = axes[:, ::-1].copy()
        self.lead = min(LEAD, self.dim)
        wanted = min(MAX_LEAVES, max(1, rows // tile_rows))
        self.cuts: list[tuple[int, float, int]] = []  # axis, value, right child; -1: leaf
        self.leaves = 0
        self._split((sample @ self.axes)[:, :self.lead], max(0, int(math.log2(wanted))))

    def _split(self, x: np.ndarray, depth: int) -> None:
        if not depth or len(x) < 32:
            self.cuts.append((-1, 0.0, self.leaves))
            self.leaves += 1
            return
        axis = int(np.argmax(x.var(axis=0)))
        value = float(np.median(x[:, axis]))
        at = len(self.cuts)
        self.cuts.append((axis, value, 0))
        self._split(x[x[:, axis] <= value], depth - 1)
        self.cuts[at] = (axis, value, len(self.cuts))
        self._split(x[x[:, axis] > value], depth - 1)

    def leading(self, unit: np.ndarray) -> np.ndarray:
        return unit @ self.axes[:, :self.lead]

    def leaf(self, lead: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lead), dtype=np.int64)
        todo = [(0, np.arange(len(lead)))]
        while todo:
            node, rows = todo.pop()
            axis, value, right = self.cuts[node]
            if axis < 0:
                out[rows] = right
            else:
                low = lead[rows, axis] <= value
                todo += [(node + 1, rows[low]), (right, rows[~low])]
        return out


def units(raw: list[bytes], dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype=np.float64).reshape(len(raw), dim)
    # scaled by the largest component first, so no square over- or underflows
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def block_ends(dim: int, lead: int) -> list[int]:
    """Where the blocks of axes end: the leading ones, then twice as many each."""
    ends = [min(lead, dim)]
    while ends[-1] < dim:
        ends.append(min(2 * ends[-1], dim))
    return ends


def tile_links(a: np.ndarray, b: np.ndarray, same: bool, axes_a: np.ndarray, axes_b: np.ndarray, lead: int,
               threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked index pairs of two tiles of unit vectors, stripe by stripe.

    ``axes_a`` and ``axes_b`` are the vectors on the principal axes.  Products
    of the leading axes are taken for all pairs; the pairs whose bound reaches
    the threshold go on block by block, each time with a nearer bound."""
    ends = block_ends(a.shape[1], lead)

    def suffix_norms(x):
        return np.stack([np.sqrt((x[:, end:] ** 2).sum(axis=1)) for end in ends], axis=1)

    rest_a, rest_b = suffix_norms(axes_a), suffix_norms(axes_b)
    bound_a = np.column_stack([axes_a[:, :ends[0]], rest_a[:, 0]]).astype(np.float32)
    bound_b = np.column_stack([axes_b[:, :ends[0]], rest_b[:, 0]]).astype(np.float32).T.copy()
    for at in range(0, len(a), STRIPE):
        start = at if same else 0
        upper = bound_a[at:at + STRIPE] @ bound_b[:, start:]
        i, j = np.nonzero(upper >= threshold - SLACK)
        i, j = i + at, j + start
        if same:
            i, j = i[i < j], j[i < j]
        for cut in range(0, len(i), 1 << 16):
            p, q = i[cut:cut + (1 << 16)], j[cut:cut + (1 << 16)]
            reached = np.einsum("ij,ij->i", axes_a[p, :ends[0]], axes_b[q, :ends[0]])
            for k, (start_axis, end) in enumerate(pairwise(ends), 1):
                reached += np.einsum("ij,ij->i", axes_a[p, start_axis:end], axes_b[q, start_axis:end])
                open_ = reached + rest_a[p, k] * rest_b[q, k] >= threshold - SLACK
                p, q, reached = p[open_], q[open_], reached[open_]
            hit = np.einsum("ij,ij->i", a[p], b[q]) >= threshold
            if hit.any():
                yield p[hit], q[hit]


def link_table(vectors: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``rep, key, links, other``: for distinct vectors (``rep, key, copies,
    dim, raw``) the number of linked other rows found in one tile pair, and an
    id to which a spanning forest links it (null: none there)."""
    spark = vectors.sparkSession
    parts = []
    for row in vectors.groupBy("dim").count().orderBy("dim").collect():  # one row per dimension
        dim, n = row["dim"], row["count"]
        own = vectors.where(F.col("dim") == dim)
        # a hash range expected to hold twice the sample, so no ordering of all rows
        share = (1 << 30) if n <= 2 * FIT_ROWS else max(1, (1 << 31) * FIT_ROWS // n)
        at = F.xxhash64("rep", "key")
        picked = own.where(F.pmod(at, F.lit(1 << 30)) < share).orderBy(at, "raw").limit(FIT_ROWS).select("raw").collect()
        tiling = Tiling(units([bytes(r["raw"]) for r in picked], dim), n, tile_rows)
        del picked
        parts.append(_dimension_links(own, tiling, dim, threshold, tile_rows))
    if not parts:
        return spark.createDataFrame([], "rep long, key long, links long, other long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _dimension_links(vectors: DataFrame, tiling: Tiling, dim: int, threshold: float,
                     tile_rows: int) -> DataFrame:
    lead_schema = ", ".join(f"l{k} double" for k in range(tiling.lead))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lead = tiling.leading(units(batch.column(3).to_pylist(), dim))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tiling.leaf(lead)), *(pa.array(c) for c in lead.T)],
                names=["rep", "key", "copies", "raw", "leaf", *(f"l{k}" for k in range(tiling.lead))])

    placed = staged(vectors.select("rep", "key", "copies", "raw").mapInArrow(
        place, f"rep long, key long, copies long, raw binary, leaf long, {lead_schema}"), "placed")
    bounds = [f(f"l{k}").alias(f"{name}{k}") for k in range(tiling.lead)
              for name, f in (("lo", F.min), ("hi", F.max))]
    leaves = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), *bounds).collect()  # MAX_LEAVES at most
    chunks = {r["leaf"]: max(1, -(-r["n"] // tile_rows)) for r in leaves}
    lo = {r["leaf"]: np.array([r[f"lo{k}"] for k in range(tiling.lead)]) for r in leaves}
    hi = {r["leaf"]: np.array([r[f"hi{k}"] for k in range(tiling.lead)]) for r in leaves}
    reach = 2 - 2 * threshold + SLACK
    near = []
    for x in chunks:
        for y in chunks:
            if x <= y:
                gap = np.maximum(0, np.maximum(lo[x] - hi[y], lo[y] - hi[x]))
                if (gap * gap).sum() <= reach:
                    near.append((x, y, chunks[x], chunks[y]))
    columns = list(zip(*near, strict=True)) or [()] * 4
    pairs = placed.sparkSession.createDataFrame(  # MAX_LEAVES squared over two at most
        pa.table({k: pa.array(c, pa.int64()) for k, c in zip(("x", "y", "nx", "ny"), columns, strict=True)}))
    n_chunks = F.create_map(*(F.lit(v) for kv in sorted(chunks.items()) for v in kv))
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("rep", "key"), F.element_at(n_chunks, F.col("leaf"))))

    def sides(leaf, other, mine, theirs, side):
        """A row of ``leaf`` goes to every chunk of the other leaf."""
        rows = placed.join(F.broadcast(pairs), placed["leaf"] == pairs[leaf]).where(
            F.lit(True) if side == 0 else F.col("x") != F.col("y"))
        return rows.withColumn("c", F.explode(F.sequence(F.lit(0), F.col(theirs) - 1))).select(
            "x", "y", F.when(F.lit(side == 0), F.col("chunk")).otherwise(F.col("c")).alias("cx"),
            F.when(F.lit(side == 0), F.col("c")).otherwise(F.col("chunk")).alias("cy"),
            "rep", "key", "copies", "raw", F.lit(side).alias("side"))

    first = sides("x", "y", "nx", "ny", 0)
    # within one leaf, chunk pairs are taken once: the lower chunk first
    inner = first.where("x = y").select(
        "x", "y", F.least("cx", "cy").alias("cx"), F.greatest("cx", "cy").alias("cy"), "rep", "key", "copies",
        "raw", F.when(F.col("cx") <= F.col("cy"), 0).otherwise(1).alias("side"))
    tiles = first.where("x <> y").unionByName(inner).unionByName(sides("y", "x", "ny", "nx", 1))

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        same = table["x"][0].as_py() == table["y"][0].as_py() and table["cx"][0].as_py() == table["cy"][0].as_py()
        side = table["side"].to_numpy()
        rep, key, copies = (table[c].to_numpy() for c in ("rep", "key", "copies"))
        unit = units(table["raw"].to_pylist(), dim)
        axes = unit @ tiling.axes
        ia = np.flatnonzero(side == 0)
        ib = ia if same else np.flatnonzero(side == 1)
        links = np.zeros(len(rep), dtype=np.int64)
        labels = np.arange(len(rep))
        if len(ia) and len(ib):
            for p, q in tile_links(unit[ia], unit[ib], same, axes[ia], axes[ib], tiling.lead, threshold):
                p, q = ia[p], ib[q]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                labels = min_labels(len(rep), p, q, labels)
        hit = np.flatnonzero(links)
        other = np.where(labels[hit] == hit, -1, labels[hit])
        return pa.table({
            "rep": rep[hit], "key": key[hit], "links": links[hit],
            "other": pa.array(rep[labels[hit]], mask=other < 0),
        })

    return tiles.groupBy("x", "y", "cx", "cy").applyInArrow(compare, "rep long, key long, links long, other long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per row: ``id_col, n_links, component_id, kept``."""
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = (
        F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(whole, F.lit(False))
        & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # -0.0 + 0.0 is 0.0: equal vectors get equal bytes
            raw = [None if not ok else (np.array(v, dtype=np.float64) + 0.0).tobytes()
                   for v, ok in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["id", "raw"])

    packed = staged(rows.withColumn("ok", valid).mapInArrow(pack, "id long, raw binary"), "vectors")
    distinct = packed.where("raw is not null").groupBy("raw").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    distinct = staged(distinct.select(
        "raw", "rep", F.xxhash64("raw").alias("key"), "copies",
        (F.length("raw") / 8).cast("int").alias("dim")), "distinct")
    found = staged(link_table(distinct, threshold, tile_rows), "tile-links")
    # copies of one vector link with each other; ids under one vector are one component
    counts = found.groupBy("rep", "key").agg(F.sum("links").alias("links"))
    groups = components(found.where("other is not null"), "rep", "other")
    named = (
        distinct.join(counts, ["rep", "key"], "left")
        .join(groups, distinct["rep"] == groups["node"], "left")
        .select("raw", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id"))
    )
    joined = packed.where("raw is not null").join(named, "raw").select("id", "n_links", "component_id")
    alone = packed.where("raw is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return joined.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
