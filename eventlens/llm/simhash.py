"""SimHash near-duplicates: byte-position inverted index, count filter, bit check.

A 64-bit fingerprint has eight bytes.  Two fingerprints that differ in at
most four bits share at least four of the eight positional bytes: the
guaranteed minimum.  The index lists each distinct fingerprint under its bytes
by position; as the first of four shared positions is one of the first five,
five postings a fingerprint suffice.  The pairs of a posting are tallied by
shared positional bytes, pairs with fewer than four are dropped, the rest is
verified by differing bits.  A posting passes on a spanning forest of its
links, never its pairs.

A posting of one byte holds a 256th of all fingerprints, and its pairs grow
with the square of their number.  So a posting of more than ``split_above``
fingerprints is split by the next shared position: its members are listed
under the (position, byte) pairs that follow, up to the four bytes which any
linked pair shares.  However many fingerprints there are, each meets at most
``split_above`` others in a posting that can still be split.

Only fingerprints of which more than ``dense`` agree in four bytes are left:
large clusters of close ones.  Two differ in at most four bits exactly if some
64-bit word lies within two bits of both, so each is listed under the 2,081
words within two bits of it, and those under a word are linked to its smallest
one.  This is exact, and linear in the number of such fingerprints.

Nulls: a null text counts as empty.  A null id keeps its row and fingerprint,
its ``component_id`` is null and it links with nothing.  Rows that share an id
are separate rows under one label.

Other columns are not read and may bear any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm.shared import components, min_labels, staged, text_bytes

BITS = 64
BYTES = 8
MAX_BITS = 4
SHINGLE_WORDS = 4
SEED = 42
#: Bytes that any two linked fingerprints share.
SHARED = BYTES - MAX_BITS
SPLIT_ABOVE = 64
DENSE = 4096
PAIRS_AT_ONCE = 1 << 20


def shared_positions(depth: int) -> list[tuple[int, ...]]:
    """What the first ``depth`` of a pair's ``SHARED`` or more shared byte
    positions can be."""
    return list(combinations(range(BYTES - SHARED + depth), depth))


def _byte_mask(positions: tuple[int, ...]) -> int:
    """A signed 64-bit mask of the bytes at ``positions``, the first byte highest."""
    mask = sum(255 << 8 * (BYTES - 1 - i) for i in positions)
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def simhash(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one text: majority of the bits of its shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[s:e], SEED)
         for s, e in zip(starts[: -width + 1 or None].tolist(), ends[width - 1:].tolist(), strict=True)],
        dtype=np.uint64,
    )
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, BYTES)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = SHINGLE_WORDS) -> DataFrame:
    """``id_col, fp``: the fingerprint of every row as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [simhash(t, width) for t in text_bytes(batch.column(1))]
            fp = pa.array(np.array(fps, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), fp], names=[id_col, "fp"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, f"`{id_col}` long, fp long")


def _postings(reps: DataFrame, depth: int) -> DataFrame:
    """``part, word, parent_part, parent_word, fp, rep``: each fingerprint under
    its bytes at ``depth`` positions (``part`` says which, ``word`` holds the
    bytes), with the posting of one position less that this one splits."""
    parents = {p: i for i, p in enumerate(shared_positions(depth - 1))}
    lists = F.array(*(
        F.struct(F.lit(i).alias("part"), F.lit(_byte_mask(p)).cast("long").alias("mask"),
                 F.lit(parents[p[:-1]]).alias("parent"), F.lit(_byte_mask(p[:-1])).cast("long").alias("above"))
        for i, p in enumerate(shared_positions(depth))))
    return reps.select("fp", "rep", F.explode(lists).alias("at")).select(
        F.col("at.part").alias("part"), F.col("fp").bitwiseAND(F.col("at.mask")).alias("word"),
        F.col("at.parent").alias("parent_part"), F.col("fp").bitwiseAND(F.col("at.above")).alias("parent_word"),
        "fp", "rep")


def _linked(fp_a: np.ndarray, fp_b: np.ndarray) -> np.ndarray:
    """Count filter on shared positional bytes, then the exact bit check."""
    differing = fp_a ^ fp_b
    shared = (differing.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    close = shared >= BYTES - MAX_BITS
    close[close] = np.bitwise_count(differing[close]) <= MAX_BITS
    return close


def _forest(first: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """Labels over rows sorted by posting, ``first`` marking where one begins:
    smallest row linked within a posting."""
    n = len(first)
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    size = np.diff(np.r_[np.flatnonzero(first), n])
    end = start + size[np.cumsum(first) - 1]
    labels = np.arange(n)
    ga, gb, held, step = [], [], 0, 1
    left = np.arange(n)
    while True:
        left = left[left + step < end[left]]
        if len(left):
            for at in range(0, len(left), PAIRS_AT_ONCE):
                a = left[at:at + PAIRS_AT_ONCE]
                a = a[_linked(fp[a], fp[a + step])]
                ga.append(a)
                gb.append(a + step)
                held += len(a)
        if held > PAIRS_AT_ONCE or not len(left):
            if ga:
                labels = min_labels(n, np.concatenate(ga), np.concatenate(gb), labels)
            ga, gb, held = [], [], 0
        if not len(left):
            return labels
        step += 1


def _posting_links(postings: DataFrame) -> DataFrame:
    """``a, b``: spanning links of every (bounded) posting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(first, fp, rep):
            labels = _forest(first, fp)
            moved = np.flatnonzero(labels != np.arange(len(labels)))
            return pa.RecordBatch.from_arrays(
                [pa.array(rep[moved]), pa.array(rep[labels[moved]])], names=["a", "b"])

        held = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            part, word, fp, rep = cols
            if not len(part):
                continue
            first = np.r_[True, (part[1:] != part[:-1]) | (word[1:] != word[:-1])]
            cut = int(np.flatnonzero(first)[-1])  # the last posting may go on
            held = [c[cut:] for c in cols]
            if cut:
                yield links(first[:cut], fp[:cut].view(np.uint64), rep[:cut])
        if held is not None:
            yield links(np.arange(len(held[0])) == 0, held[2].view(np.uint64), held[3])

    rows = postings.select("part", "word", "fp", "rep").repartition("part", "word")
    return rows.sortWithinPartitions("part", "word").mapInArrow(run, "a long, b long")


def _dense_links(dense: DataFrame) -> DataFrame:
    """``a, b``: links among fingerprints ``fp``, through the words within two
    bits of each."""
    bits = [1 << b for b in range(BITS)]
    flips = np.array([0, *bits, *(x | y for x, y in combinations(bits, 2))], dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                fp, rep = (c.to_numpy(zero_copy_only=False) for c in batch.slice(at, 256).columns)
                words = (fp.view(np.uint64)[:, None] ^ flips).ravel().view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words), pa.array(np.repeat(rep, len(flips)))], names=["word", "rep"])

    words = dense.select("fp", "rep").mapInArrow(run, "word long, rep long")
    low = (
        words.groupBy("word").agg(F.min("rep").alias("b"), F.max("rep").alias("top"))
        .where("b <> top").select("word", "b")
    )
    return words.join(low, "word").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct()


def fingerprint_links(reps: DataFrame, split_above: int = SPLIT_ABOVE, dense: int = DENSE) -> DataFrame:
    """``a, b``: links that connect the ids ``rep`` of distinct fingerprints
    ``fp`` exactly as all pairs within ``MAX_BITS`` bits would."""
    links, large = None, None
    for depth in range(1, SHARED + 1):
        postings = _postings(reps, depth)
        if large is not None:
            above = large.select(F.col("part").alias("parent_part"), F.col("word").alias("parent_word"))
            postings = postings.join(above, ["parent_part", "parent_word"], "left_semi")
        limit = split_above if depth < SHARED else dense
        sizes = postings.groupBy("part", "word").count()
        large = staged(sizes.where(F.col("count") > limit).select("part", "word"), "large-postings")
        found = _posting_links(postings.join(large, ["part", "word"], "left_anti"))
        links = found if links is None else links.unionByName(found)
        if large.isEmpty():
            return links
    clusters = postings.join(large, ["part", "word"], "left_semi").select("fp", "rep").distinct()
    return links.unionByName(_dense_links(clusters))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       width: int = SHINGLE_WORDS, **index) -> DataFrame:
    """``id_col, fingerprint`` (16 hex digits) and ``component_id``, the
    smallest id reachable over links of at most ``MAX_BITS`` bits; one row per
    input row.  ``index``: options of ``fingerprint_links``."""
    fps = staged(fingerprints(docs, id_col, text_col, width), "fingerprints")
    reps = staged(
        fps.where(F.col(id_col).isNotNull()).groupBy("fp").agg(F.min(id_col).alias("rep")), "reps")
    groups = components(fingerprint_links(reps, **index))
    named = (
        reps.join(groups, reps["rep"] == groups["node"], "left")
        .select("fp", F.coalesce("component", "rep").alias("component_id"))
    )
    return fps.join(named, "fp", "left").select(
        id_col,
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col(id_col).isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       **options) -> DataFrame:
    """The rows of ``docs`` that lead their near-duplicate group, all columns.

    A group keeps its smallest id; of several rows with that id, one (the
    first by text, then by the other columns).  Rows with a null id stay.
    """
    groups = simhash_components(docs, id_col, text_col, **options)
    leaders = groups.where(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
    # the whole row as one value, so no column of docs can clash with ours
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    kept = rows.join(leaders.withColumnRenamed(id_col, "id"), "id", "left_semi")
    others = sorted(c for c in docs.columns if c not in (id_col, text_col))
    order = [F.col("row")[text_col], *(F.to_json(F.struct(F.col("row")[c].alias("v"))) for c in others)]
    ranked = kept.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy(*order))).where("n = 1")
    return ranked.select("row").unionByName(rows.where("id is null").select("row")).select("row.*")
