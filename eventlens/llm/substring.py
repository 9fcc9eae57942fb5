"""Substring dedup: sliding runs of consecutive sentences.

A unit is a sentence (ended by ``.``, ``!`` or ``?`` before white space, or by
a line end).  Sentences of more than ``UNIT_WORDS`` words are cut by content:
of any ``UNIT_WORDS`` neighbouring word borders the one whose two words hash
lowest is a cut, so no unit is longer and a passage is cut at the same places
wherever in a sentence it begins, but for at most ``UNIT_WORDS`` + 1 words at
either end.  A run is a stretch of consecutive units of at least ``MIN_UNITS``
units and ``MIN_WORDS`` words: for every unit the shortest run that starts
there, and its extensions up to where the next unit's shortest run ends, so
any repeated stretch is covered to its last unit.  Runs are hashed (64 bits;
words compared with ASCII case folded and white space as one blank).

Limit: words are parted by ASCII white space and sentences end at ASCII marks,
so a line of Chinese or Japanese without blanks is one unit of one word, and a
passage repeated there goes only from ``MIN_WORDS`` such lines on.

A run belongs to the document with the smallest id that holds it, at its first
place there.  Units covered by a run anywhere else are removed.  Rows sharing
an id count as one document for this order.

Hashes are combined per task before they are shuffled, so a passage shared by
a third of all documents is one small group; its rows are one skewed join side
that AQE splits.

Nulls: a null text stays null, a row with a null id is returned unchanged and
takes no part.  Empty texts have no units.  Repeated rows share an id and are
all kept (exact duplicates of documents are another operator's work).

Other columns are kept and may bear any name; one named like an added
column is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.shared import map_arrow, staged, text_bytes, widened

MIN_UNITS = 3
MIN_WORDS = 20
UNIT_WORDS = 16
CUT_SEED = 0
_END = re.compile(rb"[.!?]+(?=\s)|\n")
_WORD = re.compile(rb"\S+")


def cuts(words: list[bytes]) -> list[int]:
    """Places, as counts of words before them, where a long sentence is cut."""
    hashed = xxhash.xxh64_intdigest
    values = [hashed(a + b" " + b, CUT_SEED) for a, b in pairwise(words)]
    out, low = [], -1
    for stop in range(UNIT_WORDS, len(values) + 1):
        if low < stop - UNIT_WORDS:
            low = min(range(stop - UNIT_WORDS, stop), key=values.__getitem__)
        elif values[stop - 1] < values[low]:
            low = stop - 1
        else:
            continue
        out.append(low + 1)
    return out


def units(text: bytes) -> tuple[list[int], list[int], list[bytes]]:
    """Ends, word counts and keys of a text's units; white space after a unit
    belongs to it, white space before the first unit to the first."""
    ends, counts, keys = [], [], []
    folded, start = text.lower(), 0
    for stop in [*(m.end() for m in _END.finditer(text)), len(text)]:
        words = folded[start:stop].split()
        n = len(words)
        if not n:
            if ends:
                ends[-1] = stop
        elif n <= UNIT_WORDS:
            ends.append(stop)
            counts.append(n)
            keys.append(b" ".join(words))
        else:
            places = [m.start() for m in _WORD.finditer(folded, start, stop)]
            places.append(stop)
            for at, to in pairwise([0, *cuts(words), n]):
                ends.append(places[to])
                counts.append(to - at)
                keys.append(b" ".join(words[at:to]))
        start = stop
    if ends:
        ends[-1] = len(text)
    return ends, counts, keys


def runs(counts: list[int], keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First unit, last unit and hash of every run of a text."""
    n = len(counts)
    empty = np.zeros(0, dtype=np.int64)
    if n < MIN_UNITS:
        return empty, empty, empty
    total = np.r_[0, np.cumsum(counts)]
    by_words = np.searchsorted(total, total[:-1] + MIN_WORDS, side="left") - 1
    last = np.maximum(by_words, np.arange(n) + MIN_UNITS - 1)  # n or more: none
    starts = np.flatnonzero(last < n)
    if not len(starts):
        return empty, empty, empty
    last = last[starts]
    until = np.r_[last[1:], n]  # the next unit's shortest run ends here
    length = np.maximum(until - last, 1)
    first = np.repeat(starts, length)
    step = np.arange(len(first)) - np.repeat(np.cumsum(length) - length, length)
    stop = np.repeat(last, length) + step
    digest = xxhash.xxh64_digest
    units_hashed = b"".join([digest(k) for k in keys])
    hashed = xxhash.xxh64_intdigest
    values = [hashed(units_hashed[8 * a:8 * b + 8]) for a, b in zip(first.tolist(), stop.tolist(), strict=True)]
    return first, stop, np.array(values, dtype=np.uint64).view(np.int64)


def run_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``run, doc``: each run of each document once."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owner = [], []
            for doc, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                _, counts, keys = units(text)
                values = np.unique(runs(counts, keys)[2])
                found.append(values)
                owner.append(np.full(len(values), doc, dtype=np.int64))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found)), pa.array(np.concatenate(owner))], names=["run", "doc"])

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), text_col)
    return rows.mapInArrow(go, "run long, doc long")


def cut_text(text: bytes, gone: np.ndarray) -> tuple[bytes, int]:
    """The text without units covered by a repeated run, and how many units
    went: runs in ``gone``, and later places of a run of the text itself."""
    ends, counts, keys = units(text)
    first, stop, values = runs(counts, keys)
    if not len(values):
        return text, 0
    repeated = np.ones(len(values), dtype=bool)
    repeated[np.unique(values, return_index=True)[1]] = False
    hit = np.flatnonzero(repeated | np.isin(values, gone))
    if not len(hit):
        return text, 0
    change = np.zeros(len(ends) + 1, dtype=np.int64)
    np.add.at(change, first[hit], 1)
    np.add.at(change, stop[hit] + 1, -1)
    covered = np.cumsum(change)[:-1] > 0
    starts = [0, *ends[:-1]]
    kept = b"".join([text[a:b] for a, b, c in zip(starts, ends, covered, strict=True) if not c])
    return kept, int(covered.sum())


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   removed_col: str = "units_removed") -> DataFrame:
    """All columns of ``docs`` with ``text_col`` cut, and ``removed_col``, the
    number of units taken out."""
    table = staged(run_table(docs, id_col, text_col), "runs")
    owners = (
        table.groupBy("run").agg(F.min("doc").alias("owner"), F.max("doc").alias("top"))
        .where("owner < top").select("run", "owner")
    )
    gone = (
        table.join(owners, "run").where("doc <> owner")
        .groupBy("doc").agg(F.collect_set("run").alias("gone"))
    )
    names = [c for c in docs.columns if c != removed_col]
    at = names.index(text_col)
    rows = docs.select(*(F.col(f"`{c}`") for c in names))
    joined = rows.join(gone, rows[f"`{id_col}`"] == gone["doc"], "left").select(
        *(rows[f"`{c}`"] for c in names), gone["gone"])
    id_at = names.index(id_col)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            lists = batch.column(len(names))
            for i, (doc, text) in enumerate(
                    zip(batch.column(id_at).to_pylist(), text_bytes(batch.column(at)), strict=True)):
                gone_here = lists[i].values
                hashes = np.zeros(0, dtype=np.int64) if gone_here is None else gone_here.to_numpy()
                text, n = (text, 0) if doc is None else cut_text(text, hashes)
                texts.append(text)
                counts.append(n)
            was = batch.column(at)
            new = pa.array(texts, pa.binary(), mask=np.array(was.is_null())).cast(was.type)
            columns = [*batch.columns[:at], new, *batch.columns[at + 1:len(names)], pa.array(counts, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, removed_col])

    return map_arrow(joined, go, widened(rows.schema, (removed_col, "integer")))
