"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased and read as words of letters; every other character ends
a word.  The n-grams of ``GRAMS`` characters of a word with a border before and
after it are hashed to ``BUCKETS``.  Training counts the hashed n-grams of all
labelled rows per language: a task adds up its own counts and passes on one row
per language and bucket met, Spark adds these up, and the table (languages x
buckets, smoothed by ``ALPHA``) goes to the scoring tasks as one broadcast of
log-probabilities.  Its size is bounded by ``MAX_LANGS`` x ``BUCKETS``; more
labels raise an error, none is left out.

Scoring is sparse: a batch's texts are bucket indices and the place where each
text starts; the log-probabilities of the indices are added up text by text.
Whole texts are read, in blocks of ``BLOCK`` characters.  ``score`` is the
posterior of the language named, by the log-prior of the languages' documents.

Nulls: a null text, or one without a letter, is ``und`` with score 0; a null
language is not learned from.  Texts of equal posterior get the language that
sorts first.  Null ids and repeated rows are scored like others, and each
repeated row counts in training.  Without training rows every text is ``und``.

Other columns are kept and may bear any name; one named like an added
column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.shared import map_arrow, widened

GRAMS = (1, 2, 3, 4)
BUCKETS = 1 << 15
ALPHA = 0.5
MAX_LANGS = 256
BLOCK = 1 << 18
#: Odd 64-bit multiplier of the n-gram hash.
MIX = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = "und"


@cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket indices of all n-grams of lower-case texts, and each one's text."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype="<u4")
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    letter = letters()[codes]
    # one border between words; a text's end is a border too
    same = np.r_[False, owner[1:] == owner[:-1]]
    places = np.flatnonzero(letter)
    if not len(places):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = np.r_[True, (np.diff(places) > 1) | ~same[places[1:]]]
    at = np.arange(len(places)) + np.cumsum(gap)  # a border before each word
    line = np.zeros(at[-1] + 2, dtype=np.uint64)
    line[at] = codes[places]
    whose = np.zeros(len(line), dtype=np.int64)
    whose[at] = owner[places]
    found, of = [], []
    inner = line > 0
    whole = np.ones(len(line), dtype=bool)  # no border inside the n-gram
    h = np.zeros(len(line), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        size = len(line) - n + 1
        h = (h[:size] ^ line[n - 1:]) * MIX
        h ^= h >> np.uint64(31)
        whole = whole[:size] & inner[n - 2:n - 2 + size] if n > 2 else whole[:size]
        if n in GRAMS:
            keep = whole if n > 2 else inner[:size] | inner[n - 1:]
            start = np.flatnonzero(keep)
            found.append((h[start] & np.uint64(BUCKETS - 1)).astype(np.int64))
            of.append(np.where(inner[start], whose[start], whose[np.minimum(start + 1, len(line) - 1)]))
    return np.concatenate(found), np.concatenate(of)


def blocks(texts: list[str | None], size: int = BLOCK) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Portions of about ``size`` characters: the text numbers and the pieces.

    A text longer than that is cut between words, so that no n-gram is lost; a
    word longer than a block is cut with an overlap of no characters (its two
    pieces count as words)."""
    numbers, pieces, held = [], [], 0
    for i, text in enumerate(texts):
        text = (text or "").lower()
        at = 0
        while at < len(text):
            end = min(len(text), at + size)
            if end < len(text):
                cut = end
                while cut > at and text[cut - 1].isalpha():
                    cut -= 1
                end = cut if cut > at else end
            numbers.append(i)
            pieces.append(text[at:end])
            held += end - at
            at = end
            if held >= size:
                yield np.array(numbers), pieces
                numbers, pieces, held = [], [], 0
    if pieces:
        yield np.array(numbers), pieces


class NaiveBayes:
    """Languages in order, and log-probabilities: languages x buckets, priors."""

    def __init__(self, langs: list[str], counts: np.ndarray, docs: np.ndarray):
        self.langs = langs
        smooth = counts + ALPHA
        self.table = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
        self.prior = np.log(docs / docs.sum())

    def classify(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        margin = np.tile(self.prior, (len(texts), 1))
        met = np.zeros(len(texts), dtype=bool)
        for numbers, pieces in blocks(texts):
            index, of = grams(pieces)
            met[numbers[of]] = True
            for k, row in enumerate(self.table):
                np.add.at(margin[:, k], numbers, np.bincount(of, row[index], len(pieces)))
        best = margin.argmax(axis=1)
        odds = np.exp(margin - margin.max(axis=1, keepdims=True))
        score = np.where(met, 1 / odds.sum(axis=1), 0.0)
        return [self.langs[b] if m else UNKNOWN for b, m in zip(best.tolist(), met.tolist(), strict=True)], score


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> NaiveBayes | None:
    """Count the n-grams of all ``rows`` with a language; None without any."""
    known = rows.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text")).where(
        "lang is not null")
    found = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(MAX_LANGS + 1).collect()
    if len(found) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages to learn")
    if not found:
        return None
    number = {r["lang"]: i for i, r in enumerate(found)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(number), BUCKETS), dtype=np.int64)
        for batch in batches:
            lang = np.array([number[v] for v in batch.column(0).to_pylist()], dtype=np.int64)
            for numbers, pieces in blocks(batch.column(1).to_pylist()):
                index, of = grams(pieces)
                np.add.at(counts.reshape(-1), lang[numbers[of]] * BUCKETS + index, 1)
        row, bucket = np.nonzero(counts)
        for at in range(0, len(row), 1 << 16):
            r, b = row[at:at + (1 << 16)], bucket[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(r.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(counts[r, b])],
                names=["lang", "bucket", "n"])

    table = known.mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toArrow()  # MAX_LANGS x BUCKETS rows at most
    counts = np.zeros((len(number), BUCKETS), dtype=np.float64)
    counts[table["lang"].to_numpy(), table["bucket"].to_numpy()] = table["n"].to_numpy()
    return NaiveBayes(list(number), counts, np.array([r["n"] for r in found], dtype=np.float64))


def identify(docs: DataFrame, model: NaiveBayes | None, text_col: str = "text", out: str = "lang_pred",
             score: str = "score") -> DataFrame:
    """All columns of ``docs`` but the text, with the language and its score;
    columns of ``docs`` bearing those two names are replaced."""
    names = [c for c in docs.columns if c not in (text_col, out, score)]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bayes = shared.value
        for batch in batches:
            texts = batch.column(len(names)).to_pylist()
            langs, scores = bayes.classify(texts) if bayes and texts else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*names, out, score])

    kept = docs.select(*(F.col(f"`{c}`") for c in [*names, text_col]))
    return map_arrow(kept, run, widened(kept.drop(text_col).schema, (out, "string"), (score, "double")))
