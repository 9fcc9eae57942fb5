"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (with word borders) and itself,
each hashed to a row of an embedding matrix; a stretch of words is the average
of its words' averages, and a linear softmax over the two classes reads it.
Embeddings and softmax are trained jointly in numpy, so a misspelling never
seen shares the vectors of the n-grams it has in common with known words.

A single abusive word must count in a text of any length, so the average runs
over windows of ``WINDOW_WORDS`` words (half overlapping) and a document's
score is that of its worst window; training uses the same worst window after
a few rounds over all windows.  N-grams seen in fewer than ``MIN_DOCS``
training rows are left out (their vectors are zero), and all vectors decay, so
the words peculiar to one training row cannot carry its label.  A bag's average
counts ``DAMP`` zero vectors besides, so words of few n-grams weigh less.

A stretch without white space of over ``LONG_WORD`` characters (Chinese,
Japanese or Thai text, URLs, words joined by marks) is read whole, as words of
``PIECE_CHARS`` characters, each half over the one before, so an insult in it
weighs about what a spaced one does; where marks divide it, the parts between
them of at most ``LONG_WORD`` characters are words besides.

The model is fitted on a bounded, seeded sample of labelled rows (at most
``MAX_ROWS_PER_CLASS`` of each class and no row over ``MAX_TRAIN_CHARS``
characters, so the driver holds at most their product).  Scoring reads whole
texts.

Nulls: a null or empty text scores as a text without words, by the softmax
bias alone.  Null ids and repeated rows are scored like others; of rows sharing
an id and a label the smallest text is trained on.  Labelled
rows with a null label are not used; with labels of one class only, or none,
nothing can be told apart and every score is (nearly) 0.

Other columns are kept and may bear any name; one named like an added
column is replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.shared import WordMemo, map_arrow, sampled_ids, widened

MAX_ROWS_PER_CLASS = 800
MAX_TRAIN_CHARS = 6000
WINDOW_WORDS = 10
BUCKETS = 1 << 16
DIM = 4
GRAMS = (3, 4, 5)
MIN_DOCS = 3
WARM_ROUNDS = 10
ROUNDS = 60
RATE = 1.0
DAMP = 6
DECAY = 2e-3
CACHE_WORDS = 200_000
LONG_WORD = 40
PIECE_CHARS = 10
_EDGES = re.compile(r"^\W+|\W+$")
_PART = re.compile(r"[^\W_]+")


def word_buckets(word: str) -> list[int]:
    """Embedding rows of a bare word: the bordered word and its UTF-8 n-grams."""
    text = f"<{word}>".encode("utf-8", "replace")
    crc, n = zlib.crc32, len(text)
    return [crc(text) % BUCKETS] + [
        crc(text[i:i + k]) % BUCKETS for k in GRAMS for i in range(n - k + 1)]


def pieces(word: str) -> list[str]:
    """A long word as shorter ones in text order; every n-gram is in one whole."""
    step = PIECE_CHARS // 2
    found = [(at, word[at:at + PIECE_CHARS]) for at in range(0, len(word) - PIECE_CHARS + step, step)]
    parts = [(m.start(), m.group()) for m in _PART.finditer(word) if m.end() - m.start() <= LONG_WORD]
    return [w for _, w in sorted(found + parts)]


def words_of(text: str | None) -> list[str]:
    words = (text or "").lower().split()
    if max(map(len, words), default=0) <= LONG_WORD:
        return words
    return [p for w in words for p in (pieces(w) if len(w) > LONG_WORD else [w])]


def window_bounds(n: int, width: int = WINDOW_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of half-overlapping windows over ``n`` words."""
    starts = np.arange(0, max(n - width // 2, 1), width // 2)
    return starts, np.minimum(starts + width, n)


class SubwordSoftmax:
    """Joint model; ``margin`` of a word is its share of the class-1 margin."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32)
        self.weight = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
        self.bias = np.zeros(2, dtype=np.float32)

    def fit(self, texts: list[str], labels: np.ndarray) -> SubwordSoftmax:
        vocab: dict[str, int] = {}
        bags: list[np.ndarray] = []
        words, starts, ends, owner = [], [], [], []
        rows_with = np.zeros(BUCKETS, dtype=np.int64)
        at = 0
        for d, text in enumerate(texts):
            ws = []
            for w in words_of(text):
                i = vocab.setdefault(w, len(vocab))
                if i == len(bags):
                    bags.append(np.array(word_buckets(_EDGES.sub("", w)), dtype=np.int32))
                ws.append(i)
            rows_with[np.unique(np.concatenate([bags[i] for i in set(ws)] or [np.zeros(0, np.int32)]))] += 1
            s, e = window_bounds(len(ws))
            words.append(np.array(ws, dtype=np.int64))
            starts.append(s + at)
            ends.append(e + at)
            owner.append(np.full(len(s), d))
            at += len(ws)
        words = np.concatenate([*words, np.zeros(1, dtype=np.int64)])
        starts, ends, owner = map(np.concatenate, (starts, ends, owner))
        bags = bags or [np.zeros(1, dtype=np.int32)]
        known = rows_with >= min(MIN_DOCS, len(texts))
        self.embed[~known] = 0
        sizes = np.array([len(g) for g in bags])
        flat = np.concatenate(bags)
        held_by = np.repeat(np.arange(len(bags)), sizes)[known[flat]]
        flat = flat[known[flat]]
        used, flat = np.unique(flat, return_inverse=True)  # train on the known rows alone
        embed = self.embed[used]
        inverse = (1 / (sizes + DAMP)).astype(np.float32)[:, None]
        some, some_at = np.unique(held_by, return_index=True)
        length = np.maximum(ends - starts, 1).astype(np.float32)[:, None]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        one_hot = np.eye(2, dtype=np.float32)[labels]
        weight_of = (0.5 / np.bincount(labels, minlength=2))[labels].astype(np.float32)
        params = [embed, self.weight, self.bias]
        m = [np.zeros_like(p) for p in params]

        for step in range(1, WARM_ROUNDS + ROUNDS + 1):
            rate = RATE * (1 - (step - 1) / (WARM_ROUNDS + ROUNDS))
            vectors = np.zeros((len(bags), DIM), dtype=np.float32)
            vectors[some] = np.add.reduceat(embed[flat], some_at)
            vectors *= inverse
            sums = np.r_[np.zeros((1, DIM)), np.cumsum(vectors[words], axis=0, dtype=np.float64)]
            mean = ((sums[ends] - sums[starts]) / length).astype(np.float32)
            logits = mean @ self.weight + self.bias
            margin = logits[:, 1] - logits[:, 0]
            if step <= WARM_ROUNDS:
                chosen = np.arange(len(owner))
                share = weight_of[owner] / np.bincount(owner)[owner]
            else:
                worst = np.maximum.reduceat(margin, first)
                hit = np.flatnonzero(margin == worst[owner])
                chosen = hit[np.unique(owner[hit], return_index=True)[1]]
                share = weight_of[owner[chosen]]
            z = logits[chosen]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            delta = (p - one_hot[owner[chosen]]) * share[:, None]
            g_weight, g_bias = mean[chosen].T @ delta, delta.sum(axis=0)
            back = (delta @ self.weight.T) / length[chosen]
            # a window's gradient goes to each of its words, by differences
            slope = np.zeros((len(words) + 1, DIM))
            np.add.at(slope, starts[chosen], back)
            np.add.at(slope, ends[chosen], -back)
            per_place = np.cumsum(slope, axis=0)[:-1]
            g_word = np.stack([np.bincount(words, per_place[:, k], len(bags)) for k in range(DIM)], 1) * inverse
            spread = g_word[held_by]
            g_embed = np.stack([np.bincount(flat, spread[:, k], len(used)) for k in range(DIM)], 1)
            for i, (param, g) in enumerate(zip(params, (g_embed, g_weight, g_bias), strict=True)):
                # one step size for a whole matrix: rows that many texts agree
                # on move, rows of single texts hardly do
                m[i] = 0.8 * m[i] + 0.2 * g
                param -= rate * (1 if i == 0 else 0.1) * m[i] / (np.abs(m[i]).max(initial=0) + 1e-12)
            embed *= 1 - DECAY
        self.embed[used] = embed
        return self

    def tables(self) -> tuple[np.ndarray, float]:
        """Per-bucket margins and the bias margin: all that scoring needs."""
        return self.embed @ (self.weight[:, 1] - self.weight[:, 0]), float(self.bias[1] - self.bias[0])


class Scorer:
    """Scores texts from bucket margins, remembering words."""

    def __init__(self, margins: np.ndarray, bias: float):
        self._margins, self._bias = margins.tolist(), bias
        self._bare = WordMemo(self._bag, CACHE_WORDS)
        self._words = WordMemo(lambda w: self._bare.one(_EDGES.sub("", w)), CACHE_WORDS)

    def _bag(self, word: str) -> float:
        bag = word_buckets(word)
        return sum(map(self._margins.__getitem__, bag)) / (len(bag) + DAMP)

    def word(self, word: str) -> float:
        return self._words.one(word)

    def score(self, text: str | None) -> float:
        values = self._words.all(words_of(text))
        margin = self._bias
        if values:
            starts, ends = window_bounds(len(values))
            sums = np.r_[0.0, np.cumsum(values)]
            margin += float(((sums[ends] - sums[starts]) / (ends - starts)).max())
        return float(1 / (1 + np.exp(-np.clip(margin, -50, 50))))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id",
                  text_col: str = "text", per_class: int = MAX_ROWS_PER_CLASS,
                  max_chars: int = MAX_TRAIN_CHARS) -> DataFrame:
    """A bounded, seeded sample of labelled rows: ``text, y``.

    Labels are read only from rows whose ``crc32(id as text) mod 5`` is not 0.
    """
    known = labels.select(F.col(id_col), F.col(label).alias("y")).where(
        F.crc32(F.col(id_col).cast("string")) % 5 != 0)
    ids = [sampled_ids(known.where(F.col("y") == y), id_col, "train", per_class).withColumn("y", F.lit(y))
           for y in (0, 1)]
    return (
        docs.select(id_col, F.col(text_col).alias("text"))
        .join(F.broadcast(ids[0].unionByName(ids[1])), id_col)  # per_class ids of each class at most
        .where(F.length("text") <= max_chars).groupBy(id_col, "y").agg(F.min("text").alias("text")).select("text", "y")
    )


def fit(sample: DataFrame) -> tuple[np.ndarray, float]:
    """Train on a bounded sample ``text, y``; the tables for scoring."""
    rows = sorted((r["text"], int(r["y"])) for r in sample.collect())
    y = np.array([r[1] for r in rows], dtype=np.int64)
    if len(set(y.tolist())) < 2:
        return np.zeros(BUCKETS), -50.0
    return SubwordSoftmax().fit([r[0] for r in rows], y).tables()


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text",
          out: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score (0 to 1) of every whole text."""
    margins, bias = model[0].astype(np.float32), model[1]
    names = [c for c in docs.columns if c != out]
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(margins, bias)
        for batch in batches:
            scores = [scorer.score(t) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*names, out])

    kept = docs.select(*(F.col(f"`{c}`") for c in names))
    return map_arrow(kept, run, widened(kept.schema, (out, "double")))
