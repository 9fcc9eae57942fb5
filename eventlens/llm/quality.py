"""Quality classifier by positive-unlabelled learning.

Trusted positives (rows labelled 1) and unlabelled web text train a small
network on shape features of whole texts by minimising the non-negative
unbiased risk  prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)]);
while the second part is negative, its gradient is followed the other way.

The class prior is estimated from the two samples, or given as a parameter.
Networks told to separate positives from unlabelled texts rank every row, each
row by a network that did not see it (``FOLDS`` folds).  Above a rank, the
share of unlabelled over positive mass is lowest where only positives are
left: at the rank (holding at least ``MIN_MASS`` of the positives) whose upper
confidence bound on that ratio is lowest, the ratio is the prior.  Rows
labelled 0 have no part in it.

Features are computed in Spark over the whole text of every row; the driver
holds only the features of two bounded, seeded samples (``MAX_ROWS`` each).

Nulls: a null or empty text has all features 0 and is scored like any other.
Null ids and repeated rows are scored like others; of rows sharing an id the
smallest text is trained on.  Labelled rows with a null label are not used;
without positives every score is 0.5.

Other columns are kept and may bear any name; one named like an added
column is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from eventlens.llm.shared import map_arrow, sampled_ids, text_bytes, widened

MAX_ROWS = 6000
MIN_MASS = 0.1
FOLDS = 5
HIDDEN = 16
STEPS = 600
#: Bytes counted one by one.
MARKS = b".,;:!?#%&*$|/@<>()[]{}\"'-_=+~^0"


def features(text: bytes) -> np.ndarray:
    """Shape of one whole text: byte classes, marks, words, repetition, lines."""
    n = len(text)
    if not n:
        return np.zeros(len(MARKS) + 22, dtype=np.float32)
    byte = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    words = text.split()
    m = max(len(words), 1)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1, np.int64)
    counts = Counter(words)
    tops = [c for _, c in counts.most_common(3)] + [0, 0, 0]
    repeated = sum(map(bytes.__eq__, words, words[1:]))
    raised = sum(map(bytes.isupper, words))
    plain = sum(map(bytes.isalpha, words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    k = max(len(lines), 1)
    long_bytes = byte[128:].sum()
    values = [
        np.log1p(m), lengths.mean() / 10, lengths.std() / 10, (lengths == 1).mean(), (lengths > 12).mean(),
        (lengths > 30).mean(), len(counts) / m, len(counts) / np.sqrt(m) / 10, tops[0] / m, tops[1] / m, tops[2] / m,
        repeated / m, raised / m, plain / m,
        byte[65:91].sum() / n, byte[97:123].sum() / n, byte[48:58].sum() / n, long_bytes / n,
        byte[32] / n, byte[10] * 10 / m, len(set(lines)) / k, np.log1p(m / k),
    ]
    marks = byte[np.frombuffer(MARKS, dtype=np.uint8)] / m
    return np.concatenate([values, np.minimum(marks, 3)]).astype(np.float32)


class ShapeNet:
    """One hidden layer; ``margin`` is the log-odds of label 1."""

    def __init__(self, width: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.shift, self.scale = np.zeros(width), np.ones(width)
        self.params = [rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN),
                       rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.params
        return np.tanh((np.clip((x - self.shift) / self.scale, -8, 8)) @ a + b) @ c + d[0]

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> ShapeNet:
        """With a prior: non-negative unbiased risk; without: plain separation."""
        both = np.concatenate([positive, unlabelled]).astype(np.float64)
        self.shift, self.scale = both.mean(axis=0), both.std(axis=0) + 1e-3
        x = np.clip((both - self.shift) / self.scale, -8, 8)
        n_p, n_u = len(positive), len(unlabelled)
        m = [np.zeros_like(p) for p in self.params]
        v = [np.zeros_like(p) for p in self.params]
        for step in range(1, STEPS + 1):
            a, b, c, d = self.params
            h = np.tanh(x @ a + b)
            g = h @ c + d[0]
            p1 = 1 / (1 + np.exp(-np.clip(g, -40, 40)))
            # logistic loss: slope p1 - 1 for label 1, p1 for label 0
            slope = np.empty(n_p + n_u)
            if prior is None:
                slope[:n_p], slope[n_p:] = (p1[:n_p] - 1) / (2 * n_p), p1[n_p:] / (2 * n_u)
            else:
                negative = np.log1p(np.exp(np.clip(g, -40, 40)))
                excess = negative[n_p:].mean() - prior * negative[:n_p].mean()
                if excess >= 0:
                    slope[:n_p] = prior * (p1[:n_p] - 1 - p1[:n_p]) / n_p
                    slope[n_p:] = p1[n_p:] / n_u
                else:
                    slope[:n_p] = prior * p1[:n_p] / n_p
                    slope[n_p:] = -p1[n_p:] / n_u
            inner = np.outer(slope, c) * (1 - h * h)
            grads = [x.T @ inner + 1e-4 * a, inner.sum(axis=0), h.T @ slope + 1e-4 * c, slope.sum(keepdims=True)]
            rate = 0.02 if step < STEPS // 2 else 0.005
            for i, grad in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad * grad
                self.params[i] = self.params[i] - rate * (m[i] / (1 - 0.9**step)) / (
                    np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        return self


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled: the ratio of unlabelled to
    positive mass above the score where it is surely smallest, by two standard
    errors.  Every row is scored by a network fitted without its fold."""
    p, u = np.empty(len(positive)), np.empty(len(unlabelled))
    for fold in range(FOLDS):
        own_p, own_u = np.arange(len(p)) % FOLDS == fold, np.arange(len(u)) % FOLDS == fold
        net = ShapeNet(positive.shape[1]).fit(positive[~own_p], unlabelled[~own_u], None)
        p[own_p], u[own_u] = net.margin(positive[own_p]), net.margin(unlabelled[own_u])
    p.sort()
    u.sort()
    at = np.quantile(p, np.linspace(0, 1 - MIN_MASS, 200))
    above_p = 1 - np.searchsorted(p, at) / len(p)
    above_u = 1 - np.searchsorted(u, at) / len(u)
    error = np.sqrt(above_u * (1 - above_u) / len(u)) + np.sqrt(above_p * (1 - above_p) / len(p))
    best = np.argmin((above_u + 2 * error) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.98))


def with_features(docs: DataFrame, text_col: str = "text", out: str = "features") -> DataFrame:
    """All columns of ``docs`` but the text, and its features."""
    names = [c for c in docs.columns if c not in (text_col, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t) for t in text_bytes(batch.column(len(names)))]
            flat = np.concatenate(rows) if rows else np.zeros(0, np.float32)
            width = len(rows[0]) if rows else 0
            lists = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * width, pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*names, out])

    kept = docs.select(*(F.col(f"`{c}`") for c in [*names, text_col]))
    return map_arrow(kept, run, widened(kept.drop(text_col).schema, (out, ArrayType(FloatType()))))


def _sample(rows: DataFrame, docs: DataFrame, id_col: str, text_col: str, salt: str, limit: int) -> np.ndarray:
    """Features of at most ``limit`` documents whose ids are in ``rows``."""
    picked = docs.join(F.broadcast(sampled_ids(rows, id_col, salt, limit)), id_col)
    picked = picked.groupBy(id_col).agg(F.min(f"`{text_col}`").alias(text_col))  # of repeated ids the first text
    found = sorted(tuple(r["features"]) for r in with_features(picked.select(text_col), text_col).collect())
    mixed = np.random.default_rng(5).permutation(len(found))
    return np.array(found, dtype=np.float32)[mixed] if found else np.zeros((0, len(MARKS) + 22), np.float32)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", prior: float | None = None, limit: int = MAX_ROWS) -> ShapeNet | None:
    """Train; labels are read only from rows whose ``crc32(id as text) mod 5``
    is not 0, and of these only the positives' texts."""
    trusted = labels.where((F.col(label) == 1) & (F.crc32(F.col(id_col).cast("string")) % 5 != 0))
    texts = docs.select(id_col, text_col)
    positive = _sample(trusted, texts, id_col, text_col, "p", limit)
    unlabelled = _sample(texts, texts, id_col, text_col, "u", limit)
    if len(positive) < 2 or len(unlabelled) < 2:
        return None
    if prior is None:
        prior = estimate_prior(positive, unlabelled)
    net = ShapeNet(positive.shape[1]).fit(positive, unlabelled, prior)
    net.prior = prior
    return net


def score(docs: DataFrame, net: ShapeNet | None, text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` but the text, and the score (0 to 1) of every
    whole text."""
    names = [c for c in docs.columns if c not in (text_col, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(len(names)))
            if net is None or not texts:
                scores = np.full(len(texts), 0.5)
            else:
                margin = net.margin(np.stack([features(t) for t in texts]))
                scores = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*names, out])

    kept = docs.select(*(F.col(f"`{c}`") for c in [*names, text_col]))
    return map_arrow(kept, run, widened(kept.drop(text_col).schema, (out, "double")))
