"""Count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates every vocabulary piece in a text; dynamic
programming over character positions carries the best score and the number of
pieces of the best path, never the path.  The rules are those of the public
``tokenizers`` unigram model: at a position the path with the strictly larger
score wins, starts being considered from left to right, so ties keep the
earliest start; a character that is no piece itself may be skipped at the
smallest score minus 10; with byte fallback such a character counts one piece
per byte, without it a run of them counts one piece.

Texts are normalised as usual for such vocabularies: one mark is put before a
non-empty text and every blank becomes the mark.  Where no piece has the mark
after another character, a best path never crosses into a mark, so a text's
path is that of its words; words are remembered.  Scores are multiples of
1/1024, whose sums are exact, so word-wise and whole-text sums are equal.

No public unigram file is at hand: ``unigram_vocabulary`` takes the pieces of a
public BPE file, with scores made from their ranks.

Nulls: a null or empty text has 0 pieces and score 0.  Null ids and repeated
rows are counted like others.

Other columns are kept and may bear any name; one named like an added
column is replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.shared import WordMemo, map_arrow, widened

MARK = "▁"
UNKNOWN = "<unk>"
UNK_PENALTY = 10.0
CACHE_WORDS = 250_000
_WORD = re.compile(r" *[^ \n]+| +|\n")


def unigram_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores from a public vocabulary file: its order is a rank of
    frequency, and by rule piece r scores ``-ln(r + 2)``, rounded to 1/1024.
    The unknown piece comes first, then the byte pieces, then the ordinary ones."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.vocab_size())
    byte = [model.id_to_piece(i) for i in ids if model.is_byte(i)]
    plain = [model.id_to_piece(i) for i in ids
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    worst = -round(1024 * math.log(len(plain) + 2)) / 1024
    return [(UNKNOWN, 0.0), *((b, worst) for b in byte),
            *((p, -round(1024 * math.log(r + 2)) / 1024) for r, p in enumerate(plain))]


class PieceCounter:
    """Number of pieces and best score of texts under a unigram vocabulary.

    The first vocabulary entry is the unknown piece."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = True,
                 cache_words: int = CACHE_WORDS):
        scores = dict(vocabulary)
        self._automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            if piece:
                self._automaton.add_word(piece, (len(piece), score))
        self._automaton.make_automaton()
        self._single = {p for p in scores if len(p) == 1}
        self._unknown = min(scores.values()) - UNK_PENALTY
        self._bytes = byte_fallback and all(f"<0x{b:02X}>" in scores for b in range(256))
        exact = all(float(s * 1024).is_integer() for s in scores.values())
        inner = any(MARK in p.lstrip(MARK) for p in scores)
        lines = not any("\n" in p for p in scores)
        self._by_word = exact and not inner and lines and MARK in scores and self._bytes
        self._words = WordMemo(lambda w: self._best(w.replace(" ", MARK)), cache_words)

    def _best(self, text: str) -> tuple[int, float]:
        """Pieces and score of the best path over ``text`` (already marked)."""
        n = len(text)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end, piece in self._automaton.iter(text):  # longest first per end
            ending[end + 1].append(piece)
        best, count, skipped = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            top, pieces, skip = None, 0, False
            for length, score in ending[end]:
                value = best[end - length] + score
                if top is None or value > top:
                    top, pieces = value, count[end - length] + 1
            char = text[end - 1]
            if char not in self._single:
                value = best[end - 1] + self._unknown
                if top is None or value > top:
                    top, skip = value, True
                    if self._bytes:
                        pieces = count[end - 1] + len(char.encode("utf-8", "replace"))
                    else:
                        pieces = count[end - 1] + (not skipped[end - 1])
            best[end], count[end], skipped[end] = top, pieces, skip
        return count[n], best[n]

    def count(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        if not self._by_word:
            return self._best(MARK + text.replace(" ", MARK))
        # a mark written in the text is a mark like a blank's
        found = self._words.all(_WORD.findall(" " + text.replace(MARK, " ")))
        return sum(f[0] for f in found), sum(f[1] for f in found)


def count_tokens(docs: DataFrame, vocabulary_path: str, text_col: str = "text",
                 count_col: str = "n_tokens", score_col: str = "best_score") -> DataFrame:
    """All columns of ``docs`` but the text, the number of pieces of each whole
    text and the score of its best path."""
    names = [c for c in docs.columns if c not in (text_col, count_col, score_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(unigram_vocabulary(vocabulary_path))
        for batch in batches:
            found = [counter.count(t) for t in batch.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.array([f[0] for f in found], dtype=np.int64)),
                 pa.array(np.array([f[1] for f in found], dtype=np.float64))],
                names=[*names, count_col, score_col])

    kept = docs.select(*(F.col(f"`{c}`") for c in [*names, text_col]))
    schema = widened(kept.drop(text_col).schema, (count_col, "long"), (score_col, "double"))
    return map_arrow(kept, run, schema)
