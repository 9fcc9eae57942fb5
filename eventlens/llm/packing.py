"""Sum-of-squares packing of tokenised documents into fixed windows.

Every document is tokenised, ended with one separator id and cut: each whole
window's worth becomes a sequence of its own, the rest is placed online.  A
placement chooses, among the fill levels that hold an open window (and the
level of a new window), the one that makes the sum of squared counts of
partially filled windows smallest; the counts live in a level array, ties go
to the fullest window.  Past ``MAX_OPEN`` open windows, and at the end of a
partition, the open windows are merged: pieces of the emptiest are cut to fill
the fullest, which leaves one partial window to go on with, and so at most one
padded window per partition of any size.

Packing is online per input partition: no shuffle, memory bounded by the pieces
of ``MAX_OPEN`` open windows, and a lost task is redone from its own input alone.  Sequence ids combine the partition and a counter.

Nulls: a null text is empty and yields one piece holding the separator.  A
null id or a repeated id is packed like any other row.

Other columns are not read and may bear any name.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.shared import text_bytes

WINDOW = 2048
SEPARATOR = 1
MAX_OPEN = 1024
CACHE_WORDS = 1_000_000
JOINED = 256  # words of one tokenizer call
PORTION_BYTES = 1 << 22
ID_BYTES = 4
#: ASCII marks that form a pre-token of their own after a letter or digit.
TAIL_MARKS = b".,!?;:)%$&*#"

SCHEMA = ("start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


class WordEncoder:
    """Token ids (little-endian 32-bit) of texts, remembered per word.

    The tokenizer drops white space and never merges across it, so a text's
    ids are those of its ASCII-blank-separated words; a run of ASCII marks
    ending a word is likewise a pre-token of its own.  Texts that may hold a
    special token's string are encoded whole.

    Arrow splits a portion of texts and numbers its distinct words; only these
    are looked up, and the ids put in the place of each word are the texts' ids
    one after another.

    The words of a portion that are not remembered are encoded together, joined
    by blanks, if they are of Latin letters alone: each is then one pre-token,
    and only its last id is that of a piece ending a word.  Lower-case ASCII
    letters are their own normal and byte-level form, so for these the model is
    asked without the other steps.  Other words are encoded one by one.  At most
    ``cache_words`` words are remembered, beyond that the memory starts afresh
    with those of the portion at hand.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._of_letters = Tokenizer(self._tokenizer.model)
        self._of_letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self._tokenizer.get_vocab()
        suffix = getattr(self._tokenizer.model, "end_of_word_suffix", None)
        self._ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        if suffix:
            self._ends[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True
        self._limit = cache_words
        self._words: dict[bytes, bytes] = {}

    def _each(self, texts: list[bytes]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(
            [text.decode("utf-8", "replace") for text in texts], add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _together(self, words: list[bytes], tokenizer) -> list[bytes] | None:
        """Ids of words of letters, from one call; None if they do not add up."""
        text = b" ".join(words).decode()
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = (np.flatnonzero(self._ends[ids]) + 1) * ID_BYTES
        if len(ends) != len(words) or ends[-1] != len(ids) * ID_BYTES:
            return None
        raw, at = ids.tobytes(), 0
        return [raw[at:(at := end)] for end in ends.tolist()]

    def _learn(self, words: list[bytes]) -> None:
        known = self._words
        letters, latin, other, cut = [], [], [], []
        parts = set()
        for word in words:
            if word.isalpha():
                letters.append(word)
            elif len(base := word.rstrip(TAIL_MARKS)) < len(word) and base[-1:].isalnum():
                cut.append((word, base, tail := word[len(base):]))
                parts.add(base)
                parts.add(tail)
            else:
                parts.add(word)
        for part in parts.difference(letters):
            if part not in known:
                # Latin letters: their normal and lower-case forms are letters too
                if part.isalpha():
                    letters.append(part)
                elif (s := part.decode("utf-8", "replace")).isalpha() and max(s) < "\u0130":
                    latin.append(part)
                else:
                    other.append(part)
        for simple, tokenizer in ((letters, self._of_letters), (latin, self._tokenizer)):
            for at in range(0, len(simple), JOINED):
                joined = simple[at:at + JOINED]
                known.update(zip(joined, self._together(joined, tokenizer) or self._each(joined), strict=True))
        for at in range(0, len(other), JOINED):
            known.update(zip(other[at:at + JOINED], self._each(other[at:at + JOINED]), strict=True))
        for word, base, tail in cut:
            known[word] = known[base] + known[tail]

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        ids = list(map(self._words.get, words))
        missing = [i for i, own in enumerate(ids) if own is None]
        if missing:
            if len(self._words) + len(missing) > self._limit:
                self._words = {word: own for word, own in zip(words, ids, strict=True) if own is not None}
            self._learn([words[i] for i in missing])
            for i in missing:
                ids[i] = self._words[words[i]]
        return ids

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        whole = [i for i, text in enumerate(texts) if b"<|" in text]
        if whole:
            special, texts = set(whole), list(texts)
            found = self._each([texts[i] for i in whole])
            texts = [b"" if i in special else text for i, text in enumerate(texts)]
        lower = pc.ascii_lower(pa.array(texts, pa.large_binary()).view(pa.large_string()))
        split = pc.ascii_split_whitespace(lower)
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        placed = pa.array(self._ids_of(distinct), pa.large_binary()).take(words.indices)
        _, starts, data = placed.buffers()
        raw = data.to_pybytes() if data else b""
        bounds = np.frombuffer(starts, np.int64)[split.offsets.to_numpy()].tolist() if len(placed) else [0] * (len(texts) + 1)
        out = [raw[a:b] for a, b in pairwise(bounds)]
        if whole:
            for i, ids in zip(whole, found, strict=True):
                out[i] = ids
        return out


@lru_cache(maxsize=1)
def encoder_of(path: str) -> WordEncoder:
    """One encoder a Python worker: later tasks go on with its words.  A bare
    file name is one of the public tokenizers."""
    if not os.path.dirname(path):
        import public_tokenizers

        path = public_tokenizers.path(path)
    return WordEncoder(path)


def portions(texts: list[bytes], size: int = PORTION_BYTES) -> Iterator[list[bytes]]:
    """Consecutive texts of about ``size`` bytes together."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield texts[start:i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield texts[start:]


class SumOfSquares:
    """Online placement into windows; pieces are (row, start, length)."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window = window
        self.max_open = max_open
        self.counts = np.zeros(window + 1, dtype=np.int64)  # open windows by level
        self.open: dict[int, list[list[tuple]]] = {}
        self.n_open = 0

    def _take(self, level: int) -> list[tuple]:
        self.counts[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def _put(self, level: int, pieces: list[tuple]) -> None:
        self.counts[level] += 1
        self.n_open += 1
        self.open.setdefault(level, []).append(pieces)

    def place(self, piece: tuple) -> list[tuple] | None:
        """Place a piece shorter than a window; a window it fills, if any."""
        size, counts, window = piece[2], self.counts, self.window
        levels = np.flatnonzero(counts[: window - size + 1])
        best = None
        if len(levels):
            # sum of squares after moving one window from level h to h + size
            new = levels + size
            change = 1 - 2 * counts[levels] + np.where(new < window, 2 * counts[new] + 1, 0)
            i = len(levels) - 1 - int(np.argmin(change[::-1]))
            if change[i] <= 2 * counts[size] + 1:
                best = int(levels[i])
        pieces = self._take(best) if best is not None else []
        pieces.append(piece)
        level = size + (best or 0)
        if level == window:
            return pieces
        self._put(level, pieces)
        return None

    def relieve(self) -> tuple[list[list[tuple]], set[int]]:
        """Past ``max_open`` open windows: full windows merged from them, and the
        rows that have a piece in the partial window that stays open."""
        if self.n_open <= self.max_open:
            return [], set()
        merged = list(self.finish())
        self.counts[:] = 0
        self.open, self.n_open = {}, 0
        level = sum(p[2] for p in merged[-1])
        if level == self.window:
            return merged, set()
        rest = merged.pop()
        self._put(level, rest)
        return merged, {p[0] for p in rest}

    def finish(self) -> Iterator[list[tuple]]:
        """The open windows, merged by cutting until at most one is partial."""
        rest = [w for level in sorted(self.open) for w in self.open[level]]
        levels = [sum(p[2] for p in w) for w in rest]
        low, high = 0, len(rest) - 1
        while low < high:
            room = self.window - levels[high]
            while room and low < high:
                row, start, length = rest[low].pop()
                part = min(room, length)
                rest[high].append((row, start + length - part, part))
                if part < length:
                    rest[low].append((row, start, length - part))
                room -= part
                levels[low] -= part
                if not levels[low]:
                    low += 1
            if room:
                break
            yield rest[high]
            high -= 1
        if low == high and levels[low]:
            yield rest[low]


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, separator: int = SEPARATOR) -> DataFrame:
    """One row per piece: ``id_col``, ``start`` and ``length`` in the document's
    ids, ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence, and
    ``ids`` as little-endian unsigned 32-bit binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)
        end = np.array([separator], dtype="<u4").tobytes()
        base = TaskContext.get().partitionId() << 40
        packer = SumOfSquares(window)
        held: dict[int, list] = {}  # rows with an open piece: id, ids, tokens, open pieces
        n_row = n_seq = 0
        out: list[tuple] = []
        out_bytes = 0

        def emit(pieces):
            nonlocal n_seq, out_bytes
            at = 0
            for row, start, length in pieces:
                doc_id, ids, tokens, first = held[row]
                cut = ids[(start - first) * ID_BYTES:(start - first + length) * ID_BYTES]
                out.append((doc_id, start, length, tokens, base + n_seq, at, cut))
                out_bytes += len(cut)
                at += length
            n_seq += 1

        def release(pieces, still_open=()):
            for row in {p[0] for p in pieces}.difference(still_open):
                held.pop(row, None)

        def table():
            nonlocal out, out_bytes
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64()] * 6 + [pa.binary()]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
            out, out_bytes = [], 0
            return batch

        for batch in batches:
            encoded = (ids for texts in portions(text_bytes(batch.column(1))) for ids in encoder.encode_all(texts))
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                ids = ids + end
                tokens = len(ids) // ID_BYTES
                whole = tokens // window * window
                held[n_row] = [doc_id, ids, tokens, 0]
                for start in range(0, whole, window):
                    emit([(n_row, start, window)])
                if whole == tokens:
                    held.pop(n_row)
                else:
                    held[n_row][1:] = ids[whole * ID_BYTES:], tokens, whole
                    full = packer.place((n_row, whole, tokens - whole))
                    if full:
                        emit(full)
                        release(full)
                    merged, still_open = packer.relieve()
                    for pieces in merged:
                        emit(pieces)
                        if out_bytes > 8 << 20:
                            yield table()
                    for pieces in merged:
                        release(pieces, still_open)
                n_row += 1
                if out_bytes > 8 << 20:
                    yield table()
        for pieces in packer.finish():
            emit(pieces)
            if out_bytes > 8 << 20:
                yield table()
        if out:
            yield table()

    return docs.select(F.col(f"`{id_col}`").cast("long").alias(id_col), F.col(f"`{text_col}`")).mapInArrow(
        run, f"`{id_col}` long, {SCHEMA}")
