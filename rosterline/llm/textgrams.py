"""Words, shingles and character n-grams of Arrow text columns, in numpy.

The functions work on the UTF-8 bytes of a whole batch at once.  Words are runs
of bytes other than space and 0x09-0x0D; hashes are 64-bit polynomial sums over
bytes or words, finished by a mixing step, and equal in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that one numpy step handles (a longer text is handled alone).
STEP_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def pieces_of(batch: pa.RecordBatch, column: str, step: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows of ``batch`` with about ``step`` bytes of text each."""
    ends = np.cumsum(byte_lengths(batch.column(column)))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + step, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def byte_lengths(texts: pa.Array) -> np.ndarray:
    return np.diff(_offsets(texts))


def _offsets(texts: pa.Array) -> np.ndarray:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    raw = np.frombuffer(texts.buffers()[1] or b"\0" * 8, np.int64 if wide else np.int32)
    return raw[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and the offsets of each (nulls: none)."""
    off = _offsets(texts)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data else np.zeros(0, np.uint8)
    return raw, off - off[0]


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return raw + np.where((raw >= 65) & (raw <= 90), 32, 0).astype(np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """A finishing step that spreads 64-bit sums over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, 1 << 16)
        _powers = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _BASE)], dtype=np.uint64)
        _inverses = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _INVERSE)], dtype=np.uint64)
    return _powers, _inverses


@dataclass
class Words:
    """Words of a batch of texts: byte ranges, text index and 64-bit hash of each."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    n_docs: int
    sums: np.ndarray

    def beginning(self, n: int) -> np.ndarray:
        """Hash of each word's first n bytes (of the whole word if it is shorter)."""
        end = np.minimum(self.start + n, self.end)
        part = (self.sums[end] - self.sums[self.start]) * _power_tables(len(self.raw))[1][self.start]
        return mix(part + np.uint64(n))

    def first(self) -> np.ndarray:
        """Index of each text's first word, and the number of words at the end."""
        return np.searchsorted(self.doc, np.arange(self.n_docs + 1))


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    raw, off = text_bytes(texts)
    n, size = len(texts), len(raw)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(raw, none, none, none, np.zeros(0, np.uint64), n, np.zeros(1, np.uint64))
    if lower:
        raw = lower_ascii(raw)
    is_word = (raw != 32) & ((raw < 9) | (raw > 13))
    edge = np.zeros(size + 1, bool)
    edge[off] = True
    before = np.r_[False, is_word[:-1]] & ~edge[:-1]
    after = np.r_[is_word[1:], False] & ~edge[1:]
    start = np.flatnonzero(is_word & ~before)
    end = np.flatnonzero(is_word & ~after) + 1
    doc = np.searchsorted(off, start, "right") - 1
    powers, inverses = _power_tables(size)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[:size], out=sums[1:])
    return Words(raw, start, end, doc, mix((sums[end] - sums[start]) * inverses[start]), n, sums)


def windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of every run of n words of one text."""
    have = len(words.hash) - n + 1
    if have <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(have, np.uint64)
    for j in range(n):
        total = total * _BASE + words.hash[j : j + have]
    at = np.flatnonzero(words.doc[:have] == words.doc[n - 1 :])
    return at, mix(total[at])


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of the distinct n-word shingles of each text, sorted by both.

    A text of fewer words has its whole sequence as its one shingle.
    """
    at, value = windows(words, n)
    doc = words.doc[at]
    first = words.first()
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < n))
    extra = np.zeros(len(short), np.uint64)
    for j in range(n - 1):
        has = count[short] > j
        extra[has] = extra[has] * _BASE + words.hash[first[short[has]] + j]
    doc = np.r_[doc, short]
    value = np.r_[value, mix(extra + count[short].astype(np.uint64))]
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])] if len(doc) else np.zeros(0, bool)
    return doc[new], value[new]


def byte_grams(raw: np.ndarray, off: np.ndarray, n: int, bits: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash of ``bits`` bits) of every run of n bytes of one text."""
    have = len(raw) - n + 1
    if have <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(have, np.uint64)
    for j in range(n):
        code = (code << np.uint64(8)) | raw[j : j + have]
    code = (code + np.uint64(salt + 1)) * _BASE
    code ^= code >> np.uint64(29)
    code = ((code * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    inside = doc[:have] == doc[n - 1 :]
    return doc[:have][inside], code[inside]
