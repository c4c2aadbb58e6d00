"""Whole texts as numpy arrays, a bounded chunk of documents at a time.

A word is a maximal run of bytes other than space and 0x09-0x0D, within one document. A chunk holds
at least one document, however long; its arrays take some 30 bytes for each byte of text. A null
text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BASE = np.uint64(0xD6E8FEB86659FD93)
_GRAM = np.uint64(0x9FB21C651E98DF25)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and odd multiplications)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def chunk_bounds(texts: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``max_bytes`` together, one row at least."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    lo = 0
    while lo < len(ends):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        yield lo, hi
        lo = hi


class Words:
    """The words of a chunk: byte range of each word, and the word range of each document."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        self.doc_at = offsets - offsets[0]
        size = int(self.doc_at[-1])
        data = texts.buffers()[2]
        self.data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[0] + size] if size else np.zeros(0, np.uint8)
        blank = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        first = np.ones(size + 1, bool)
        first[1:-1] = blank[:-1]
        first[self.doc_at] = True
        self.starts = np.flatnonzero(first[:-1] & ~blank)
        first[:-1] |= blank
        self.ends = np.flatnonzero(~blank & first[1:]) + 1
        self.blank = blank
        self.word_at = np.searchsorted(self.starts, self.doc_at)

    def counts(self) -> np.ndarray:
        return np.diff(self.word_at)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.doc_at) - 1), self.counts())

    def hashes(self, lower: bool = False, ends: np.ndarray | None = None) -> np.ndarray:
        """One 64-bit hash per word; ``lower`` maps A-Z to a-z first, ``ends`` may cut words shorter."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        ends = self.ends if ends is None else ends
        lengths = ends - self.starts
        at = np.zeros(len(self.data), np.int64)
        at[self.starts] = self.starts
        np.maximum.accumulate(at, out=at)
        at = np.arange(len(self.data)) - at
        at[self.blank] = 0
        value = (_BYTE_LOWER if lower else _BYTE)[self.data] * powers(_BASE, int((self.ends - self.starts).max()))[at]
        value[self.blank] = 0
        off = self.ends - ends
        value[np.repeat(ends - (np.cumsum(off) - off), off) + np.arange(int(off.sum()))] = 0
        return mix(np.add.reduceat(value, self.starts) + lengths.astype(np.uint64))

    def word(self, k: int) -> str:
        return self.data[self.starts[k] : self.ends[k]].tobytes().decode("utf-8", "replace")


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words that start at each word (whole runs only; document borders are ignored)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out = out * _GRAM + hashes[j : j + m]
    return mix(out)


def sequence_key(hashes: np.ndarray) -> tuple[int, int]:
    """Two 64-bit keys of a whole word sequence, as signed integers."""
    n = np.uint64(len(hashes))
    a = mix(np.array([(hashes * powers(_GRAM, len(hashes))[: len(hashes)]).sum(dtype=np.uint64) + n], np.uint64))
    b = mix(np.array([(mix(hashes ^ _BASE) * powers(_BASE, len(hashes))[: len(hashes)]).sum(dtype=np.uint64) + n], np.uint64))
    return int(a.view(np.int64)[0]), int(b.view(np.int64)[0])
