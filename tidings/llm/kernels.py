"""Vectorised text kernels over Arrow string buffers (used inside tasks only).

A batch of texts is one byte buffer plus offsets. Words are the maximal runs of bytes other than
``[\\x20\\x09-\\x0D]``; A-Z is lower-cased byte-wise, so multi-byte characters are untouched. Word and shingle
identities are 64-bit hashes; callers that need certainty compare bytes.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 512 << 10  # texts worked on at once; a longer single text is a chunk of its own

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LETTERS_ONLY = np.ones(256, dtype=bool)  # gaps when only ASCII letters, digits and non-ASCII bytes make words
LETTERS_ONLY[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
_LIBC = ctypes.CDLL(None) if sys.platform.startswith("linux") else None
if _LIBC is not None and not hasattr(_LIBC, "malloc_trim"):  # another C library
    _LIBC = None
_POW: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the word."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_HASH = mix(np.arange(1, 257, dtype=_U) * _U(_BASE)) | _U(1)  # one odd number per byte value


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; those of a usual chunk are kept per worker process."""
    if n > CHUNK_BYTES + 1:
        return _accumulated(_BASE, n), _accumulated(pow(_BASE, -1, 1 << 64), n)
    if not _POW:
        _POW.update(zip("pq", (_accumulated(_BASE, CHUNK_BYTES + 1), _accumulated(pow(_BASE, -1, 1 << 64), CHUNK_BYTES + 1)), strict=True))
    return _POW["p"][:n], _POW["q"][:n]


def _accumulated(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=_U)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def string_buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string array, without a copy; a null is an empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    _, off, data = arr.buffers()
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    offsets = np.frombuffer(off, dtype=kind)[arr.offset: arr.offset + len(arr) + 1].astype(np.int64) if off is not None else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def chunked(arr: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``limit`` bytes."""
    raw, off = string_buffers(arr)
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, raw[off[i]: off[j]], off[i: j + 1] - off[i]
        i = j
    hand_back()


def hand_back() -> None:
    """Give memory that the worker process has freed back to the system: idle workers of other stages share its executor."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


class Words:
    """Word bounds, owning text and hash of every word of a chunk of texts."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, gap: np.ndarray = _SPACE):
        n = len(raw)
        self.n_docs = len(off) - 1
        self.low = _LOWER[raw]
        solid = ~gap[raw]
        first = np.zeros(n + 1, dtype=bool)
        first[off] = True
        before = np.empty(n, dtype=bool)
        before[:1] = False
        before[1:] = solid[:-1]
        begins = solid & (~before | first[:n])
        after = np.empty(n, dtype=bool)
        after[-1:] = False
        after[:-1] = solid[1:]
        ends = solid & (~after | first[1:])
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.doc = np.searchsorted(off, self.start, side="right") - 1
        self.count = np.bincount(self.doc, minlength=self.n_docs)
        self.first = np.concatenate(([0], np.cumsum(self.count)))
        p, self._q = powers(n + 1)
        self._prefix = np.zeros(n + 1, dtype=_U)
        np.cumsum(BYTE_HASH[self.low] * p[:n], out=self._prefix[1:])

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._prefix[end] - self._prefix[start]) * self._q[start] + (end - start).astype(_U))

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.start, self.end)


def word_counts(arr: pa.Array) -> np.ndarray:
    """Number of words of every text."""
    out = np.zeros(len(arr), dtype=np.int64)
    for i, j, raw, off in chunked(arr):
        solid = ~_SPACE[raw]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        inner = off[:-1][off[:-1] < off[1:]]
        begins[inner] = solid[inner]
        total = np.concatenate(([0], np.cumsum(begins)))
        out[i:j] = total[off[1:]] - total[off[:-1]]
    return out


def shingles(words: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words in order, and the bounds per text (n + 1).

    A text with some words but fewer than ``size`` has one shingle, its whole sequence.
    """
    count = np.diff(first)
    n_sh = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    bounds = np.concatenate(([0], np.cumsum(n_sh)))
    total = len(words)
    acc = np.zeros(total, dtype=_U)
    for k in range(size):
        acc[: total - k] = acc[: total - k] * _U(0xD6E8FEB86659FD93) + words[k:]
    out = np.empty(bounds[-1], dtype=_U)
    # position of the first word of every shingle
    doc = np.repeat(np.arange(len(count)), n_sh)
    at = np.arange(bounds[-1]) - bounds[doc] + first[doc]
    out[:] = mix(acc[at] + _U(size)) if len(at) else 0
    for d in np.flatnonzero((count > 0) & (count < size)):
        h = _U(0)
        with np.errstate(over="ignore"):
            for w in words[first[d]: first[d + 1]]:
                h = h * _U(0xD6E8FEB86659FD93) + w
            out[bounds[d]] = mix(np.array([h + _U(int(count[d]))], dtype=_U))[0]
    return out, bounds
