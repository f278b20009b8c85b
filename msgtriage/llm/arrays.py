"""Array helpers shared by the operators that run inside ``mapInArrow`` tasks.

Texts arrive as Arrow string columns; words are found and hashed for many
documents at once with numpy on the UTF-8 bytes, so no Python object is made
per word. All hashes are 64-bit and depend on the bytes only, never on the
process, so they agree between tasks and runs.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19  # texts of one slice; bounds the temporary arrays of a task, some 50 times as large, and the tables each worker keeps

_rng = np.random.RandomState(20240607)
_BYTE_VALUE = _rng.randint(1, 2**62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
SHINGLE_MULT = _rng.randint(1, 2**62, 16).astype(np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.uint64), np.empty(0, np.uint64))


def release_memory() -> None:
    """Give the system back what freed arrays held. Called at the end of a partition, as
    Spark keeps workers for later stages, whose memory would come on top."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def separator_words() -> np.ndarray:
    """Byte table of ``[^\\x20\\x09-\\x0D]+``: True where a byte belongs to a word."""
    table = np.ones(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def alnum_words() -> np.ndarray:
    """Byte table of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z is lower-cased:
    digits, a-z and every byte of a non-ASCII character."""
    table = np.ones(256, bool)
    table[0x00:0x30] = False
    table[0x3A:0x61] = False
    table[0x7B:0x80] = False
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 4096)
        tables = []
        for base in (_BASE, _INV):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t))
        _powers = (tables[0], tables[1])
    return _powers


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends) of an Arrow string column; a null counts as empty."""
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        column = column.cast(pa.string())
        width = np.int32
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(n, np.int64), np.zeros(n, np.int64)
    off = np.frombuffer(offsets, width)[column.offset : column.offset + n + 1].astype(np.int64)
    values = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    starts, ends = off[:-1], off[1:].copy()
    if column.null_count:
        ends = np.where(column.is_valid().to_numpy(zero_copy_only=False), ends, starts)
    return values, starts, ends


def doc_slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Consecutive rows of at most ``max_bytes`` of text (one row at least):
    (first row, end row, bytes, starts, ends), positions relative to the slice."""
    values, starts, ends = string_buffers(column)
    lo, n = 0, len(starts)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + max_bytes, "right")))
        a, b = int(starts[lo]), int(ends[lo:hi].max())
        yield lo, hi, values[a:b], starts[lo:hi] - a, ends[lo:hi] - a
        lo = hi


def _segments(is_word: np.ndarray, doc_starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut a long slice where no word crosses: at a document start or a separator."""
    n, lo = len(is_word), 0
    while lo < n:
        hi = min(n, lo + SLICE_BYTES + 2048)
        if hi < n:
            seps = np.flatnonzero(~is_word[lo + 1 : hi])
            k = int(np.searchsorted(doc_starts, hi, "right")) - 1
            cut = max(int(seps[-1]) + lo + 1 if len(seps) else 0, int(doc_starts[k]) if k >= 0 else 0)
            if cut <= lo:  # one word longer than a segment: go on to its end
                rest = np.flatnonzero(~is_word[hi:])
                k = int(np.searchsorted(doc_starts, hi, "left"))
                cut = min(int(rest[0]) + hi if len(rest) else n, int(doc_starts[k]) if k < len(doc_starts) else n)
            hi = cut
        yield lo, hi
        lo = hi


def find_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of a slice in text order, A-Z lower-cased for hashing: (hashes, first
    byte, end byte, offsets); ``offsets[d]:offsets[d + 1]`` are document d's words."""
    low = LOWER[data]
    is_word = table[low]
    heads = np.unique(starts[ends > starts])
    hashes, firsts, lasts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for lo, hi in _segments(is_word, heads):
        w = is_word[lo:hi]
        own = heads[np.searchsorted(heads, lo) : np.searchsorted(heads, hi)] - lo
        begin = w.copy()
        begin[1:] &= ~w[:-1]
        begin[own] = w[own]
        stop = np.empty_like(w)  # a word's last byte
        stop[-1:] = w[-1:]
        stop[:-1] = w[:-1] & (~w[1:] | begin[1:])
        s, e = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        power, inverse = _power_tables(hi - lo + 1)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[low[lo:hi]] * power[: hi - lo], out=total[1:])
        hashes.append(mix((total[e] - total[s]) * inverse[s]))
        firsts.append(s + lo)
        lasts.append(e + lo)
    first = np.concatenate(firsts)
    off = np.append(np.searchsorted(first, starts), len(first))
    return np.concatenate(hashes), first, np.concatenate(lasts), off


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and document offsets of :func:`find_words`."""
    h, _, _, off = find_words(data, starts, ends, table)
    return h, off


def shingle_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position (positions near a document's
    end mix in the next document; callers take the valid ranges)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out += h[k : k + n] * SHINGLE_MULT[k]
    return mix(out)


def short_hash(h: np.ndarray, width: int) -> np.uint64:
    """Hash of a whole sequence of fewer than ``width`` words, apart from all shingles."""
    size = np.array([0x5851F42D4C957F2D], np.uint64) * np.uint64(len(h))
    return mix(size + (h * SHINGLE_MULT[width : width + len(h)]).sum(dtype=np.uint64))[0]
