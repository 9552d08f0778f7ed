"""Vectorised word and window hashing over Arrow string columns (numpy only).

A word is a run of bytes other than 0x20 and 0x09-0x0D.  Texts are read
straight from the Arrow buffers, whole, whatever their length; no Python
object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEGMENT = 1 << 21  # bytes hashed at a time; bounds the scratch arrays
_powers: list[np.ndarray] = []


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche (splitmix64) on uint64 values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers derived from ``seed``."""
    start = (seed + 1) * 0x632BE59BD9B4E019 % (1 << 64)
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=U64) * U64(_BASE) + U64(start)) | U64(1)


def column_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string or binary column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if col.null_count:
        col = col.fill_null("" if "string" in str(col.type) else b"")
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return off.astype(np.int64), raw


def row_groups(offsets: np.ndarray, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``max_bytes`` (or one longer row)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, _SEGMENT)
        fwd, back = np.full(size, _BASE, dtype=U64), np.full(size, _INVERSE, dtype=U64)
        fwd[0] = back[0] = 1
        _powers[:] = [np.cumprod(fwd), np.cumprod(back)]
    return _powers[0], _powers[1]


def word_spans(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) byte positions of all words and, per row, the first word's index (length rows + 1)."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    part = data[lo:hi]
    word = ~_SPACE[part]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    inner = offsets[(offsets > lo) & (offsets < hi)] - lo
    begins[inner] |= word[inner]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    ends[inner - 1] |= word[inner - 1]
    start, end = np.flatnonzero(begins) + lo, np.flatnonzero(ends) + lo + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes (polynomial prefix sums, then mixed)."""
    out = np.empty(len(start), dtype=U64)
    i = 0
    while i < len(start):
        j = int(np.searchsorted(end, start[i] + _SEGMENT, side="right"))
        j = max(j, i + 1)
        lo, hi = int(start[i]), int(end[j - 1])
        fwd, back = _power_tables(hi - lo + 1)
        sums = np.empty(hi - lo + 1, dtype=U64)
        sums[0] = 0
        np.cumsum((data[lo:hi].astype(U64) + U64(1)) * fwd[:hi - lo], out=sums[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * back[s] + (e - s).astype(U64)
        i = j
    return mix64(out)


def window_hashes(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` consecutive words, rows ignored."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = np.zeros(n, dtype=U64)
    for j, c in enumerate(constants(size, seed)):
        out += words[j:j + n] * c
    return mix64(out)


def windows_inside(first: np.ndarray, n_words: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(inside, row): which window starts lie in one row, and the row of each word."""
    counts = np.diff(first)
    row = np.repeat(np.arange(len(counts)), counts)
    n = n_words - size + 1
    if n <= 0:
        return np.zeros(0, dtype=bool), row
    return row[:n] == row[size - 1:size - 1 + n], row


_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(raw: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with the capitals A-Z and those of Latin-1 in lower case (same length)."""
    low = _LOWER[raw]
    if len(raw) > 1:
        low[1:][(raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)] += np.uint8(32)
    return low


def letter_words(offsets: np.ndarray, data: np.ndarray,
                 prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(row, [(word, hash)]) of each run of letters, in lower case; bytes beyond ASCII count as letters.

    ``row`` gives each word's row.  The first pair holds all words; one more
    for each length in ``prefixes`` holds the words longer than so many bytes
    with the hash of their first bytes.
    """
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw, offsets = data[lo:hi], offsets - lo
    letter = _LETTER[raw]
    edge = offsets[(offsets > 0) & (offsets < len(raw))]
    begins, ends = letter.copy(), letter.copy()
    begins[1:] &= ~letter[:-1]
    begins[edge] |= letter[edge]
    ends[:-1] &= ~letter[1:]
    ends[edge - 1] |= letter[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    low = lowered(raw)
    found = [(np.arange(len(start)), word_hashes(low, start, end))]
    for n in prefixes:
        longer = np.flatnonzero(end - start > n)
        found.append((longer, word_hashes(low, start[longer], start[longer] + n)))
    return row, found
