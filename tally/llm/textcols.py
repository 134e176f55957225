"""Array views of a text column inside a task: byte offsets, words and their hashes.

A batch of texts is handled as one byte array with document offsets (the
Arrow layout itself), so words, word hashes and rolling window hashes are a
few array operations for the whole batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: \x20 and \x09-\x0D
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
WORD_BASE_INV = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))

SLICE_BYTES = 2 << 20
#: For what makes dozens of 8-byte values of each byte: a worker's memory follows the slice.
SMALL_SLICE = 512 << 10


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int, _kept: dict = {}) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, grown by doubling and kept by the worker."""
    have = _kept.get(int(base))
    if have is None or len(have) < n:
        size = 1 << max(10, (n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _kept[int(base)] = have
    return have[:n]


def text_slices(column: pa.Array, size: int = SLICE_BYTES, rows: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past the last row, bytes, offsets) in runs of about ``size`` bytes and at most ``rows`` rows.

    Null texts are empty.  A text longer than ``size`` is a run of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=kind, count=n + 1, offset=column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        to = min(to, n) if rows is None else min(to, n, at + rows)
        yield at, to, raw[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and the number of words before each text (n + 1 values)."""
    n = len(raw)
    full = ~SPACE[raw]
    before = np.empty(n + 1, dtype=bool)
    before[0] = False
    before[1:] = full
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    after = np.empty(n + 1, dtype=bool)
    after[:n] = full
    after[n] = False
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes: a polynomial over the bytes, then mixed."""
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(raw)), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(BASE_INV, len(raw) + 1)[starts])


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of each ``width`` consecutive values (rolling, modulo 2**64, then mixed)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(WORD_BASE, len(values)), out=total[1:])
    return mix((total[width:] - total[:-width]) * powers(WORD_BASE_INV, n))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The integers of [start, start + length) for each pair, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return shift + np.arange(total)


def codepoints(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the number of them before each text (n + 1 values)."""
    at = np.flatnonzero((raw & 0xC0) != 0x80)
    pad = np.concatenate((raw, np.zeros(3, np.uint8))).astype(np.uint32)
    b = pad[at]
    out = b.copy()
    for low, high, mask, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
        k = np.flatnonzero((b >= low) & (b < high))
        value = b[k] & mask
        for j in range(1, more + 1):
            value = (value << 6) | (pad[at[k] + j] & 0x3F)
        out[k] = value
    return np.minimum(out, 0x10FFFF), np.searchsorted(at, offsets)


def letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether it is a letter, and its lower case (itself where that is not one character)."""
    import sys

    kept = sys.__dict__.setdefault("_tally_letters", [])
    if not kept:
        alpha = np.zeros(0x110000, dtype=bool)
        lower = np.arange(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                alpha[c] = True
                if len(x.lower()) == 1:
                    lower[c] = ord(x.lower())
        kept += [alpha, lower]
    return kept[0], kept[1]
