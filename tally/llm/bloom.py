"""Bloom filters over 64-bit hashes, set in tasks and united per shard.

A filter's size follows the number of keys up to ``MAX_BITS`` (64 MB), so what
a task holds and what is broadcast is bounded whatever the table; with more
keys than it is made for, a filter lets more through, and its users count
exactly behind it.

``repeats``: two planes, positions set at least once and at least twice, over
all tasks.  Every position of a hash that occurs twice is set twice, whichever
tasks saw it, so no repeated hash is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tally.llm.textcols import mix

MAX_BITS = 1 << 29
MIN_BITS = 1 << 16
SHARD_BITS = 1 << 20
BITS_PER_KEY = 16
PROBES = 4


def bits_for(keys: int, most: int = MAX_BITS) -> int:
    return min(max(MIN_BITS, 1 << max(keys * BITS_PER_KEY - 1, 1).bit_length()), most)


def _probes(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    at, step = mix(hashes), mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)) | np.uint64(1)
    for _ in range(PROBES):
        yield (at & np.uint64(bits - 1)).astype(np.int64)
        at = at + step


def holds(plane: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash has all its positions set in the plane of packed bits."""
    found = np.ones(len(hashes), bool)
    for at in _probes(hashes, 8 * len(plane)):
        found &= (plane[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return found


def _put(plane: np.ndarray, at: np.ndarray) -> None:
    """Sets sorted positions."""
    if len(at):
        cells = at >> 3
        first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
        plane[cells[first]] |= np.bitwise_or.reduceat((1 << (at & 7)).astype(np.uint8), first)


def _set(batches: Iterator[pa.RecordBatch], bits: int, repeats: bool) -> Iterator[pa.RecordBatch]:
    once = np.zeros(bits // 8, np.uint8)
    twice = np.zeros(bits // 8 if repeats else 0, np.uint8)
    for batch in batches:
        for at in _probes(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits):
            at = np.sort(at)
            if repeats and len(at):
                had = (once[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                _put(twice, at[had | np.append(False, at[1:] == at[:-1])])
            _put(once, at)
    yield from _shards({s: (o, twice[a:a + len(o)]) for s, a, o in _cut(once)})


def _cut(plane: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    for a in range(0, len(plane), SHARD_BITS // 8):
        part = plane[a:a + SHARD_BITS // 8]
        if part.any():
            yield a // (SHARD_BITS // 8), a, part


def _shards(planes: dict) -> Iterator[pa.RecordBatch]:
    for shard, (once, twice) in planes.items():
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([once.tobytes()], pa.binary()),
                                          pa.array([twice.tobytes()], pa.binary())], names=["shard", "once", "twice"])


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All parts of the shards that came to this task, one after another."""
    planes: dict = {}
    for batch in batches:
        for shard, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            once, twice = np.frombuffer(once, np.uint8), np.frombuffer(twice, np.uint8)
            if shard in planes:
                o, t = planes[shard]
                if len(t):
                    t |= twice | (o & once)
                o |= once
            else:
                planes[shard] = (once.copy(), twice.copy())
    yield from _shards(planes)


def plane(hashes: DataFrame, bits: int, repeats: bool = False) -> np.ndarray:
    """The filter over the one long column of ``hashes`` (or, with ``repeats``, over those that occur again)."""
    name = "twice" if repeats else "once"
    schema = "shard long, once binary, twice binary"
    parts = hashes.mapInArrow(lambda it: _set(it, bits, repeats), schema)
    shards = parts.repartition(min(max(1, bits // SHARD_BITS), 64), "shard").mapInArrow(_unite, schema)
    out = np.zeros(bits // 8, np.uint8)
    for r in shards.select("shard", name).toLocalIterator():      # bits / 8 bytes at most
        part = np.frombuffer(bytes(r[name]), np.uint8)
        a = r["shard"] * (SHARD_BITS // 8)
        out[a:a + len(part)] = part
    return out
