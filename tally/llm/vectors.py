"""Vector columns inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def rows_of(column: pa.Array) -> Iterator[np.ndarray | None]:
    """Each row as doubles; None for a null vector or one with a null or non-finite component or without length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    for n, end, ok in zip(sizes, ends, column.is_valid().to_pylist(), strict=True):
        v = flat[end - n:end]
        yield v if ok and n and np.isfinite(v).all() and v.any() else None


def matrix(blobs: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Binary column of equally long float64 rows as a matrix."""
    values = blobs.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1) if values else np.zeros((0, 0))


def spherical_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """k unit centroids of unit rows; an empty one takes the row that is worst served."""
    k = max(1, min(k, len(x)))
    centres = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        sims = x @ centres.T
        own = sims.argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        missing = np.flatnonzero(np.bincount(own, minlength=k) == 0)
        if len(missing):
            sums[missing] = x[np.argsort(sims.max(axis=1))[:len(missing)]]
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres
