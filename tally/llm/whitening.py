"""Embedding whitening by weighted multiplicity covariance.

Vectors become integer vectors x.  Identical ones are grouped; a group's
weight is its number of vectors (or one).  All heavy steps run once per
different x:

1.  sums of weight * x, exact;
2.  the weighted covariance: one matrix product a batch of the centred rows
    with their weighted selves, added up row by row of the matrix;
3.  eigenvectors of that matrix (its size is the vector length, whatever the
    table), on the driver;
4.  projection on the first components, divided by the root of the eigenvalue.

The result is joined back to the rows; a vector that a large share of the rows
hold is spread over tasks by ``join_back``.

A centred entry is (n*x - S) / n with the integer n*x - S exact, so it is the
double nearest to its true value.

Nulls and edge cases: rows whose vector is null or holds a null or non-finite
entry are dropped; zero vectors stay.  Vectors of different lengths have
nothing in common: each length is a fit list of its own, and an empty vector
has no component and so no row.  A component without variance (constant or
fewer different vectors than components) has ``whitened`` null and
``explained`` 0; with no variance at all ``explained`` and ``identity_error``
are null.  An entry beyond 2**52 / 1024 is held at that bound.  Null and
repeated ids stay as they are.  Only the two named columns are read, so others
cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions.skew import join_back
from tally.llm.staging import stage, table

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
BOUND = 1 << 52
#: an eigenvalue below this share of the largest, times the length, is rounding
RANK_TOLERANCE = 1e-14


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, dim, x): floor(1024 * entry) + 100000 of every vector of finite entries."""
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    held = lambda c: F.greatest(F.lit(float(-BOUND)), F.least(F.lit(float(BOUND)), c * SCALE))
    return (v.where(F.col("v").isNotNull() & ~bad)
            .select("vec_id", F.size("v").alias("dim"), F.transform("v", lambda c: F.floor(held(c)).cast("long") + F.lit(SHIFT)).alias("x")))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) of the long vectors in the column ``x``, for each length in the batch."""
    column = batch.column("x")
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    for dim in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == dim)
        at = (ends[rows] - dim)[:, None] + np.arange(dim)
        yield dim, rows, flat[at]


def _weights(batch: pa.RecordBatch, rows: np.ndarray) -> np.ndarray:
    return batch.column("weight").to_numpy(zero_copy_only=False)[rows]


def _exact(values: np.ndarray, factor: int, terms: int) -> np.ndarray:
    """``values``, as Python integers where ``terms`` products with ``factor`` could pass 64 bits."""
    top = int(np.abs(values).max(initial=0))
    return values if top * factor * terms < 1 << 62 else values.astype(object)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, n, sums) of a task, exact."""
    total: dict[int, list] = {}
    for batch in batches:
        for dim, rows, x in _by_length(batch):
            w = _weights(batch, rows)
            s = (_exact(x, int(w.max()), len(w)) * w[:, None]).sum(axis=0)
            old = total.setdefault(dim, [0, np.zeros(dim, object)])
            old[0] += int(w.sum())
            old[1] = old[1] + s
    for dim, (n, s) in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([n], pa.int64()),
             pa.array([[Decimal(int(v)) for v in s]], pa.list_(pa.decimal128(38, 0)))], names=["dim", "n", "sums"])


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact; as Python integers where 64 bits do not hold the squares' sum."""
    y = _exact(x, n, 2) * n - (sums if max(map(abs, sums), default=0) >= 1 << 62 else sums.astype(np.int64))
    top = max(abs(int(y.min())), abs(int(y.max())))
    return y.astype(np.int64) if top * top * x.shape[1] < 1 << 62 else y.astype(object)


def _covariance(batches: Iterator[pa.RecordBatch], centres: dict) -> Iterator[pa.RecordBatch]:
    """(dim, i, part): the rows of a task's weighted product of centred vectors."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for dim, rows, x in _by_length(batch):
            n, sums = centres[dim]
            z = _deviations(x, n, sums).astype(np.float64) / n
            part = (z * _weights(batch, rows)[:, None]).T @ z
            total[dim] = total[dim] + part if dim in total else part
    for dim, m in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(dim, dim, np.int32)), pa.array(np.arange(dim, dtype=np.int32)),
             pa.FixedSizeListArray.from_arrays(pa.array(m.ravel()), dim).cast(pa.list_(pa.float64()))], names=["dim", "i", "part"])


def _added(group: pa.Table) -> pa.Table:
    """One row of the matrix: the sum of its parts (one part a task)."""
    parts = group.column("part").combine_chunks()
    return pa.table({"dim": group.column("dim").slice(0, 1), "i": group.column("i").slice(0, 1),
                     "row": pa.array([np.sum([p.values.to_numpy() for p in parts], axis=0)], pa.list_(pa.float64()))})


def _projected(batches: Iterator[pa.RecordBatch], centres: dict, models: dict) -> Iterator[pa.RecordBatch]:
    """(x, dim, weight, n, deviation, whitened) of each different vector."""
    for batch in batches:
        for dim, rows, x in _by_length(batch):
            n, sums = centres[dim]
            y = _deviations(x, n, sums)
            deviation = (y * y).sum(axis=1)
            white = (y.astype(np.float64) / n) @ models[dim][0]
            kept = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [kept.column("x"), kept.column("dim"), kept.column("weight"), pa.array(np.full(len(rows), n)),
                 pa.array([Decimal(int(v)) for v in deviation], pa.decimal128(38, 0)),
                 pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), white.shape[1]).cast(pa.list_(pa.float64()))],
                names=["x", "dim", "weight", "n", "deviation", "whitened"])


def _model(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Projection with the scaling in it (length x components), explained shares, and which components have variance."""
    e, u = np.linalg.eigh((v + v.T) / 2)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    trace = float(np.trace(v))
    good = e > RANK_TOLERANCE * len(v) * max(float(e[0]), 0.0)
    scaled = np.where(good, u / np.sqrt(np.where(good, e, 1.0)), 0.0)
    return scaled, np.where(good, e, 0.0) / (trace if trace > 0 else np.nan), good


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
           weights: str = "counts") -> DataFrame:
    """One row per vector: vec_id, dim, n, deviation, and a list of (whitened, explained) by component, with identity_error.

    ``weights``: ``counts`` fits on all vectors, ``one`` on the different ones.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights are counts or one")
    spark = vectors.sparkSession
    rows = stage(integer_vectors(vectors, id_col, vec_col).where("dim > 0"), "integers")
    weight = F.count(F.lit(1)) if weights == "counts" else F.lit(1).cast("long")
    distinct = stage(rows.groupBy("x").agg(weight.alias("weight"), F.first("dim").alias("dim")), "distinct")

    # what comes to the driver has one entry per dimension, or the covariance of one length
    centres: dict = {}
    for r in distinct.mapInArrow(_sums, "dim int, n long, sums array<decimal(38,0)>").toLocalIterator():
        n, s = centres.get(r["dim"], (0, np.zeros(r["dim"], object)))
        centres[r["dim"]] = (n + r["n"], s + np.array([int(v) for v in r["sums"]], object))
    shape = "dim int, i int, part array<double>"
    summed = (distinct.mapInArrow(lambda it: _covariance(it, centres), shape).groupBy("dim", "i")
              .applyInArrow(_added, "dim int, i int, row array<double>"))
    matrices: dict = {dim: np.zeros((dim, dim)) for dim in centres}
    for r in summed.toLocalIterator():
        matrices[r["dim"]][r["i"]] = np.array(r["row"]) / centres[r["dim"]][0]
    models = {dim: _model(v, components) for dim, v in matrices.items()}

    white = stage(distinct.mapInArrow(lambda it: _projected(it, centres, models),
                                      "x array<long>, dim int, weight long, n long, deviation decimal(38,0), whitened array<double>"), "whitened")
    k = range(components)
    at = [F.get("whitened", F.lit(i)) for i in k]
    moments = (white.groupBy("dim").agg(
        F.sum("weight").alias("n"), *[F.sum(at[i] * F.col("weight")).alias(f"m{i}") for i in k],
        *[F.sum(at[i] * at[j] * F.col("weight")).alias(f"c{i}_{j}") for i in k for j in range(i, components)]).collect())
    told = []
    for r in moments:        # one row per vector length
        good = np.flatnonzero(models[r["dim"]][2]).tolist()
        errors = [abs(r[f"c{i}_{j}"] / r["n"] - r[f"m{i}"] * r[f"m{j}"] / r["n"] ** 2 - (i == j)) for i in good for j in good if i <= j]
        told.append((r["dim"], [float(x) if np.isfinite(x) else None for x in models[r["dim"]][1]],
                     [bool(x) for x in models[r["dim"]][2]], max(errors, default=None)))
    facts = F.broadcast(spark.createDataFrame(told, "dim int, explained array<double>, good array<boolean>, identity_error double"))
    parts = F.transform(F.col("whitened"), lambda v, i: F.struct(
        (i + 1).alias("component"), F.when(F.get("good", i), v).alias("whitened"), F.get("explained", i).alias("explained")))
    each = white.join(facts, "dim").select("x", "n", "deviation", parts.alias("parts"), "identity_error")
    return (join_back(rows, each, ["x"], spread=["vec_id"])
            .select("vec_id", "dim", "n", "deviation", "parts", "identity_error"))


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """``deviation`` is null where 64 bits do not hold it; ``deviation_exact`` always has it."""
    found = whiten(table(spark, sf_dir, "embeddings"))
    return (found.select("vec_id", "n", "deviation", "identity_error", F.inline("parts"))
            .select("vec_id", F.col("component").cast("int"), "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"),
                    "whitened", "explained", "identity_error", F.col("deviation").alias("deviation_exact")))
