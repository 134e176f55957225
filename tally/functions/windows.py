"""Per-key ordered computations that do not put a whole key into one task.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; a
key holding a third of the rows would then be a third of the job on one
core.  These helpers split each key into time buckets: the ordered work runs
per (key, bucket), and only the small per-bucket summary is ordered per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def bucketed_lag(df: DataFrame, key: list[str], order: list[str], value: str, bucket: Column,
                 out: str) -> DataFrame:
    """``lag(value) over (partition by key order by order)`` computed per (key, bucket)."""
    b = "_bucket"
    d = df.withColumn(b, bucket)
    w_in = Window.partitionBy(*key, b).orderBy(*_cols(order))
    d = d.withColumn("_prev_in", F.lag(value).over(w_in)).withColumn("_rn_in", F.row_number().over(w_in))
    last = (d.groupBy(*key, b).agg(F.max_by(F.col(value), F.struct(*_cols(order))).alias("_last"))
            .withColumn("_prev_bucket", F.lag("_last").over(Window.partitionBy(*key).orderBy(b)))
            .drop("_last"))
    return (d.join(last, [*key, b])
            .withColumn(out, F.when(F.col("_rn_in") == 1, F.col("_prev_bucket")).otherwise(F.col("_prev_in")))
            .drop("_prev_in", "_rn_in", "_prev_bucket", b))


def bucketed_running_sum(df: DataFrame, key: list[str], order: list[str], value: str, bucket: Column,
                         out: str) -> DataFrame:
    """Running ``sum(value)`` per key in ``order`` (rows up to and including the current one)."""
    b = "_bucket"
    d = df.withColumn(b, bucket)
    w_in = (Window.partitionBy(*key, b).orderBy(*_cols(order))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("_run_in", F.sum(value).over(w_in))
    totals = (d.groupBy(*key, b).agg(F.sum(value).alias("_tot"))
              .withColumn("_before", F.coalesce(
                  F.sum("_tot").over(Window.partitionBy(*key).orderBy(b)
                                     .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("_tot"))
    return (d.join(totals, [*key, b])
            .withColumn(out, F.col("_before") + F.col("_run_in"))
            .drop("_run_in", "_before", b))


def bucketed_row_number(df: DataFrame, key: list[str], order: list[str], bucket: Column, out: str) -> DataFrame:
    """``row_number() over (partition by key order by order)`` per (key, bucket) plus bucket offsets."""
    b = "_bucket"
    d = df.withColumn(b, bucket)
    d = d.withColumn("_rn_in", F.row_number().over(Window.partitionBy(*key, b).orderBy(*_cols(order))))
    counts = (d.groupBy(*key, b).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.coalesce(
                  F.sum("_n").over(Window.partitionBy(*key).orderBy(b)
                                   .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("_n"))
    return (d.join(counts, [*key, b])
            .withColumn(out, (F.col("_before") + F.col("_rn_in")).cast("int"))
            .drop("_rn_in", "_before", b))
