"""Expand / backfill / promote / contract as data jobs over the month-partitioned entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally import constants as K
from tally.sources.storage import write_by_month

COLUMN = "settlement_batch_id"


def expand_read(spark: SparkSession, path: str, schema) -> DataFrame:
    """MIG-1: old files (no column) and new files (column) read as one; missing -> NULL."""
    return spark.read.schema(schema).option("mergeSchema", "true").parquet(path)


def months_needing_backfill(df: DataFrame, column: str = COLUMN) -> list[str]:
    """The partition list (one small row per month) -- metadata, not data, comes to the driver."""
    return sorted(r[0] for r in df.filter(F.col(column).isNull()).select("posting_month").distinct().collect())


def backfill(spark: SparkSession, path: str, column: str = COLUMN, sentinel: str = K.SENTINEL_BATCH,
             months_per_commit: int = 12, log: str | None = None) -> int:
    """MIG-2: resumable backfill -- only NULL rows change, live values are kept.

    Months go in groups.  A group is staged whole under ``log`` (default:
    ``<path>.backfill``) and appears there by a rename; then it is swapped in
    with a dynamic partition overwrite, which is the commit, and only then its
    stage is dropped.  The swap deletes before it renames, so a run that died
    in between leaves its stage behind: a rerun first swaps in every stage it
    finds, whatever the table shows of those months, then goes on with the
    months that still hold NULLs.  Returns months touched.
    """
    log = log or f"{path.rstrip('/')}.backfill"
    schema = spark.read.parquet(path).schema

    def swap_in(stage: str) -> None:
        write_by_month(spark.read.schema(schema).parquet(stage), path, dynamic=True)
        _drop(spark, stage)

    for name in _children(spark, log):
        if not name.endswith(".tmp"):
            swap_in(f"{log}/{name}")
    months = months_needing_backfill(spark.read.parquet(path), column)
    for i in range(0, len(months), months_per_commit):
        group = months[i:i + months_per_commit]
        stage = f"{log}/{group[0]}_{group[-1]}"
        part = spark.read.parquet(path).filter(F.col("posting_month").isin(group))
        part.withColumn(column, F.coalesce(F.col(column), F.lit(sentinel))).write.mode("overwrite").parquet(f"{stage}.tmp")
        _rename(spark, f"{stage}.tmp", stage)
        swap_in(stage)
    return len(months)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    if not fs.rename(p, _fs(spark, target)[1]):
        raise RuntimeError(f"cannot rename {source} to {target}")


def _drop(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def backfill_progress(df: DataFrame, column: str = COLUMN) -> DataFrame:
    """AGG-13 / MIG-3: rows and remaining NULLs per month."""
    return (df.groupBy("posting_month")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.sum(F.col(column).isNull().cast("bigint")).alias("null_rows"))
            .withColumn("done", F.col("null_rows") == 0))


def promote_check(df: DataFrame, column: str = COLUMN) -> DataFrame:
    """MIG-4: the NOT NULL promotion is allowed only when no NULL is left (one scan)."""
    return (df.agg(F.count(F.lit(1)).alias("rows"),
                   F.sum(F.col(column).isNull().cast("bigint")).alias("null_rows"))
            .withColumn("can_promote", F.col("null_rows") == 0))


def require_promotable(df: DataFrame, column: str = COLUMN) -> None:
    n = promote_check(df, column).first()["null_rows"]
    if n:
        raise ValueError(f"{column}: {n} NULL rows remain; backfill before promoting")


def nulls_after_deploy(df: DataFrame, deploy_ts, column: str = COLUMN) -> DataFrame:
    """PRJ-9: NULLs written after the dual-write deploy, per month (all zero when dual-write works)."""
    return (df.filter(F.col("created_at") > F.lit(deploy_ts))
            .groupBy("posting_month")
            .agg(F.sum(F.col(column).isNull().cast("bigint")).alias("null_rows")))


def settled_without_batch(entries_v: DataFrame, transactions: DataFrame, column: str = COLUMN) -> DataFrame:
    """MIG-5: SETTLED postings that carry no batch."""
    settled = transactions.filter(F.col("status") == "SETTLED").select("transaction_id")
    return (entries_v.filter(F.col(column).isNull()).join(settled, "transaction_id", "left_semi")
            .select("entry_id", "transaction_id", "posting_month"))


def batch_orphans(entries_v: DataFrame, batches: DataFrame, column: str = COLUMN) -> DataFrame:
    """MIG-6: batch ids with no batch row (the FK the column does not have)."""
    return (entries_v.filter(F.col(column).isNotNull())
            .join(batches.select(F.col("settlement_batch_id").alias(column)), column, "left_anti")
            .select("entry_id", column, "posting_month"))


def shape_old(df: DataFrame, column: str = COLUMN) -> DataFrame:
    """MIG-7: the reader of app version N (ignores the new column)."""
    return df.drop(column)


def shape_new(df: DataFrame, column: str = COLUMN) -> DataFrame:
    """MIG-7: the reader of app version N+2 (requires the column)."""
    return df.select("entry_id", "transaction_id", "posting_month", column).filter(F.col(column).isNotNull())


def backfill_undo(df: DataFrame, column: str = COLUMN, sentinel: str = K.SENTINEL_BATCH) -> DataFrame:
    """MIG-8: un-fill the sentinel (restores the pre-backfill column)."""
    return df.withColumn(column, F.when(F.col(column) == sentinel, F.lit(None)).otherwise(F.col(column)))


def backfill_invariance(before: DataFrame, after: DataFrame) -> DataFrame:
    """MIG-9: per (month, currency) count and money sum before vs after the backfill."""
    def summary(df, tag):
        return df.groupBy("posting_month", "currency").agg(
            F.count(F.lit(1)).alias(f"{tag}_rows"), F.sum("amount").cast("decimal(38,4)").alias(f"{tag}_amount"))
    return (summary(before, "before").join(summary(after, "after"), ["posting_month", "currency"], "full_outer")
            .withColumn("unchanged", F.col("before_rows").eqNullSafe(F.col("after_rows"))
                        & F.col("before_amount").eqNullSafe(F.col("after_amount"))))


def hot_archive_split(df: DataFrame, as_of_month: str, hot_months: int = K.HOT_MONTHS) -> tuple[DataFrame, DataFrame]:
    """MIG-10: months within ``hot_months`` of ``as_of_month`` stay hot; the rest is archive."""
    y, m = (int(x) for x in as_of_month.split("-"))
    idx = y * 12 + m - 1 - hot_months
    first_hot = f"{idx // 12:04d}-{idx % 12 + 1:02d}"
    hot = df.filter(F.col("posting_month") >= first_hot)
    archive = df.filter(F.col("posting_month") < first_hot)
    return hot, archive
