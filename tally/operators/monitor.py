"""Monitoring metrics computed from ledger and activity data, and rule evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tally import constants as K
from tally.operators import integrity as I
from tally.operators import reports as R


def _seconds_between(later, earlier):
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(1_000_000)


def pending_backlog(transactions: DataFrame, as_of) -> DataFrame:
    """AGG-8 / OBS-2: pending count and oldest pending age (minutes) at ``as_of``, per header type."""
    return (transactions.filter(F.col("status") == "PENDING").groupBy("type")
            .agg(F.count(F.lit(1)).alias("pending_count"), F.min("created_at").alias("oldest_pending"))
            .withColumn("oldest_age_minutes",
                        (_seconds_between(F.lit(as_of), F.col("oldest_pending")) / 60).cast("bigint")))


def reversal_rate(transactions: DataFrame) -> DataFrame:
    """AGG-9: share of REVERSED headers per day."""
    return (transactions.groupBy(F.date_format("created_at", "yyyy-MM-dd").alias("day"))
            .agg(F.count(F.lit(1)).alias("headers"),
                 F.sum((F.col("status") == "REVERSED").cast("bigint")).alias("reversed"))
            .withColumn("reversal_rate", F.round(F.col("reversed") / F.col("headers"), 6)))


def rollback_ratio(activity: DataFrame) -> DataFrame:
    """AGG-9: rolled-back share of operation outcomes per day."""
    out = activity.filter(F.col("event_type") == "OPERATION_OUTCOME")
    return (out.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"))
            .agg(F.count(F.lit(1)).alias("outcomes"),
                 F.sum((F.col("outcome") == "ROLLED_BACK").cast("bigint")).alias("rolled_back"))
            .withColumn("rollback_ratio", F.round(F.col("rolled_back") / F.col("outcomes"), 6)))


def latency_percentiles(activity: DataFrame) -> DataFrame:
    """AGG-10 / OBS-4: exact p50/p95/p99 per outcome type.

    ``percentile`` keeps a value->count map per group; latencies are whole
    milliseconds, so its size is bounded by distinct latencies, not by rows.
    """
    d = activity.filter(F.col("latency_ms").isNotNull())
    return (d.groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.round(F.percentile("latency_ms", 0.5), 3).alias("p50_ms"),
                 F.round(F.percentile("latency_ms", 0.95), 3).alias("p95_ms"),
                 F.round(F.percentile("latency_ms", 0.99), 3).alias("p99_ms")))


def step_change(daily: DataFrame, rate: str, z_threshold: float = 3.0) -> DataFrame:
    """WIN-4: a daily rate vs its trailing 7-day baseline (window over one row per day)."""
    w = Window.orderBy("day").rowsBetween(-7, -1)
    base_avg, base_std = F.avg(rate).over(w), F.stddev(rate).over(w)
    z = (F.col(rate) - F.col("baseline_avg")) / F.col("baseline_std")
    return (daily.select("day", rate, base_avg.alias("baseline_avg"), base_std.alias("baseline_std"))
            .withColumn("z", F.when(F.col("baseline_std") > 0, F.round(z, 4)))
            .withColumn("step_change", F.coalesce(F.abs(F.col("z")) > z_threshold, F.lit(False)))
            .withColumn("baseline_avg", F.round("baseline_avg", 6))
            .withColumn("baseline_std", F.round("baseline_std", 6)))


def reversal_step_change(transactions: DataFrame, z_threshold: float = 3.0) -> DataFrame:
    """WIN-4: step change of the daily reversal rate."""
    return step_change(reversal_rate(transactions), "reversal_rate", z_threshold)


def rollback_step_change(activity: DataFrame, z_threshold: float = 3.0) -> DataFrame:
    """WIN-4: step change of the daily rollback ratio."""
    return step_change(rollback_ratio(activity), "rollback_ratio", z_threshold)


def latency_histogram(activity: DataFrame, minutes: int = K.LATENCY_WINDOW_MINUTES) -> DataFrame:
    """Commit latencies as (window_start, latency_ms, n): latencies are whole milliseconds, so a window's histogram
    is exact and bounded, combines map-side, and histograms of any windows merge by summing ``n``."""
    commits = activity.filter((F.col("event_type") == "OPERATION_OUTCOME") & F.col("latency_ms").isNotNull())
    return (commits.groupBy(F.window("ts", f"{minutes} minutes").getField("start").alias("window_start"), "latency_ms")
            .agg(F.count(F.lit(1)).alias("n")))


def latency_windows(histogram: DataFrame, limit_ms: float = K.COMMIT_P99_LIMIT_MS) -> DataFrame:
    """OBS-6: commit p99 of every window from its histogram, and whether it is above the limit."""
    return (histogram.groupBy("window_start")
            .agg(F.sum("n").alias("commits"), F.percentile("latency_ms", 0.99, F.col("n")).alias("p99_ms"))
            .select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "commits",
                    F.round("p99_ms", 3).alias("p99_ms"), (F.col("p99_ms") > limit_ms).alias("breached")))


def integrity_panel(entries: DataFrame, wallets: DataFrame) -> DataFrame:
    """OBS-1: drift rows, non-zero currencies and unbalanced transactions as (metric, value)."""
    drift = I.balance_drift(wallets, entries).agg(F.count(F.lit(1)).alias("v")) \
        .select(F.lit("drift_rows").alias("metric"), "v")
    nonzero = R.global_zero_sum(entries).agg(F.sum((F.col("imbalance") != 0).cast("bigint")).alias("v")) \
        .select(F.lit("nonzero_currencies").alias("metric"), "v")
    unbalanced = I.zero_sum_violations(entries).agg(F.count(F.lit(1)).alias("v")) \
        .select(F.lit("unbalanced_groups").alias("metric"), "v")
    return drift.unionByName(nonzero).unionByName(unbalanced).select("metric", F.col("v").cast("bigint").alias("value"))


def partition_runway(entries: DataFrame, as_of, first: str = K.FIRST_PARTITION_MONTH,
                     last: str = K.LAST_PARTITION_MONTH) -> DataFrame:
    """OBS-3: every month from the first posting to the month after ``as_of``: provisioned or not,
    entries held, and the rows that would land in DEFAULT."""
    counts = entries.groupBy("posting_month").agg(F.count(F.lit(1)).alias("entries"))
    bounds = entries.agg(F.min("created_at").alias("lo"))
    months = bounds.select(F.explode(F.sequence(F.trunc(F.col("lo").cast("date"), "MM"),
                                                F.add_months(F.trunc(F.lit(as_of).cast("date"), "MM"), 1),
                                                F.expr("INTERVAL 1 MONTH"))).alias("m")) \
        .select(F.date_format("m", "yyyy-MM").alias("posting_month"))
    provisioned = (F.col("posting_month") >= first) & (F.col("posting_month") <= last)
    return (months.join(counts, "posting_month", "left")
            .select("posting_month", provisioned.alias("provisioned"),
                    F.coalesce("entries", F.lit(0)).alias("entries"),
                    F.when(~provisioned, F.coalesce("entries", F.lit(0))).otherwise(F.lit(0)).alias("default_rows")))


def slo_attainment(activity: DataFrame, minutes: int = K.SETTLE_SLO_MINUTES) -> DataFrame:
    """OBS-5: share of received requests with an outcome within ``minutes``, per day."""
    rec = activity.filter(F.col("event_type") == "REQUEST_RECEIVED").select("request_id", F.col("ts").alias("t0"))
    out = (activity.filter(F.col("event_type").isin("OPERATION_OUTCOME", "IDEMPOTENT_REPLAY",
                                                    "VALIDATION_REJECTED"))
           .select("request_id", F.col("ts").alias("t1")))
    within = F.coalesce(_seconds_between(F.col("t1"), F.col("t0")) <= minutes * 60, F.lit(False))
    return (rec.join(out, "request_id", "left")
            .groupBy(F.date_format("t0", "yyyy-MM-dd").alias("day"))
            .agg(F.count(F.lit(1)).alias("requests"), F.sum(within.cast("bigint")).alias("attained"))
            .withColumn("share", F.round(F.col("attained") / F.col("requests"), 6)))


# Alert rules (metric, comparator, threshold, severity) from the alert table.
ALERT_RULES = [
    ("drift_rows", ">", 0.0, "PAGE"),
    ("nonzero_currencies", ">", 0.0, "PAGE"),
    ("oldest_pending_minutes", ">", 15.0, "PAGE"),
    ("default_partition_rows", ">", 0.0, "PAGE"),
    ("next_month_missing", ">", 0.0, "PAGE"),
    ("commit_latency_p99_ms", ">", 150.0, "PAGE"),
    ("pending_backlog", ">", 1000.0, "TICKET"),
    ("reversal_step_changes", ">", 0.0, "TICKET"),
    ("rollback_step_changes", ">", 0.0, "TICKET"),
    ("commit_latency_breached_windows", ">", 0.0, "PAGE"),
]


def metrics_long(entries: DataFrame, wallets: DataFrame, transactions: DataFrame, activity: DataFrame,
                 as_of) -> DataFrame:
    """Every alert metric as one (metric, value) row computed from the data."""
    def one(df, name, expr):
        return df.agg(expr.cast("double").alias("value")).select(F.lit(name).alias("metric"), "value")
    pend = transactions.filter(F.col("status") == "PENDING")
    runway = partition_runway(entries, as_of)
    next_month = (F.add_months(F.trunc(F.lit(as_of).cast("date"), "MM"), 1))
    parts = [
        one(I.balance_drift(wallets, entries), "drift_rows", F.count(F.lit(1))),
        one(R.global_zero_sum(entries), "nonzero_currencies", F.sum((F.col("imbalance") != 0).cast("int"))),
        one(pend, "oldest_pending_minutes",
            F.coalesce(_seconds_between(F.lit(as_of), F.min("created_at")) / 60, F.lit(0))),
        one(runway, "default_partition_rows", F.sum("default_rows")),
        one(runway.filter(F.col("posting_month") == F.date_format(next_month, "yyyy-MM")), "next_month_missing",
            F.sum((~F.col("provisioned")).cast("int"))),
        one(activity.filter(F.col("event_type") == "OPERATION_OUTCOME"), "commit_latency_p99_ms",
            F.percentile("latency_ms", 0.99)),
        one(pend, "pending_backlog", F.count(F.lit(1))),
        one(reversal_step_change(transactions), "reversal_step_changes",
            F.sum(F.col("step_change").cast("int"))),
        one(rollback_step_change(activity), "rollback_step_changes", F.sum(F.col("step_change").cast("int"))),
        one(latency_windows(latency_histogram(activity)), "commit_latency_breached_windows",
            F.sum(F.col("breached").cast("int"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def alert_evaluation(spark: SparkSession, metrics: DataFrame) -> DataFrame:
    """OBS-6: metrics joined to the rule table -> OK or the rule's severity."""
    rules = spark.createDataFrame(ALERT_RULES, "metric string, comparator string, threshold double, severity string")
    fired = F.when(F.col("comparator") == ">", F.col("value") > F.col("threshold")) \
             .otherwise(F.col("value") < F.col("threshold"))
    return (metrics.join(F.broadcast(rules), "metric")       # the rule table is fixed-size
            .select("metric", F.round("value", 3).alias("value"), "threshold",
                    F.when(fired, F.col("severity")).otherwise(F.lit("OK")).alias("status")))
