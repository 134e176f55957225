"""Alert rules over activity: windows of commit latency and steps of the rollback ratio."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tally.operators import monitor as O

SCHEMA = "ts timestamp, event_type string, outcome string, latency_ms double"
START = datetime(2025, 3, 1)


def _rows(spark, rows):
    return spark.createDataFrame([(START + t, "OPERATION_OUTCOME", o, ms) for t, o, ms in rows], SCHEMA)


def test_latency_alert_fires_on_one_window(spark):
    """A slow window is found though the p99 of the whole day stays under the limit."""
    calm = [(timedelta(minutes=5 * w, seconds=s), "COMMITTED", float(20 + s % 40)) for w in range(40) for s in range(100)]
    slow = [(timedelta(minutes=202, seconds=s), "COMMITTED", 400.0) for s in range(20)]
    activity = _rows(spark, calm + slow + [(timedelta(hours=9), "COMMITTED", None)])
    found = {r["window_start"]: r for r in O.latency_windows(O.latency_histogram(activity)).collect()}
    assert [w for w, r in found.items() if r["breached"]] == ["2025-03-01 03:20"]
    assert found["2025-03-01 03:20"]["commits"] == 20 and sum(r["commits"] for r in found.values()) == 4020
    assert activity.agg(F.percentile("latency_ms", 0.99)).first()[0] < 150


def test_histograms_merge_to_the_exact_percentile(spark):
    rows = [(timedelta(seconds=7 * k), "COMMITTED", float(k * k % 211)) for k in range(900)]
    activity = _rows(spark, rows)
    merged = (O.latency_histogram(activity).groupBy("latency_ms").agg(F.sum("n").alias("n"))
              .agg(F.percentile("latency_ms", 0.99, F.col("n"))).first()[0])
    assert merged == activity.agg(F.percentile("latency_ms", 0.99)).first()[0]


def test_rollback_step(spark):
    rows = [(timedelta(days=d, minutes=k), "ROLLED_BACK" if k < (40 if d == 9 else 5 + d % 2) else "COMMITTED", 10.0)
            for d in range(10) for k in range(100)]
    found = O.rollback_step_change(_rows(spark, rows)).collect()
    assert [r["day"] for r in found if r["step_change"]] == ["2025-03-10"]
    assert O.rollback_step_change(_rows(spark, rows).limit(0)).collect() == []
