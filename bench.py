"""Benchmark: headline ledger queries on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR``.

Prints ONE JSON line::

    {"metric": "headline_total", "value": <sec>, "unit": "sec", "queries": {...}, "sf": ...}

Two parts:

1. the registered headline queries over the fixture ledger (each result is
   fully computed and discarded with the ``noop`` sink, nothing is collected);
2. the reference's own benchmark shape: a generated ledger of
   ``$BENCH_GEN_TXN`` headers (two legs each, 24 months, default 2,000,000
   headers = 4,000,000 entries), the one-month settlement report over a flat
   table, over the month-partitioned table, and from the refreshed rollup.
   ``value`` is the sum of part 1; part 2 is reported per step, cold (first
   run) and ``_warm`` (best of two repeats).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tally.functions.columns import half_open, month_end, month_start  # noqa: E402
from tally.operators import reports as R  # noqa: E402
from tally.plans.registry import spark_callables  # noqa: E402
from tally.session import get_spark, scratch_path  # noqa: E402
from tally.sources.fixtures import Ledger  # noqa: E402
from tally.sources.storage import generate_ledger, overwrite_months, write_by_month  # noqa: E402

HEADLINE = [
    "settlement_report", "settlement_year", "monthly_rollup", "net_movement", "balance_audit", "balance_drift",
    "zero_sum_violations", "posting_accepted", "posting_quarantine", "fk_orphans", "duplicate_keys",
    "violations_all", "wallet_statement", "trial_balance", "idempotency_resolve", "audit_correlation",
    "backfill_result", "fraud_rings", "referral_clusters", "stream_zero_sum", "stream_dedup", "stream_latency",
]
GEN_MONTH = "2025-06"


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def cold_and_warm(out: dict, name: str, make) -> None:
    """First run (cold: plan, code generation, file listing) and best of two repeats (warm)."""
    out[name] = timed(lambda: consume(make()))
    out[f"{name}_warm"] = min(timed(lambda: consume(make())) for _ in range(2))


def generated_ledger_bench(spark, n_txn: int) -> dict[str, float]:
    out: dict[str, float] = {}
    base = scratch_path(spark, "bench-gen")
    headers, entries = generate_ledger(spark.range(1, n_txn + 1).withColumnRenamed("id", "i"))
    # the library's own layout: headers and entries by month
    out["gen_write_flat"] = timed(lambda: (write_by_month(headers, f"{base}/headers"),
                                           entries.write.parquet(f"{base}/entries_flat")))
    flat = spark.read.parquet(f"{base}/entries_flat")
    out["gen_write_partitioned"] = timed(lambda: write_by_month(flat, f"{base}/entries"))
    hdr = spark.read.parquet(f"{base}/headers").withColumn("posting_month", F.col("posting_month").cast("string"))
    part = spark.read.parquet(f"{base}/entries")
    start, end = month_start(GEN_MONTH), month_end(GEN_MONTH)

    def flat_report():   # the "before" shape: range on the entries only, no partition column
        e = flat.filter(half_open("created_at", start, end)).select("transaction_id", "wallet_id", "currency",
                                                                   "amount")
        t = hdr.filter(F.col("status") == "SETTLED").select("transaction_id")
        return (e.join(t, "transaction_id", "left_semi").groupBy("wallet_id", "currency")
                .agg(F.sum("amount").cast("decimal(38,4)").alias("settled_total")))

    cold_and_warm(out, "gen_report_flat", flat_report)
    cold_and_warm(out, "gen_report_partitioned", lambda: R.settlement_report(part, hdr, GEN_MONTH))
    rollup_path = f"{base}/rollup"
    out["gen_rollup_refresh"] = timed(lambda: overwrite_months(
        R.monthly_rollup(part, hdr, [GEN_MONTH]), rollup_path))
    cold_and_warm(out, "gen_report_rollup",
                  lambda: spark.read.parquet(rollup_path).filter(F.col("month") == GEN_MONTH))
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    n_txn = int(os.environ.get("BENCH_GEN_TXN", "2000000"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k] or HEADLINE
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=2 * cpus, app="tally-bench")
    qs = spark_callables()
    times: dict[str, float] = {}
    # one-time costs, timed and counted on their own: JVM warm-up, then deriving and storing the
    # fixture ledger (every query after it reads the stored, month-partitioned copy)
    times["session_warmup"] = timed(lambda: spark.range(1_000_000).selectExpr("sum(id)").collect())
    times["ledger_store"] = timed(lambda: (Ledger(spark, sf_dir).entries_with_keys, None))
    for k in only:
        times[k] = timed(lambda k=k: consume(qs[k](spark, sf_dir)))
    total = round(sum(times.values()), 3)
    if n_txn > 0:
        times.update(generated_ledger_bench(spark, n_txn))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus, "generated_headers": n_txn}))
    spark.stop()


if __name__ == "__main__":
    main()
