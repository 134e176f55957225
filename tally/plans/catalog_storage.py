"""Registered storage queries (SRC-3/4, SNK-1/2, SET-1).  These write to the shared folder
(``spark.checkpoint.dir``) and return what a reader sees afterwards."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally import constants as K
from tally.functions.columns import MONEY_SUM
from tally.operators import reports as R
from tally.operators.snapshots import multiset_difference
from tally.plans.registry import query
from tally.session import scratch_path
from tally.sources import storage as S


def _gen_sql():
    def lane(k, n):
        return f"(CAST('0x' || substr(md5(g), {8 * k + 1}, 8) AS BIGINT) % {n})"

    status, top = "CASE", 0
    for value, share in S.GEN_STATUS_PERCENT:
        top += share
        status += f" WHEN {lane(0, 100)} < {top} THEN '{value}'"
    wallets = S.GEN_WALLETS
    return f"""
    WITH h AS (
      SELECT g AS transaction_id, {status} END AS status,
             TIMESTAMP '{S.GEN_START}' + to_seconds({lane(1, S.GEN_DAYS * 86_400)}) AS created_at,
             CAST(CAST({lane(2, 10_000_000)} + 100 AS DECIMAL(19,4)) / 100 AS DECIMAL(19,4)) AS amount,
             {list(S.GEN_CURRENCIES)}[1 + {lane(2, len(S.GEN_CURRENCIES))}] AS currency,
             {lane(3, wallets)} AS payer, 1 + {lane(0, wallets - 1)} AS distance
      FROM (SELECT 'G' || lpad(CAST(o_orderkey + 1 AS VARCHAR), 12, '0') AS g FROM orders)),
    legs AS (
      SELECT *, 'DEBIT' AS type, payer AS w FROM h UNION ALL SELECT *, 'CREDIT', (payer + distance) % {wallets} FROM h)
    SELECT transaction_id || '-' || type AS entry_id, transaction_id, 'GW-' || CAST(w AS VARCHAR) AS wallet_id, type,
           CAST(amount AS DOUBLE) AS amount, currency, created_at, status, strftime(created_at, '%Y-%m') AS posting_month
    FROM legs"""


@query("generate_ledger", _gen_sql())
def _generate_ledger(L):
    """SRC-3: the benchmark generator driven by the order keys (grows with the data)."""
    headers, entries = S.generate_ledger(L.raw("orders").select((F.col("o_orderkey") + 1).alias("i")))
    return entries.join(headers.select("transaction_id", "status"), "transaction_id")


@query("flat_to_partitioned", """
    SELECT posting_month, COUNT(*) AS rows, CAST(SUM(amount) AS DOUBLE) AS amount FROM entries GROUP BY posting_month""")
def _flat_to_partitioned(L):
    """SRC-4: flat entries rewritten month-partitioned, read back per month."""
    flat = scratch_path(L.spark, "entries-flat")
    L.entries.drop("posting_month").write.mode("overwrite").parquet(flat)
    part = S.flat_to_partitioned(L.spark, flat, scratch_path(L.spark, "entries-part"))
    return part.groupBy("posting_month").agg(F.count(F.lit(1)).alias("rows"),
                                             F.sum("amount").cast(MONEY_SUM).alias("amount"))


@query("partition_route", f"""
    SELECT CASE WHEN posting_month BETWEEN '{K.FIRST_PARTITION_MONTH}' AND '{K.LAST_PARTITION_MONTH}'
                THEN posting_month ELSE '{K.DEFAULT_PARTITION}' END AS entry_partition, COUNT(*) AS rows
    FROM entries GROUP BY 1""")
def _partition_route(L):
    """SNK-1: entries routed to their month or to DEFAULT, read back per partition."""
    path = scratch_path(L.spark, "entries-routed")
    S.write_routed(L.entries.drop("posting_month"), path)
    return L.spark.read.parquet(path).groupBy("entry_partition").agg(F.count(F.lit(1)).alias("rows"))


@query("rollup_refresh", """
    SELECT e.posting_month AS month, e.wallet_id, e.currency, CAST(SUM(e.amount) AS DOUBLE) AS settled_total,
           COUNT(*) AS entry_count
    FROM entries e JOIN transactions t ON t.transaction_id = e.transaction_id
    WHERE t.status = 'SETTLED'
    GROUP BY e.posting_month, e.wallet_id, e.currency""")
def _rollup_refresh(L):
    """SNK-2: a stale month in the rollup is replaced by a refresh; other months untouched."""
    path = scratch_path(L.spark, "rollup")
    good = R.monthly_rollup(L.entries, L.transactions).filter(F.col("month") != K.REPORT_MONTH)
    stale = (L.entries.filter(F.col("posting_month") == K.REPORT_MONTH)       # every status: wrong on purpose
             .groupBy(F.col("posting_month").alias("month"), "wallet_id", "currency")
             .agg(F.sum("amount").cast(MONEY_SUM).alias("settled_total"), F.count(F.lit(1)).alias("entry_count")))
    S.write_by_month(good.unionByName(stale), path, month_col="month", key_col="wallet_id")
    refreshed = R.monthly_rollup(L.entries, L.transactions, [K.REPORT_MONTH])
    S.overwrite_months(refreshed, path)
    return L.spark.read.parquet(path)


@query("result_equivalence", f"""
    SELECT 'flat_minus_partitioned' AS direction, CAST(0 AS BIGINT) AS rows
    UNION ALL SELECT 'partitioned_minus_flat', 0
    UNION ALL SELECT 'groups', COUNT(*) FROM (
      SELECT e.wallet_id, e.currency FROM entries e JOIN transactions t ON t.transaction_id = e.transaction_id
      WHERE t.status = 'SETTLED' AND e.posting_month = '{K.REPORT_MONTH}'
      GROUP BY e.wallet_id, e.currency)""")
def _result_equivalence(L):
    """SET-1: the report from a flat table and from the partitioned table are identical (fingerprints in one pass)."""
    flat_path, part_path = scratch_path(L.spark, "eq-flat"), scratch_path(L.spark, "eq-part")
    L.entries.write.mode("overwrite").parquet(flat_path)
    S.write_by_month(L.entries, part_path)
    flat = R.settlement_report(L.spark.read.parquet(flat_path), L.transactions, K.REPORT_MONTH)
    part = R.settlement_report(L.spark.read.parquet(part_path), L.transactions, K.REPORT_MONTH)
    only_flat, only_part, groups = multiset_difference(flat, part)
    rows = [("flat_minus_partitioned", only_flat), ("partitioned_minus_flat", only_part), ("groups", groups)]
    return L.spark.createDataFrame(rows, "direction string, rows bigint")
