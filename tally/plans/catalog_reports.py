"""Registered report queries (AGG-1/2/3/5/6/12/16/17, SET-3, WIN-1/7, PRJ-1/2/6, SRC-1/2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally import constants as K
from tally.functions.columns import month_end, month_start
from tally.operators import reports as R
from tally.plans.registry import query
from tally.session import scratch_path
from tally.sources.storage import overwrite_months

M = K.REPORT_MONTH
MS, ME = month_start(M), month_end(M)
RANGE_E = f"e.created_at >= TIMESTAMP '{MS}' AND e.created_at < TIMESTAMP '{ME}'"
RANGE_T = f"t.created_at >= TIMESTAMP '{MS}' AND t.created_at < TIMESTAMP '{ME}'"


@query("settlement_report", f"""
    SELECT e.wallet_id, e.currency, CAST(SUM(e.amount) AS DOUBLE) AS settled_total
    FROM entries e JOIN transactions t ON t.transaction_id = e.transaction_id
    WHERE t.status = 'SETTLED' AND {RANGE_E} AND {RANGE_T}
    GROUP BY e.wallet_id, e.currency""")
def _settlement_report(L):
    """Flagship: gross settled total per wallet and currency for the report month."""
    return R.settlement_report(L.entries, L.headers, M)


@query("settlement_year", """
    SELECT e.posting_month, e.wallet_id, e.currency, CAST(SUM(e.amount) AS DOUBLE) AS settled_total
    FROM entries e JOIN transactions t ON t.transaction_id = e.transaction_id
    WHERE t.status = 'SETTLED' AND e.created_at >= TIMESTAMP '1998-01-01' AND e.created_at < TIMESTAMP '1999-01-01'
      AND strftime(t.created_at, '%Y-%m') = e.posting_month
    GROUP BY e.posting_month, e.wallet_id, e.currency""")
def _settlement_year(L):
    """The report for every month of 1998 in one job (the entry() query)."""
    return R.settlement_by_month(L.entries, L.headers, "1998-01", "1998-12")


@query("settled_headers", f"""
    SELECT transaction_id, type, created_at FROM transactions t
    WHERE t.status = 'SETTLED' AND {RANGE_T}""")
def _settled_headers(L):
    """PRJ-2: settled headers of the report month."""
    return R.settled_headers(L.headers, MS, ME).select("transaction_id", "type", "created_at")


@query("month_scan", f"""
    SELECT entry_id, transaction_id, wallet_id, type, amount::DOUBLE AS amount, currency, created_at
    FROM entries e WHERE {RANGE_E}""")
def _month_scan(L):
    """SRC-2 + PRJ-1: one posting month of entries."""
    return R.month_scan(L.entries, M).drop("posting_month")


@query("scan_entries", """
    SELECT entry_id, transaction_id, wallet_id, type, amount::DOUBLE AS amount, currency, created_at, posting_month
    FROM entries""")
def _scan_entries(L):
    """SRC-1: the entries fact with its declared schema."""
    return L.entries


@query("net_movement", f"""
    SELECT e.wallet_id, e.currency,
           CAST(SUM(CASE WHEN e.type = 'CREDIT' THEN e.amount ELSE -e.amount END) AS DOUBLE) AS net_total
    FROM entries e JOIN transactions t ON t.transaction_id = e.transaction_id
    WHERE t.status = 'SETTLED' AND {RANGE_E} AND {RANGE_T}
    GROUP BY e.wallet_id, e.currency""")
def _net_movement(L):
    """AGG-2 / PRJ-6: signed settled movement per wallet for the report month."""
    return R.net_movement(L.entries, L.headers, M)


@query("debit_credit_totals", """
    SELECT wallet_id, currency,
           CAST(COALESCE(SUM(amount) FILTER (WHERE type = 'DEBIT'), 0) AS DOUBLE) AS debits,
           CAST(COALESCE(SUM(amount) FILTER (WHERE type = 'CREDIT'), 0) AS DOUBLE) AS credits,
           COUNT(*) AS entry_count
    FROM entries GROUP BY wallet_id, currency""")
def _debit_credit_totals(L):
    """AGG-3: conditional sums per wallet."""
    return R.debit_credit_totals(L.entries)


@query("monthly_rollup", """
    SELECT e.posting_month AS month, e.wallet_id, e.currency, CAST(SUM(e.amount) AS DOUBLE) AS settled_total,
           COUNT(*) AS entry_count
    FROM entries e JOIN transactions t ON t.transaction_id = e.transaction_id
    WHERE t.status = 'SETTLED'
    GROUP BY e.posting_month, e.wallet_id, e.currency""")
def _monthly_rollup(L):
    """AGG-6: the per-(month, wallet, currency) rollup over every month."""
    return R.monthly_rollup(L.entries, L.transactions)


@query("global_zero_sum", """
    SELECT currency,
           CAST(COALESCE(SUM(amount) FILTER (WHERE type = 'DEBIT'), 0) AS DOUBLE) AS debits,
           CAST(COALESCE(SUM(amount) FILTER (WHERE type = 'CREDIT'), 0) AS DOUBLE) AS credits,
           CAST(COALESCE(SUM(amount) FILTER (WHERE type = 'CREDIT'), 0)
                - COALESCE(SUM(amount) FILTER (WHERE type = 'DEBIT'), 0) AS DOUBLE) AS imbalance
    FROM entries GROUP BY currency""")
def _global_zero_sum(L):
    """AGG-5: system-wide per-currency zero-sum."""
    return R.global_zero_sum(L.entries)


@query("multi_grain_summary", """
    SELECT year, month, day, hour, currency, CAST(grouping(month) * 4 + grouping(day) * 2 + grouping(hour) AS BIGINT) AS grain,
           COUNT(*) AS entry_count, CAST(SUM(amount) AS DOUBLE) AS volume
    FROM (SELECT CAST(year(created_at) AS BIGINT) AS year, strftime(created_at, '%Y-%m') AS month,
                 strftime(created_at, '%Y-%m-%d') AS day, CAST(hour(created_at) AS BIGINT) AS hour, currency, amount
          FROM entries)
    GROUP BY GROUPING SETS ((year, currency), (year, month, currency), (year, month, day, currency),
                            (year, month, day, hour, currency))""")
def _multi_grain_summary(L):
    """AGG-12: year / month / day / hour summaries with grouping id."""
    return R.multi_grain_summary(L.entries)


@query("wallet_statement", """
    SELECT wallet_id, entry_id, created_at, type, amount::DOUBLE AS amount, currency,
           CAST(SUM(CASE WHEN type = 'CREDIT' THEN amount ELSE -amount END)
                OVER (PARTITION BY wallet_id ORDER BY created_at, entry_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_balance
    FROM entries""")
def _wallet_statement(L):
    """WIN-1: running balance per wallet (bucketed, skew-safe)."""
    return R.wallet_statement(L.entries)


@query("trial_balance", """
    SELECT a.type AS account_type, w.currency,
           CAST(SUM(CASE WHEN e.type = 'CREDIT' THEN e.amount ELSE -e.amount END) AS DOUBLE) AS balance,
           COUNT(*) AS entry_count
    FROM entries e JOIN wallets w ON w.wallet_id = e.wallet_id JOIN accounts a ON a.account_id = w.account_id
    GROUP BY a.type, w.currency""")
def _trial_balance(L):
    """AGG-17: balance per account type and currency."""
    return R.trial_balance(L.entries, L.wallets, L.accounts)


@query("fx_position", """
    SELECT currency, CAST(SUM(CASE WHEN type = 'CREDIT' THEN amount ELSE -amount END) AS DOUBLE) AS position,
           COUNT(*) AS entry_count
    FROM entries WHERE wallet_id LIKE 'FX-%' GROUP BY currency""")
def _fx_position(L):
    """AGG-16: FX desk position per currency."""
    return R.fx_position(L.entries)




@query("settlement_routed", """
    SELECT e.posting_month AS month, e.wallet_id, e.currency, CAST(SUM(e.amount) AS DOUBLE) AS settled_total
    FROM entries e JOIN transactions t ON t.transaction_id = e.transaction_id
    WHERE t.status = 'SETTLED'
      AND (e.posting_month < (SELECT max(posting_month) FROM entries)
           OR strftime(t.created_at, '%Y-%m') = e.posting_month)
    GROUP BY e.posting_month, e.wallet_id, e.currency""")
def _settlement_routed(L):
    """SET-3: every closed month from the stored rollup, the current (last) month live."""
    current = L.entries.agg(F.max("posting_month")).first()[0]
    path = scratch_path(L.spark, "routed-rollup")
    overwrite_months(R.monthly_rollup(L.entries, L.transactions).filter(F.col("month") < current), path)
    rollup = L.spark.read.parquet(path).withColumn("month", F.col("month").cast("string"))
    return R.settlement_routed(rollup, L.entries, L.headers, current)


@query("monthly_growth", """
    SELECT posting_month, entries, lag(entries) OVER (ORDER BY posting_month) AS prev_entries,
           entries - lag(entries) OVER (ORDER BY posting_month) AS delta,
           round((entries - lag(entries) OVER (ORDER BY posting_month))
                 / lag(entries) OVER (ORDER BY posting_month), 6) AS growth
    FROM (SELECT posting_month, COUNT(*) AS entries FROM entries GROUP BY posting_month)""")
def _monthly_growth(L):
    """WIN-7: month-on-month ledger growth."""
    return R.monthly_growth(L.entries)


@query("scalar_functions", """
    SELECT t.transaction_id,
           COALESCE(t.exchange_rate_id, 'none') AS rate_or_none,
           CAST(CASE WHEN t.status = 'SETTLED' THEN 1 WHEN t.status = 'PENDING' THEN 2 ELSE 3 END AS BIGINT) AS status_rank,
           md5(t.transaction_id) AS txn_md5,
           CAST(('0x' || substr(md5(t.transaction_id), 1, 8)) AS BIGINT) AS txn_hash32,
           abs(CAST(('0x' || substr(md5(t.transaction_id), 1, 8)) AS BIGINT) - 2147483648) % 1000 AS bucket,
           ['USD', 'VND', 'EUR'][1 + CAST(('0x' || substr(md5(t.transaction_id), 1, 8)) AS BIGINT) % 3] AS pick,
           strftime(date_trunc('month', t.created_at), '%Y-%m-%d') AS month_start,
           strftime(t.created_at, '%Y%m') AS yyyymm,
           t.created_at + INTERVAL 1 MONTH + INTERVAL 2 DAY + INTERVAL 3 HOUR AS shifted,
           format('{}:{}', t.transaction_id, t.status) AS label,
           length(t.transaction_id) AS id_length,
           t.type || '/' || t.status AS type_status,
           t.exchange_rate_id IS NULL AND t.status <> 'REVERSED' AS plain_open
    FROM transactions t""")
def _scalar_functions(L):
    """Scalar function surface of the reference in one projection."""
    t = L.transactions
    h = F.conv(F.substring(F.md5("transaction_id"), 1, 8), 16, 10).cast("bigint")
    return t.select(
        "transaction_id",
        F.coalesce("exchange_rate_id", F.lit("none")).alias("rate_or_none"),
        F.when(F.col("status") == "SETTLED", 1).when(F.col("status") == "PENDING", 2).otherwise(3)
         .cast("bigint").alias("status_rank"),
        F.md5("transaction_id").alias("txn_md5"),
        h.alias("txn_hash32"),
        (F.abs(h - F.lit(2147483648)) % 1000).alias("bucket"),
        F.element_at(F.array(F.lit("USD"), F.lit("VND"), F.lit("EUR")), (h % 3 + 1).cast("int")).alias("pick"),
        F.date_format(F.date_trunc("month", "created_at"), "yyyy-MM-dd").alias("month_start"),
        F.date_format("created_at", "yyyyMM").alias("yyyymm"),
        (F.col("created_at") + F.expr("INTERVAL 1 MONTH") + F.expr("INTERVAL 2 DAYS")
         + F.expr("INTERVAL 3 HOURS")).alias("shifted"),
        F.format_string("%s:%s", "transaction_id", "status").alias("label"),
        F.length("transaction_id").cast("bigint").alias("id_length"),
        F.concat_ws("/", "type", "status").alias("type_status"),
        (F.col("exchange_rate_id").isNull() & (F.col("status") != "REVERSED")).alias("plain_open"))
