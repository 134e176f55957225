"""Settlement report, rollup, statements and ledger summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tally.functions.columns import (MONEY_SUM, half_open, money_sum, month_end, month_predicate, month_start,
                                     signed_amount, sum_where)
from tally.functions.windows import bucketed_running_sum


def settled_headers(transactions: DataFrame, start=None, end=None) -> DataFrame:
    """PRJ-2: SETTLED headers, optionally inside [start, end).

    Headers stored by month (with ``posting_month``) are also filtered on it, so only those months are opened.
    """
    t = transactions.filter(F.col("status") == "SETTLED")
    if start is not None:
        t = t.filter(half_open("created_at", start, end))
        if "posting_month" in transactions.columns:
            last = end - dt.timedelta(microseconds=1)
            t = t.filter(F.col("posting_month").between(f"{start:%Y-%m}", f"{last:%Y-%m}"))
    return t


def settlement_report(entries: DataFrame, transactions: DataFrame, month: str) -> DataFrame:
    """AGG-1 + JOIN-1 + PRJ-7: gross settled amount per (wallet, currency) for one posting month.

    The month range goes on both sides: on the entries it becomes a partition
    filter plus a pushed range, on the headers a pushed range.  The header side
    only has to prove existence, so the join is a left-semi join: no header
    columns travel through the shuffle and AQE may turn it into a broadcast
    when the month's settled headers are small.
    """
    start, end = month_start(month), month_end(month)
    e = entries.filter(month_predicate(month)).select("transaction_id", "wallet_id", "currency", "amount")
    t = settled_headers(transactions, start, end).select("transaction_id")
    return (e.join(t, "transaction_id", "left_semi")
            .groupBy("wallet_id", "currency")
            .agg(money_sum("amount").alias("settled_total")))


def settlement_by_month(entries: DataFrame, transactions: DataFrame, first_month: str, last_month: str) -> DataFrame:
    """The report for a run of months at once, keyed by posting month."""
    start, end = month_start(first_month), month_end(last_month)
    e = (entries.filter((F.col("posting_month") >= first_month) & (F.col("posting_month") <= last_month))
         .filter(half_open("created_at", start, end)))
    t = settled_headers(transactions, start, end).select("transaction_id", F.col("created_at").alias("t_created"))
    # posting-time equality: the header month must be the entry month (the range is per month)
    return (e.join(t, "transaction_id")
            .filter(F.date_format("t_created", "yyyy-MM") == F.col("posting_month"))
            .groupBy("posting_month", "wallet_id", "currency")
            .agg(money_sum("amount").alias("settled_total")))


def monthly_rollup(entries: DataFrame, transactions: DataFrame, months: list[str] | None = None) -> DataFrame:
    """AGG-6: (month, wallet, currency) -> settled_total, entry_count.  No header time filter."""
    e = entries if months is None else entries.filter(F.col("posting_month").isin(months))
    t = transactions.filter(F.col("status") == "SETTLED").select("transaction_id")
    return (e.join(t, "transaction_id", "left_semi")
            .groupBy(F.col("posting_month").alias("month"), "wallet_id", "currency")
            .agg(money_sum("amount").alias("settled_total"), F.count(F.lit(1)).alias("entry_count")))


def net_movement(entries: DataFrame, transactions: DataFrame, month: str) -> DataFrame:
    """AGG-2 + PRJ-6: signed CREDIT - DEBIT per (wallet, currency) of a month's settled entries."""
    start, end = month_start(month), month_end(month)
    e = entries.filter(month_predicate(month))
    t = settled_headers(transactions, start, end).select("transaction_id")
    return (e.join(t, "transaction_id", "left_semi")
            .groupBy("wallet_id", "currency")
            .agg(F.sum(signed_amount()).cast(MONEY_SUM).alias("net_total")))


def debit_credit_totals(entries: DataFrame) -> DataFrame:
    """AGG-3: conditional sums per (wallet, currency), COALESCE 0."""
    return (entries.groupBy("wallet_id", "currency")
            .agg(sum_where(F.col("type") == "DEBIT").alias("debits"),
                 sum_where(F.col("type") == "CREDIT").alias("credits"),
                 F.count(F.lit(1)).alias("entry_count")))


def month_scan(entries: DataFrame, month: str) -> DataFrame:
    """SRC-2 + PRJ-1: the entries of one posting month (partition filter + half-open range)."""
    return entries.filter(month_predicate(month))


def multi_grain_summary(entries: DataFrame) -> DataFrame:
    """AGG-12: entry count and volume at year / month / day / hour grain: hours once, then grouping sets over the
    hours, so the expansion of the sets follows the number of hours and not of entries."""
    grains = ["year", "month", "day", "hour"]
    hours = (entries.groupBy(F.year("created_at").alias("year"), F.date_format("created_at", "yyyy-MM").alias("month"),
                             F.date_format("created_at", "yyyy-MM-dd").alias("day"), F.hour("created_at").alias("hour"),
                             "currency")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast(MONEY_SUM).alias("v")))
    sets = [[F.col(c) for c in (*grains[:k], "currency")] for k in range(1, 5)]
    grain = (F.grouping("month") * 4 + F.grouping("day") * 2 + F.grouping("hour")).cast("bigint")
    return (hours.groupingSets(sets, *[F.col(c) for c in (*grains, "currency")])
            .agg(grain.alias("grain"), F.sum("n").alias("entry_count"), F.sum("v").cast(MONEY_SUM).alias("volume")))


def wallet_statement(entries: DataFrame) -> DataFrame:
    """WIN-1: every entry of every wallet with the running balance (CREDIT +, DEBIT -).

    Ordered by (created_at, entry_id); bucketed by day so a hot wallet is
    spread over many tasks (see functions.windows).
    """
    d = entries.select("wallet_id", "entry_id", "created_at", "type", "amount", "currency",
                       signed_amount().alias("signed"))
    return (bucketed_running_sum(d, ["wallet_id"], ["created_at", "entry_id"], "signed",
                                 F.to_date("created_at"), "running_balance")
            .withColumn("running_balance", F.col("running_balance").cast(MONEY_SUM))
            .drop("signed"))


def trial_balance(entries: DataFrame, wallets: DataFrame, accounts: DataFrame) -> DataFrame:
    """AGG-17 + JOIN-12: net balance per (account type, currency); sums to zero per currency."""
    per_wallet = entries.groupBy("wallet_id").agg(F.sum(signed_amount()).alias("net"),
                                                  F.count(F.lit(1)).alias("n"))
    w = wallets.select("wallet_id", "account_id", "currency")
    a = accounts.select("account_id", F.col("type").alias("account_type"))
    return (per_wallet.join(w, "wallet_id").join(a, "account_id")
            .groupBy("account_type", "currency")
            .agg(F.sum("net").cast(MONEY_SUM).alias("balance"), F.sum("n").alias("entry_count")))


def fx_position(entries: DataFrame) -> DataFrame:
    """AGG-16: the FX desk's signed position per currency."""
    return (entries.filter(F.col("wallet_id").startswith("FX-"))
            .groupBy("currency")
            .agg(F.sum(signed_amount()).cast(MONEY_SUM).alias("position"),
                 F.count(F.lit(1)).alias("entry_count")))


def settlement_routed(rollup: DataFrame, entries: DataFrame, transactions: DataFrame,
                      current_month: str) -> DataFrame:
    """SET-3: every closed month from the stored rollup, the current month live, one result."""
    closed = (rollup.filter(F.col("month") < current_month)
              .select("month", "wallet_id", "currency", "settled_total"))
    live = (settlement_report(entries, transactions, current_month)
            .select(F.lit(current_month).alias("month"), "wallet_id", "currency", "settled_total"))
    return closed.unionByName(live)


def monthly_growth(entries: DataFrame) -> DataFrame:
    """WIN-7: entries per month and the month-on-month change (a window over ~months rows only)."""
    m = entries.groupBy("posting_month").agg(F.count(F.lit(1)).alias("entries"))
    w = Window.orderBy("posting_month")
    prev = F.lag("entries").over(w)
    return m.select("posting_month", "entries", prev.alias("prev_entries"),
                    (F.col("entries") - prev).alias("delta"),
                    F.round((F.col("entries") - prev) / prev, 6).alias("growth"))


def global_zero_sum(entries: DataFrame) -> DataFrame:
    """AGG-5: system-wide DEBIT vs CREDIT per currency."""
    return (entries.groupBy("currency")
            .agg(sum_where(F.col("type") == "DEBIT").alias("debits"),
                 sum_where(F.col("type") == "CREDIT").alias("credits"))
            .withColumn("imbalance", (F.col("credits") - F.col("debits")).cast(MONEY_SUM)))
