"""Leg expansion (fee split, FX bridge), reversal, idempotency and pinned-rate lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.functions.columns import MONEY
from tally.functions.skew import join_back
from tally.sources.fixtures import Ledger


def fee_split_legs(movements: DataFrame) -> DataFrame:
    """INT-5: same-currency movement -> payer pays amount + fee; payee and revenue credited."""
    return Ledger.legs_of(movements.filter(F.col("txn_type") == "transfer")).drop("o_orderkey", "posting_month")


def fx_bridge_legs(movements: DataFrame, rates: DataFrame) -> DataFrame:
    """INT-4: cross-currency movement -> 4 legs through the FX wallets (+ the fee leg).

    The rate is the pinned row (looked up by id), never "the latest": the
    rate table is bounded by calendar days x currency pairs, so the planner
    may broadcast it by size.
    """
    fx = movements.filter(F.col("txn_type") == "exchange").withColumn(
        "exchange_rate_id", F.concat_ws("|", F.date_format("created_at", "yyyy-MM-dd"), "p", "q"))
    pinned = (fx.drop("rate", "b")
              .join(rates.select("exchange_rate_id", "rate"), "exchange_rate_id")
              .withColumn("b", F.round(F.col("a") * F.col("rate"), 4).cast(MONEY)))
    return Ledger.legs_of(pinned).drop("o_orderkey", "posting_month")


def reversal_postings(entries: DataFrame, transactions: DataFrame) -> DataFrame:
    """INT-6: a reversal is a new transaction with every leg's direction swapped."""
    rev = transactions.filter(F.col("status") == "REVERSED").select("transaction_id")
    swapped = F.when(F.col("type") == "DEBIT", "CREDIT").when(F.col("type") == "CREDIT", "DEBIT")
    return (entries.join(rev, "transaction_id", "left_semi")
            .select(F.concat("entry_id", F.lit("-R")).alias("entry_id"),
                    F.concat("transaction_id", F.lit("-R")).alias("transaction_id"),
                    F.col("transaction_id").alias("reverses"),
                    "wallet_id", swapped.alias("type"), "amount", "currency", "created_at"))


def first_per_key(df: DataFrame, keys: list[str], order: list[str], payload: list[str]) -> DataFrame:
    """First row per key by ``order`` as a partial aggregate (min over a struct), skew-safe."""
    return (df.groupBy(*keys)
            .agg(F.min(F.struct(*[F.col(c) for c in order + payload])).alias("_w"))
            .select(*keys, *[F.col(f"_w.{c}").alias(c) for c in order + payload]))


def idempotency_resolve(requests: DataFrame) -> DataFrame:
    """WIN-2: first claim per (caller, key) wins; later requests resolve to the winner's transaction."""
    win = first_per_key(requests, ["caller_id", "key"], ["created_at", "event_id"], ["transaction_id"]) \
        .select("caller_id", "key", F.col("event_id").alias("winner_event"),
                F.col("transaction_id").alias("resolved_transaction_id"))
    # the winner goes back to every attempt on its key, of which there may be very many
    return (join_back(requests, win, ["caller_id", "key"], spread=["request_id"])
            .select("request_id", "caller_id", "key", "transaction_id", "resolved_transaction_id",
                    (F.col("event_id") == F.col("winner_event")).alias("is_first")))


def duplicate_attempts(requests: DataFrame) -> DataFrame:
    """AGG-19: repeated attempts per (caller, key)."""
    return (requests.groupBy("caller_id", "key").agg(F.count(F.lit(1)).alias("attempts"))
            .withColumn("duplicates", F.col("attempts") - 1)
            .filter(F.col("duplicates") > 0))


def expired_keys(requests: DataFrame, as_of) -> DataFrame:
    """INT-8: keys the sweep removes at ``as_of`` (expiry is only a sweep marker)."""
    return (requests.filter(F.col("expires_at") < F.lit(as_of))
            .select("request_id", "caller_id", "key", "expires_at"))


def insert_absent(new: DataFrame, current: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """SNK-4: ``INSERT ... ON CONFLICT DO NOTHING`` as data: in-batch first wins, then rows whose
    key already exists are dropped.  Returns the rows to append."""
    payload = [c for c in new.columns if c not in keys and c not in order]
    first = first_per_key(new, keys, order, payload).select(*new.columns)
    return first.join(current.select(*keys), keys, "left_anti")


def fx_enriched(transactions: DataFrame, rates: DataFrame, currencies: DataFrame) -> DataFrame:
    """JOIN-7: header -> pinned rate -> base and quote currency (one dimension, two roles)."""
    base = currencies.select(F.col("currency_id").alias("base_currency_id"), F.col("name").alias("base_name"))
    quote = currencies.select(F.col("currency_id").alias("currency_id"), F.col("name").alias("quote_name"))
    return (transactions.filter(F.col("exchange_rate_id").isNotNull())
            .select("transaction_id", "exchange_rate_id", "status")
            .join(rates, "exchange_rate_id")
            .join(F.broadcast(base), "base_currency_id")       # currencies: five rows by definition
            .join(F.broadcast(quote), "currency_id")
            .select("transaction_id", "status", F.date_format("rate_date", "yyyy-MM-dd").alias("rate_date"),
                    F.col("base_currency_id").alias("base_code"), "base_name",
                    F.col("currency_id").alias("quote_code"), "quote_name", "rate"))


def exchange_headers(transactions: DataFrame) -> DataFrame:
    """PRJ-10: the partial-index predicate as a filter."""
    return transactions.filter(F.col("exchange_rate_id").isNotNull()).select(
        "transaction_id", "exchange_rate_id", "status")


EXTRA_INFO = T.StructType([T.StructField("priority", T.StringType()), T.StructField("lines", T.IntegerType())])


def json_payload(transactions: DataFrame) -> DataFrame:
    """SRC-5: typed fields out of the JSON payload, by schema (from_json) and by path (variant)."""
    parsed = F.from_json("extra_info", EXTRA_INFO)
    v = F.try_parse_json("extra_info")
    return transactions.select(
        "transaction_id", parsed.getField("priority").alias("priority"),
        parsed.getField("lines").cast("bigint").alias("lines"),
        F.try_variant_get(v, "$.lines", "bigint").alias("lines_by_path"))
