"""The reference's executable integrity spec (3 positive, 7 negative cases) on literal DataFrames."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tally.operators import integrity as I
from tally.operators import postings as P

TS = dt.datetime(2026, 6, 15, 10, 0, 0)
WALLETS = [  # wallet_id, account_id, currency, kind, status, name, balance
    ("w-payer", "a-payer", "VND", "regular", "active", "payer VND", D("0")),
    ("w-payee", "a-payee", "VND", "regular", "active", "payee VND", D("0")),
    ("w-rev", "a-rev", "VND", "regular", "active", "revenue VND", D("0")),
    ("w-fx-vnd", "a-fx", "VND", "regular", "active", "FX VND", D("0")),
    ("w-fx-usd", "a-fx", "USD", "regular", "active", "FX USD", D("0")),
    ("w-payee-usd", "a-payee", "USD", "regular", "active", "payee USD", D("0")),
]
W_SCHEMA = ("wallet_id string, account_id string, currency string, kind string, status string, name string, "
            "balance decimal(19,4)")
T_SCHEMA = "transaction_id string, type string, status string, exchange_rate_id string, extra_info string, " \
           "created_at timestamp"
E_SCHEMA = ("entry_id string, transaction_id string, wallet_id string, type string, amount decimal(19,4), "
            "currency string, created_at timestamp, posting_month string")

TRANSFER = [("e1", "t-transfer", "w-payer", "DEBIT", D("101000"), "VND"),
            ("e2", "t-transfer", "w-payee", "CREDIT", D("100000"), "VND"),
            ("e3", "t-transfer", "w-rev", "CREDIT", D("1000"), "VND")]
FX = [("e4", "t-fx", "w-payer", "DEBIT", D("27000"), "VND"),
      ("e5", "t-fx", "w-fx-vnd", "CREDIT", D("27000"), "VND"),
      ("e6", "t-fx", "w-fx-usd", "DEBIT", D("1"), "USD"),
      ("e7", "t-fx", "w-payee-usd", "CREDIT", D("1"), "USD")]


def headers(spark, ids):
    return spark.createDataFrame([(t, "transfer", "PENDING", None, "{}", TS) for t in ids], T_SCHEMA)


def legs(spark, rows):
    return spark.createDataFrame([(*r, TS, "2026-06") for r in rows], E_SCHEMA)


@pytest.fixture(scope="module")
def wallets(spark):
    return spark.createDataFrame(WALLETS, W_SCHEMA)


def gate(spark, wallets, rows, txns):
    staged = legs(spark, rows)
    t = headers(spark, txns)
    acc = {r.entry_id for r in I.posting_accepted(staged, t, wallets).collect()}
    rej = {r.transaction_id: r.reasons for r in I.posting_quarantine(staged, t, wallets).collect()}
    return acc, rej


def test_transfer_with_fee_and_fx_bridge_are_accepted(spark, wallets):
    acc, rej = gate(spark, wallets, TRANSFER + FX, ["t-transfer", "t-fx"])
    assert rej == {}
    assert acc == {f"e{i}" for i in range(1, 8)}


def test_entry_counts_and_per_currency_balance(spark):
    e = legs(spark, TRANSFER + FX)
    counts = {r.transaction_id: r["count"] for r in e.groupBy("transaction_id").count().collect()}
    assert counts == {"t-transfer": 3, "t-fx": 4}
    assert I.zero_sum_violations(e).count() == 0


def test_balance_sync_leaves_zero_drift(spark, wallets):
    e = legs(spark, TRANSFER + FX)
    synced = I.balance_sync(wallets, e)
    w2 = wallets.drop("balance").join(synced.select("wallet_id", "balance"), "wallet_id")
    assert I.balance_drift(w2, e).count() == 0
    bal = {r.wallet_id: r.balance for r in synced.collect()}
    assert bal["w-payer"] == D("-128000") and bal["w-payee-usd"] == D("1")


def test_a_imbalance_rejects_whole_transaction(spark, wallets):
    bad = [("x1", "t-bad", "w-payer", "DEBIT", D("500"), "VND"),
           ("x2", "t-bad", "w-payee", "CREDIT", D("400"), "VND")]
    acc, rej = gate(spark, wallets, TRANSFER + bad, ["t-transfer", "t-bad"])
    assert "unbalanced" in rej["t-bad"]
    assert not {"x1", "x2"} & acc and {"e1", "e2", "e3"} <= acc


def test_b_duplicate_idempotency_key_keeps_first(spark):
    schema = "caller_id string, key string, request_id string, transaction_id string, created_at timestamp, " \
             "event_id long"
    req = spark.createDataFrame([("c1", "k1", "r1", "T1", TS, 1), ("c1", "k1", "r2", "T2", TS + dt.timedelta(1), 2)],
                                schema)
    res = {r.request_id: r.resolved_transaction_id for r in P.idempotency_resolve(req).collect()}
    assert res == {"r1": "T1", "r2": "T1"}
    current = req.limit(0)
    assert [r.request_id for r in P.insert_absent(req, current, ["caller_id", "key"],
                                                  ["created_at", "event_id"]).collect()] == ["r1"]
    assert P.insert_absent(req, req, ["caller_id", "key"], ["created_at", "event_id"]).count() == 0


def test_c_d_update_and_delete_are_detected(spark):
    old = legs(spark, TRANSFER)
    new = legs(spark, [TRANSFER[0], (*TRANSFER[1][:4], D("99999"), "VND")])
    changes = {r.entry_id: r.change for r in I.immutability_audit(old, new).collect()}
    assert changes == {"e2": "UPDATED", "e3": "DELETED"}


def test_e_currency_mismatch_rejected(spark, wallets):
    bad = [("x1", "t-ccy", "w-payer", "DEBIT", D("1"), "USD"),
           ("x2", "t-ccy", "w-payee-usd", "CREDIT", D("1"), "USD")]
    acc, rej = gate(spark, wallets, bad, ["t-ccy"])
    assert "currency_mismatch" in rej["t-ccy"] and not acc


def test_f_amount_must_be_positive(spark, wallets):
    bad = [("x1", "t-zero", "w-payer", "DEBIT", D("0"), "VND"),
           ("x2", "t-zero", "w-payee", "CREDIT", D("0"), "VND")]
    acc, rej = gate(spark, wallets, bad, ["t-zero"])
    assert "amount_not_positive" in rej["t-zero"] and not acc


def test_missing_header_and_bad_type_rejected(spark, wallets):
    bad = [("x1", "t-nohdr", "w-payer", "DEBIT", D("5"), "VND"),
           ("x2", "t-nohdr", "w-payee", "REFUND", D("5"), "VND")]
    acc, rej = gate(spark, wallets, bad, [])
    assert set(rej["t-nohdr"].split(",")) >= {"missing_header", "bad_type"}


def test_cross_currency_cancel_fools_a_currency_blind_check(spark):
    e = legs(spark, [("x1", "t-x", "w-payer", "DEBIT", D("27000"), "VND"),
                     ("x2", "t-x", "w-payee-usd", "CREDIT", D("27000"), "USD")])
    row = I.zero_sum_scope(e).collect()[0]
    assert row.blind_balanced and not row.per_currency_balanced and row.fooled
    assert I.zero_sum_violations(e).count() == 2


def test_reversal_twice_is_identity_on_balances(spark):
    e = legs(spark, TRANSFER + FX)
    t = spark.createDataFrame([("t-transfer", "transfer", "REVERSED", None, "{}", TS),
                               ("t-fx", "exchange", "REVERSED", None, "{}", TS)], T_SCHEMA)
    r1 = P.reversal_postings(e, t).drop("reverses")
    t1 = r1.select("transaction_id").distinct().select(
        "transaction_id", F.lit("transfer").alias("type"), F.lit("REVERSED").alias("status"),
        F.lit(None).cast("string").alias("exchange_rate_id"), F.lit("{}").alias("extra_info"),
        F.lit(TS).alias("created_at"))
    r2 = P.reversal_postings(r1, t1).drop("reverses")
    signed = F.when(F.col("type") == "CREDIT", F.col("amount")).otherwise(-F.col("amount"))

    def bal(df):
        return {r.wallet_id: r.b for r in df.groupBy("wallet_id").agg(F.sum(signed).alias("b")).collect()}
    assert bal(r2) == bal(e)
    assert all(v == 0 for v in bal(e.unionByName(r1.withColumn("posting_month", F.lit("2026-06")))).values())
