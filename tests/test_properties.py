"""Properties of the posting gate and the ledger fixture."""

import datetime as dt
from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tally.operators import integrity as I
from tally.sources.fixtures import Ledger

from .conftest import SF_SMALL

TS = dt.datetime(2026, 1, 2)
WALLETS = [(f"w{i}", c) for i in range(4) for c in ("USD", "VND")]
amounts = st.decimals(min_value=D("0.0001"), max_value=D("1000000"), places=4)


@st.composite
def postings(draw):
    out = []
    for t in range(draw(st.integers(1, 6))):
        ccy = draw(st.sampled_from(["USD", "VND"]))
        a, fee = draw(amounts), draw(amounts)
        out += [(f"t{t}-1", f"t{t}", f"w0", "DEBIT", a + fee, ccy),
                (f"t{t}-2", f"t{t}", f"w1", "CREDIT", a, ccy),
                (f"t{t}-3", f"t{t}", f"w2", "CREDIT", fee, ccy)]
    return out


def _frames(spark, rows):
    e = spark.createDataFrame([(*r, TS, "2026-01") for r in rows],
                              "entry_id string, transaction_id string, wallet_id string, type string, "
                              "amount decimal(19,4), currency string, created_at timestamp, posting_month string")
    t = e.select("transaction_id").distinct().select(
        "transaction_id", F.lit("transfer").alias("type"), F.lit("PENDING").alias("status"),
        F.lit(None).cast("string").alias("exchange_rate_id"), F.lit("{}").alias("extra_info"),
        F.lit(TS).alias("created_at"))
    w = spark.createDataFrame(WALLETS, "wallet_id string, currency string")
    return e, t, w


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=postings(), which=st.integers(0, 100), cents=st.integers(1, 99))
def test_gate_accepts_balanced_and_rejects_whole_unbalanced(spark, rows, which, cents):
    e, t, w = _frames(spark, rows)
    assert I.posting_accepted(e, t, w).count() == len(rows)
    i = which % len(rows)
    bad = list(rows)
    bad[i] = (*bad[i][:4], bad[i][4] + D(cents) / 100, bad[i][5])
    e2, t2, w2 = _frames(spark, bad)
    accepted = {r.transaction_id for r in I.posting_accepted(e2, t2, w2).select("transaction_id").collect()}
    assert bad[i][1] not in accepted
    assert len(accepted) == len({r[1] for r in rows}) - 1


def test_fixture_ledger_sums_to_zero_per_currency(spark):
    L = Ledger(spark, SF_SMALL)
    assert I.zero_sum_violations(L.entries).count() == 0
    signed = F.when(F.col("type") == "CREDIT", F.col("amount")).otherwise(-F.col("amount"))
    for r in L.entries.groupBy("currency").agg(F.sum(signed).alias("s")).collect():
        assert r.s == 0


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=postings(), nameless=st.sets(st.integers(0, 17), max_size=5))
def test_gate_loses_no_leg(spark, rows, nameless):
    """Accepted and rejected legs are the staged legs, also those without a transaction or an entry id."""
    staged = [(None if i % 3 == 1 else r[0], None, *r[2:]) if i in nameless else r for i, r in enumerate(rows)]
    e, _, w = _frames(spark, staged)
    _, t, _ = _frames(spark, rows)
    accepted, rejected = I.posting_accepted(e, t, w), I.posting_rejected_legs(e, t, w)
    assert accepted.count() + rejected.count() == len(staged)
    assert accepted.filter("transaction_id is null").count() == 0
    lost = rejected.filter("transaction_id is null")
    assert lost.count() == len([i for i in nameless if i < len(rows)])
    assert all("not_null" in r.reasons for r in lost.collect())


def test_gate_judges_hot_units_like_others(spark):
    """Each rule broken in a transaction of its own: the same reasons by windows and by aggregates, and beside a hot one."""
    ok = [("{t}-1", "{t}", "w0", "DEBIT", D(3), "USD"), ("{t}-2", "{t}", "w1", "CREDIT", D(3), "USD")]

    def txn(t, *legs):
        return [(e and e.format(t=t), t, *r) for e, _, *r in legs]
    rows = (txn("fine", *ok) + txn("type", *ok, ("{t}-3", "", "w0", "REFUND", D(1), "USD")) + txn("zero", *ok, ("{t}-3", "", "w0", "DEBIT", D(0), "USD"))
            + txn("stray", *ok[:1], ("{t}-2", "", "w9", "CREDIT", D(3), "USD")) + txn("odd", *ok, ("{t}-3", "", "w0", "DEBIT", D(1), "VND"))
            + txn("twice", ok[0], ok[0], ok[1], ("{t}-3", "", "w1", "CREDIT", D(3), "USD")) + txn("none", *ok, (None, "", None, "DEBIT", D(1), None))
            + [(None, None, "w0", "DEBIT", D(1), "USD")] * 2)
    headless = txn("headless", *ok)
    e, _, w = _frames(spark, rows + headless)
    _, t, _ = _frames(spark, [r for r in rows if r[1]])
    want = {"type": ["bad_type"], "zero": ["amount_not_positive"], "stray": ["currency_mismatch"], "odd": ["unbalanced"],
            "twice": ["duplicate_entry"], "none": ["not_null", "unbalanced"], "headless": ["missing_header"], "fine": [],
            "entry:": ["duplicate_entry", "missing_header", "not_null", "unbalanced"]}
    many = spark.range(400).select(F.concat(F.lit("h-"), "id").alias("entry_id"), F.lit("fine").alias("transaction_id"), F.lit("w0").alias("wallet_id"),
                                   F.when(F.col("id") % 2 == 0, "DEBIT").otherwise("CREDIT").alias("type"), F.lit(1).cast("decimal(19,4)").alias("amount"),
                                   F.lit("USD").alias("currency"), F.lit(TS).alias("created_at"), F.lit("2026-01").alias("posting_month"))
    cold = many.withColumn("transaction_id", F.concat(F.lit("c"), F.substring("entry_id", 3, 9)))
    for more in (None, many, cold):             # all are hot, one is, none is
        staged = e if more is None else e.unionByName(more)
        got = {r.transaction_id: list(r.reasons) for r in I.posting_verdicts(staged, t, w).where("not transaction_id rlike '^c[0-9]'").collect()}
        assert got == want
        assert I.posting_accepted(staged, t, w).count() == (402 if more is many else 2)


def test_quarantine_keeps_the_legs(spark):
    from tally.session import scratch_path
    L = Ledger(spark, SF_SMALL)
    path = scratch_path(spark, "quarantine")
    I.quarantine(L.entries_staged, L.transactions, L.wallet_dim, path)
    kept = spark.read.parquet(path)
    assert kept.count() + I.posting_accepted(L.entries_staged, L.transactions, L.wallet_dim).count() == L.entries_staged.count()
    assert kept.filter("reasons = ''").count() == 0


def test_balances_beyond_the_money_type(spark):
    """A wallet's sum may pass what one amount can hold."""
    e = spark.createDataFrame([(f"e{i}", "t", "FX-VND", "CREDIT", D("900000000000000.0000"), "VND") for i in range(40)],
                              "entry_id string, transaction_id string, wallet_id string, type string, "
                              "amount decimal(19,4), currency string")
    w = spark.createDataFrame([("FX-VND", "VND", D("36000000000000000.0100"))],
                              "wallet_id string, currency string, balance decimal(38,4)")
    r = I.balance_drift(w, e).first()
    assert r.computed_balance == D("36000000000000000") and r.discrepancy == D("0.01")
    assert Ledger(spark, SF_SMALL).wallets.schema["balance"].dataType.precision == 38


def test_backfill_restores_a_swap_that_died(spark):
    """A stage left by a run that died while swapping is swapped in by the next run."""
    from tally.operators import migrate as G
    from tally.session import scratch_path
    from tally.sources.storage import write_by_month
    path = scratch_path(spark, "bf")
    rows = [(f"e{i}", f"1998-0{1 + i % 3}", None) for i in range(30)]
    df = spark.createDataFrame(rows, "entry_id string, posting_month string, settlement_batch_id string")
    write_by_month(df, path)
    staged = spark.read.parquet(path).filter("posting_month = '1998-02'").withColumn("settlement_batch_id", F.lit("B"))
    staged.write.parquet(f"{path}.backfill/1998-02_1998-02")
    G._drop(spark, f"{path}/posting_month=1998-02")  # deleted, not yet renamed
    G.backfill(spark, path)
    after = spark.read.parquet(path)
    assert after.count() == 30 and after.filter("settlement_batch_id is null").count() == 0
    assert after.filter("settlement_batch_id = 'B'").count() == 10
    assert G._children(spark, f"{path}.backfill") == []
