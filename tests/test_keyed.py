"""Keyed tables: lookups open only months that may hold a key, appends can be replayed; the gate over them."""

import datetime as dt
from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tally.operators import integrity as I
from tally.operators.migrate import _drop
from tally.session import scratch_path
from tally.sources.keyed import KeyedTable

from .test_properties import _frames, postings

SCHEMA = "id string, at timestamp, posting_month string"


def _rows(spark, ids, month):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, 1), month) for i in ids], SCHEMA)


def _table(spark, keys=("id",)):
    rows = _rows(spark, [], "")
    return KeyedTable(spark, scratch_path(spark, "keyed"), rows.schema, list(keys))


def test_only_months_that_may_hold_a_key_are_opened(spark):
    t = _table(spark)
    months = [f"2024-{m:02d}" for m in range(1, 13)]
    whole = _rows(spark, [], "")
    for m in months:
        whole = whole.unionByName(_rows(spark, [f"{m}/{i}" for i in range(200)], m))
    assert t.append_absent(whole, "a", ["at"]) and t.append_absent(_rows(spark, ["new"], "2024-03"), "b", ["at"])
    asked = _rows(spark, ["2024-05/7", "2024-09/0", "nowhere", "new", "2024-05/7", None], "2030-01")
    assert t.parts_holding(asked) == [("b-a", "2024-05"), ("b-a", "2024-09"), ("b-b", "2024-03")]
    found = t.holds(asked)
    assert sorted(r["id"] for r in found.collect()) == ["2024-05/7", "2024-09/0", "new"]
    opened = t.read(t.parts_holding(asked)).groupBy("batch", "posting_month").count().collect()
    assert sorted((r["batch"], r["posting_month"], r["count"]) for r in opened) == [
        ("b-a", "2024-05", 200), ("b-a", "2024-09", 200), ("b-b", "2024-03", 1)]
    scan = [ln for ln in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in ln and "posting_month" in ln][0]
    assert "2024-05" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert t.parts_holding(_rows(spark, ["nowhere", "else"], "x")) == [] and t.holds(_rows(spark, ["nowhere"], "x")).count() == 0


def test_appends_can_be_replayed(spark):
    t = _table(spark)
    rows = _rows(spark, ["a", "b", "a", None], "2024-01")
    assert t.holds(rows).count() == 0                                    # no table yet
    assert t.append_absent(rows, "007", ["at"]) and t.read().count() == 3
    assert not t.append_absent(_rows(spark, ["z"], "2024-01"), "007", ["at"])   # that batch is there
    t.append_absent(rows.where("id is not null"), "008", ["at"])                # the same rows under another id
    assert sorted(str(r["id"]) for r in t.read().collect()) == ["None", "a", "b"]
    # a run that died before its commit: the index is there, the rows are not
    t.append_absent(_rows(spark, ["c"], "2024-02"), "009", ["at"])
    _drop(spark, f"{t.rows_path}/batch=b-009")
    assert t.parts_holding(_rows(spark, ["c"], "x")) == [] and t.append_absent(_rows(spark, ["c", "a"], "2024-02"), "009", ["at"])
    assert sorted(str(r["id"]) for r in t.read().collect()) == ["None", "a", "b", "c"]


def test_filters_miss_no_key_however_full(spark):
    rows = _rows(spark, [f"k{i}" for i in range(3000)], "2024-01")
    t = KeyedTable(spark, scratch_path(spark, "keyed"), rows.schema, ["id"], words=64)
    t.append_absent(rows, "a", ["at"])
    assert t.holds(rows).count() == 3000 and t.holds(_rows(spark, ["other"], "x")).count() == 0


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=postings(), again=st.integers(1, 3), shared=st.booleans())
def test_gate_posts_a_batch_once(spark, rows, again, shared):
    """Replays of a batch add nothing; of transactions that share a key the first clean one is posted."""
    rows = [*rows, ("x-1", "x", "w0", "DEBIT", D("5"), "USD"), ("x-2", "x", "w1", "CREDIT", D("4"), "USD")]
    e, t, w = _frames(spark, rows)
    key = F.lit("k") if shared else F.col("transaction_id")
    requests = t.select("transaction_id", F.lit("c").alias("caller_id"), key.alias("key"),
                        (F.col("created_at") - F.expr("make_interval(0,0,0,0,0,0,int(transaction_id = 'x'))")).alias("created_at"))
    path = scratch_path(spark, "gate")
    posted = KeyedTable(spark, f"{path}/e", e.schema, ["entry_id"])
    claims = KeyedTable(spark, f"{path}/c", requests.withColumn("posting_month", F.lit("")).schema, ["caller_id", "key"])
    n = len({r[1] for r in rows}) - 1
    for k in range(again + 1):
        assert I.post_batch(e, t, w, requests, posted, claims, f"{k // 2}") == (k % 2 == 0)
        got = {r["transaction_id"] for r in posted.read().collect()}
        assert got == ({"t0"} if shared else {f"t{i}" for i in range(n)})
        assert {r["transaction_id"] for r in claims.read().collect()} == got
        assert posted.read().count() == 3 * len(got)
    told = {r["transaction_id"]: r["reasons"] for r in I.posting_quarantine(
        e, t, w, posted=posted, requests=requests, claims=claims).collect()}
    assert set(told) == {r[1] for r in rows} and told["t0"] == "already_posted,key_claimed" and "unbalanced" in told["x"]
