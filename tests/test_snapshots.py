"""The digest tree finds what a whole comparison finds and opens only what changed."""

import random

from pyspark.sql import functions as F

from tally.operators.integrity import immutability_audit
from tally.operators.snapshots import changed_leaves, multiset_difference, snapshot_audit
from tally.session import scratch_path
from tally.sources.fixtures import Ledger
from tally.sources.storage import write_by_month

from .conftest import SF_SMALL

SCHEMA = "entry_id string, wallet_id string, amount decimal(19,4), note string, posting_month string"


def test_same_rows_as_the_whole_comparison(spark):
    rnd = random.Random(5)
    rows = [[f"e{i}", f"w{i % 7}", None if i % 11 == 0 else i, rnd.choice([None, "x", ""]), f"2024-{1 + i % 9:02d}"] for i in range(900)]
    new = [list(r) for r in rows if r[0] not in ("e5", "e600")] + [["added", "w", 1, None, "2024-02"]]
    by = {r[0]: r for r in new}
    by["e7"][2] = 70                                   # a value
    by["e8"][3] = "" if by["e8"][3] is None else None   # null against empty
    by["e9"][1], by["e9"][3] = "x", "w2"
    by["e10"][4] = "2024-09"                           # to another month
    by["e11"][4] = None
    frame = lambda r: spark.createDataFrame([(a, b, None if c is None else __import__("decimal").Decimal(c), d, m) for a, b, c, d, m in r], SCHEMA)
    old, new = frame(rows), frame(random.Random(1).sample(new, len(new))).select("posting_month", "note", "amount", "wallet_id", "entry_id")
    want = sorted(map(str, immutability_audit(old, new).collect()))
    assert sorted(map(str, snapshot_audit(old, new, ranges=16).collect())) == want and len(want) == 8
    assert changed_leaves(old, old.select(*reversed(old.columns)).repartition(5), "entry_id").count() == 0
    assert snapshot_audit(old, old).count() == 0


def test_only_changed_months_are_opened_again(spark):
    L = Ledger(spark, SF_SMALL)
    path = scratch_path(spark, "snapshot")
    cents = F.when(F.col("posting_month") == "1998-06", F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(19,4)")
    write_by_month(L.entries.withColumn("amount", cents), path)
    new = spark.read.parquet(path).withColumn("posting_month", F.col("posting_month").cast("string")).select(*L.entries.columns)
    found = snapshot_audit(L.entries, new)
    assert found.count() == L.entries.where("posting_month = '1998-06'").count() > 0
    scans = [ln for ln in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in ln]
    assert scans and all("1998-06" in s.split("PartitionFilters:")[1] for s in scans)


def test_multiset_difference(spark):
    frame = lambda rows: spark.createDataFrame(rows, "a string, b int")
    rows = [("x", 1), ("x", 1), ("y", None), (None, 2)] + [(f"r{i}", i) for i in range(300)]
    left = frame(rows)
    assert multiset_difference(left, left.repartition(3).select("b", "a")) == (0, 0, 304)
    assert multiset_difference(left, frame(rows[1:] + [("new", 5), ("y", 0)])) == (1, 2, 304)      # one of two equal rows is gone
    assert multiset_difference(left.where("b > 999"), left) == (0, 304, 0)
