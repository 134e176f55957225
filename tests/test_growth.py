"""What keeps tasks and shuffles small: the store's writes, combined wallets, landed files, calls to the claim state."""

import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tally.operators import integrity
from tally.plans import catalog_stream
from tally.sources.fixtures import Ledger
from tally.streaming.state_ops import ClaimBuckets
from tests.conftest import SF_SMALL


def test_legs_are_stored_without_a_shuffle(spark, monkeypatch):
    ledger = Ledger(spark, SF_SMALL)
    monkeypatch.setattr(Ledger, "store_root", ledger.store_root + "-growth")
    monkeypatch.setattr("tally.sources.storage.write_by_month", None)          # it deals all rows out again
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    stored = ledger.entries_with_keys
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split
    assert "Exchange" not in ledger.legs_of(ledger.movements)._jdf.queryExecution().executedPlan().toString()
    plain = Ledger(spark, SF_SMALL, stored=False).entries_with_keys
    assert stored.count() == plain.count()
    assert stored.exceptAll(plain).isEmpty() and plain.exceptAll(stored).isEmpty()


def test_wallets_meet_each_used_wallet_once(spark):
    parts = [spark.createDataFrame([(w, "EUR", "regular") for w in names], "wallet_id string, currency string, kind string")
             for names in (["a", "b", None], ["FX", "FX"], ["c"])]
    wallets = parts[0].unionByName(parts[1]).unionByName(parts[2])
    entries = spark.createDataFrame([("FX",)] * 500 + [("a",), (None,)], "wallet_id string")
    for find, want in ((integrity.wallets_with_entries, ["FX", "FX", "a"]), (integrity.wallets_without_entries, ["None", "b", "c"])):
        found = find(wallets, entries)
        assert sorted(str(r["wallet_id"]) for r in found.collect()) == want
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == 1 and "Aggregate [wallet_id" in plan


def test_more_legs_land_in_more_files(spark, monkeypatch):
    legs = spark.range(1000).select(F.col("id").cast("string").alias("entry_id"))
    ledger = Ledger(spark, SF_SMALL)
    for most, files in ((500_000, 6), (50, 24)):
        monkeypatch.setattr(catalog_stream, "FILE_LEGS", most)
        path, batch = catalog_stream._land_shuffled(ledger, legs, "growth")
        assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == files == 3 * batch
        assert spark.read.parquet(path).count() == 1000


class Claims(dict):
    """A map state that counts its calls."""

    def __init__(self, *a):
        super().__init__(*a)
        self.calls = 0

    def exists(self):
        return bool(self)

    def getValue(self, k):
        self.calls += 1
        return self.get(k)

    def updateValue(self, k, v):
        self.calls += 1
        self[k] = v

    def removeKey(self, k):
        self.calls += 1
        del self[k]

    def iterator(self):
        return iter(list(self.items()))


class Timers:
    now = 0

    def listTimers(self):
        return iter([])

    def registerTimer(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.now

    getExpiryTimeInMs = getCurrentWatermarkInMs


def test_claims_cost_one_call_a_key_and_none_to_forget():
    bucket, n = ClaimBuckets(1000, 1), 100
    bucket.handle, bucket.claims = Timers(), Claims()
    rows = pd.DataFrame({"request_id": [f"r{i}" for i in range(n)], "caller_id": "c", "idempotency_key": [f"k{i}" for i in range(n)],
                         "event_id": np.arange(n), "event_type": "click", "at_us": np.arange(n) * 1000, "latency_ms": 1,
                         "verdict": "", "transaction_id": [f"T{i}" for i in range(n)]})
    (out,) = bucket.handleInputRows((0,), iter([rows]), None)
    assert (out["verdict"] == "CLAIMED").all() and bucket.claims.calls == n == len(bucket.claims)
    bucket.claims.calls, timers = 0, Timers()
    timers.now = n - 2          # all but the last few have ended
    assert not list(bucket.handleExpiredTimer((0,), timers, timers))
    assert sorted(bucket.claims) == [("c", f"k{i}") for i in (98, 99)] and bucket.claims.calls == 2
    assert bucket.handle.at == 100
    (again,) = bucket.handleInputRows((0,), iter([rows.assign(at_us=98_500)]), None)
    assert again["verdict"].tolist() == ["CLAIMED"] * 98 + ["REPLAY"] * 2
