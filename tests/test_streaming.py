"""foreachBatch sinks are replay-safe: re-running a batch id or restarting changes nothing."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from tally.session import scratch_path
from tally.sources.fixtures import Ledger
from tally.streaming import jobs as S

from .conftest import SF_SMALL


def _snapshot(df, keys):
    return sorted(tuple(r) for r in df.orderBy(*keys).collect())


def test_balance_batch_replay_is_idempotent(spark):
    L = Ledger(spark, SF_SMALL)
    base = scratch_path(spark, "replay-balance")
    fn = S.balance_batches(base)
    batch = L.entries.filter(F.col("posting_month") == "1998-06")
    fn(batch, 0)
    first = _snapshot(S.balances(spark, base), ["wallet_id"])
    fn(batch, 0)                       # the same batch delivered again after a failure
    assert _snapshot(S.balances(spark, base), ["wallet_id"]) == first
    fn(batch, 1)                       # a genuinely new batch does count
    doubled = {r.wallet_id: r.balance for r in S.balances(spark, base).collect()}
    once = {r[0]: r[2] for r in first}
    assert all(doubled[w] == 2 * once[w] for w in once)


def test_rollup_batch_replay_and_late_side_output(spark):
    L = Ledger(spark, SF_SMALL)
    legs = Ledger.legs_of(L.movements, ("status",)).withColumn("arrival", F.lit(0)).drop("leg")
    base = scratch_path(spark, "replay-rollup")
    fn = S.rollup_batches(base)
    later = legs.filter(F.col("posting_month") >= "1999-01")
    early = legs.filter(F.col("posting_month") < "1999-01")
    fn(later, 0)
    fn(early, 1)                       # every 1998 month closed already: all of it is late
    fn(early, 1)                       # replay
    late = spark.read.parquet(f"{base}/late")
    assert late.count() == early.count()
    roll = spark.read.parquet(f"{base}/rollup")
    settled = legs.filter(F.col("status") == "SETTLED")
    assert roll.agg(F.sum("entry_count")).first()[0] == settled.count()
    assert roll.agg(F.sum("settled_total")).first()[0] == settled.agg(F.sum("amount")).first()[0]


def test_batch_is_read_once_and_not_kept(spark, monkeypatch):
    """Late legs, months and the frontier come from the folders that the batch was landed in."""
    legs = Ledger.legs_of(Ledger(spark, SF_SMALL).movements, ("status",)).withColumn("arrival", F.lit(0)).drop("leg")
    base, read, write = scratch_path(spark, "read-once"), {}, S._overwrite

    def overwrite(df, path, by):
        read[path.rsplit("/", 1)[1]] = df.inputFiles()
        write(df, path, by)
    monkeypatch.setattr(S, "_overwrite", overwrite)
    monkeypatch.setattr(type(legs), "persist", lambda *_: 1 / 0)
    fn = S.rollup_batches(base)
    fn(legs.filter(F.col("posting_month") >= "1999-01"), 0)
    fn(legs.filter(F.col("posting_month") < "1999-01"), 1)
    assert all("/ledger/posting_month=" in f for name in ("late", "rollup", "frontier") for f in read[name])
    assert read["late"] and spark.read.parquet(f"{base}/late").columns == [*legs.columns, "batch_id"]


def test_stream_restart_resumes_from_checkpoint(spark):
    L = Ledger(spark, SF_SMALL)
    land = scratch_path(spark, "restart-landing")
    L.entries.write.parquet(land)
    from tally.streaming.sources import event_time, stream_table
    run = scratch_path(spark, "restart-run")
    for _ in range(2):                 # second run: nothing new, nothing double counted
        S.run_foreach_batch(event_time(stream_table(spark, land), "created_at"), S.balance_batches(run),
                            f"{run}/checkpoint")
    total = S.balances(spark, run).agg(F.sum("legs")).first()[0]
    assert total == L.entries.count()
    assert S.balances(spark, run).agg(F.sum("balance")).first()[0] == D("0")


def test_claims_across_runs_equal_one_run(spark):
    """Claim state and sweep timers carry over between incremental runs on one checkpoint."""
    import datetime as dt

    from tally.streaming.sources import event_time, stream_table
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    mid = dt.datetime(2024, 1, 15)

    def claims_of(path):
        return S.claim_requests(event_time(stream_table(spark, path), "ts")).select(
            "request_id", "verdict", "transaction_id")

    whole = scratch_path(spark, "claims-whole")
    ev.write.parquet(whole)
    one = scratch_path(spark, "claims-one")
    S.run_to_files(claims_of(whole), f"{one}/out", f"{one}/ck")

    land = scratch_path(spark, "claims-landing")
    two = scratch_path(spark, "claims-two")
    for part in (ev.filter(F.col("ts") < F.lit(mid)), ev.filter(F.col("ts") >= F.lit(mid))):
        part.write.mode("append").parquet(land)
        S.run_to_files(claims_of(land), f"{two}/out", f"{two}/ck")

    a = _snapshot(spark.read.parquet(f"{one}/out"), ["request_id"])
    b = _snapshot(spark.read.parquet(f"{two}/out"), ["request_id"])
    assert a == b and len(a) > 0
    assert any(r[1] == "REPLAY" for r in a)


def test_balance_compaction_and_replay(spark):
    """Snapshots every 2 batches; a replayed compaction batch rewrites the same snapshot."""
    L = Ledger(spark, SF_SMALL)
    base = scratch_path(spark, "compact-balance")
    fn = S.balance_batches(base, compact_every=2)
    e = L.entries
    cuts = ["1996-01", "1997-01", "1998-01", "1999-01"]
    bounds = [None] + cuts + [None]
    batches = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        b = e
        if lo:
            b = b.filter(F.col("posting_month") >= lo)
        if hi:
            b = b.filter(F.col("posting_month") < hi)
        batches.append(b)
    for i, b in enumerate(batches):
        fn(b, i)
    fn(batches[3], 3)                  # replay of a compaction batch
    assert S._snapshot_marks(spark, base) == [1, 3]
    signed = F.when(F.col("type") == "CREDIT", F.col("amount")).otherwise(-F.col("amount"))
    want = {(r.wallet_id, r.currency): (r.b, r.n) for r in
            e.groupBy("wallet_id", "currency").agg(F.sum(signed).alias("b"), F.count(F.lit(1)).alias("n")).collect()}
    got = {(r.wallet_id, r.currency): (r.balance, r.legs) for r in S.balances(spark, base).collect()}
    assert got == want


def test_zero_sum_in_shuffled_micro_batches(spark):
    """Legs of one transaction in different micro-batches, in no order of time: the verdict is the batch one."""
    from tally.streaming.sources import event_time, stream_table
    L = Ledger(spark, SF_SMALL)
    land, run = scratch_path(spark, "zs-landing"), scratch_path(spark, "zs-run")
    L.entries_staged.repartition(6, "entry_id").write.parquet(land)
    S.run_foreach_batch(event_time(stream_table(spark, land, 1), "created_at"), S.zero_sum_batches(run, compact_every=2),
                        f"{run}/checkpoint")
    assert spark.read.parquet(f"{run}/deltas").select("batch_id").distinct().count() == 6
    got = {(r.transaction_id, r.currency): (r.debits, r.credits, r.legs) for r in S.zero_sum_verdicts(spark, run).collect()}
    one = scratch_path(spark, "zs-one")
    S.zero_sum_batches(one)(L.entries_staged, 0)
    want = {(r.transaction_id, r.currency): (r.debits, r.credits, r.legs) for r in S.zero_sum_verdicts(spark, one).collect()}
    assert got == want and len(got) > 0


def test_claims_survive_another_partition_count(spark):
    """The claim state is keyed by a fixed number of buckets: a restart under other session settings finds it."""
    from tally.streaming.sources import event_time, stream_table
    land, run = scratch_path(spark, "pc-landing"), scratch_path(spark, "pc-run")
    rows = [(i, 1 + i % 5, "click", "k%d" % (i % 40), 5.0) for i in range(40)]
    first = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, props string, value double")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n, hour in ((4, 1), (6, 2)):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            (first.withColumn("event_id", F.col("event_id") + 1000 * hour)
             .withColumn("ts", F.lit(f"2024-01-01 0{hour}:00:00").cast("timestamp")).write.mode("append").parquet(land))
            S.run_to_files(S.claim_requests(event_time(stream_table(spark, land), "ts")), f"{run}/out", f"{run}/ck")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    verdicts = {r["verdict"]: r["count"] for r in spark.read.parquet(f"{run}/out").groupBy("verdict").count().collect()}
    assert verdicts == {"CLAIMED": 40, "REPLAY": 40}


def test_unreadable_frontier_is_an_error(spark):
    """A frontier that cannot be read must not look like a first batch."""
    import pytest
    L = Ledger(spark, SF_SMALL)
    legs = Ledger.legs_of(L.movements, ("status",)).withColumn("arrival", F.lit(0)).drop("leg")
    base = scratch_path(spark, "bad-frontier")
    fn = S.rollup_batches(base)
    fn(legs.filter(F.col("posting_month") >= "1999-01"), 0)
    spark.createDataFrame([("not a parquet file",)], "v string").write.mode("overwrite").text(f"{base}/frontier")
    with pytest.raises(Exception):
        fn(legs.filter(F.col("posting_month") < "1999-01"), 1)


def test_projection_is_readable_after_a_sweep(spark):
    import datetime as dt
    run = scratch_path(spark, "sweep")
    days = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i)) for i in range(6)], "v long, event_date date")
    sink = S.append_batches(f"{run}/activity", ["event_date"])
    sink(days, 0)
    sink(days, 0)  # replay
    assert len(S.retention_sweep(spark, f"{run}/activity", dt.date(2024, 1, 4))) == 3
    assert sorted(r.v for r in spark.read.parquet(f"{run}/activity").collect()) == [3, 4, 5]
