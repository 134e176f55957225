"""Structured Streaming jobs over the activity stream and the posting stream (STR-1..13).

Two streams feed them:

* the **activity stream** -- driver ``events`` read with ``readStream``; each
  event is a request whose received document is at ``ts`` and whose outcome
  document (if any) is at ``ts + latency``;
* the **posting stream** -- ledger legs landed as parquet by arrival batch
  (``land``) and read back with ``readStream``.

Every job runs with a checkpoint in the shared folder and a replay-safe sink
(file sink with its commit log, or ``foreachBatch`` writes keyed by batch id),
so a lost executor or a restarted driver resumes without double counting.
State is bounded by watermarks or event-time timers everywhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally import constants as K
from tally.functions.columns import MONEY_SUM, ms_interval, signed_amount, sum_where
from tally.session import path_exists, scratch_path
from tally.streaming.state_ops import ClaimBuckets

US_PER_HOUR = 3_600_000_000

# ---------------------------------------------------------------------------
# running a stream to completion (the registered queries are finite runs)
# ---------------------------------------------------------------------------


def run_to_files(df: DataFrame, sink: str, checkpoint: str, partition_by: list[str] | None = None,
                 mode: str = "append") -> None:
    """Drain everything available into a parquet file sink (exactly-once via its commit log)."""
    w = (df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
         .outputMode(mode).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.start().awaitTermination()


def run_foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    (df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
       .trigger(availableNow=True).start().awaitTermination())


def append_batches(path: str, partition_by: list[str]) -> Callable[[DataFrame, int], None]:
    """Sink of plain partition folders: each micro-batch owns the partitions named by its id, so a replay rewrites
    the same files and a folder can be dropped without a sink log that still names its files."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        _overwrite(batch.withColumn("batch_id", F.lit(batch_id)), path, [*partition_by, "batch_id"])
    return fn


# ---------------------------------------------------------------------------
# the activity stream: requests, outcomes, claims
# ---------------------------------------------------------------------------

def attempt_documents(events: DataFrame) -> DataFrame:
    """Stateless part of the layer-3 projection: one row per document.

    ``kind`` is ``received`` (every non-view event, at ``ts``), ``access``
    (views) or ``outcome`` (signup, purchase, click, and errors except every
    fifth, at ``ts + latency``).  Purchase/click outcomes are classified as
    commit or replay by the claim operator, not here.
    """
    et = F.col("event_type")
    latency = F.floor(F.col("value")).cast("bigint")
    has_outcome = et.isin("signup", "purchase", "click") | (
        (et == "error") & (F.col("event_id") % K.NO_OUTCOME_MODULUS != 0))
    null_l = F.lit(None).cast("bigint")
    first = F.struct(F.when(et == "view", "access").otherwise("received").alias("kind"),
                     F.col("ts").alias("at"), null_l.alias("latency_ms"))
    out = F.when(has_outcome, F.struct(F.lit("outcome").alias("kind"),
                                       (F.col("ts") + ms_interval(latency)).alias("at"),
                                       latency.alias("latency_ms")))
    return (events.select("event_id", "event_type", "user_id", "props",
                          F.inline(F.filter(F.array(first, out), lambda x: x.isNotNull())))
            .select(F.concat(F.lit("req-"), "event_id").alias("request_id"),
                    F.concat(F.lit("C"), "user_id").alias("caller_id"),
                    "event_id", "event_type", "props", "kind", "at", "latency_ms"))


CLAIM_OUT = ("request_id string, caller_id string, idempotency_key string, event_id long, event_type string, "
             "at_us long, latency_ms long, verdict string, transaction_id string")


#: Hash buckets of the claim state.  The state is keyed by them, so the number is fixed for the life of a checkpoint.
CLAIM_BUCKETS = 128


def claim_requests(events: DataFrame, delay: str = K.ACTIVITY_DELAY, buckets: int = CLAIM_BUCKETS) -> DataFrame:
    """STR-2: per-(caller, key) idempotency claims with a 24-hour horizon, one verdict per request.

    Keys are grouped into ``buckets`` hash buckets so one Python call handles
    many keys; the claim state itself is per key in RocksDB and swept by
    event-time timers.  A checkpoint must be restarted with the ``buckets`` it
    was started with, whatever the session's partition count.
    """
    req = (events.filter(F.col("event_type").isin("purchase", "click"))
           .withWatermark("ts", delay)
           .select(F.concat(F.lit("req-"), "event_id").alias("request_id"),
                   F.concat(F.lit("C"), "user_id").alias("caller_id"),
                   F.col("props").alias("idempotency_key"), "event_id", "event_type",
                   F.unix_micros("ts").alias("at_us"),
                   F.floor(F.col("value")).cast("bigint").alias("latency_ms"),
                   F.concat(F.lit("T"), "event_id").alias("transaction_id"))
           .withColumn("bucket", F.pmod(F.xxhash64("caller_id", "idempotency_key"), F.lit(buckets))))
    processor = ClaimBuckets(K.IDEMPOTENCY_TTL_HOURS * US_PER_HOUR, 3_600_000)
    return (req.groupBy("bucket")
            .transformWithStateInPandas(processor, CLAIM_OUT, "append", "EventTime")
            .withColumn("created_at", F.timestamp_micros("at_us")))


def activity_documents(events: DataFrame) -> DataFrame:
    """STR-1: the layer-3 documents; purchase/click outcomes come from the claim operator."""
    docs = attempt_documents(events)
    null_s = F.lit(None).cast("string")
    intent = F.to_json(F.struct(F.upper("event_type").alias("type"), F.col("props").alias("props")))
    is_req = F.col("event_type").isin("purchase", "click")
    plain = (docs.filter((F.col("kind") != "outcome") | ~is_req)
             .select(F.concat(F.lit("ev-"), "event_id",
                              F.when(F.col("kind") == "access", F.lit("-access"))
                              .when(F.col("kind") == "received", F.lit("-in")).otherwise(F.lit("-out")))
                     .alias("event_id"),
                     F.when(F.col("kind") == "access", "ACCESS").when(F.col("kind") == "received", "REQUEST_RECEIVED")
                     .when(F.col("event_type") == "signup", "VALIDATION_REJECTED")
                     .otherwise("OPERATION_OUTCOME").alias("event_type"),
                     F.col("at").alias("ts"), "caller_id", "request_id",
                     F.when(is_req, F.col("props")).alias("idempotency_key"),
                     F.when(F.col("kind") == "received", "ACCEPTED")
                     .when((F.col("kind") == "outcome") & (F.col("event_type") == "signup"), "REJECTED")
                     .when(F.col("kind") == "outcome", "ROLLED_BACK").alias("outcome"),
                     F.when(F.col("kind") == "outcome",
                            F.when(F.col("event_type") == "signup", "VALIDATION_FAILED")
                            .otherwise("INSUFFICIENT_FUNDS")).alias("reason"),
                     null_s.alias("operation_id"), "latency_ms", intent.alias("intent"),
                     F.col("event_id").alias("source_event_id")))
    claims = claim_requests(events)
    claimed = F.col("verdict") == "CLAIMED"
    done = (claims.select(
        F.concat(F.lit("ev-"), "event_id", F.lit("-out")).alias("event_id"),
        F.when(claimed, "OPERATION_OUTCOME").otherwise("IDEMPOTENT_REPLAY").alias("event_type"),
        (F.col("created_at") + ms_interval(F.col("latency_ms"))).alias("ts"),
        "caller_id", "request_id", "idempotency_key",
        F.when(claimed, "COMMITTED").otherwise("ACCEPTED").alias("outcome"),
        null_s.alias("reason"), F.col("transaction_id").alias("operation_id"), "latency_ms",
        F.to_json(F.struct(F.upper("event_type").alias("type"), F.col("idempotency_key").alias("props")))
        .alias("intent"),
        F.col("event_id").alias("source_event_id")))
    return plain.unionByName(done).withColumn("event_date", F.to_date("ts"))


# ---------------------------------------------------------------------------
# windowed activity metrics (append mode: a window is final once the watermark passes it)
# ---------------------------------------------------------------------------

def _window_cols(c: str = "window") -> list:
    return [F.col(f"{c}.start").alias("window_start"), F.col(f"{c}.end").alias("window_end")]


def latency_windows(docs: DataFrame, delay: str = K.ACTIVITY_DELAY) -> DataFrame:
    """STR-3: tumbling 5-minute p99 of outcome latency; alert when above the 150 ms objective."""
    out = docs.filter(F.col("kind") == "outcome").withWatermark("at", delay)
    return (out.groupBy(F.window("at", "5 minutes"))
            .agg(F.count(F.lit(1)).alias("outcomes"),
                 F.percentile_approx("latency_ms", 0.99).alias("p99_ms"),
                 F.max("latency_ms").alias("max_ms"))
            .select(*_window_cols(), "outcomes", "p99_ms", "max_ms",
                    (F.col("p99_ms") > K.LATENCY_SLO_MS).alias("alert")))


def throughput_windows(docs: DataFrame, delay: str = K.ACTIVITY_DELAY) -> DataFrame:
    """STR-4: requests received and outcomes produced per minute."""
    d = docs.filter(F.col("kind") != "access").withWatermark("at", delay)
    return (d.groupBy(F.window("at", "1 minute"))
            .agg(F.count(F.when(F.col("kind") == "received", 1)).alias("received"),
                 F.count(F.when(F.col("kind") == "outcome", 1)).alias("outcomes"))
            .select(*_window_cols(), "received", "outcomes"))


def rollback_windows(docs: DataFrame, delay: str = K.ACTIVITY_DELAY) -> DataFrame:
    """STR-5: sliding 10-minute (every 5) share of operation outcomes that rolled back."""
    ops = (docs.filter((F.col("kind") == "outcome") & F.col("event_type").isin("purchase", "click", "error"))
           .withWatermark("at", delay))
    return (ops.groupBy(F.window("at", "10 minutes", "5 minutes"))
            .agg(F.count(F.lit(1)).alias("outcomes"),
                 F.count(F.when(F.col("event_type") == "error", 1)).alias("rolled_back"))
            .select(*_window_cols(), "outcomes", "rolled_back",
                    F.round(F.col("rolled_back") / F.col("outcomes"), 6).alias("rollback_ratio")))


def caller_sessions(events: DataFrame, gap: str = "30 minutes", delay: str = K.ACTIVITY_DELAY) -> DataFrame:
    """STR-12: per-caller session windows (a session ends after 30 idle minutes)."""
    e = events.withWatermark("ts", delay)
    return (e.groupBy(F.concat(F.lit("C"), "user_id").alias("caller_id"), F.session_window("ts", gap))
            .agg(F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
            .select("caller_id", F.col("session_window.start").alias("session_start"),
                    F.col("session_window.end").alias("session_end"), "events", "first_ts", "last_ts"))


def orphan_attempts(docs: DataFrame, bound: str = "1 hour", delay: str = K.ACTIVITY_DELAY) -> DataFrame:
    """STR-6: received requests with no outcome within ``bound`` (stream-stream left outer join).

    Both sides carry watermarks and the join a time range, so a received
    request is kept in state only until the other side's watermark passes
    ``received + bound``; then it is emitted with a NULL outcome.
    """
    rec = (docs.filter(F.col("kind") == "received")
           .select("request_id", "caller_id", "event_type", F.col("at").alias("received_at"))
           .withWatermark("received_at", delay))
    out = (docs.filter(F.col("kind") == "outcome")
           .select(F.col("request_id").alias("out_request_id"), F.col("at").alias("outcome_at"))
           .withWatermark("outcome_at", delay))
    cond = ((F.col("request_id") == F.col("out_request_id"))
            & (F.col("outcome_at") >= F.col("received_at"))
            & (F.col("outcome_at") <= F.col("received_at") + F.expr(f"INTERVAL {bound}")))
    return (rec.join(out, cond, "leftOuter").filter(F.col("outcome_at").isNull())
            .select("request_id", "caller_id", "event_type", "received_at"))


def stuck_pending(docs: DataFrame, minutes: int = K.PENDING_ALERT_MINUTES, delay: str = K.ACTIVITY_DELAY) -> DataFrame:
    """STR-13: requests without an outcome for ``minutes``: the same join, bounded by the alert time."""
    limit = f"{minutes} minutes"
    return (orphan_attempts(docs, limit, delay)
            .select("request_id", "caller_id", "received_at",
                    (F.col("received_at") + F.expr(f"INTERVAL {limit}")).alias("alert_at")))


# ---------------------------------------------------------------------------
# the posting stream
# ---------------------------------------------------------------------------

def arrival_bucket(orderkey: F.Column, max_key: int, n: int) -> F.Column:
    """Orders arrive in key order: bucket b holds keys in [b, b+1) x (max_key+1)/n."""
    return F.floor(orderkey * F.lit(n) / F.lit(max_key + 1)).cast("int")


def postings_feed(legs: DataFrame, max_key: int, n: int) -> DataFrame:
    """Legs (carrying their header status) tagged with their arrival bucket."""
    return legs.withColumn("arrival", arrival_bucket(F.col("o_orderkey"), max_key, n)).drop("leg")


def land(df: DataFrame, path: str, buckets: list[int] | None = None) -> None:
    """Append one arrival (or all of them) to the landing folder."""
    if buckets is not None:
        df = df.filter(F.col("arrival").isin(buckets))
    df.write.mode("append").parquet(path)


def _overwrite(df: DataFrame, path: str, partition_by: list[str]) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))


def _snapshot_marks(spark: SparkSession, base: str) -> list[int]:
    """Batch ids of the balance snapshots present (directory names only)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{base}/snapshot")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    return sorted(int(st.getPath().getName().split("=", 1)[1]) for st in fs.listStatus(root)
                  if st.isDirectory() and st.getPath().getName().startswith("upto="))


def _folded(spark: SparkSession, base: str, keys: list[str], upto: int | None = None, own_mark: bool = True) -> DataFrame:
    """Sums per key: the latest snapshot (at or before ``upto``; strictly before when ``own_mark`` is False) plus
    the deltas after it up to ``upto``."""
    marks = [m for m in _snapshot_marks(spark, base)
             if upto is None or m < upto or (own_mark and m == upto)]
    parts = spark.read.parquet(f"{base}/deltas")
    sums = [c for c in parts.columns if c not in (*keys, "batch_id")]
    if upto is not None:
        parts = parts.filter(F.col("batch_id") <= upto)
    if marks:
        parts = parts.filter(F.col("batch_id") > marks[-1])
    parts = parts.select(*keys, *sums)
    if marks:
        parts = parts.unionByName(spark.read.parquet(f"{base}/snapshot/upto={marks[-1]}").select(*keys, *sums))
    kind = dict(parts.dtypes)
    return parts.groupBy(*keys).agg(*[F.sum(c).cast(kind[c]).alias(c) for c in sums])


def fold_batches(base: str, keys: list[str], sums: dict[str, Column], compact_every: int = 16
                 ) -> Callable[[DataFrame, int], None]:
    """Running sums per key over a stream, in any order of arrival.

    Each micro-batch writes its own sums under its batch id (replay = rewrite).
    Every ``compact_every`` batches the deltas up to this batch are folded into
    a snapshot ``snapshot/upto=<batch id>`` (again an overwrite keyed by the
    batch id), so reading costs one snapshot plus at most ``compact_every``
    deltas, however long the stream has run.  Old deltas and snapshots are no
    longer read and can be expired.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        delta = batch.groupBy(*keys).agg(*[c.alias(n) for n, c in sums.items()]).withColumn("batch_id", F.lit(batch_id))
        _overwrite(delta, f"{base}/deltas", ["batch_id"])
        if compact_every and batch_id % compact_every == compact_every - 1:
            # built from earlier snapshots only, so a replay never reads the folder it rewrites
            snap = _folded(spark, base, keys, batch_id, own_mark=False).withColumn("upto", F.lit(batch_id))
            _overwrite(snap, f"{base}/snapshot", ["upto"])
    return fn


WALLET = ["wallet_id", "currency"]
UNIT = ["posting_day", "transaction_id", "currency"]


def balance_batches(base: str, compact_every: int = 16) -> Callable[[DataFrame, int], None]:
    """STR-8: running wallet balances."""
    return fold_batches(base, WALLET, {"balance": F.sum(signed_amount()).cast(MONEY_SUM), "legs": F.count(F.lit(1))},
                        compact_every)


def balances(spark: SparkSession, base: str) -> DataFrame:
    """Current balance: the latest snapshot plus the deltas committed after it."""
    return _folded(spark, base, WALLET)


def zero_sum_batches(base: str, compact_every: int = 16) -> Callable[[DataFrame, int], None]:
    """STR-7: running debits and credits per (posting day, transaction, currency).

    A leg that arrives late changes the sums of its transaction like any other, so it is judged again with it.
    """
    fold = fold_batches(base, UNIT, {"debits": sum_where(F.col("type") == "DEBIT"),
                                     "credits": sum_where(F.col("type") == "CREDIT"), "legs": F.count(F.lit(1))},
                        compact_every)

    def fn(batch: DataFrame, batch_id: int) -> None:
        fold(batch.withColumn("posting_day", F.date_trunc("day", "created_at")), batch_id)
        mark = batch.agg(F.max("created_at").alias("max_created_at")).withColumn("batch_id", F.lit(batch_id))
        _overwrite(mark, f"{base}/frontier", ["batch_id"])
    return fn


def zero_sum_verdicts(spark: SparkSession, base: str, delay: str = K.LEDGER_DELAY) -> DataFrame:
    """Transactions whose legs do not balance, of the days that the feed has left behind by ``delay``."""
    reached = spark.read.parquet(f"{base}/frontier").agg(F.max("max_created_at")).first()[0]
    final = F.col("posting_day") + F.expr("INTERVAL 1 day") <= F.lit(reached) - F.expr(f"INTERVAL {delay}")
    return (_folded(spark, base, UNIT).filter(final & (F.col("debits") != F.col("credits")))
            .select(*UNIT, "debits", "credits", (F.col("credits") - F.col("debits")).cast(MONEY_SUM).alias("imbalance"),
                    "legs"))


def rollup_batches(base: str, grace_days: int = K.LATE_GRACE_DAYS) -> Callable[[DataFrame, int], None]:
    """STR-9 + STR-10: land legs, side-output late ones, refresh only the months the batch touched.

    A month is closed once the feed (as of earlier batches) has reached the
    next month's start plus ``grace_days``; legs of a closed month are late:
    they go to ``late/`` and their month is refreshed once more.  Every write
    is a dynamic overwrite of partitions named by this batch id or by the
    touched months, so replaying a batch after a failure rewrites the same
    files.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _overwrite(batch.withColumn("batch_id", F.lit(batch_id)), f"{base}/ledger", ["posting_month", "batch_id"])
        # the batch as it was landed, by month: nothing of it is kept in memory, and closed months are whole folders
        schema = batch.withColumn("batch_id", F.lit(batch_id)).schema
        ledger = spark.read.schema(schema).parquet(f"{base}/ledger")
        landed = ledger.filter(F.col("batch_id") == batch_id)
        frontier = None
        if path_exists(spark, f"{base}/frontier"):  # before the first batch there is none
            frontier = (spark.read.parquet(f"{base}/frontier").filter(F.col("batch_id") < batch_id)
                        .agg(F.max("max_created_at")).first()[0])
        months = [r[0] for r in landed.select("posting_month").distinct().collect()]      # the names of its folders
        if frontier is not None:
            closes = F.add_months(F.to_date(F.concat(F.col("posting_month"), F.lit("-01"))), 1)
            late = landed.filter(F.date_add(closes, grace_days).cast("timestamp") <= F.lit(frontier))
            _overwrite(late.select(*batch.columns, "batch_id"), f"{base}/late", ["batch_id"])
        rollup = (ledger.filter(F.col("posting_month").isin(months) & (F.col("status") == "SETTLED"))
                  .groupBy(F.col("posting_month").alias("month"), "wallet_id", "currency")
                  .agg(F.sum("amount").cast(MONEY_SUM).alias("settled_total"),
                       F.count(F.lit(1)).alias("entry_count")))
        _overwrite(rollup, f"{base}/rollup", ["month"])
        mark = landed.agg(F.max("created_at").alias("max_created_at")).withColumn("batch_id", F.lit(batch_id))
        _overwrite(mark, f"{base}/frontier", ["batch_id"])
    return fn


def retention_sweep(spark: SparkSession, path: str, keep_from, date_col: str = "event_date") -> list[str]:
    """STR-11: drop whole event-date partitions older than ``keep_from`` (a metadata operation).

    Only directory names are listed on the driver; no row is read or rewritten.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    cut = keep_from.strftime("%Y-%m-%d")
    dropped = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{date_col}=") and name.split("=", 1)[1] < cut:
            fs.delete(st.getPath(), True)
            dropped.append(name)
    return dropped


def new_run(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for one run (sinks + checkpoints)."""
    return scratch_path(spark, name)
