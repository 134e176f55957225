"""Registered stream queries (STR-1..13, SNK-3).

Each callable runs its Structured Streaming job to completion
(``availableNow``) into a fresh folder under the shared checkpoint dir and
returns the sink read back as a batch DataFrame.  The oracles are the batch
twins in DuckDB: windowed outputs in append mode carry the watermark cut
(a window is final once ``end <= max(event time) - delay``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally import constants as K
from tally.plans.registry import query
from tally.session import path_exists
from tally.sources.fixtures import Ledger
from tally.streaming import jobs as S
from tally.streaming.sources import event_time, stream_table

DELAY_MIN = int(K.ACTIVITY_DELAY.split()[0])
N_ARRIVALS = K.ARRIVAL_BATCHES
KEEP_FROM = (K.EVENTS_AS_OF - dt.timedelta(days=K.RETENTION_DAYS)).date()


# ---- helpers ---------------------------------------------------------------

def _events(L: Ledger) -> DataFrame:
    return event_time(stream_table(L.spark, f"{L.sf_dir}/events.parquet"), "ts")


def _drain(L: Ledger, name: str, stream: DataFrame, partition_by=None) -> DataFrame:
    run = S.new_run(L.spark, name)
    schema = stream.schema
    S.run_to_files(stream, f"{run}/out", f"{run}/checkpoint", partition_by)
    return L.spark.read.schema(schema).parquet(f"{run}/out")


def _read_or_empty(L: Ledger, path: str, like: DataFrame) -> DataFrame:
    """What was written at ``path``; nothing if nothing ever was."""
    return L.spark.read.parquet(path) if path_exists(L.spark, path) else L.spark.createDataFrame([], like.schema)


LANDED_FILES = 6
FILES_PER_BATCH = 2
#: Legs of a landed file; more legs land in more files and as many batches.
FILE_LEGS = 500_000


def _land_shuffled(L: Ledger, legs: DataFrame, name: str) -> tuple[str, int]:
    """Legs in files by hash of the entry: legs of a transaction and of a day arrive apart.  The folder, and the files
    of it that make a batch."""
    path = S.new_run(L.spark, name)
    times = max(1, -(-legs.count() // (LANDED_FILES * FILE_LEGS)))
    legs.repartition(LANDED_FILES * times, "entry_id").write.mode("overwrite").parquet(path)
    return path, FILES_PER_BATCH * times


def _ledger_stream(L: Ledger, path: str, max_files: int | None = None) -> DataFrame:
    return event_time(stream_table(L.spark, path, max_files), "created_at")


# ---- DuckDB fragments shared by the oracles ----------------------------------

ATT = f"""att AS (
      SELECT 'req-' || event_id AS request_id, 'C' || user_id AS caller_id, event_id, event_type, props,
             CASE WHEN event_type = 'view' THEN 'access' ELSE 'received' END AS kind, ts AS t_at,
             CAST(NULL AS BIGINT) AS latency_ms
      FROM events
      UNION ALL
      SELECT 'req-' || event_id, 'C' || user_id, event_id, event_type, props, 'outcome',
             ts + CAST(floor(value) AS BIGINT) * INTERVAL 1 MILLISECOND, CAST(floor(value) AS BIGINT)
      FROM events
      WHERE event_type IN ('signup', 'purchase', 'click')
         OR (event_type = 'error' AND event_id % {K.NO_OUTCOME_MODULUS} <> 0))"""

CLAIMS = f"""req AS (
      SELECT 'req-' || event_id AS request_id, 'C' || user_id AS caller_id, props AS idempotency_key,
             event_id, event_type, ts, CAST(floor(value) AS BIGINT) AS latency_ms, 'T' || event_id AS own_txn,
             row_number() OVER (PARTITION BY user_id, props ORDER BY ts, event_id) AS rn
      FROM events WHERE event_type IN ('purchase', 'click')),
    claims AS (
      SELECT caller_id, idempotency_key, rn, request_id, event_id, event_type, ts, latency_ms,
             'CLAIMED' AS verdict, own_txn AS transaction_id,
             ts + INTERVAL {K.IDEMPOTENCY_TTL_HOURS} HOUR AS claim_until
      FROM req WHERE rn = 1
      UNION ALL
      SELECT r.caller_id, r.idempotency_key, r.rn, r.request_id, r.event_id, r.event_type, r.ts, r.latency_ms,
             CASE WHEN r.ts >= c.claim_until THEN 'CLAIMED' ELSE 'REPLAY' END,
             CASE WHEN r.ts >= c.claim_until THEN r.own_txn ELSE c.transaction_id END,
             CASE WHEN r.ts >= c.claim_until THEN r.ts + INTERVAL {K.IDEMPOTENCY_TTL_HOURS} HOUR
                  ELSE c.claim_until END
      FROM claims c JOIN req r
        ON r.caller_id = c.caller_id AND r.idempotency_key = c.idempotency_key AND r.rn = c.rn + 1)"""

DOCS = """docs AS (
      SELECT 'ev-' || event_id || CASE kind WHEN 'access' THEN '-access' WHEN 'received' THEN '-in' ELSE '-out' END
               AS event_id,
             CASE WHEN kind = 'access' THEN 'ACCESS' WHEN kind = 'received' THEN 'REQUEST_RECEIVED'
                  WHEN event_type = 'signup' THEN 'VALIDATION_REJECTED' ELSE 'OPERATION_OUTCOME' END AS event_type,
             t_at AS ts, caller_id, request_id,
             CASE WHEN event_type IN ('purchase', 'click') THEN props END AS idempotency_key,
             CASE WHEN kind = 'received' THEN 'ACCEPTED'
                  WHEN kind = 'outcome' AND event_type = 'signup' THEN 'REJECTED'
                  WHEN kind = 'outcome' THEN 'ROLLED_BACK' END AS outcome,
             CASE WHEN kind = 'outcome' THEN CASE WHEN event_type = 'signup' THEN 'VALIDATION_FAILED'
                                                  ELSE 'INSUFFICIENT_FUNDS' END END AS reason,
             CAST(NULL AS VARCHAR) AS operation_id, latency_ms,
             json_object('type', upper(event_type), 'props', props)::VARCHAR AS intent, event_id AS source_event_id
      FROM att WHERE kind <> 'outcome' OR event_type NOT IN ('purchase', 'click')
      UNION ALL
      SELECT 'ev-' || event_id || '-out',
             CASE WHEN verdict = 'CLAIMED' THEN 'OPERATION_OUTCOME' ELSE 'IDEMPOTENT_REPLAY' END,
             ts + latency_ms * INTERVAL 1 MILLISECOND, caller_id, request_id, idempotency_key,
             CASE WHEN verdict = 'CLAIMED' THEN 'COMMITTED' ELSE 'ACCEPTED' END, CAST(NULL AS VARCHAR),
             transaction_id, latency_ms,
             json_object('type', upper(event_type), 'props', idempotency_key)::VARCHAR, event_id
      FROM claims)"""


def _bucket(col: str, minutes: int) -> str:
    us = minutes * 60_000_000
    return f"make_timestamp((epoch_us({col}) // {us}) * {us})"


# ---- STR-1 / SNK-3 ---------------------------------------------------------------

@query("stream_ingest", f"""
    WITH RECURSIVE {ATT}, {CLAIMS}, {DOCS}
    SELECT *, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS event_date FROM docs""")
def _stream_ingest(L):
    """STR-1 + SNK-3: events -> append-only layer-3 documents, partitioned by event date."""
    return _drain(L, "stream_ingest", S.activity_documents(_events(L)), ["event_date"])


# ---- STR-2 -------------------------------------------------------------------------

@query("stream_dedup", f"""
    WITH RECURSIVE {CLAIMS}
    SELECT request_id, caller_id, idempotency_key, ts AS created_at, verdict, transaction_id FROM claims""")
def _stream_dedup(L):
    """STR-2: idempotency claims per (caller, key) with a 24-hour horizon (stateful, timeout-bounded)."""
    claims = S.claim_requests(_events(L)).select("request_id", "caller_id", "idempotency_key", "created_at",
                                                 "verdict", "transaction_id")
    return _drain(L, "stream_dedup", claims)


# ---- STR-3/4/5: windowed metrics ---------------------------------------------------

@query("stream_latency", f"""
    WITH {ATT}, o AS (SELECT * FROM att WHERE kind = 'outcome'),
    g AS (SELECT {_bucket('t_at', 5)} AS window_start, COUNT(*) AS outcomes,
                 list_sort(list(latency_ms))[CAST(ceil(0.99 * COUNT(*)) AS BIGINT)] AS p99_ms,
                 max(latency_ms) AS max_ms
          FROM o GROUP BY 1)
    SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, outcomes, p99_ms, max_ms,
           p99_ms > {K.LATENCY_SLO_MS} AS alert
    FROM g WHERE window_start + INTERVAL 5 MINUTE <= (SELECT max(t_at) FROM o) - INTERVAL {DELAY_MIN} MINUTE""")
def _stream_latency(L):
    """STR-3: tumbling 5-minute p99 latency with the 150 ms alert."""
    return _drain(L, "stream_latency", S.latency_windows(S.attempt_documents(_events(L))))


@query("stream_throughput", f"""
    WITH {ATT}, d AS (SELECT * FROM att WHERE kind <> 'access'),
    g AS (SELECT {_bucket('t_at', 1)} AS window_start,
                 COUNT(*) FILTER (WHERE kind = 'received') AS received,
                 COUNT(*) FILTER (WHERE kind = 'outcome') AS outcomes
          FROM d GROUP BY 1)
    SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, received, outcomes
    FROM g WHERE window_start + INTERVAL 1 MINUTE <= (SELECT max(t_at) FROM d) - INTERVAL {DELAY_MIN} MINUTE""")
def _stream_throughput(L):
    """STR-4: requests and outcomes per minute."""
    return _drain(L, "stream_throughput", S.throughput_windows(S.attempt_documents(_events(L))))


@query("stream_rollback_ratio", f"""
    WITH {ATT}, o AS (SELECT * FROM att WHERE kind = 'outcome' AND event_type IN ('purchase', 'click', 'error')),
    w AS (SELECT {_bucket('t_at', 5)} AS window_start, event_type FROM o
          UNION ALL SELECT {_bucket('t_at', 5)} - INTERVAL 5 MINUTE, event_type FROM o),
    g AS (SELECT window_start, COUNT(*) AS outcomes, COUNT(*) FILTER (WHERE event_type = 'error') AS rolled_back
          FROM w GROUP BY 1)
    SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, outcomes, rolled_back,
           round(rolled_back / outcomes, 6) AS rollback_ratio
    FROM g WHERE window_start + INTERVAL 10 MINUTE <= (SELECT max(t_at) FROM o) - INTERVAL {DELAY_MIN} MINUTE""")
def _stream_rollback_ratio(L):
    """STR-5: sliding 10-minute rollback ratio, every 5 minutes."""
    return _drain(L, "stream_rollback_ratio", S.rollback_windows(S.attempt_documents(_events(L))))


# ---- STR-12 ------------------------------------------------------------------------

@query("stream_sessions", f"""
    WITH s AS (SELECT 'C' || user_id AS caller_id, ts,
                      CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                             OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE
                           THEN 1 ELSE 0 END AS new_session
               FROM events),
    n AS (SELECT *, sum(new_session) OVER (PARTITION BY caller_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM s),
    g AS (SELECT caller_id, sid, min(ts) AS first_ts, max(ts) AS last_ts, COUNT(*) AS events FROM n GROUP BY 1, 2)
    SELECT caller_id, first_ts AS session_start, last_ts + INTERVAL 30 MINUTE AS session_end, events, first_ts, last_ts
    FROM g WHERE last_ts + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL {DELAY_MIN} MINUTE""")
def _stream_sessions(L):
    """STR-12: per-caller 30-minute session windows."""
    return _drain(L, "stream_sessions", S.caller_sessions(_events(L)))


# ---- STR-6 / STR-13 ----------------------------------------------------------------

@query("stream_orphan_attempts", f"""
    WITH {ATT}, rec AS (SELECT * FROM att WHERE kind = 'received'), o AS (SELECT * FROM att WHERE kind = 'outcome')
    SELECT r.request_id, r.caller_id, r.event_type, r.t_at AS received_at FROM rec r
    WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.request_id = r.request_id AND o.t_at >= r.t_at
                                        AND o.t_at <= r.t_at + INTERVAL {K.ORPHAN_BOUND})
      AND r.t_at + INTERVAL {K.ORPHAN_BOUND} < least((SELECT max(t_at) FROM rec), (SELECT max(t_at) FROM o))
                                             - INTERVAL {DELAY_MIN} MINUTE""")
def _stream_orphan_attempts(L):
    """STR-6: received requests with no outcome within the bound (stream-stream left outer join)."""
    return _drain(L, "stream_orphan_attempts", S.orphan_attempts(S.attempt_documents(_events(L)), K.ORPHAN_BOUND))


@query("stream_stuck_pending", f"""
    WITH {ATT}, rec AS (SELECT * FROM att WHERE kind = 'received'), o AS (SELECT * FROM att WHERE kind = 'outcome')
    SELECT r.request_id, r.caller_id, r.t_at AS received_at,
           r.t_at + INTERVAL {K.PENDING_ALERT_MINUTES} MINUTE AS alert_at
    FROM rec r
    WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.request_id = r.request_id AND o.t_at >= r.t_at
                                        AND o.t_at <= r.t_at + INTERVAL {K.PENDING_ALERT_MINUTES} MINUTE)
      AND r.t_at + INTERVAL {K.PENDING_ALERT_MINUTES} MINUTE
          < least((SELECT max(t_at) FROM rec), (SELECT max(t_at) FROM o)) - INTERVAL {DELAY_MIN} MINUTE""")
def _stream_stuck_pending(L):
    """STR-13: requests pending longer than 15 minutes (stream-stream left outer join, bounded state)."""
    return _drain(L, "stream_stuck_pending", S.stuck_pending(S.attempt_documents(_events(L))))


# ---- STR-7 / STR-8: posting stream, one arrival ----------------------------------

@query("stream_zero_sum", """
    SELECT CAST(date_trunc('day', created_at) AS TIMESTAMP) AS posting_day, transaction_id, currency,
           CAST(COALESCE(SUM(amount) FILTER (WHERE type = 'DEBIT'), 0) AS DOUBLE) AS debits,
           CAST(COALESCE(SUM(amount) FILTER (WHERE type = 'CREDIT'), 0) AS DOUBLE) AS credits,
           CAST(COALESCE(SUM(amount) FILTER (WHERE type = 'CREDIT'), 0)
                - COALESCE(SUM(amount) FILTER (WHERE type = 'DEBIT'), 0) AS DOUBLE) AS imbalance,
           COUNT(*) AS legs
    FROM entries_staged
    GROUP BY 1, 2, 3
    HAVING COALESCE(SUM(amount) FILTER (WHERE type = 'DEBIT'), 0)
           <> COALESCE(SUM(amount) FILTER (WHERE type = 'CREDIT'), 0)
       AND CAST(date_trunc('day', created_at) AS TIMESTAMP) + INTERVAL 1 DAY
           <= (SELECT max(created_at) FROM entries_staged) - INTERVAL 1 DAY""")
def _stream_zero_sum(L):
    """STR-7: deferred per-(transaction, currency) zero-sum over the staged posting stream, in shuffled micro-batches."""
    path, files = _land_shuffled(L, L.entries_staged, "landing-staged")
    run = S.new_run(L.spark, "stream_zero_sum")
    S.run_foreach_batch(_ledger_stream(L, path, files), S.zero_sum_batches(run), f"{run}/checkpoint")
    return S.zero_sum_verdicts(L.spark, run)


@query("stream_balance", """
    SELECT wallet_id, currency,
           CAST(SUM(CASE WHEN type = 'CREDIT' THEN amount ELSE -amount END) AS DOUBLE) AS balance,
           COUNT(*) AS legs
    FROM entries GROUP BY wallet_id, currency""")
def _stream_balance(L):
    """STR-8: running wallet balances from per-batch deltas written by batch id (replay-safe)."""
    path, files = _land_shuffled(L, L.entries, "landing-entries")
    run = S.new_run(L.spark, "stream_balance")
    S.run_foreach_batch(_ledger_stream(L, path, files), S.balance_batches(run), f"{run}/checkpoint")
    return S.balances(L.spark, run)


# ---- STR-9 / STR-10: posting stream in key-ordered arrivals -----------------------

def _rollup_run(L: Ledger) -> tuple[str, DataFrame]:
    """Postings arrive in ``N_ARRIVALS`` key-ordered runs; each run is one availableNow trigger
    that resumes from the same checkpoint, as a scheduled incremental job would."""
    max_key = L.raw("orders").agg(F.max("o_orderkey")).first()[0]
    feed = S.postings_feed(Ledger.legs_of(L.movements, ("status",)), max_key, N_ARRIVALS)
    landing = S.new_run(L.spark, "landing-postings")
    run = S.new_run(L.spark, "stream_rollup")
    for b in range(N_ARRIVALS):
        S.land(feed, landing, [b])
        S.run_foreach_batch(_ledger_stream(L, landing), S.rollup_batches(run), f"{run}/checkpoint")
    return run, feed


ROLLUP_SQL = """
    SELECT e.posting_month AS month, e.wallet_id, e.currency, CAST(SUM(e.amount) AS DOUBLE) AS settled_total,
           COUNT(*) AS entry_count
    FROM entries e JOIN transactions t ON t.transaction_id = e.transaction_id
    WHERE t.status = 'SETTLED'
    GROUP BY e.posting_month, e.wallet_id, e.currency"""


@query("stream_rollup", ROLLUP_SQL)
def _stream_rollup(L):
    """STR-9: the monthly rollup maintained incrementally (only touched months refreshed)."""
    run, _ = _rollup_run(L)
    return L.spark.read.parquet(f"{run}/rollup").select("month", "wallet_id", "currency", "settled_total",
                                                        "entry_count")


@query("stream_late_entries", f"""
    WITH f AS (SELECT entry_id, transaction_id, posting_month, created_at,
                      CAST(floor(o_orderkey * {N_ARRIVALS} / (SELECT max(o_orderkey) + 1 FROM orders)) AS BIGINT)
                        AS arrival
               FROM entries_with_keys),
    b AS (SELECT arrival, max(created_at) AS mx FROM f GROUP BY arrival),
    fr AS (SELECT b1.arrival, (SELECT max(b2.mx) FROM b b2 WHERE b2.arrival < b1.arrival) AS frontier FROM b b1)
    SELECT f.entry_id, f.transaction_id, f.posting_month, f.arrival
    FROM f JOIN fr USING (arrival)
    WHERE CAST(strptime(f.posting_month || '-01', '%Y-%m-%d') AS DATE) + INTERVAL 1 MONTH
          + INTERVAL {K.LATE_GRACE_DAYS} DAY <= fr.frontier""")
def _stream_late_entries(L):
    """STR-10: legs that arrived after their month closed (side output; their month is refreshed again)."""
    run, feed = _rollup_run(L)
    late = _read_or_empty(L, f"{run}/late", feed)
    return late.select("entry_id", "transaction_id", "posting_month", F.col("arrival").cast("bigint"))


# ---- STR-11 --------------------------------------------------------------------------

@query("retention_sweep", f"""
    WITH {ATT}
    SELECT strftime(CAST(t_at AS DATE), '%Y-%m-%d') AS event_date, COUNT(*) AS documents
    FROM att WHERE CAST(t_at AS DATE) >= DATE '{KEEP_FROM:%Y-%m-%d}' GROUP BY 1""")
def _retention_sweep(L):
    """STR-11: drop event-date partitions of the ingested projection older than the horizon."""
    run = S.new_run(L.spark, "retention")
    docs = S.activity_documents(_events(L))
    S.run_foreach_batch(docs, S.append_batches(f"{run}/activity", ["event_date"]), f"{run}/checkpoint")
    S.retention_sweep(L.spark, f"{run}/activity", KEEP_FROM)
    kept = L.spark.read.parquet(f"{run}/activity")
    return kept.groupBy("event_date").agg(F.count(F.lit(1)).alias("documents"))
