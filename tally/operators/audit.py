"""Layer-2 audit log and layer-3 activity events: derivation and batch queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tally import constants as K
from tally.functions.columns import ms_interval
from tally.functions.skew import join_back
from tally.functions.windows import bucketed_lag, bucketed_row_number


def first_claims(events: DataFrame) -> DataFrame:
    """First (ts, event_id) per (user, props) among purchase/click requests.

    A min over a struct is a partial aggregate, so a hot (user, props) group is
    pre-combined on the map side instead of landing whole in one task.
    """
    return (events.filter(F.col("event_type").isin("purchase", "click"))
            .groupBy("user_id", "props")
            .agg(F.min(F.struct("ts", "event_id")).alias("_first")))


def activity_events(events: DataFrame) -> DataFrame:
    """Each driver event -> its layer-3 documents (received/access, then outcome)."""
    first = first_claims(events)
    e = join_back(events, first, ["user_id", "props"], "left", spread=["event_id"])
    et = F.col("event_type")
    is_req = et.isin("purchase", "click")
    is_first = (F.col("_first.ts") == F.col("ts")) & (F.col("_first.event_id") == F.col("event_id"))
    latency = F.floor(F.col("value")).cast("bigint")
    done_at = F.col("ts") + ms_interval(latency)
    caller = F.concat(F.lit("C"), F.col("user_id"))
    idem = F.when(is_req, F.col("props"))
    intent = F.to_json(F.struct(F.upper(et).alias("type"), F.col("props").alias("props")))

    def doc(suffix, typ, ts, outcome, reason, op, lat):
        return F.struct(F.concat(F.lit("ev-"), F.col("event_id"), F.lit(suffix)).alias("event_id"),
                        typ.alias("event_type"), ts.alias("ts"), outcome.alias("outcome"),
                        reason.alias("reason"), op.alias("operation_id"), lat.alias("latency_ms"))

    null_s, null_l = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    first_doc = F.when(et == "view", doc("-access", F.lit("ACCESS"), F.col("ts"), null_s, null_s, null_s, null_l)) \
                 .otherwise(doc("-in", F.lit("REQUEST_RECEIVED"), F.col("ts"), F.lit("ACCEPTED"),
                                null_s, null_s, null_l))
    outcome_doc = (
        F.when(et == "signup", doc("-out", F.lit("VALIDATION_REJECTED"), done_at, F.lit("REJECTED"),
                                   F.lit("VALIDATION_FAILED"), null_s, latency))
        .when(is_req & is_first, doc("-out", F.lit("OPERATION_OUTCOME"), done_at, F.lit("COMMITTED"),
                                     null_s, F.concat(F.lit("T"), F.col("event_id")), latency))
        .when(is_req, doc("-out", F.lit("IDEMPOTENT_REPLAY"), done_at, F.lit("ACCEPTED"), null_s,
                          F.concat(F.lit("T"), F.col("_first.event_id")), latency))
        .when((et == "error") & (F.col("event_id") % K.NO_OUTCOME_MODULUS != 0),
              doc("-out", F.lit("OPERATION_OUTCOME"), done_at, F.lit("ROLLED_BACK"),
                  F.lit("INSUFFICIENT_FUNDS"), null_s, latency)))
    docs = F.filter(F.array(first_doc, outcome_doc), lambda x: x.isNotNull())
    return (e.select(caller.alias("caller_id"), F.concat(F.lit("req-"), F.col("event_id")).alias("request_id"),
                     idem.alias("idempotency_key"), intent.alias("intent"),
                     F.col("event_id").alias("source_event_id"), F.inline(docs))
            .select("event_id", "event_type", "ts", "caller_id", "request_id", "idempotency_key",
                    "outcome", "reason", "operation_id", "latency_ms", "intent", "source_event_id"))


def as_documents(activity: DataFrame) -> DataFrame:
    """Nest the flat columns into the document envelope (meta, actor)."""
    return activity.select(
        "event_id", "event_type", "ts",
        F.struct(F.col("caller_id"), F.col("event_type")).alias("meta"),
        "request_id", "idempotency_key",
        F.struct(F.col("caller_id").alias("principal")).alias("actor"),
        "intent", "outcome", "reason", "operation_id", "latency_ms",
        F.to_date("ts").alias("event_date"))


def audit_log_rows(events: DataFrame) -> DataFrame:
    """signup -> CREATED, error -> FROZEN on W-C<user>; old_state chains the previous new_state."""
    base = (events.filter(F.col("event_type").isin("signup", "error"))
            .select(F.concat(F.lit("AL-"), F.col("event_id")).alias("audit_log_id"),
                    F.lit("wallet").alias("entity_type"),
                    F.concat(F.lit("W-C"), F.col("user_id")).alias("entity_id"),
                    F.when(F.col("event_type") == "signup", "CREATED").otherwise("FROZEN").alias("action"),
                    F.col("props").alias("new_state"),
                    F.element_at(F.array(*[F.lit(a) for a in K.AUDIT_ACTORS]),
                                 (F.col("event_id") % 4 + 1).cast("int")).alias("actor_type"),
                    F.concat(F.lit("C"), F.col("user_id")).alias("actor_id"),
                    F.concat(F.lit("req-"), F.col("event_id")).alias("request_id"),
                    F.col("ts").alias("created_at"), "event_id"))
    chained = bucketed_lag(base, ["entity_id"], ["created_at", "event_id"], "new_state",
                           F.to_date("created_at"), "_prev_state")
    old = (F.when(F.col("action") == "CREATED", F.lit(None))
           .when(F.col("_prev_state").isNull(), F.lit(None))
           .when(F.col("event_id") % K.AUDIT_CHAIN_BREAK == 0, F.lit('{"k": -1}'))
           .otherwise(F.col("_prev_state")))
    return chained.select("audit_log_id", "entity_type", "entity_id", "action", old.alias("old_state"),
                          "new_state", F.lit(None).cast("string").alias("reason"), "actor_id", "actor_type",
                          F.lit(None).cast("string").alias("transaction_id"), "request_id", "created_at")


# ---- batch queries over layers 2 and 3 -------------------------------------

def audit_chain_breaks(audit_logs: DataFrame) -> DataFrame:
    """WIN-6: rows whose old_state is not the previous row's new_state (same entity)."""
    aid = F.substring_index(F.col("audit_log_id"), "-", -1).cast("bigint")
    d = bucketed_lag(audit_logs.withColumn("_id", aid), ["entity_type", "entity_id"], ["created_at", "_id"],
                     "new_state", F.to_date("created_at"), "expected_old_state")
    return (d.filter((F.col("action") != "CREATED") & ~F.col("old_state").eqNullSafe(F.col("expected_old_state")))
            .select("audit_log_id", "entity_id", "action", "old_state", "expected_old_state", "created_at"))


def latest_entity_state(audit_logs: DataFrame) -> DataFrame:
    """WIN-3: newest audit row per entity; max_by is a partial aggregate, skew-safe."""
    aid = F.substring_index(F.col("audit_log_id"), "-", -1).cast("bigint")
    return (audit_logs.groupBy("entity_type", "entity_id")
            .agg(F.max_by(F.struct("audit_log_id", "action", "new_state", "created_at"),
                          F.struct("created_at", aid)).alias("r"),
                 F.count(F.lit(1)).alias("n_changes"))
            .select("entity_type", "entity_id", "r.audit_log_id", F.col("r.action").alias("last_action"),
                    F.col("r.new_state").alias("state"), F.col("r.created_at").alias("changed_at"), "n_changes"))


def attempt_sequence(activity: DataFrame) -> DataFrame:
    """WIN-5: ordinal of each request inside its idempotency key and the gap to the previous one."""
    req = (activity.filter((F.col("event_type") == "REQUEST_RECEIVED") & F.col("idempotency_key").isNotNull())
           .select("caller_id", "idempotency_key", "request_id", "ts", "source_event_id"))
    key = ["caller_id", "idempotency_key"]
    d = bucketed_row_number(req, key, ["ts", "source_event_id"], F.to_date("ts"), "attempt_no")
    d = bucketed_lag(d, key, ["ts", "source_event_id"], "ts", F.to_date("ts"), "prev_ts")
    gap = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("prev_ts").cast("timestamp"))) / 1e6
    return d.select(*key, "request_id", "ts", "attempt_no", F.round(gap, 3).alias("gap_seconds"))


def caller_recent(activity: DataFrame, n: int = 5) -> DataFrame:
    """SORT-4: newest n events per caller (row_number <= n plans a partial group limit)."""
    w = Window.partitionBy("caller_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    return (activity.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
            .select("caller_id", "rank", "event_id", "event_type", "ts", "outcome"))


def audit_correlation(activity: DataFrame, transactions: DataFrame, audit_logs: DataFrame) -> DataFrame:
    """JOIN-10: each outcome event -> ledger header (operation_id) and layer-2 row (request_id)."""
    out = activity.filter(F.col("event_type").isin("OPERATION_OUTCOME", "IDEMPOTENT_REPLAY", "VALIDATION_REJECTED"))
    hdr = transactions.select(F.col("transaction_id").alias("operation_id"),
                              F.col("status").alias("ledger_status"))
    l2 = audit_logs.select("request_id", F.col("action").alias("audit_action"))
    attempts = (activity.filter(F.col("event_type") == "REQUEST_RECEIVED")
                .groupBy("caller_id", "idempotency_key").agg(F.count(F.lit(1)).alias("attempts")))
    counted = join_back(out, attempts, ["caller_id", "idempotency_key"], "left", spread=["event_id"])
    return (counted.join(hdr, "operation_id", "left").join(l2, "request_id", "left")
            .select("event_id", "request_id", "operation_id", "outcome", "ledger_status", "audit_action",
                    F.when(F.col("idempotency_key").isNotNull(), F.col("attempts")).alias("attempts")))


def audit_entity_join(audit_logs: DataFrame, wallets: DataFrame, accounts: DataFrame,
                      transactions: DataFrame) -> DataFrame:
    """JOIN-11: polymorphic (entity_type, entity_id) resolved against a type-tagged union."""
    ents = (wallets.select(F.lit("wallet").alias("entity_type"), F.col("wallet_id").alias("entity_id"),
                           F.col("status").alias("entity_status"))
            .unionByName(accounts.select(F.lit("account").alias("entity_type"),
                                         F.col("account_id").alias("entity_id"),
                                         F.col("status").alias("entity_status")))
            .unionByName(transactions.select(F.lit("transaction").alias("entity_type"),
                                             F.col("transaction_id").alias("entity_id"),
                                             F.col("status").alias("entity_status"))))
    return (audit_logs.join(ents, ["entity_type", "entity_id"], "left")
            .select("audit_log_id", "entity_type", "entity_id", "action", "entity_status",
                    F.col("entity_status").isNotNull().alias("entity_found")))
