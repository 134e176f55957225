"""Registered migration queries (MIG-1..10, AGG-13, PRJ-9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally import constants as K
from tally.functions.columns import MONEY_SUM
from tally.operators import migrate as G
from tally.plans.registry import query
from tally.session import scratch_path
from tally.sources.storage import write_by_month

SENT = K.SENTINEL_BATCH


def _backfilled(L):
    path = scratch_path(L.spark, "entries-v0")
    write_by_month(L.entries_v0, path)
    G.backfill(L.spark, path)
    G.backfill(L.spark, path)         # a rerun is a no-op (resumable)
    return L.spark.read.parquet(path)


@query("expand_read", """SELECT entry_id, posting_month, settlement_batch_id FROM entries_v0""")
def _expand_read(L):
    """MIG-1: old-shape and new-shape files read together; the missing column reads NULL."""
    path = scratch_path(L.spark, "entries-expand")
    old = L.entries_v0.filter(F.col(G.COLUMN).isNull()).drop(G.COLUMN)
    new = L.entries_v0.filter(F.col(G.COLUMN).isNotNull())
    write_by_month(old, path)
    write_by_month(new, path, mode="append")
    return G.expand_read(L.spark, path, L.entries_v0.schema).select("entry_id", "posting_month", G.COLUMN)


@query("backfill_result", f"""
    SELECT entry_id, posting_month, COALESCE(settlement_batch_id, '{SENT}') AS settlement_batch_id FROM entries_v0""")
def _backfill_result(L):
    """MIG-2: month-by-month resumable backfill (run twice), read back."""
    return _backfilled(L).select("entry_id", "posting_month", G.COLUMN)


@query("backfill_progress", """
    SELECT posting_month, COUNT(*) AS rows, CAST(SUM(CASE WHEN settlement_batch_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_rows,
           SUM(CASE WHEN settlement_batch_id IS NULL THEN 1 ELSE 0 END) = 0 AS done
    FROM entries_v0 GROUP BY posting_month""")
def _backfill_progress(L):
    """AGG-13 / MIG-3: NULLs remaining per month before the backfill."""
    return G.backfill_progress(L.entries_v0)


@query("promote_check", """
    SELECT COUNT(*) AS rows, CAST(SUM(CASE WHEN settlement_batch_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_rows,
           SUM(CASE WHEN settlement_batch_id IS NULL THEN 1 ELSE 0 END) = 0 AS can_promote
    FROM entries_v0""")
def _promote_check(L):
    """MIG-4: promotion gate on the expand-phase table (fails while NULLs remain)."""
    return G.promote_check(L.entries_v0)


@query("nulls_after_deploy", f"""
    SELECT posting_month, CAST(SUM(CASE WHEN settlement_batch_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_rows
    FROM entries_v0 WHERE created_at > TIMESTAMP '{K.DEPLOY_TS}' GROUP BY posting_month""")
def _nulls_after_deploy(L):
    """PRJ-9: NULLs written after the dual-write deploy (zero per month)."""
    return G.nulls_after_deploy(L.entries_v0, K.DEPLOY_TS)


@query("settled_without_batch", """
    SELECT e.entry_id, e.transaction_id, e.posting_month FROM entries_v0 e
    WHERE e.settlement_batch_id IS NULL
      AND e.transaction_id IN (SELECT transaction_id FROM transactions WHERE status = 'SETTLED')""")
def _settled_without_batch(L):
    """MIG-5: SETTLED postings without a batch."""
    return G.settled_without_batch(L.entries_v0, L.transactions)


@query("batch_orphans", """
    SELECT e.entry_id, e.settlement_batch_id, e.posting_month FROM entries_v0 e
    WHERE e.settlement_batch_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM settlement_batches b WHERE b.settlement_batch_id = e.settlement_batch_id)""")
def _batch_orphans(L):
    """MIG-6: batch ids with no batch row."""
    return G.batch_orphans(L.entries_v0, L.settlement_batches)


@query("shape_old", """
    SELECT entry_id, transaction_id, wallet_id, type, CAST(amount AS DOUBLE) AS amount, currency, created_at,
           posting_month FROM entries_v0""")
def _shape_old(L):
    """MIG-7: old-shape reader."""
    return G.shape_old(L.entries_v0)


@query("shape_new", """
    SELECT entry_id, transaction_id, posting_month, settlement_batch_id FROM entries_v0
    WHERE settlement_batch_id IS NOT NULL""")
def _shape_new(L):
    """MIG-7: new-shape reader."""
    return G.shape_new(L.entries_v0)


@query("backfill_undo", """SELECT entry_id, posting_month, settlement_batch_id FROM entries_v0""")
def _backfill_undo(L):
    """MIG-8: un-fill the sentinel after a backfill (round trip to the expand state)."""
    return G.backfill_undo(_backfilled(L)).select("entry_id", "posting_month", G.COLUMN)


@query("backfill_invariance", """
    SELECT posting_month, currency, COUNT(*) AS before_rows, CAST(SUM(amount) AS DOUBLE) AS before_amount,
           COUNT(*) AS after_rows, CAST(SUM(amount) AS DOUBLE) AS after_amount, true AS unchanged
    FROM entries_v0 GROUP BY posting_month, currency""")
def _backfill_invariance(L):
    """MIG-9: money and counts per (month, currency) are the same before and after the backfill."""
    return G.backfill_invariance(L.entries_v0, _backfilled(L))


AS_OF_MONTH = K.AS_OF.strftime("%Y-%m")


@query("hot_archive", f"""
    SELECT CASE WHEN posting_month >= '2001-06' THEN 'hot' ELSE 'archive' END AS tier,
           COUNT(DISTINCT posting_month) AS months, COUNT(*) AS rows, CAST(SUM(amount) AS DOUBLE) AS amount
    FROM entries GROUP BY 1""")
def _hot_archive(L):
    """MIG-10: hot / archive split by age written to two paths; the union is the source."""
    hot, archive = G.hot_archive_split(L.entries, AS_OF_MONTH)
    hp, ap = scratch_path(L.spark, "hot"), scratch_path(L.spark, "archive")
    write_by_month(hot, hp)
    write_by_month(archive, ap)
    both = (L.spark.read.parquet(hp).withColumn("tier", F.lit("hot"))
            .unionByName(L.spark.read.parquet(ap).withColumn("tier", F.lit("archive"))))
    return both.groupBy("tier").agg(F.countDistinct("posting_month").alias("months"),
                                    F.count(F.lit(1)).alias("rows"),
                                    F.sum("amount").cast(MONEY_SUM).alias("amount"))
