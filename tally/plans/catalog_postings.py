"""Registered posting queries (INT-4/5/6/8, WIN-2, AGG-19, SNK-4, JOIN-7, PRJ-10, SRC-5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tally.operators import postings as P
from tally.plans.registry import query
from tally.session import scratch_path
from tally.sources.keyed import KeyedTable

SWEEP_AS_OF = dt.datetime(2024, 1, 15)

LEGS_SQL = """
    SELECT transaction_id || '-' || leg AS entry_id, transaction_id, wallet_id, type,
           CAST(amount AS DOUBLE) AS amount, currency, created_at, CAST(leg AS BIGINT) AS leg
    FROM ({src})"""


def _legs(fx: bool) -> str:
    rate = "r.rate"
    b = f"CAST(round(m.a * {rate}, 4) AS DECIMAL(19,4))"
    if fx:
        src = f"""
          SELECT m.transaction_id, m.created_at, 1 AS leg, 'DEBIT' AS type, 'W-' || m.payer AS wallet_id,
                 m.a + m.fee AS amount, m.p AS currency FROM mv m
          UNION ALL SELECT m.transaction_id, m.created_at, 2, 'CREDIT', 'REV-' || m.p, m.fee, m.p FROM mv m
          UNION ALL SELECT m.transaction_id, m.created_at, 3, 'CREDIT', 'FX-' || m.p, m.a, m.p FROM mv m
          UNION ALL SELECT m.transaction_id, m.created_at, 4, 'DEBIT', 'FX-' || m.q, {b}, m.q FROM mv m
            JOIN exchange_rates r ON r.exchange_rate_id = strftime(m.created_at, '%Y-%m-%d') || '|' || m.p || '|' || m.q
          UNION ALL SELECT m.transaction_id, m.created_at, 5, 'CREDIT', 'W-' || m.payee, {b}, m.q FROM mv m
            JOIN exchange_rates r ON r.exchange_rate_id = strftime(m.created_at, '%Y-%m-%d') || '|' || m.p || '|' || m.q
        """.replace("FROM mv m", "FROM (SELECT * FROM movements WHERE txn_type = 'exchange') m")
    else:
        src = """
          SELECT transaction_id, created_at, 1 AS leg, 'DEBIT' AS type, 'W-' || payer AS wallet_id,
                 a + fee AS amount, p AS currency FROM movements WHERE txn_type = 'transfer'
          UNION ALL SELECT transaction_id, created_at, 2, 'CREDIT', 'REV-' || p, fee, p
            FROM movements WHERE txn_type = 'transfer'
          UNION ALL SELECT transaction_id, created_at, 3, 'CREDIT', 'W-' || payee, a, p
            FROM movements WHERE txn_type = 'transfer'"""
    return LEGS_SQL.format(src=src)


@query("fee_split_legs", _legs(False))
def _fee_split_legs(L):
    """INT-5: fee split into three balanced legs."""
    return P.fee_split_legs(L.movements)


@query("fx_bridge_legs", _legs(True))
def _fx_bridge_legs(L):
    """INT-4: FX bridge with the pinned rate."""
    return P.fx_bridge_legs(L.movements, L.exchange_rates)


@query("reversal_postings", """
    SELECT e.entry_id || '-R' AS entry_id, e.transaction_id || '-R' AS transaction_id, e.transaction_id AS reverses,
           e.wallet_id, CASE WHEN e.type = 'DEBIT' THEN 'CREDIT' WHEN e.type = 'CREDIT' THEN 'DEBIT' END AS type,
           CAST(e.amount AS DOUBLE) AS amount, e.currency, e.created_at
    FROM entries e WHERE e.transaction_id IN (SELECT transaction_id FROM transactions WHERE status = 'REVERSED')""")
def _reversal_postings(L):
    """INT-6: reversing postings for every REVERSED header."""
    return P.reversal_postings(L.entries, L.transactions)


@query("idempotency_resolve", """
    SELECT request_id, caller_id, key, transaction_id,
           first_value(transaction_id) OVER (PARTITION BY caller_id, key ORDER BY created_at, event_id)
             AS resolved_transaction_id,
           row_number() OVER (PARTITION BY caller_id, key ORDER BY created_at, event_id) = 1 AS is_first
    FROM idempotency_requests""")
def _idempotency_resolve(L):
    """WIN-2: first claim wins per (caller, key)."""
    return P.idempotency_resolve(L.idempotency_requests)


@query("duplicate_attempts", """
    SELECT caller_id, key, COUNT(*) AS attempts, COUNT(*) - 1 AS duplicates
    FROM idempotency_requests GROUP BY caller_id, key HAVING COUNT(*) > 1""")
def _duplicate_attempts(L):
    """AGG-19: duplicate attempts per caller and key."""
    return P.duplicate_attempts(L.idempotency_requests)


@query("expired_keys", f"""
    SELECT request_id, caller_id, key, expires_at FROM idempotency_requests
    WHERE expires_at < TIMESTAMP '{SWEEP_AS_OF}'""")
def _expired_keys(L):
    """INT-8: expired-key sweep at a fixed as-of."""
    return P.expired_keys(L.idempotency_requests, SWEEP_AS_OF)


@query("insert_absent", f"""
    WITH cur AS (SELECT * FROM idempotency_requests WHERE created_at < TIMESTAMP '{SWEEP_AS_OF}'),
         new AS (SELECT * FROM idempotency_requests WHERE created_at >= TIMESTAMP '{SWEEP_AS_OF}'),
         first_new AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY caller_id, key
                                                               ORDER BY created_at, event_id) AS rn FROM new)
                       WHERE rn = 1)
    SELECT caller_id, key, request_id, transaction_id, created_at, expires_at, event_id FROM first_new f
    WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE c.caller_id = f.caller_id AND c.key = f.key)""")
def _insert_absent(L):
    """SNK-4: insert-if-absent of the second half-month's claims into the first half's table."""
    r = L.idempotency_requests
    cur = r.filter(F.col("created_at") < F.lit(SWEEP_AS_OF))
    new = r.filter(F.col("created_at") >= F.lit(SWEEP_AS_OF))
    return P.insert_absent(new, cur, ["caller_id", "key"], ["created_at", "event_id"])


@query("append_replay", """
    SELECT caller_id, key, request_id, transaction_id, created_at, expires_at, event_id
    FROM (SELECT *, row_number() OVER (PARTITION BY caller_id, key ORDER BY created_at, event_id) AS rn
          FROM idempotency_requests) WHERE rn = 1""")
def _append_replay(L):
    """SNK-4: claims appended in two batches, each of them sent again: under its own id and under another."""
    r = L.idempotency_requests.withColumn("month", F.date_format("created_at", "yyyy-MM"))
    t = KeyedTable(L.spark, scratch_path(L.spark, "claims"), r.schema, ["caller_id", "key"], month_col="month")
    early = F.col("created_at") < F.lit(SWEEP_AS_OF)
    for batch, rows in (("1", r.filter(early)), ("2", r.filter(~early)), ("2", r.filter(~early)), ("2-again", r)):
        t.append_absent(rows, batch, ["created_at", "event_id"])
    return t.read().drop("month", "batch")


@query("fx_enriched", """
    SELECT t.transaction_id, t.status, strftime(r.rate_date, '%Y-%m-%d') AS rate_date,
           r.base_currency_id AS base_code, b.name AS base_name, r.currency_id AS quote_code, q.name AS quote_name,
           CAST(r.rate AS DOUBLE) AS rate
    FROM transactions t JOIN exchange_rates r ON r.exchange_rate_id = t.exchange_rate_id
    JOIN currencies b ON b.currency_id = r.base_currency_id JOIN currencies q ON q.currency_id = r.currency_id""")
def _fx_enriched(L):
    """JOIN-7: pinned rate with both currency roles."""
    return P.fx_enriched(L.transactions, L.exchange_rates, L.currencies)


@query("exchange_headers", """
    SELECT transaction_id, exchange_rate_id, status FROM transactions WHERE exchange_rate_id IS NOT NULL""")
def _exchange_headers(L):
    """PRJ-10: headers with a pinned rate."""
    return P.exchange_headers(L.transactions)


@query("json_payload", """
    SELECT transaction_id, json_extract_string(extra_info, '$.priority') AS priority,
           CAST(json_extract(extra_info, '$.lines') AS BIGINT) AS lines,
           CAST(json_extract(extra_info, '$.lines') AS BIGINT) AS lines_by_path
    FROM transactions""")
def _json_payload(L):
    """SRC-5: JSON payload fields by schema and by path."""
    return P.json_payload(L.transactions)
