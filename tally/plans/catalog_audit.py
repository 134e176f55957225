"""Registered audit queries (JOIN-10/11, WIN-3/5/6, SORT-4)."""

from __future__ import annotations

from tally.operators import audit as A
from tally.plans.registry import query


@query("audit_chain_breaks", """
    SELECT audit_log_id, entity_id, action, old_state, expected_old_state, created_at FROM (
      SELECT *, lag(new_state) OVER (PARTITION BY entity_type, entity_id
                                     ORDER BY created_at, CAST(substr(audit_log_id, 4) AS BIGINT))
                  AS expected_old_state
      FROM audit_logs)
    WHERE action <> 'CREATED' AND old_state IS DISTINCT FROM expected_old_state""")
def _audit_chain_breaks(L):
    """WIN-6: audit rows whose old_state is not the previous new_state."""
    return A.audit_chain_breaks(L.audit_logs)


@query("latest_entity_state", """
    SELECT entity_type, entity_id,
           arg_max(audit_log_id, (created_at, CAST(substr(audit_log_id, 4) AS BIGINT))) AS audit_log_id,
           arg_max(action, (created_at, CAST(substr(audit_log_id, 4) AS BIGINT))) AS last_action,
           arg_max(new_state, (created_at, CAST(substr(audit_log_id, 4) AS BIGINT))) AS state,
           max(created_at) AS changed_at, COUNT(*) AS n_changes
    FROM audit_logs GROUP BY entity_type, entity_id""")
def _latest_entity_state(L):
    """WIN-3: latest audit row per entity."""
    return A.latest_entity_state(L.audit_logs)


@query("attempt_sequence", """
    SELECT caller_id, idempotency_key, request_id, ts,
           row_number() OVER w AS attempt_no,
           round(date_diff('microsecond', lag(ts) OVER w, ts) / 1e6, 3) AS gap_seconds
    FROM activity_audit WHERE event_type = 'REQUEST_RECEIVED' AND idempotency_key IS NOT NULL
    WINDOW w AS (PARTITION BY caller_id, idempotency_key ORDER BY ts, source_event_id)""")
def _attempt_sequence(L):
    """WIN-5: attempt ordinal and gap inside one idempotency key."""
    return A.attempt_sequence(L.activity_audit)


@query("caller_recent", """
    SELECT caller_id, rank, event_id, event_type, ts, outcome FROM (
      SELECT *, row_number() OVER (PARTITION BY caller_id ORDER BY ts DESC, event_id DESC) AS rank
      FROM activity_audit) WHERE rank <= 5""")
def _caller_recent(L):
    """SORT-4: newest five events per caller."""
    return A.caller_recent(L.activity_audit, 5)


@query("audit_correlation", """
    SELECT o.event_id, o.request_id, o.operation_id, o.outcome, t.status AS ledger_status, l.action AS audit_action,
           CASE WHEN o.idempotency_key IS NOT NULL THEN a.attempts END AS attempts
    FROM activity_audit o
    LEFT JOIN transactions t ON t.transaction_id = o.operation_id
    LEFT JOIN audit_logs l ON l.request_id = o.request_id
    LEFT JOIN (SELECT caller_id, idempotency_key, COUNT(*) AS attempts FROM activity_audit
               WHERE event_type = 'REQUEST_RECEIVED' GROUP BY caller_id, idempotency_key) a
      ON a.caller_id = o.caller_id AND a.idempotency_key = o.idempotency_key
    WHERE o.event_type IN ('OPERATION_OUTCOME', 'IDEMPOTENT_REPLAY', 'VALIDATION_REJECTED')""")
def _audit_correlation(L):
    """JOIN-10: layer-3 outcome -> ledger header and layer-2 row, with attempt counts."""
    return A.audit_correlation(L.activity_audit, L.transactions, L.audit_logs)


@query("audit_entity_join", """
    SELECT l.audit_log_id, l.entity_type, l.entity_id, l.action, e.entity_status,
           e.entity_status IS NOT NULL AS entity_found
    FROM audit_logs l LEFT JOIN (
      SELECT 'wallet' AS entity_type, wallet_id AS entity_id, status AS entity_status FROM wallets
      UNION ALL SELECT 'account', account_id, status FROM accounts
      UNION ALL SELECT 'transaction', transaction_id, status FROM transactions) e
      ON e.entity_type = l.entity_type AND e.entity_id = l.entity_id""")
def _audit_entity_join(L):
    """JOIN-11: polymorphic entity reference resolved."""
    return A.audit_entity_join(L.audit_logs, L.wallets, L.accounts, L.transactions)
