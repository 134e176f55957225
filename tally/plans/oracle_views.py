"""The fixture mapping written a second time, independently, as DuckDB SQL.

Each oracle query is ``WITH <needed views> <body>``; ``with_views`` pulls in
the transitive dependencies of the views a body names.  The DuckDB side is
deliberately plain (window functions, row_number) -- it is a checker, not
the scalable implementation.
"""

from __future__ import annotations

import re

from tally import constants as K


def _case(col: str, mapping: dict, cast: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN CAST('{v}' AS {cast})" for k, v in mapping.items())
    return f"(CASE {col} {whens} END)"


def rate_sql(base: str, quote: str) -> str:
    return (f"CAST({_case(quote, K.CURRENCY_UNITS, 'DECIMAL(19,8)')} * "
            f"{_case(base, K.CURRENCY_INVERSE, 'DECIMAL(19,8)')} AS DECIMAL(19,8))")


_CCY = "[" + ", ".join(f"'{c}'" for c in K.REGION_CURRENCY) + "]"
_STATUS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.ORDER_STATUS.items())
_ACTORS = "[" + ", ".join("NULL" if a is None else f"'{a}'" for a in K.AUDIT_ACTORS) + "]"
_PAIRS = ", ".join(f"('{b}', '{q}')" for b in K.REGION_CURRENCY for q in K.REGION_CURRENCY if b != q)

VIEWS: dict[str, str] = {
    "currencies": f"""
        SELECT {_CCY}[r_regionkey + 1] AS currency_id, r_name AS name, {_CCY}[r_regionkey + 1] AS code
        FROM region""",
    "nation_currency": f"""
        SELECT n_nationkey, {_CCY}[r_regionkey + 1] AS currency
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "customers": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, currency
        FROM customer JOIN nation_currency ON c_nationkey = n_nationkey""",
    "suppliers": """
        SELECT s_suppkey, s_name, s_nationkey, currency
        FROM supplier JOIN nation_currency ON s_nationkey = n_nationkey""",
    "parties": """
        SELECT 'C' AS party_kind, c_custkey AS party_key, currency FROM customers
        UNION ALL SELECT 'S', s_suppkey, currency FROM suppliers""",
    "accounts": f"""
        SELECT 'C' || c_custkey AS account_id, c_name AS name, 'CUSTOMER' AS type,
               CASE WHEN c_acctbal < {K.CLOSED_ACCTBAL_BELOW} THEN 'closed' ELSE 'active' END AS status,
               currency
        FROM customers
        UNION ALL SELECT 'S' || s_suppkey, s_name, 'MERCHANT_PAYABLE', 'active', currency FROM suppliers
        UNION ALL SELECT * FROM (VALUES ('P-REV', 'Platform revenue', 'PLATFORM_REVENUE', 'active', NULL),
                                        ('P-FX', 'FX desk', 'FX_POSITION', 'active', NULL),
                                        ('P-FLOAT', 'Platform float', 'PLATFORM_FLOAT', 'active', NULL))""",
    "wallet_dim": """
        SELECT *, wallet_id || ' ' || currency AS name FROM (
          SELECT 'W-' || account_id AS wallet_id, account_id, currency, 'regular' AS kind, status
          FROM accounts WHERE type IN ('CUSTOMER', 'MERCHANT_PAYABLE')
          UNION ALL SELECT 'H-' || account_id, account_id, currency, 'holding', status
          FROM accounts WHERE type = 'CUSTOMER'
          UNION ALL SELECT 'REV-' || code, 'P-REV', code, 'regular', 'active' FROM currencies
          UNION ALL SELECT 'FX-' || code, 'P-FX', code, 'regular', 'active' FROM currencies
          UNION ALL SELECT 'FLOAT-' || code, 'P-FLOAT', code, 'regular', 'active' FROM currencies)""",
    "wallets": f"""
        SELECT d.*, CAST(COALESCE(c.computed, 0)
                   + CASE WHEN d.wallet_id LIKE 'W-C%'
                           AND CAST(substr(d.wallet_id, 4) AS BIGINT) % {K.DRIFT_MODULUS} = 0
                          THEN CAST('{K.DRIFT_AMOUNT}' AS DECIMAL(19,4)) ELSE 0 END AS DECIMAL(19,4)) AS balance
        FROM wallet_dim d LEFT JOIN (
          SELECT wallet_id, SUM(CASE WHEN type = 'CREDIT' THEN amount ELSE -amount END) AS computed
          FROM entries GROUP BY wallet_id) c ON c.wallet_id = d.wallet_id""",
    "exchange_rates": f"""
        SELECT strftime(rate_date, '%Y-%m-%d') || '|' || b || '|' || q AS exchange_rate_id,
               rate_date, b AS base_currency_id, q AS currency_id, {rate_sql('b', 'q')} AS rate
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_date FROM orders) d,
             (VALUES {_PAIRS}) p(b, q)""",
    "order_lines": """
        SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(19,4))) AS DECIMAL(19,4)) AS a,
               MIN(l_suppkey) AS min_suppkey, COUNT(*) AS n_lines
        FROM lineitem GROUP BY l_orderkey""",
    "order_flow_raw": f"""
        SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority,
               l.a, l.min_suppkey, l.n_lines,
               CASE WHEN o.o_orderpriority = '{K.URGENT_PRIORITY}' THEN 'C' ELSE 'S' END AS payee_kind,
               CASE WHEN o.o_orderpriority = '{K.URGENT_PRIORITY}'
                    THEN (o.o_custkey * {K.PAYEE_MULTIPLIER} + o.o_orderkey + 1) % (SELECT COUNT(*) FROM customer)
                    ELSE l.min_suppkey END AS payee_key
        FROM orders o LEFT JOIN order_lines l ON o.o_orderkey = l.l_orderkey""",
    "order_flow": f"""
        SELECT 'T' || f.o_orderkey AS transaction_id, f.o_orderkey, f.o_orderdate, f.o_orderpriority, f.n_lines,
               'C' || f.o_custkey AS payer, f.payee_kind || f.payee_key AS payee,
               pc.currency AS p, pe.currency AS q,
               CASE WHEN pe.currency IS NOT NULL AND pc.currency <> pe.currency THEN 'exchange' ELSE 'transfer' END
                 AS txn_type,
               CASE f.o_orderstatus {_STATUS} END AS status,
               CASE WHEN pe.currency IS NOT NULL AND pc.currency <> pe.currency
                    THEN strftime(f.o_orderdate, '%Y-%m-%d') || '|' || pc.currency || '|' || pe.currency END
                 AS exchange_rate_id,
               f.a,
               CAST(round(f.a * CAST('{K.FEE_RATE}' AS DECIMAL(3,2)), 4) AS DECIMAL(19,4)) AS fee,
               CASE WHEN pe.currency IS NOT NULL AND pc.currency <> pe.currency
                    THEN {rate_sql('pc.currency', 'pe.currency')} END AS rate,
               CASE WHEN pe.currency IS NOT NULL AND pc.currency <> pe.currency
                    THEN CAST(round(f.a * {rate_sql('pc.currency', 'pe.currency')}, 4) AS DECIMAL(19,4))
                    ELSE f.a END AS b,
               (f.a IS NOT NULL AND NOT (f.payee_kind = 'C' AND f.payee_key = f.o_custkey)) AS is_movement,
               f.o_orderdate AS created_at
        FROM order_flow_raw f
        LEFT JOIN (SELECT c_custkey, currency FROM customers) pc ON f.o_custkey = pc.c_custkey
        LEFT JOIN parties pe ON f.payee_kind = pe.party_kind AND f.payee_key = pe.party_key""",
    "transactions": """
        SELECT transaction_id, txn_type AS type, status, exchange_rate_id,
               json_object('priority', o_orderpriority, 'lines', CAST(COALESCE(n_lines, 0) AS INTEGER))::VARCHAR
                 AS extra_info,
               created_at
        FROM order_flow""",
    "movements": """
        SELECT transaction_id, o_orderkey, payer, payee, p, q, txn_type, status, a, fee, rate, b, created_at
        FROM order_flow WHERE is_movement""",
    "entries_with_keys": """
        SELECT transaction_id || '-' || leg AS entry_id, transaction_id, wallet_id, type,
               CAST(amount AS DECIMAL(19,4)) AS amount, currency, created_at,
               strftime(created_at, '%Y-%m') AS posting_month, leg, o_orderkey
        FROM (
          SELECT transaction_id, o_orderkey, created_at, 1 AS leg, 'DEBIT' AS type, 'W-' || payer AS wallet_id,
                 a + fee AS amount, p AS currency FROM movements
          UNION ALL SELECT transaction_id, o_orderkey, created_at, 2, 'CREDIT', 'REV-' || p, fee, p FROM movements
          UNION ALL SELECT transaction_id, o_orderkey, created_at, 3, 'CREDIT', 'W-' || payee, a, p
            FROM movements WHERE txn_type = 'transfer'
          UNION ALL SELECT transaction_id, o_orderkey, created_at, 3, 'CREDIT', 'FX-' || p, a, p
            FROM movements WHERE txn_type = 'exchange'
          UNION ALL SELECT transaction_id, o_orderkey, created_at, 4, 'DEBIT', 'FX-' || q, b, q
            FROM movements WHERE txn_type = 'exchange'
          UNION ALL SELECT transaction_id, o_orderkey, created_at, 5, 'CREDIT', 'W-' || payee, b, q
            FROM movements WHERE txn_type = 'exchange')""",
    "entries": """
        SELECT entry_id, transaction_id, wallet_id, type, amount, currency, created_at, posting_month
        FROM entries_with_keys""",
    "entries_staged": f"""
        SELECT entry_id,
               CASE WHEN o_orderkey % {K.FAULT_MISSING_HEADER} = 0 THEN transaction_id || '-X'
                    ELSE transaction_id END AS transaction_id,
               wallet_id,
               CASE WHEN o_orderkey % {K.FAULT_LEG3_BAD_TYPE} = 0 AND leg = 3 THEN 'REFUND' ELSE type END AS type,
               CAST(CASE WHEN o_orderkey % {K.FAULT_LEG1_PLUS_CENT} = 0 AND leg = 1
                           THEN amount + CAST('{K.DRIFT_AMOUNT}' AS DECIMAL(19,4))
                         WHEN o_orderkey % {K.FAULT_LEG2_ZERO} = 0 AND leg = 2 THEN 0
                         ELSE amount END AS DECIMAL(19,4)) AS amount,
               CASE WHEN o_orderkey % {K.FAULT_LEG3_BAD_CURRENCY} = 0 AND leg = 3 THEN 'XXX'
                    ELSE currency END AS currency,
               created_at, posting_month
        FROM entries_with_keys""",
    "posted_entries": f"""
        SELECT entry_id FROM entries_with_keys WHERE o_orderkey % {K.FAULT_ALREADY_POSTED} = 0""",
    "posting_requests": f"""
        SELECT transaction_id, 'C' || (CAST(substr(payer, 2) AS BIGINT) % {K.REQUEST_CALLERS}) AS caller_id,
               'k' || (o_orderkey // {K.REQUEST_KEY_SPAN}) AS key, created_at, o_orderkey
        FROM order_flow""",
    "posted_claims": f"""
        SELECT caller_id, key FROM posting_requests WHERE o_orderkey % {K.CLAIMED_EARLIER} = 0""",
    "entries_snapshot_new": f"""
        SELECT entry_id, transaction_id, wallet_id, type,
               CAST(CASE WHEN o_orderkey % {K.SNAPSHOT_CHANGED} = 0 THEN amount + 1 ELSE amount END
                    AS DECIMAL(19,4)) AS amount,
               currency, created_at, posting_month
        FROM entries_with_keys WHERE o_orderkey % {K.SNAPSHOT_DELETED} <> 0""",
    "entries_v0": f"""
        SELECT *, CASE WHEN created_at >= TIMESTAMP '{K.DEPLOY_TS}' THEN 'B-' || posting_month END
                    AS settlement_batch_id
        FROM entries""",
    "settlement_batches": f"""
        SELECT 'B-' || posting_month AS settlement_batch_id, 'SETTLED' AS status, posting_month AS month
        FROM (SELECT DISTINCT posting_month FROM entries WHERE created_at >= TIMESTAMP '{K.DEPLOY_TS}')
        WHERE posting_month <> '{K.MISSING_BATCH_MONTH}'
        UNION ALL SELECT '{K.SENTINEL_BATCH}', 'SETTLED', NULL""",
    "transfer_edges": """
        SELECT transaction_id AS txn_id, payer AS src, payee AS dst, created_at AS transferred_at, a AS amount, p AS currency
        FROM movements WHERE payee LIKE 'C%' AND status <> 'REVERSED'""",
    "referral_edges": f"""
        SELECT 'C' || c_custkey AS src, 'C' || (c_custkey - 1) AS dst FROM customer
        WHERE c_custkey % {K.REFERRAL_CHAIN_SKIP[0]} <> 0 AND c_custkey % {K.REFERRAL_CHAIN_SKIP[1]} <> 0
        UNION ALL
        SELECT 'C' || c_custkey, 'C' || (c_custkey - {K.REFERRAL_JUMP}) FROM customer
        WHERE c_custkey % {K.REFERRAL_JUMP} = 0 AND c_custkey % {K.REFERRAL_JUMP_SKIP} <> 0""",
    "account_identity": f"""
        SELECT 'C' || c_custkey AS account_id,
               md5(concat_ws('|', CAST(c_nationkey AS VARCHAR), c_mktsegment,
                             CAST(CAST(floor(c_acctbal / {K.ACCTBAL_BUCKET}) AS BIGINT) AS VARCHAR))) AS card,
               md5(concat_ws('|', CAST(c_nationkey AS VARCHAR), CAST(c_custkey % {K.DEVICE_MODULUS} AS VARCHAR)))
                 AS device
        FROM customer""",
    "idempotency_requests": f"""
        SELECT 'C' || user_id AS caller_id, props AS key, 'req-' || event_id AS request_id,
               'T' || event_id AS transaction_id, ts AS created_at,
               ts + INTERVAL {K.IDEMPOTENCY_TTL_HOURS} HOUR AS expires_at, event_id
        FROM events WHERE event_type IN ('purchase', 'click')""",
    "events_ranked": """
        SELECT e.*,
               CASE WHEN event_type IN ('purchase', 'click') THEN
                 row_number() OVER (PARTITION BY user_id, props, event_type IN ('purchase', 'click')
                                    ORDER BY ts, event_id) END AS claim_rank,
               CASE WHEN event_type IN ('purchase', 'click') THEN
                 first_value(event_id) OVER (PARTITION BY user_id, props, event_type IN ('purchase', 'click')
                                             ORDER BY ts, event_id) END AS first_event_id,
               CAST(floor(value) AS BIGINT) AS lat
        FROM events e""",
    "activity_audit": f"""
        SELECT * FROM (
          SELECT 'ev-' || event_id || CASE WHEN event_type = 'view' THEN '-access' ELSE '-in' END AS event_id,
                 CASE WHEN event_type = 'view' THEN 'ACCESS' ELSE 'REQUEST_RECEIVED' END AS event_type,
                 ts, 'C' || user_id AS caller_id, 'req-' || event_id AS request_id,
                 CASE WHEN event_type IN ('purchase', 'click') THEN props END AS idempotency_key,
                 CASE WHEN event_type = 'view' THEN NULL ELSE 'ACCEPTED' END AS outcome,
                 CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS operation_id,
                 CAST(NULL AS BIGINT) AS latency_ms, event_id AS source_event_id,
                 json_object('type', upper(event_type), 'props', props)::VARCHAR AS intent
          FROM events_ranked
          UNION ALL
          SELECT 'ev-' || event_id || '-out',
                 CASE WHEN event_type = 'signup' THEN 'VALIDATION_REJECTED'
                      WHEN event_type IN ('purchase', 'click') AND claim_rank > 1 THEN 'IDEMPOTENT_REPLAY'
                      ELSE 'OPERATION_OUTCOME' END,
                 ts + lat * INTERVAL 1 MILLISECOND, 'C' || user_id, 'req-' || event_id,
                 CASE WHEN event_type IN ('purchase', 'click') THEN props END,
                 CASE WHEN event_type = 'signup' THEN 'REJECTED'
                      WHEN event_type = 'error' THEN 'ROLLED_BACK'
                      WHEN claim_rank = 1 THEN 'COMMITTED' ELSE 'ACCEPTED' END,
                 CASE WHEN event_type = 'signup' THEN 'VALIDATION_FAILED'
                      WHEN event_type = 'error' THEN 'INSUFFICIENT_FUNDS' END,
                 CASE WHEN event_type IN ('purchase', 'click') THEN 'T' || first_event_id END,
                 lat, event_id, json_object('type', upper(event_type), 'props', props)::VARCHAR
          FROM events_ranked
          WHERE event_type IN ('signup', 'purchase', 'click')
             OR (event_type = 'error' AND event_id % {K.NO_OUTCOME_MODULUS} <> 0))""",
    "audit_base": f"""
        SELECT 'AL-' || event_id AS audit_log_id, 'wallet' AS entity_type, 'W-C' || user_id AS entity_id,
               CASE WHEN event_type = 'signup' THEN 'CREATED' ELSE 'FROZEN' END AS action,
               props AS new_state, {_ACTORS}[event_id % 4 + 1] AS actor_type,
               'C' || user_id AS actor_id, 'req-' || event_id AS request_id, ts AS created_at, event_id,
               lag(props) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_state
        FROM events WHERE event_type IN ('signup', 'error')""",
    "audit_logs": f"""
        SELECT audit_log_id, entity_type, entity_id, action,
               CASE WHEN action = 'CREATED' OR prev_state IS NULL THEN NULL
                    WHEN event_id % {K.AUDIT_CHAIN_BREAK} = 0 THEN '{{"k": -1}}'
                    ELSE prev_state END AS old_state,
               new_state, CAST(NULL AS VARCHAR) AS reason, actor_id, actor_type,
               CAST(NULL AS VARCHAR) AS transaction_id, request_id, created_at
        FROM audit_base""",
}

# A view body may name other views; dependencies are discovered by name.
_NAMES = sorted(VIEWS, key=len, reverse=True)


def _deps(sql: str) -> list[str]:
    return [n for n in VIEWS if re.search(rf"\b(FROM|JOIN)\s+{n}\b", sql)]


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the CTEs of every fixture view it reads (transitively, in order)."""
    views = dict(VIEWS)
    if extra:
        views.update(extra)
    order: list[str] = []

    def visit(name, seen):
        if name in order:
            return
        if name in seen:
            raise ValueError(f"cycle at {name}")
        for d in [n for n in views if re.search(rf"\b(FROM|JOIN)\s+{n}\b", views[name]) and n != name]:
            visit(d, seen | {name})
        order.append(name)

    for n in [n for n in views if re.search(rf"\b(FROM|JOIN)\s+{n}\b", body)]:
        visit(n, frozenset())
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({views[n]})" for n in order)
    stripped = body.lstrip()
    if stripped[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{stripped[14:]}"
    if stripped[:4].upper() == "WITH":
        return f"WITH {ctes},\n{stripped[4:]}"
    return f"WITH {ctes}\n{body}"
