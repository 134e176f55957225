"""Registered integrity queries (AGG-4/7/14/15/18/20, JOIN-2..6/13, PRJ-3/4/5/8, INT-1/2/3/7/9, SORT-3)."""

from __future__ import annotations

from tally import constants as K
from tally.operators import integrity as I
from tally.operators.snapshots import snapshot_audit
from tally.plans.registry import query
from tally.session import scratch_path
from tally.sources.keyed import KeyedTable


def _inlist(vals):
    return ", ".join(f"'{v}'" for v in vals)


ZS = """
    SELECT transaction_id, currency,
           COALESCE(SUM(amount) FILTER (WHERE type = 'DEBIT'), 0) AS debits,
           COALESCE(SUM(amount) FILTER (WHERE type = 'CREDIT'), 0) AS credits
    FROM entries_staged GROUP BY transaction_id, currency"""


@query("zero_sum_violations", f"""
    SELECT transaction_id, currency, CAST(debits AS DOUBLE) AS debits, CAST(credits AS DOUBLE) AS credits
    FROM ({ZS}) WHERE debits <> credits""")
def _zero_sum_violations(L):
    """AGG-4: unbalanced (transaction, currency) groups of the staged batch."""
    return I.zero_sum_violations(L.entries_staged)


@query("first_violation", f"""
    SELECT transaction_id, arg_min(currency, currency) AS currency,
           CAST(arg_min(debits, currency) AS DOUBLE) AS debits, CAST(arg_min(credits, currency) AS DOUBLE) AS credits,
           COUNT(*) AS unbalanced_currencies
    FROM ({ZS}) WHERE debits <> credits GROUP BY transaction_id""")
def _first_violation(L):
    """SORT-3: first unbalanced currency per transaction."""
    return I.first_violation(L.entries_staged)


@query("zero_sum_scope", f"""
    SELECT transaction_id, SUM(debits) = SUM(credits) AS blind_balanced,
           bool_and(debits = credits) AS per_currency_balanced, COUNT(*) AS currencies,
           SUM(debits) = SUM(credits) AND NOT bool_and(debits = credits) AS fooled
    FROM ({ZS}) GROUP BY transaction_id""")
def _zero_sum_scope(L):
    """AGG-20: currency-blind vs per-currency verdict."""
    return I.zero_sum_scope(L.entries_staged)


@query("thin_transactions", """
    SELECT t.transaction_id, t.status, COALESCE(c.n, 0) AS entry_count
    FROM transactions t LEFT JOIN (SELECT transaction_id, COUNT(*) AS n FROM entries GROUP BY transaction_id) c
      ON c.transaction_id = t.transaction_id
    WHERE COALESCE(c.n, 0) < 2""")
def _thin_transactions(L):
    """AGG-7: headers with fewer than two entries."""
    return I.thin_transactions(L.transactions, L.entries)


@query("currency_mismatch", """
    SELECT e.entry_id, e.transaction_id, e.wallet_id, e.currency FROM entries_staged e
    WHERE e.wallet_id IS NOT NULL AND e.currency IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM wallets w WHERE w.wallet_id = e.wallet_id AND w.currency = e.currency)""")
def _currency_mismatch(L):
    """JOIN-4: composite-FK breaks in the staged batch."""
    return I.currency_mismatch(L.entries_staged, L.wallet_dim)


def _domain_sql(entity, key, column, allowed):
    return (f"SELECT 'domain:{column}' AS rule, '{entity}' AS entity, CAST({key} AS VARCHAR) AS entity_key, "
            f"CAST({column} AS VARCHAR) AS detail FROM {entity} "
            f"WHERE NOT ({column} IS NULL OR {column} IN ({_inlist(allowed)}))")


_DOMAIN_TABLES = {"accounts": "accounts", "wallets": "wallets", "transactions": "transactions",
                  "entries": "entries_staged", "audit_logs": "audit_logs", "settlement_batches": "settlement_batches"}


def _domain_union():
    parts = []
    for entity, column, allowed in I.DOMAIN_RULES:
        parts.append(_domain_sql(_DOMAIN_TABLES[entity], I.KEYS[entity], column, allowed)
                     .replace(f"'{_DOMAIN_TABLES[entity]}' AS entity", f"'{entity}' AS entity"))
    for entity, cols in I.NOT_NULL_RULES.items():
        t = _DOMAIN_TABLES[entity]
        first = "COALESCE(" + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in cols) + ")"
        cond = " OR ".join(f"{c} IS NULL" for c in cols)
        parts.append(f"SELECT 'not_null', '{entity}', CAST({I.KEYS[entity]} AS VARCHAR), {first} FROM {t} "
                     f"WHERE {cond}")
    return "\nUNION ALL ".join(parts)


@query("domain_violations", _domain_union())
def _domain_violations(L):
    """PRJ-3 + PRJ-5: closed-set and NOT NULL rules over every table."""
    return I.domain_violations({"accounts": L.accounts, "wallets": L.wallet_dim, "transactions": L.transactions,
                                "entries": L.entries_staged, "audit_logs": L.audit_logs,
                                "settlement_batches": L.settlement_batches})


@query("amount_violations", """
    SELECT 'amount_positive' AS rule, 'entries' AS entity, entry_id AS entity_key, CAST(amount AS VARCHAR) AS detail
    FROM entries_staged WHERE amount <= 0""")
def _amount_violations(L):
    """PRJ-4: non-positive amounts."""
    return I.amount_violations(L.entries_staged)


@query("rate_violations", """
    SELECT 'rate_positive' AS rule, 'exchange_rates' AS entity, exchange_rate_id AS entity_key,
           CAST(rate AS VARCHAR) AS detail FROM exchange_rates WHERE rate <= 0
    UNION ALL SELECT 'rate_distinct_pair', 'exchange_rates', exchange_rate_id, currency_id
    FROM exchange_rates WHERE base_currency_id = currency_id""")
def _rate_violations(L):
    """PRJ-4: rate > 0, base <> quote."""
    return I.rate_violations(L.exchange_rates)


FK_SQL = """
    SELECT 'wallets.account_id' AS fk, wallet_id AS child_key, account_id AS parent_key FROM wallets c
    WHERE account_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM accounts p WHERE p.account_id = c.account_id)
    UNION ALL SELECT 'transactions.exchange_rate_id', transaction_id, exchange_rate_id FROM transactions c
    WHERE exchange_rate_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM exchange_rates p WHERE p.exchange_rate_id = c.exchange_rate_id)
    UNION ALL SELECT 'entries.transaction_id', entry_id, transaction_id FROM entries_staged c
    WHERE transaction_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM transactions p WHERE p.transaction_id = c.transaction_id)
    UNION ALL SELECT 'idempotency_keys.transaction_id', request_id, transaction_id FROM idempotency_requests c
    WHERE transaction_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM transactions p WHERE p.transaction_id = c.transaction_id)
    UNION ALL SELECT 'audit_logs.transaction_id', audit_log_id, transaction_id FROM audit_logs c
    WHERE transaction_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM transactions p WHERE p.transaction_id = c.transaction_id)
    UNION ALL SELECT 'exchange_rates.base_currency_id', exchange_rate_id, base_currency_id FROM exchange_rates c
    WHERE base_currency_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM currencies p WHERE p.currency_id = c.base_currency_id)
    UNION ALL SELECT 'exchange_rates.currency_id', exchange_rate_id, currency_id FROM exchange_rates c
    WHERE currency_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM currencies p WHERE p.currency_id = c.currency_id)"""


@query("fk_orphans", FK_SQL)
def _fk_orphans(L):
    """JOIN-5: orphans of every simple foreign key."""
    return I.fk_orphans(L)


DUP_SQL = """
    SELECT 'currencies.code' AS constraint_name, code AS key, COUNT(*) AS n FROM currencies
    GROUP BY code HAVING COUNT(*) > 1
    UNION ALL SELECT 'exchange_rates.date_pair', concat_ws('|', CAST(rate_date AS VARCHAR), base_currency_id,
                     currency_id), COUNT(*) FROM exchange_rates
    GROUP BY rate_date, base_currency_id, currency_id HAVING COUNT(*) > 1
    UNION ALL SELECT 'wallets.wallet_id_currency', concat_ws('|', wallet_id, currency), COUNT(*) FROM wallets
    GROUP BY wallet_id, currency HAVING COUNT(*) > 1
    UNION ALL SELECT 'wallets.pkey', wallet_id, COUNT(*) FROM wallets GROUP BY wallet_id HAVING COUNT(*) > 1
    UNION ALL SELECT 'entries.pkey', concat_ws('|', entry_id, strftime(created_at, '%Y-%m-%d %H:%M:%S')), COUNT(*)
    FROM entries_staged GROUP BY entry_id, created_at HAVING COUNT(*) > 1
    UNION ALL SELECT 'idempotency_keys.caller_key', concat_ws('|', caller_id, key), COUNT(*)
    FROM idempotency_requests GROUP BY caller_id, key HAVING COUNT(*) > 1
    UNION ALL SELECT 'transactions.pkey', transaction_id, COUNT(*) FROM transactions
    GROUP BY transaction_id HAVING COUNT(*) > 1"""


@query("duplicate_keys", DUP_SQL)
def _duplicate_keys(L):
    """AGG-14: duplicates of every UNIQUE / PK."""
    return I.duplicate_keys(L)


AUDIT_SQL = """
    SELECT w.wallet_id, w.currency, w.balance AS cached_balance,
           CAST(COALESCE(SUM(e.amount) FILTER (WHERE e.type = 'CREDIT'), 0)
                - COALESCE(SUM(e.amount) FILTER (WHERE e.type = 'DEBIT'), 0) AS DECIMAL(38,4)) AS computed_balance,
           CAST(w.balance - (COALESCE(SUM(e.amount) FILTER (WHERE e.type = 'CREDIT'), 0)
                - COALESCE(SUM(e.amount) FILTER (WHERE e.type = 'DEBIT'), 0)) AS DECIMAL(38,4)) AS discrepancy
    FROM wallets w LEFT JOIN entries e ON e.wallet_id = w.wallet_id
    GROUP BY w.wallet_id, w.currency, w.balance"""


@query("balance_audit", f"""
    SELECT wallet_id, currency, CAST(cached_balance AS DOUBLE) AS cached_balance,
           CAST(computed_balance AS DOUBLE) AS computed_balance, CAST(discrepancy AS DOUBLE) AS discrepancy
    FROM ({AUDIT_SQL})""")
def _balance_audit(L):
    """INT-2: cached vs computed balance for every wallet."""
    return I.balance_audit(L.wallets, L.entries)


@query("balance_drift", f"""
    SELECT wallet_id, currency, CAST(cached_balance AS DOUBLE) AS cached_balance,
           CAST(computed_balance AS DOUBLE) AS computed_balance, CAST(discrepancy AS DOUBLE) AS discrepancy
    FROM ({AUDIT_SQL}) WHERE discrepancy <> 0""")
def _balance_drift(L):
    """PRJ-8: wallets whose cached balance drifted."""
    return I.balance_drift(L.wallets, L.entries)


@query("balance_sync", f"""
    SELECT wallet_id, currency, CAST(cached_balance AS DOUBLE) AS old_balance,
           CAST(computed_balance AS DOUBLE) AS balance, discrepancy <> 0 AS changed
    FROM ({AUDIT_SQL})""")
def _balance_sync(L):
    """INT-3: balance cache sync (decorrelated subquery)."""
    return I.balance_sync(L.wallets, L.entries)


@query("drift_summary", f"""
    SELECT currency, COUNT(*) AS drift_wallets, CAST(SUM(abs(discrepancy)) AS DOUBLE) AS drift_amount
    FROM ({AUDIT_SQL}) WHERE discrepancy <> 0 GROUP BY currency""")
def _drift_summary(L):
    """AGG-15: drift count and amount per currency."""
    return I.drift_summary(L.wallets, L.entries)


@query("mixed_currency_wallets", """
    SELECT wallet_id, COUNT(*) AS currencies, string_agg(currency, ',' ORDER BY currency) AS currency_list
    FROM (SELECT DISTINCT wallet_id, currency FROM entries_staged) GROUP BY wallet_id HAVING COUNT(*) > 1""")
def _mixed_currency_wallets(L):
    """AGG-18: wallets with legs in more than one currency (staged batch)."""
    return I.mixed_currency_wallets(L.entries_staged)


@query("wallets_with_entries", """
    SELECT wallet_id, currency, kind FROM wallets w
    WHERE EXISTS (SELECT 1 FROM entries e WHERE e.wallet_id = w.wallet_id)""")
def _wallets_with_entries(L):
    """JOIN-6 EXISTS."""
    return I.wallets_with_entries(L.wallet_dim, L.entries)


@query("wallets_without_entries", """
    SELECT wallet_id, currency, kind FROM wallets w
    WHERE NOT EXISTS (SELECT 1 FROM entries e WHERE e.wallet_id = w.wallet_id)""")
def _wallets_without_entries(L):
    """JOIN-6 NOT EXISTS."""
    return I.wallets_without_entries(L.wallet_dim, L.entries)


REASONS_SQL = f"""
    SELECT DISTINCT transaction_id, reason FROM (
      SELECT transaction_id, 'bad_type' AS reason FROM entries_staged
      WHERE NOT (type IS NULL OR type IN ({_inlist(K.ENTRY_TYPES)}))
      UNION ALL SELECT transaction_id, 'not_null' FROM entries_staged
      WHERE entry_id IS NULL OR transaction_id IS NULL OR wallet_id IS NULL OR type IS NULL OR amount IS NULL
         OR currency IS NULL OR created_at IS NULL
      UNION ALL SELECT transaction_id, 'amount_not_positive' FROM entries_staged WHERE amount <= 0
      UNION ALL SELECT transaction_id, 'currency_mismatch' FROM entries_staged e
      WHERE wallet_id IS NOT NULL AND currency IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM wallets w WHERE w.wallet_id = e.wallet_id AND w.currency = e.currency)
      UNION ALL SELECT transaction_id, 'missing_header' FROM entries_staged e
      WHERE NOT EXISTS (SELECT 1 FROM transactions t WHERE t.transaction_id = e.transaction_id)
      UNION ALL SELECT transaction_id, 'unbalanced' FROM ({ZS}) WHERE debits <> credits
      UNION ALL SELECT transaction_id, 'duplicate_entry' FROM entries_staged
      GROUP BY transaction_id, entry_id HAVING COUNT(*) > 1)
    WHERE transaction_id IS NOT NULL"""


@query("posting_quarantine", f"""
    SELECT r.transaction_id, r.reasons, l.legs FROM
      (SELECT transaction_id, string_agg(reason, ',' ORDER BY reason) AS reasons FROM ({REASONS_SQL})
       GROUP BY transaction_id) r
    JOIN (SELECT transaction_id, COUNT(*) AS legs FROM entries_staged GROUP BY transaction_id) l
      ON l.transaction_id = r.transaction_id""")
def _posting_quarantine(L):
    """SNK-5: rejected transactions with reasons."""
    return I.posting_quarantine(L.entries_staged, L.transactions, L.wallet_dim)


@query("posting_accepted", f"""
    SELECT transaction_id, entry_id, wallet_id, type, amount::DOUBLE AS amount, currency, created_at, posting_month
    FROM entries_staged s
    WHERE s.transaction_id IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM ({REASONS_SQL}) r WHERE r.transaction_id = s.transaction_id)""")
def _posting_accepted(L):
    """INT-1: accepted legs (transaction-atomic)."""
    return I.posting_accepted(L.entries_staged, L.transactions, L.wallet_dim)


GATE_SQL = f"""
    WITH broken AS (
      SELECT transaction_id, reason FROM ({REASONS_SQL})
      UNION SELECT transaction_id, 'already_posted' FROM entries_staged
      WHERE transaction_id IS NOT NULL AND entry_id IN (SELECT entry_id FROM posted_entries)),
    first_claim AS (
      SELECT caller_id, key, arg_min(transaction_id, (created_at, transaction_id)) AS winner
      FROM posting_requests r
      WHERE r.transaction_id IN (SELECT transaction_id FROM entries_staged)
        AND r.transaction_id NOT IN (SELECT transaction_id FROM broken)
      GROUP BY caller_id, key),
    reasons AS (
      SELECT transaction_id, reason FROM broken
      UNION SELECT r.transaction_id, 'key_claimed' FROM posting_requests r
      LEFT JOIN first_claim f ON f.caller_id = r.caller_id AND f.key = r.key
      WHERE f.winner <> r.transaction_id OR (r.caller_id, r.key) IN (SELECT (caller_id, key) FROM posted_claims))"""


def _gate(L) -> dict:
    """The posted ledger and its claims, as an earlier batch left them."""
    path = scratch_path(L.spark, "gate")
    posted = KeyedTable(L.spark, f"{path}/entries", L.posted_entries.schema, ["entry_id"])
    posted.append_absent(L.posted_entries, "0", ["created_at"])
    claims = KeyedTable(L.spark, f"{path}/claims", L.posted_claims.schema, ["caller_id", "key"])
    claims.append_absent(L.posted_claims, "0", ["created_at", "transaction_id"])
    return {"posted": posted, "claims": claims, "requests": L.posting_requests}


@query("posting_gate", GATE_SQL + """
    SELECT transaction_id, entry_id, wallet_id, type, amount::DOUBLE AS amount, currency, created_at, posting_month
    FROM entries_staged s
    WHERE s.transaction_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM reasons r WHERE r.transaction_id = s.transaction_id)""")
def _posting_gate(L):
    """INT-1 with the idempotency and posted-entry rules: accepted legs of a batch that replays part of the ledger."""
    return I.posting_accepted(L.entries_staged, L.transactions, L.wallet_dim, **_gate(L))


@query("posting_gate_rejects", GATE_SQL + """
    SELECT r.transaction_id, r.reasons, l.legs FROM
      (SELECT transaction_id, string_agg(reason, ',' ORDER BY reason) AS reasons FROM reasons GROUP BY transaction_id) r
    JOIN (SELECT transaction_id, COUNT(*) AS legs FROM entries_staged GROUP BY transaction_id) l
      ON l.transaction_id = r.transaction_id""")
def _posting_gate_rejects(L):
    """INT-1 / SNK-5: rejected transactions of that batch with all their reasons."""
    return I.posting_quarantine(L.entries_staged, L.transactions, L.wallet_dim, **_gate(L))


def _violations_sql():
    zs = (f"SELECT 'zero_sum' AS rule, 'transactions' AS entity, transaction_id || '|' || currency AS entity_key, "
          f"CAST(debits AS VARCHAR) || '/' || CAST(credits AS VARCHAR) AS detail FROM ({ZS}) "
          f"WHERE debits <> credits")
    cm = ("SELECT 'currency_fk', 'entries', entry_id, wallet_id || '|' || currency FROM entries_staged e "
          "WHERE wallet_id IS NOT NULL AND currency IS NOT NULL AND NOT EXISTS "
          "(SELECT 1 FROM wallets w WHERE w.wallet_id = e.wallet_id AND w.currency = e.currency)")
    fk = f"SELECT 'fk', fk, child_key, parent_key FROM ({FK_SQL})"
    dup = f"SELECT 'unique', constraint_name, key, CAST(n AS VARCHAR) FROM ({DUP_SQL})"
    drift = f"SELECT 'balance_drift', 'wallets', wallet_id, CAST(discrepancy AS VARCHAR) FROM ({AUDIT_SQL}) " \
            f"WHERE discrepancy <> 0"
    amt = ("SELECT 'amount_positive', 'entries', entry_id, CAST(amount AS VARCHAR) FROM entries_staged "
           "WHERE amount <= 0")
    rate = ("SELECT 'rate_positive', 'exchange_rates', exchange_rate_id, CAST(rate AS VARCHAR) FROM exchange_rates "
            "WHERE rate <= 0 UNION ALL SELECT 'rate_distinct_pair', 'exchange_rates', exchange_rate_id, currency_id "
            "FROM exchange_rates WHERE base_currency_id = currency_id")
    return "\nUNION ALL ".join([_domain_union(), amt, rate, zs, cm, fk, dup, drift])


@query("violations_all", _violations_sql())
def _violations_all(L):
    """INT-9 / SET-2: every violation, one row per (rule, key)."""
    return I.violations_all(L)


_SNAPSHOT_COLS = ("transaction_id", "wallet_id", "type", "amount", "currency", "created_at", "posting_month")
_CHANGED = {c: f"any_value({c}) FILTER (WHERE side = 'o') IS DISTINCT FROM any_value({c}) FILTER (WHERE side = 'n')"
            for c in _SNAPSHOT_COLS}


@query("immutability_audit", f"""
    SELECT entry_id,
           CASE WHEN bool_and(side = 'o') THEN 'DELETED' WHEN bool_and(side = 'n') THEN 'ADDED' ELSE 'UPDATED' END AS change,
           CASE WHEN count(*) = 2 THEN concat_ws(',', {", ".join(f"CASE WHEN {x} THEN '{c}' END" for c, x in _CHANGED.items())}) END
             AS changed_columns,
           CAST(any_value(amount) FILTER (WHERE side = 'o') AS DOUBLE) AS old_amount,
           CAST(any_value(amount) FILTER (WHERE side = 'n') AS DOUBLE) AS new_amount
    FROM (SELECT 'o' AS side, entry_id, {", ".join(_SNAPSHOT_COLS)} FROM entries
          UNION ALL SELECT 'n', entry_id, {", ".join(_SNAPSHOT_COLS)} FROM entries_snapshot_new)
    GROUP BY entry_id HAVING count(*) = 1 OR {" OR ".join(_CHANGED.values())}""")
def _immutability_audit(L):
    """INT-7 / JOIN-13: rows deleted or changed between two snapshots."""
    return I.immutability_audit(L.entries, L.entries_snapshot_new)


_ONE_MONTH = f"posting_month = '{K.REPORT_MONTH}'"


@query("snapshot_audit", f"""
    SELECT entry_id, CASE WHEN bool_and(side = 'o') THEN 'DELETED' WHEN bool_and(side = 'n') THEN 'ADDED' ELSE 'UPDATED' END AS change,
           CASE WHEN count(*) = 2 THEN concat_ws(',', {", ".join(f"CASE WHEN {x} THEN '{c}' END" for c, x in _CHANGED.items())}) END
             AS changed_columns,
           CAST(any_value(amount) FILTER (WHERE side = 'o') AS DOUBLE) AS old_amount,
           CAST(any_value(amount) FILTER (WHERE side = 'n') AS DOUBLE) AS new_amount
    FROM (SELECT 'o' AS side, entry_id, {", ".join(_SNAPSHOT_COLS)} FROM entries
          UNION ALL SELECT 'n', entry_id, {", ".join(_SNAPSHOT_COLS)} FROM entries_snapshot_new WHERE {_ONE_MONTH}
          UNION ALL SELECT 'n', entry_id, {", ".join(_SNAPSHOT_COLS)} FROM entries WHERE NOT ({_ONE_MONTH}))
    GROUP BY entry_id HAVING count(*) = 1 OR {" OR ".join(_CHANGED.values())}""")
def _snapshot_audit(L):
    """INT-7 / JOIN-13: a snapshot tampered with in one month, found by a tree of digests."""
    new = L.entries_snapshot_new.where(_ONE_MONTH).unionByName(L.entries.where(f"NOT ({_ONE_MONTH})"))
    return snapshot_audit(L.entries, new)
