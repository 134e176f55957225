"""Registered monitoring queries (AGG-8/9/10, WIN-4, OBS-1..6)."""

from __future__ import annotations

from tally import constants as K
from tally.operators import monitor as O
from tally.plans.registry import query

AS_OF = K.AS_OF
EV_AS_OF = K.EVENTS_AS_OF


@query("pending_backlog", f"""
    SELECT type, COUNT(*) AS pending_count, min(created_at) AS oldest_pending,
           CAST(trunc(date_diff('microsecond', min(created_at), TIMESTAMP '{AS_OF}') / 1e6 / 60) AS BIGINT)
             AS oldest_age_minutes
    FROM transactions WHERE status = 'PENDING' GROUP BY type""")
def _pending_backlog(L):
    """AGG-8 / OBS-2: pending backlog and oldest pending age."""
    return O.pending_backlog(L.transactions, AS_OF)


RATE_SQL = """
    SELECT strftime(created_at, '%Y-%m-%d') AS day, COUNT(*) AS headers,
           CAST(SUM(CASE WHEN status = 'REVERSED' THEN 1 ELSE 0 END) AS BIGINT) AS reversed,
           round(SUM(CASE WHEN status = 'REVERSED' THEN 1 ELSE 0 END) / COUNT(*), 6) AS reversal_rate
    FROM transactions GROUP BY 1"""


@query("reversal_rate", RATE_SQL)
def _reversal_rate(L):
    """AGG-9: daily reversal rate."""
    return O.reversal_rate(L.transactions)


ROLLBACK_SQL = """
    SELECT strftime(ts, '%Y-%m-%d') AS day, COUNT(*) AS outcomes,
           CAST(SUM(CASE WHEN outcome = 'ROLLED_BACK' THEN 1 ELSE 0 END) AS BIGINT) AS rolled_back,
           round(SUM(CASE WHEN outcome = 'ROLLED_BACK' THEN 1 ELSE 0 END) / COUNT(*), 6) AS rollback_ratio
    FROM activity_audit WHERE event_type = 'OPERATION_OUTCOME' GROUP BY 1"""


@query("rollback_ratio", ROLLBACK_SQL)
def _rollback_ratio(L):
    """AGG-9: daily rollback ratio of operation outcomes."""
    return O.rollback_ratio(L.activity_audit)


@query("latency_percentiles", """
    SELECT event_type, COUNT(*) AS n, round(quantile_cont(latency_ms, 0.5), 3) AS p50_ms,
           round(quantile_cont(latency_ms, 0.95), 3) AS p95_ms, round(quantile_cont(latency_ms, 0.99), 3) AS p99_ms
    FROM activity_audit WHERE latency_ms IS NOT NULL GROUP BY event_type""")
def _latency_percentiles(L):
    """AGG-10 / OBS-4: exact latency percentiles per outcome type."""
    return O.latency_percentiles(L.activity_audit)


def _step_sql(rate_sql: str, rate: str) -> str:
    return f"""
    SELECT day, {rate}, round(a, 6) AS baseline_avg, round(s, 6) AS baseline_std,
           CASE WHEN s > 0 THEN round(({rate} - a) / s, 4) END AS z,
           COALESCE(abs(CASE WHEN s > 0 THEN round(({rate} - a) / s, 4) END) > 3, false) AS step_change
    FROM (SELECT day, {rate}, avg({rate}) OVER w AS a, stddev_samp({rate}) OVER w AS s
          FROM ({rate_sql}) WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))"""


@query("reversal_step_change", _step_sql(RATE_SQL, "reversal_rate"))
def _reversal_step_change(L):
    """WIN-4: step change of the daily reversal rate vs a trailing 7-day baseline."""
    return O.reversal_step_change(L.transactions)


@query("rollback_step_change", _step_sql(ROLLBACK_SQL, "rollback_ratio"))
def _rollback_step_change(L):
    """WIN-4: step change of the daily rollback ratio vs a trailing 7-day baseline."""
    return O.rollback_step_change(L.activity_audit)


WINDOWS_SQL = """
    SELECT strftime(time_bucket(INTERVAL '5 minutes', ts), '%Y-%m-%d %H:%M') AS window_start, COUNT(*) AS commits,
           round(quantile_cont(latency_ms, 0.99), 3) AS p99_ms, quantile_cont(latency_ms, 0.99) > 150 AS breached
    FROM activity_audit WHERE event_type = 'OPERATION_OUTCOME' AND latency_ms IS NOT NULL GROUP BY 1"""


@query("latency_windows", WINDOWS_SQL)
def _latency_windows(L):
    """OBS-6: commit p99 per 5-minute window from mergeable histograms."""
    return O.latency_windows(O.latency_histogram(L.activity_audit))


DRIFT_SQL = """
    SELECT w.wallet_id FROM wallets w LEFT JOIN entries e ON e.wallet_id = w.wallet_id
    GROUP BY w.wallet_id, w.balance
    HAVING w.balance <> COALESCE(SUM(e.amount) FILTER (WHERE e.type = 'CREDIT'), 0)
                      - COALESCE(SUM(e.amount) FILTER (WHERE e.type = 'DEBIT'), 0)"""
NONZERO_SQL = """
    SELECT currency FROM entries GROUP BY currency
    HAVING COALESCE(SUM(amount) FILTER (WHERE type = 'CREDIT'), 0)
        <> COALESCE(SUM(amount) FILTER (WHERE type = 'DEBIT'), 0)"""


@query("integrity_panel", f"""
    SELECT 'drift_rows' AS metric, COUNT(*) AS value FROM ({DRIFT_SQL})
    UNION ALL SELECT 'nonzero_currencies', COUNT(*) FROM ({NONZERO_SQL})
    UNION ALL SELECT 'unbalanced_groups', COUNT(*) FROM (
      SELECT transaction_id, currency FROM entries GROUP BY transaction_id, currency
      HAVING COALESCE(SUM(amount) FILTER (WHERE type = 'DEBIT'), 0)
          <> COALESCE(SUM(amount) FILTER (WHERE type = 'CREDIT'), 0))""")
def _integrity_panel(L):
    """OBS-1: integrity panel."""
    return O.integrity_panel(L.entries, L.wallets)


RUNWAY_SQL = f"""
    SELECT m.posting_month,
           m.posting_month BETWEEN '{K.FIRST_PARTITION_MONTH}' AND '{K.LAST_PARTITION_MONTH}' AS provisioned,
           COALESCE(c.n, 0) AS entries,
           CASE WHEN m.posting_month BETWEEN '{K.FIRST_PARTITION_MONTH}' AND '{K.LAST_PARTITION_MONTH}' THEN 0
                ELSE COALESCE(c.n, 0) END AS default_rows
    FROM (SELECT strftime(g, '%Y-%m') AS posting_month FROM (
            SELECT unnest(generate_series(date_trunc('month', min(created_at)),
                                          date_trunc('month', TIMESTAMP '{AS_OF}') + INTERVAL 1 MONTH,
                                          INTERVAL 1 MONTH)) AS g FROM entries)) m
    LEFT JOIN (SELECT posting_month, COUNT(*) AS n FROM entries GROUP BY posting_month) c
      ON c.posting_month = m.posting_month"""


@query("partition_runway", RUNWAY_SQL)
def _partition_runway(L):
    """OBS-3: partition runway and DEFAULT-partition rows."""
    return O.partition_runway(L.entries, AS_OF)


@query("slo_attainment", f"""
    SELECT strftime(r.ts, '%Y-%m-%d') AS day, COUNT(*) AS requests,
           CAST(SUM(CASE WHEN date_diff('microsecond', r.ts, o.ts) <= {K.SETTLE_SLO_MINUTES * 60} * 1e6
                    THEN 1 ELSE 0 END) AS BIGINT) AS attained,
           round(SUM(CASE WHEN date_diff('microsecond', r.ts, o.ts) <= {K.SETTLE_SLO_MINUTES * 60} * 1e6
                     THEN 1 ELSE 0 END) / COUNT(*), 6) AS share
    FROM (SELECT * FROM activity_audit WHERE event_type = 'REQUEST_RECEIVED') r
    LEFT JOIN (SELECT * FROM activity_audit
               WHERE event_type IN ('OPERATION_OUTCOME', 'IDEMPOTENT_REPLAY', 'VALIDATION_REJECTED')) o
      ON o.request_id = r.request_id
    GROUP BY 1""")
def _slo_attainment(L):
    """OBS-5: share of requests resolved within 15 minutes, per day."""
    return O.slo_attainment(L.activity_audit)


def _alert_sql():
    rules = ", ".join(f"('{m}', '{c}', {t}, '{s}')" for m, c, t, s in O.ALERT_RULES)
    metrics = f"""
      SELECT 'drift_rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM ({DRIFT_SQL})
      UNION ALL SELECT 'nonzero_currencies', COUNT(*) FROM ({NONZERO_SQL})
      UNION ALL SELECT 'oldest_pending_minutes',
        COALESCE(date_diff('microsecond', min(created_at), TIMESTAMP '{AS_OF}') / 1e6 / 60, 0)
        FROM transactions WHERE status = 'PENDING'
      UNION ALL SELECT 'default_partition_rows', SUM(default_rows) FROM ({RUNWAY_SQL})
      UNION ALL SELECT 'next_month_missing', SUM(CASE WHEN provisioned THEN 0 ELSE 1 END) FROM ({RUNWAY_SQL})
        WHERE posting_month = strftime(date_trunc('month', TIMESTAMP '{AS_OF}') + INTERVAL 1 MONTH, '%Y-%m')
      UNION ALL SELECT 'commit_latency_p99_ms', quantile_cont(latency_ms, 0.99) FROM activity_audit
        WHERE event_type = 'OPERATION_OUTCOME'
      UNION ALL SELECT 'pending_backlog', COUNT(*) FROM transactions WHERE status = 'PENDING'
      UNION ALL SELECT 'reversal_step_changes', SUM(CASE WHEN step_change THEN 1 ELSE 0 END)
      FROM ({_step_sql(RATE_SQL, "reversal_rate")})
      UNION ALL SELECT 'rollback_step_changes', SUM(CASE WHEN step_change THEN 1 ELSE 0 END)
      FROM ({_step_sql(ROLLBACK_SQL, "rollback_ratio")})
      UNION ALL SELECT 'commit_latency_breached_windows', SUM(CASE WHEN breached THEN 1 ELSE 0 END) FROM ({WINDOWS_SQL})"""
    return f"""
    SELECT m.metric, round(m.value, 3) AS value, CAST(r.threshold AS DOUBLE) AS threshold,
           CASE WHEN (r.comparator = '>' AND m.value > r.threshold) OR (r.comparator <> '>' AND m.value < r.threshold)
                THEN r.severity ELSE 'OK' END AS status
    FROM ({metrics}) m JOIN (VALUES {rules}) r(metric, comparator, threshold, severity) ON r.metric = m.metric"""


@query("alert_evaluation", _alert_sql())
def _alert_evaluation(L):
    """OBS-6: every alert metric evaluated against its rule."""
    m = O.metrics_long(L.entries, L.wallets, L.transactions, L.activity_audit, AS_OF)
    return O.alert_evaluation(L.spark, m)
