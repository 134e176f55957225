"""Fixed values of the ledger model.

Everything here is a value that must be identical in the Spark jobs and in
the DuckDB oracle SQL, so it lives in one place.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

# ---------------------------------------------------------------------------
# Closed vocabularies of the ledger schema.
# ---------------------------------------------------------------------------
ACCOUNT_TYPES = ("CUSTOMER", "PLATFORM_FLOAT", "PLATFORM_REVENUE", "MERCHANT_PAYABLE", "FX_POSITION")
ACCOUNT_STATUSES = ("active", "closed")
WALLET_KINDS = ("regular", "holding")
WALLET_STATUSES = ("active", "closed")
TXN_STATUSES = ("PENDING", "SETTLED", "REVERSED")
ENTRY_TYPES = ("DEBIT", "CREDIT")
ACTOR_TYPES = ("ACCOUNT", "SERVICE", "OPS_USER")
BATCH_STATUSES = ("OPEN", "CLOSED", "SETTLED")

# ---------------------------------------------------------------------------
# The fixture mapping from the driver tables to the ledger.
# ---------------------------------------------------------------------------
# region key 0..4 -> currency code
REGION_CURRENCY = ("USD", "VND", "EUR", "JPY", "SGD")
# units of each currency per 1 USD, and the inverse (USD per unit)
CURRENCY_UNITS = {"USD": "1", "VND": "25000", "EUR": "2", "JPY": "150", "SGD": "4"}
CURRENCY_INVERSE = {"USD": "1", "VND": "0.00004", "EUR": "0.5", "JPY": "0.00666667", "SGD": "0.25"}
# order status -> header status
ORDER_STATUS = {"F": "SETTLED", "O": "PENDING", "P": "REVERSED"}
FEE_RATE = Decimal("0.01")
PAYEE_MULTIPLIER = 31            # payee C<(custkey*31 + orderkey + 1) % customers>
URGENT_PRIORITY = "1-URGENT"
CLOSED_ACCTBAL_BELOW = -900.0    # customer account closed when acctbal < -900
DRIFT_MODULUS = 97               # W-C<k> with k % 97 = 0 carries +0.0100 cached drift
DRIFT_AMOUNT = Decimal("0.0100")
# staged-batch faults by orderkey modulus
FAULT_LEG1_PLUS_CENT = 101
FAULT_LEG3_BAD_CURRENCY = 103
FAULT_LEG2_ZERO = 107
FAULT_LEG3_BAD_TYPE = 109
FAULT_MISSING_HEADER = 113
# replayed postings: legs posted before, and the pairs of (caller, key) that requests share or find claimed
FAULT_ALREADY_POSTED = 127
CLAIMED_EARLIER = 131
REQUEST_CALLERS = 3              # caller C<custkey % 3>
REQUEST_KEY_SPAN = 7             # key k<orderkey / 7>
# snapshot faults
SNAPSHOT_DELETED = 211
SNAPSHOT_CHANGED = 223
# referral graph
REFERRAL_CHAIN_SKIP = (7, 13)
REFERRAL_JUMP = 49
REFERRAL_JUMP_SKIP = 490
# identity projection
DEVICE_MODULUS = 50
ACCTBAL_BUCKET = 100
# audit log faults and actors
AUDIT_CHAIN_BREAK = 17
AUDIT_ACTORS = ("ACCOUNT", "SERVICE", "OPS_USER", None)   # by event_id % 4
NO_OUTCOME_MODULUS = 5          # error events with event_id % 5 = 0 never get an outcome

# ---------------------------------------------------------------------------
# Reproducible "now" and migration constants.
# ---------------------------------------------------------------------------
AS_OF = dt.datetime(2001, 8, 2, 0, 0, 0)        # orders end 2001-08-01 at every sf
DEPLOY_TS = dt.datetime(1998, 1, 1, 0, 0, 0)    # settlement_batch_id cut-over
SENTINEL_BATCH = "00000000-0000-0000-0000-000000000000"
MISSING_BATCH_MONTH = "1999-06"                 # batch deliberately absent (orphan case)
FIRST_PARTITION_MONTH = "1995-01"               # provisioned partition window
LAST_PARTITION_MONTH = "2001-06"
DEFAULT_PARTITION = "__default__"
REPORT_MONTH = "1998-06"
EVENTS_AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)
HOT_MONTHS = 2                                  # hot / archive split
RETENTION_DAYS = 7                              # retention sweep horizon on the event stream
CYCLE_WINDOW_START = dt.datetime(1995, 1, 1)
CYCLE_RATIO = Decimal("0.80")
CYCLE_MIN_HOPS = 2
CYCLE_MAX_HOPS = 6
CYCLE_TOP = 50
CLUSTER_TOP = 20
CLUSTER_SAMPLE = 10
IDEMPOTENCY_TTL_HOURS = 24
LATENCY_SLO_MS = 150
SETTLE_SLO_MINUTES = 15
#: Windows of the commit latency alert and its p99 limit.
LATENCY_WINDOW_MINUTES = 5
COMMIT_P99_LIMIT_MS = 150.0
PENDING_ALERT_MINUTES = 15

# ---------------------------------------------------------------------------
# Streaming horizons.
# ---------------------------------------------------------------------------
ACTIVITY_DELAY = "10 minutes"                   # watermark delay on the activity stream
LEDGER_DELAY = "1 day"                          # watermark delay on the posting stream
LATE_GRACE_DAYS = 1                             # a month closes one day after it ends
ARRIVAL_BATCHES = 4                             # postings arrive in this many key-ordered runs
ORPHAN_BOUND = "1 hour"                         # an outcome later than this counts as none
