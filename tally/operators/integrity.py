"""Integrity rules, the posting gate, reconciliation and snapshot audit.

Every rule is a DataFrame of violations; rules compose by ``unionByName``.
A PostgreSQL CHECK / FK / trigger becomes a set-based check over a batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally import constants as K
from tally.functions.columns import MONEY_SUM, domain_ok, sum_where
from tally.functions.skew import hot_keys_of, is_hot_key, join_back, join_beside, together
from tally.operators.rules import Balanced, Cached, Check, Reference, Rule, Unique, violations
from tally.sources.storage import write_by_month

VIOLATION_COLS = ["rule", "entity", "entity_key", "detail"]

# Closed-set rules: (entity, column, allowed values).  One table for all of PRJ-3.
DOMAIN_RULES = [
    ("accounts", "type", K.ACCOUNT_TYPES),
    ("accounts", "status", K.ACCOUNT_STATUSES),
    ("wallets", "kind", K.WALLET_KINDS),
    ("wallets", "status", K.WALLET_STATUSES),
    ("transactions", "status", K.TXN_STATUSES),
    ("entries", "type", K.ENTRY_TYPES),
    ("audit_logs", "actor_type", K.ACTOR_TYPES),
    ("settlement_batches", "status", K.BATCH_STATUSES),
]
# NOT NULL rules (PRJ-5)
NOT_NULL_RULES = {
    "entries": ("entry_id", "transaction_id", "wallet_id", "type", "amount", "currency", "created_at"),
    "transactions": ("transaction_id", "type", "status", "created_at"),
}
KEYS = {"accounts": "account_id", "wallets": "wallet_id", "transactions": "transaction_id",
        "entries": "entry_id", "audit_logs": "audit_log_id", "settlement_batches": "settlement_batch_id",
        "exchange_rates": "exchange_rate_id"}
# (table, its key, column, parent, parent column)
FOREIGN_KEYS = [
    ("wallets", "wallet_id", "account_id", "accounts", "account_id"),
    ("transactions", "transaction_id", "exchange_rate_id", "exchange_rates", "exchange_rate_id"),
    ("entries", "entry_id", "transaction_id", "transactions", "transaction_id"),
    ("idempotency_keys", "request_id", "transaction_id", "transactions", "transaction_id"),
    ("audit_logs", "audit_log_id", "transaction_id", "transactions", "transaction_id"),
    ("exchange_rates", "exchange_rate_id", "base_currency_id", "currencies", "currency_id"),
    ("exchange_rates", "exchange_rate_id", "currency_id", "currencies", "currency_id"),
]
UNIQUE_KEYS = [
    ("currencies", "code", ("code",)),
    ("exchange_rates", "date_pair", ("rate_date", "base_currency_id", "currency_id")),
    ("wallets", "wallet_id_currency", ("wallet_id", "currency")),
    ("wallets", "pkey", ("wallet_id",)),
    ("entries", "pkey", ("entry_id", "created_at")),
    ("idempotency_keys", "caller_key", ("caller_id", "key")),
    ("transactions", "pkey", ("transaction_id",)),
]


def _violation(df: DataFrame, rule: str, entity: str, key, detail) -> DataFrame:
    key = F.col(key) if isinstance(key, str) else key
    return df.select(F.lit(rule).alias("rule"), F.lit(entity).alias("entity"),
                     key.cast("string").alias("entity_key"), detail.cast("string").alias("detail"))


def domain_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """PRJ-3 + PRJ-5: closed-set and NOT NULL rules; NULL passes a CHECK, fails NOT NULL."""
    parts = []
    for entity, column, allowed in DOMAIN_RULES:
        if entity in tables:
            df = tables[entity]
            parts.append(_violation(df.filter(~domain_ok(column, allowed)), f"domain:{column}", entity,
                                    KEYS[entity], F.col(column)))
    for entity, cols in NOT_NULL_RULES.items():
        if entity in tables:
            df = tables[entity]
            bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
            first_null = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
            parts.append(_violation(df.filter(bad), "not_null", entity, KEYS[entity], first_null))
    return reduce(DataFrame.unionByName, parts)


def amount_violations(entries: DataFrame) -> DataFrame:
    """PRJ-4: amount must be > 0."""
    return _violation(entries.filter(F.col("amount") <= 0), "amount_positive", "entries", "entry_id",
                      F.col("amount"))


def rate_violations(rates: DataFrame) -> DataFrame:
    """PRJ-4: rate > 0 and base <> quote."""
    bad_rate = _violation(rates.filter(F.col("rate") <= 0), "rate_positive", "exchange_rates",
                          "exchange_rate_id", F.col("rate"))
    same = _violation(rates.filter(F.col("base_currency_id") == F.col("currency_id")), "rate_distinct_pair",
                      "exchange_rates", "exchange_rate_id", F.col("currency_id"))
    return bad_rate.unionByName(same)


def per_currency_totals(entries: DataFrame) -> DataFrame:
    """AGG-3 per (transaction, currency): debits, credits (partial aggregation absorbs hot keys)."""
    return (entries.groupBy("transaction_id", "currency")
            .agg(sum_where(F.col("type") == "DEBIT").alias("debits"),
                 sum_where(F.col("type") == "CREDIT").alias("credits")))


def zero_sum_violations(entries: DataFrame) -> DataFrame:
    """AGG-4: (transaction, currency) groups whose debits <> credits."""
    return per_currency_totals(entries).filter(F.col("debits") != F.col("credits"))


def first_violation(entries: DataFrame) -> DataFrame:
    """SORT-3: the first unbalanced currency per transaction (deterministic: smallest currency)."""
    return (zero_sum_violations(entries).groupBy("transaction_id")
            .agg(F.min_by(F.struct("currency", "debits", "credits"), F.col("currency")).alias("v"),
                 F.count(F.lit(1)).alias("unbalanced_currencies"))
            .select("transaction_id", "v.currency", "v.debits", "v.credits", "unbalanced_currencies"))


def zero_sum_scope(entries: DataFrame) -> DataFrame:
    """AGG-20: currency-blind verdict next to the per-currency verdict for every transaction."""
    per = per_currency_totals(entries)
    return (per.groupBy("transaction_id")
            .agg((F.sum("debits") == F.sum("credits")).alias("blind_balanced"),
                 F.bool_and(F.col("debits") == F.col("credits")).alias("per_currency_balanced"),
                 F.count(F.lit(1)).alias("currencies"))
            .withColumn("fooled", F.col("blind_balanced") & ~F.col("per_currency_balanced")))


def thin_transactions(transactions: DataFrame, entries: DataFrame) -> DataFrame:
    """AGG-7: headers with fewer than two entries, including none."""
    counts = entries.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("n"))
    return (transactions.select("transaction_id", "status", "created_at")
            .join(counts, "transaction_id", "left")
            .select("transaction_id", "status", F.coalesce("n", F.lit(0)).alias("entry_count"))
            .filter(F.col("entry_count") < 2))


def currency_mismatch(entries: DataFrame, wallets: DataFrame) -> DataFrame:
    """JOIN-4: legs whose (wallet_id, currency) has no wallet; composite FK skips NULL keys."""
    return (entries.filter(F.col("wallet_id").isNotNull() & F.col("currency").isNotNull())
            .join(wallets.select("wallet_id", "currency"), ["wallet_id", "currency"], "left_anti")
            .select("entry_id", "transaction_id", "wallet_id", "currency"))


def _orphans(child: DataFrame, fk: str, child_key: str, cols: list[str], parent: DataFrame,
             pcols: list[str]) -> DataFrame:
    c = child.filter(reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in cols]))
    p = parent.select(*[F.col(pc).alias(cc) for pc, cc in zip(pcols, cols)])
    return (c.join(p, cols, "left_anti")
            .select(F.lit(fk).alias("fk"), F.col(child_key).cast("string").alias("child_key"),
                    F.concat_ws("|", *[F.col(x).cast("string") for x in cols]).alias("parent_key")))


def fk_orphans(L) -> DataFrame:
    """JOIN-5: every simple foreign key as a left-anti join, unioned."""
    parts = [
        _orphans(L.wallet_dim, "wallets.account_id", "wallet_id", ["account_id"], L.accounts, ["account_id"]),
        _orphans(L.transactions, "transactions.exchange_rate_id", "transaction_id", ["exchange_rate_id"],
                 L.exchange_rates, ["exchange_rate_id"]),
        _orphans(L.entries_staged, "entries.transaction_id", "entry_id", ["transaction_id"],
                 L.transactions, ["transaction_id"]),
        _orphans(L.idempotency_requests, "idempotency_keys.transaction_id", "request_id", ["transaction_id"],
                 L.transactions, ["transaction_id"]),
        _orphans(L.audit_logs, "audit_logs.transaction_id", "audit_log_id", ["transaction_id"],
                 L.transactions, ["transaction_id"]),
        _orphans(L.exchange_rates, "exchange_rates.base_currency_id", "exchange_rate_id", ["base_currency_id"],
                 L.currencies, ["currency_id"]),
        _orphans(L.exchange_rates, "exchange_rates.currency_id", "exchange_rate_id", ["currency_id"],
                 L.currencies, ["currency_id"]),
    ]
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(L) -> DataFrame:
    """AGG-14: every UNIQUE / PK as groupBy(keys).count > 1, unioned."""
    def dups(df, name, cols):
        return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
                .select(F.lit(name).alias("constraint_name"),
                        F.concat_ws("|", *[F.col(c).cast("string") for c in cols]).alias("key"), "n"))
    parts = [
        dups(L.currencies, "currencies.code", ["code"]),
        dups(L.exchange_rates, "exchange_rates.date_pair", ["rate_date", "base_currency_id", "currency_id"]),
        dups(L.wallet_dim, "wallets.wallet_id_currency", ["wallet_id", "currency"]),
        dups(L.wallet_dim, "wallets.pkey", ["wallet_id"]),
        dups(L.entries_staged, "entries.pkey", ["entry_id", "created_at"]),
        dups(L.idempotency_requests, "idempotency_keys.caller_key", ["caller_id", "key"]),
        dups(L.transactions, "transactions.pkey", ["transaction_id"]),
    ]
    return reduce(DataFrame.unionByName, parts)


def balance_audit(wallets: DataFrame, entries: DataFrame) -> DataFrame:
    """INT-2 / JOIN-2: cached vs computed balance; entries aggregated before the outer join.

    Every entry counts whatever its header status (no join to transactions).
    """
    per_wallet = (entries.groupBy("wallet_id")
                  .agg(sum_where(F.col("type") == "CREDIT").alias("credits"),
                       sum_where(F.col("type") == "DEBIT").alias("debits")))
    computed = (F.coalesce(F.col("credits"), F.lit(0)) - F.coalesce(F.col("debits"), F.lit(0))).cast(MONEY_SUM)
    return (wallets.select("wallet_id", "currency", F.col("balance").alias("cached_balance"))
            .join(per_wallet, "wallet_id", "left")
            .select("wallet_id", "currency", "cached_balance", computed.alias("computed_balance"))
            .withColumn("discrepancy", (F.col("cached_balance") - F.col("computed_balance")).cast(MONEY_SUM)))


def balance_drift(wallets: DataFrame, entries: DataFrame) -> DataFrame:
    """PRJ-8: only the rows whose discrepancy is non-zero."""
    return balance_audit(wallets, entries).filter(F.col("discrepancy") != 0)


def balance_sync(wallets: DataFrame, entries: DataFrame) -> DataFrame:
    """INT-3 / JOIN-3: the decorrelated ``balance = (SELECT SUM ...)``: new cached balance per wallet."""
    audit = balance_audit(wallets, entries)
    return audit.select("wallet_id", "currency", F.col("cached_balance").alias("old_balance"),
                        F.col("computed_balance").alias("balance"),
                        (F.col("discrepancy") != 0).alias("changed"))


def drift_summary(wallets: DataFrame, entries: DataFrame) -> DataFrame:
    """AGG-15: mismatch count and absolute amount per currency."""
    return (balance_drift(wallets, entries).groupBy("currency")
            .agg(F.count(F.lit(1)).alias("drift_wallets"),
                 F.sum(F.abs("discrepancy")).cast(MONEY_SUM).alias("drift_amount")))


def mixed_currency_wallets(entries: DataFrame) -> DataFrame:
    """AGG-18: wallets whose entries carry more than one currency."""
    per = entries.select("wallet_id", "currency").distinct()
    return (per.groupBy("wallet_id").agg(F.count(F.lit(1)).alias("currencies"),
                                         F.concat_ws(",", F.sort_array(F.collect_list("currency")))
                                         .alias("currency_list"))
            .filter(F.col("currencies") > 1))


def _used_wallets(entries: DataFrame) -> DataFrame:
    """One row per wallet that has entries, combined per task: a platform wallet has a share of all entries.

    Joined as rows with a mark: a semi or anti join would be done once for each part of the union that wallets are.
    """
    return entries.select("wallet_id").distinct().withColumn("_used", F.lit(True))


def wallets_with_entries(wallets: DataFrame, entries: DataFrame) -> DataFrame:
    """JOIN-6 EXISTS."""
    return wallets.join(_used_wallets(entries), "wallet_id").select("wallet_id", "currency", "kind")


def wallets_without_entries(wallets: DataFrame, entries: DataFrame) -> DataFrame:
    """JOIN-6 NOT EXISTS."""
    return (wallets.join(_used_wallets(entries), "wallet_id", "left").where("_used is null")
            .select("wallet_id", "currency", "kind"))


# ---- posting gate ------------------------------------------------------------

GATE_RULES = ("bad_type", "not_null", "amount_not_positive", "currency_mismatch", "missing_header",
              "unbalanced", "duplicate_entry")


def posting_unit() -> Column:
    """What a leg stands or falls with: its transaction, or itself where it names none."""
    return F.coalesce(F.col("transaction_id"), F.concat(F.lit("entry:"), F.coalesce("entry_id", F.lit(""))))


def _judged_legs(staged: DataFrame, transactions: DataFrame, wallets: DataFrame, posted=None) -> tuple[DataFrame, list[str]]:
    """The staged legs, each with its unit, the unit's leg count ``_legs`` and what the unit breaks (``_<rule>``), and the rules.

    The legs are shuffled once, to their unit, with all their columns: header
    ids, the units with a leg in a currency its wallet has not and those with a
    posted entry meet them there, and windows over (unit, currency), (unit,
    entry) and unit tell the rest.  What finds these units is narrow.  Legs of a
    hot unit are not brought together but judged by aggregates.
    """
    staged = staged.withColumn("unit", posting_unit())
    pairs = wallets.select("wallet_id", "currency").distinct()
    strays = join_beside(staged.where("wallet_id is not null and currency is not null").select("wallet_id", "currency", "unit"),
                         pairs, ["wallet_id", "currency"], "left_anti")
    heads = transactions.where("transaction_id is not null").select(F.col("transaction_id").alias("unit")).distinct()
    facts = {"_stray": strays.select("unit").distinct(), "_header": heads}
    if posted is not None:
        facts["_posted"] = posted.held(staged.select("entry_id", "unit")).select("unit").distinct()
    rules = [*GATE_RULES, *(["already_posted"] if posted is not None else [])]
    hot, n = hot_keys_of(staged, ["unit"])
    if not hot:
        return _by_windows(together(staged, "unit", n), facts, rules), rules
    is_hot = is_hot_key(["unit"], hot)
    parts = [(how, legs, {k: f.where(c) for k, f in facts.items()}) for how, legs, c in (
        (_by_windows, together(staged.where(~is_hot), "unit", n), ~is_hot), (_by_groups, staged.where(is_hot), is_hot))]
    return reduce(DataFrame.unionByName, [how(legs, f, rules) for how, legs, f in parts]), rules


def _leg_rules(facts) -> dict[str, Column]:
    """What a leg breaks by itself or by what is known of its unit."""
    not_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in NOT_NULL_RULES["entries"]])
    out = {"bad_type": ~domain_ok("type", K.ENTRY_TYPES), "not_null": not_null,
           "amount_not_positive": F.coalesce(F.col("amount") <= 0, F.lit(False)),
           "currency_mismatch": F.col("_stray").isNotNull(),
           "missing_header": F.col("transaction_id").isNull() | F.col("_header").isNull()}
    return out | ({"already_posted": F.col("_posted").isNotNull()} if "_posted" in facts else {})


def _with_facts(legs: DataFrame, facts, few: bool = False) -> DataFrame:
    for name, units in facts.items():
        units = units.withColumn(name, F.lit(True))
        legs = legs.join(F.broadcast(units) if few else units, "unit", "left")
    return legs


def _by_windows(staged: DataFrame, facts, rules: list[str]) -> DataFrame:
    legs = _with_facts(staged, facts)
    in_ccy, same, unit = (Window.partitionBy("unit", *more) for more in (["currency"], ["entry_id"], []))
    debits, credits = (F.coalesce(F.sum(F.when(F.col("type") == t, F.col("amount"))).over(in_ccy), F.lit(0)).cast(MONEY_SUM)
                       for t in ("DEBIT", "CREDIT"))
    broken = _leg_rules(facts) | {"unbalanced": debits != credits, "duplicate_entry": F.count(F.lit(1)).over(same) > 1}
    legs = legs.select(*staged.columns, *[broken[r].alias(f"_{r}") for r in rules])
    return legs.select(*staged.columns, F.count(F.lit(1)).over(unit).alias("_legs"),
                       *[F.bool_or(f"_{r}").over(unit).alias(f"_{r}") for r in rules])


def _by_groups(staged: DataFrame, facts, rules: list[str]) -> DataFrame:
    """For the few hot units: each aggregate is combined per task, their verdicts go to every task."""
    broken = _leg_rules(facts)
    legs = _with_facts(staged, facts, few=True).select("unit", "entry_id", "currency", "type", "amount", *[c.alias(f"_{r}") for r, c in broken.items()])
    per_ccy = (legs.groupBy("unit", "currency")
               .agg(sum_where(F.col("type") == "DEBIT").alias("debits"), sum_where(F.col("type") == "CREDIT").alias("credits"),
                    F.count(F.lit(1)).alias("_legs"), *[F.bool_or(f"_{r}").alias(f"_{r}") for r in broken]))
    per_unit = (per_ccy.groupBy("unit")
                .agg(F.bool_or(F.col("debits") != F.col("credits")).alias("_unbalanced"), F.sum("_legs").alias("_legs"),
                     *[F.bool_or(f"_{r}").alias(f"_{r}") for r in broken]))
    dups = (legs.groupBy("unit", "entry_id").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("unit").agg(F.bool_or(F.col("n") > 1).alias("_duplicate_entry")))
    told = per_unit.join(dups, "unit").select("unit", "_legs", *[f"_{r}" for r in rules])
    return staged.join(F.broadcast(told), "unit").select(*staged.columns, "_legs", *[f"_{r}" for r in rules])


def _sentenced(staged: DataFrame, transactions: DataFrame, wallets: DataFrame, posted=None, requests: DataFrame | None = None,
               claims=None) -> DataFrame:
    """``_judged_legs`` with the array ``reasons`` of everything their unit breaks, claims included."""
    legs, rules = _judged_legs(staged, transactions, wallets, posted)
    names = sorted(rules)
    reasons = F.filter(F.array(*[F.when(F.col(f"_{r}"), F.lit(r)) for r in names]), lambda x: x.isNotNull())
    if requests is not None:
        # always true, and reads what the rules do not: the legs read for the claims and for the result share one shuffle
        rest = [c for c in staged.columns if c not in NOT_NULL_RULES["entries"]]
        legs = legs.where(F.length(F.concat_ws("", *[F.col(c).cast("string") for c in rest])) >= 0)
        clean = reduce(lambda a, b: a & b, [~F.coalesce(F.col(f"_{r}"), F.lit(False)) for r in names])
        told = claim_verdicts(requests, legs.where(clean).select(F.col("unit").alias("transaction_id")).distinct(), claims)
        legs = legs.join(told.select(F.col("transaction_id").alias("unit"), "key_claimed"), "unit", "left")
        reasons = F.array_sort(F.concat(reasons, F.when(F.col("key_claimed"), F.array(F.lit("key_claimed"))).otherwise(F.array())))
    return legs.select(*staged.columns, "unit", "_legs", reasons.alias("reasons"))


def posting_verdicts(staged: DataFrame, transactions: DataFrame, wallets: DataFrame, posted=None,
                     requests: DataFrame | None = None, claims=None) -> DataFrame:
    """INT-1 in one pass: one row per staged transaction with every rule's verdict and its leg count.

    A leg without a transaction id belongs to no atomic unit: it is a unit of
    its own, named by its entry id, and breaks ``not_null``.

    ``posted``: the KeyedTable of posted entries; a leg whose entry id it has
    breaks ``already_posted``.  ``requests`` (transaction_id, caller_id, key,
    created_at) and ``claims``, the KeyedTable of earlier claims, add
    ``key_claimed`` (see ``claim_verdicts``).
    """
    return (_sentenced(staged, transactions, wallets, posted, requests, claims)
            .select(F.col("unit").alias("transaction_id"), F.col("_legs").alias("legs"), "reasons").distinct())


def claim_verdicts(requests: DataFrame, clean: DataFrame, claims=None) -> DataFrame:
    """INT-1 idempotency: (transaction_id, key_claimed) of every request's transaction.

    A (caller, key) pair belongs to the transaction that claimed it first: one
    in ``claims`` (a KeyedTable), or else the earliest of the ``clean``
    transactions of this batch, by request time and id -- a transaction that
    falls to another rule claims nothing, as its claim would be rolled back with
    it.  Every other transaction with that pair breaks the rule.  A request
    without a caller or a key claims nothing.
    """
    pair = ["caller_id", "key"]
    asked = requests.where("caller_id is not null and key is not null and transaction_id is not null")
    first = (asked.join(clean, "transaction_id", "left_semi").groupBy(*pair)
             .agg(F.min(F.struct("created_at", "transaction_id"))["transaction_id"].alias("_first")))
    out = join_back(asked, first, pair, "left", spread=["transaction_id"])
    taken = F.lit(False)
    if claims is not None:
        out = join_back(out, claims.holds(asked.select(*pair)).withColumn("_taken", F.lit(True)), pair, "left",
                        spread=["transaction_id"])
        taken = F.coalesce("_taken", F.lit(False))
    lost = taken | F.coalesce(F.col("_first") != F.col("transaction_id"), F.lit(False))
    return out.groupBy("transaction_id").agg(F.bool_or(lost).alias("key_claimed"))


def posting_quarantine(staged: DataFrame, transactions: DataFrame, wallets: DataFrame, **more) -> DataFrame:
    """SNK-5: one row per rejected transaction with all its reasons and its leg count."""
    return (posting_verdicts(staged, transactions, wallets, **more).filter(F.size("reasons") > 0)
            .select("transaction_id", F.concat_ws(",", "reasons").alias("reasons"), "legs"))


def posting_accepted(staged: DataFrame, transactions: DataFrame, wallets: DataFrame, **more) -> DataFrame:
    """INT-1: legs of transactions with no violation -- one bad leg removes all legs of its transaction.

    What is not accepted is in ``posting_rejected_legs``; together they are the staged legs.
    """
    return _sentenced(staged, transactions, wallets, **more).filter(F.size("reasons") == 0).select(*staged.columns)


def posting_rejected_legs(staged: DataFrame, transactions: DataFrame, wallets: DataFrame, **more) -> DataFrame:
    """SNK-5: the rejected legs themselves, each with its transaction's reasons."""
    return (_sentenced(staged, transactions, wallets, **more).filter(F.size("reasons") > 0)
            .select(*staged.columns, F.concat_ws(",", "reasons").alias("reasons")))


def quarantine(staged: DataFrame, transactions: DataFrame, wallets: DataFrame, path: str, **more) -> None:
    """SNK-5: write the rejected legs with their reasons, by posting month."""
    write_by_month(posting_rejected_legs(staged, transactions, wallets, **more), path, dynamic=True)


def post_batch(staged: DataFrame, transactions: DataFrame, wallets: DataFrame, requests: DataFrame, posted, claims, batch: str) -> bool:
    """INT-1 / SNK-4: the whole gate, then the accepted legs and their claims appended as ``batch``.

    Running it again -- the same batch, or the same rows under another id --
    appends nothing.  The legs are committed before the claims; a run that died
    between them is finished by its rerun, which finds the legs' batch there.
    """
    fresh = posted.append_absent(
        posting_accepted(staged, transactions, wallets, posted=posted, requests=requests, claims=claims), batch, ["created_at"])
    mine = posted.read().where(F.col("batch") == f"b-{batch}").select("transaction_id")
    won = requests.join(mine, "transaction_id", "left_semi").withColumn("posting_month", F.date_format("created_at", "yyyy-MM"))
    claims.append_absent(won, batch, ["created_at", "transaction_id"])
    return fresh


def rule_set() -> list[Rule]:
    """Every rule of the ledger, as ``rules.violations`` compiles them."""
    def check(rule, entity, bad, detail, table=None):
        return Check(rule, table or entity, entity, KEYS[entity], bad, detail)

    def inside(column, allowed):
        return f"{column} not in ({', '.join(repr(v) for v in allowed)})"

    out: list[Rule] = [check(f"domain:{c}", t, inside(c, allowed), c) for t, c, allowed in DOMAIN_RULES]
    for t, cols in NOT_NULL_RULES.items():
        first_null = ", ".join(f"case when {c} is null then '{c}' end" for c in cols)
        out.append(check("not_null", t, " or ".join(f"{c} is null" for c in cols), f"coalesce({first_null})"))
    out += [check("amount_positive", "entries", "amount <= 0", "amount"),
            check("rate_positive", "exchange_rates", "rate <= 0", "rate"),
            check("rate_distinct_pair", "exchange_rates", "base_currency_id = currency_id", "currency_id"),
            Balanced("zero_sum", "transactions", "entries", ("transaction_id", "currency")),
            Reference("currency_fk", "entries", "entries", "entry_id", ("wallet_id", "currency"), "wallets", ("wallet_id", "currency")),
            Cached("balance_drift", "wallets", "wallets", "wallet_id", "balance", "posted")]
    out += [Reference("fk", f"{t}.{c}", t, key, (c,), parent, (pc,)) for t, key, c, parent, pc in FOREIGN_KEYS]
    return out + [Unique(f"{t}.{name}", t, cols) for t, name, cols in UNIQUE_KEYS]


def violations_all(L) -> DataFrame:
    """INT-9 / SET-2: every rule's violations, one row per (rule, key); each table is read once, all rules share one
    aggregate, and rows are read again only where a group shows that they refer to a missing key."""
    return violations({"accounts": L.accounts, "wallets": L.wallets, "transactions": L.transactions,
                       "entries": L.entries_staged, "posted": L.entries, "audit_logs": L.audit_logs,
                       "settlement_batches": L.settlement_batches, "exchange_rates": L.exchange_rates,
                       "currencies": L.currencies, "idempotency_keys": L.idempotency_requests}, rule_set())


# ---- snapshots -----------------------------------------------------------------

def immutability_audit(old: DataFrame, new: DataFrame, key: str = "entry_id") -> DataFrame:
    """INT-7 / JOIN-13: rows deleted, added or changed between two snapshots (null-safe compare)."""
    cols = [c for c in old.columns if c != key and c in new.columns]
    o = old.select(key, *[F.col(c).alias(f"o_{c}") for c in cols], F.lit(True).alias("_in_old"))
    n = new.select(key, *[F.col(c).alias(f"n_{c}") for c in cols], F.lit(True).alias("_in_new"))
    changed = reduce(lambda a, b: a | b, [~F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}")) for c in cols])
    kind = (F.when(F.col("_in_new").isNull(), "DELETED").when(F.col("_in_old").isNull(), "ADDED")
            .when(changed, "UPDATED"))
    diff_cols = F.concat_ws(",", *[F.when(~F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}")), F.lit(c)) for c in cols])
    return (o.join(n, key, "full_outer")
            .select(key, kind.alias("change"), diff_cols.alias("changed_columns"),
                    F.col("o_amount").alias("old_amount"), F.col("n_amount").alias("new_amount"))
            .filter(F.col("change").isNotNull())
            .withColumn("changed_columns", F.when(F.col("change") == "UPDATED", F.col("changed_columns"))))
