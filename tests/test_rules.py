"""The compiled rules against each rule on its own, over tables with every kind of fault."""

import datetime as dt
from decimal import Decimal

import pytest

from tally.operators import integrity as I
from tally.operators import rules as R
from tally.sources.fixtures import Ledger
from tests.conftest import SF_SMALL

AT = dt.datetime(1998, 1, 1)


def _rows(df):
    return sorted(tuple(map(str, r)) for r in df.select("rule", "entity", "entity_key", "detail").collect())


@pytest.fixture(scope="module")
def tables(spark):
    entry = "entry_id string, transaction_id string, wallet_id string, type string, amount decimal(19,4), currency string, created_at timestamp"
    m = Decimal
    legs = [("e1", "t1", "w1", "DEBIT", m(5), "EUR", AT), ("e2", "t1", "w2", "CREDIT", m(5), "EUR", AT),
            ("e3", "t2", "w1", "DEBIT", m(7), "EUR", AT), ("e4", "t2", "w9", "CREDIT", m(6), "EUR", AT),
            ("e4", "t2", "w2", "ODD", m(-1), "EUR", AT), ("e5", "t8", "w1", "CREDIT", m(0), None, AT),
            (None, "t8", None, None, None, "EUR", None), (None, "t8", None, None, None, "EUR", None)]
    return {"entries": spark.createDataFrame(legs, entry), "posted": spark.createDataFrame(legs[:4], entry),
            "wallets": spark.createDataFrame(
                [("w1", "EUR", m(-12)), ("w2", "EUR", m(6)), ("w3", "EUR", m(0)), ("w3", "EUR", m(2)), (None, "EUR", m(1))],
                "wallet_id string, currency string, balance decimal(38,4)"),
            "transactions": spark.createDataFrame([("t1", AT), ("t2", AT), ("t2", AT)],
                                                  "transaction_id string, created_at timestamp")}


RULES = [R.Check("positive", "entries", "entries", "entry_id", "amount <= 0", "amount"),
         R.Check("typed", "entries", "entries", "entry_id", "type is null", "'type'"),
         R.Unique("entries.pkey", "entries", ("entry_id", "created_at")),
         R.Unique("wallets.pkey", "wallets", ("wallet_id",)),
         R.Unique("transactions.pkey", "transactions", ("transaction_id",)),
         R.Reference("fk", "entries.transaction_id", "entries", "entry_id", ("transaction_id",), "transactions", ("transaction_id",)),
         R.Reference("fk", "entries.wallet", "entries", "entry_id", ("wallet_id", "currency"), "wallets", ("wallet_id", "currency")),
         R.Balanced("zero_sum", "transactions", "entries", ("transaction_id", "currency")),
         R.Cached("drift", "wallets", "wallets", "wallet_id", "balance", "posted")]

EXPECTED = sorted([
    ("positive", "entries", "e4", "-1.0000"), ("positive", "entries", "e5", "0.0000"),
    ("typed", "entries", "None", "type"), ("typed", "entries", "None", "type"),
    ("unique", "entries.pkey", "e4|1998-01-01 00:00:00", "2"), ("unique", "entries.pkey", "", "2"),
    ("unique", "wallets.pkey", "w3", "2"), ("unique", "transactions.pkey", "t2", "2"),
    ("fk", "entries.transaction_id", "e5", "t8"), ("fk", "entries.transaction_id", "None", "t8"),
    ("fk", "entries.transaction_id", "None", "t8"), ("fk", "entries.wallet", "e4", "w9|EUR"),
    ("zero_sum", "transactions", "t2|EUR", "7.0000/6.0000"),
    ("drift", "wallets", "w2", "1.0000"), ("drift", "wallets", "w3", "2.0000"), ("drift", "wallets", "None", "1.0000")])


def test_every_kind_of_rule(tables):
    assert _rows(R.violations(tables, RULES)) == EXPECTED


def test_many_broken_keys_and_repeats_give_the_same(tables, monkeypatch):
    monkeypatch.setattr(R, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(R, "REPEATS", 1)
    assert _rows(R.violations(tables, RULES)) == EXPECTED


def test_bitmaps_let_through_what_is_broken_and_little_else(spark):
    rows = spark.range(3000).selectExpr("concat('e', id) as _child", "concat('k', id) as k1", "if(id % 2 = 0, 'EUR', null) as k2",
                                        "cast(null as string) as k3", "if(id % 3 = 0, timestamp'1998-01-01', null) as at")
    broken = rows.where("_child like 'e1%'").drop("_child")
    found = {r[0] for r in R._maybe(rows, broken).select("_child").collect()}
    wanted = {f"e{i}" for i in range(3000) if str(i)[0] == "1"}
    assert wanted <= found and len(found) < len(wanted) + 10
    assert {r[0] for r in R._again(rows, broken, R.BROADCAST_KEYS + 1, "left_semi").select("_child").collect()} == wanted


def test_tasks_stay_small_as_legs_grow(spark, tables, monkeypatch):
    """Files are read in splits, and groups meet in as many partitions as the legs ask for."""
    DataFrame = type(tables["entries"])
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"]
    before, seen, kept = [spark.conf.get(n) for n in names], [], DataFrame.checkpoint

    def checkpoint(df, **how):
        seen.append([int(spark.conf.get(n)) for n in names])
        return kept(df, **how)
    monkeypatch.setattr(DataFrame, "checkpoint", checkpoint)
    monkeypatch.setattr(R, "SUM_LEGS", 0.1)
    assert _rows(R.violations(tables, RULES)) == EXPECTED
    assert seen == [[R.SPLIT_BYTES, R.SUM_BYTES, 80]]
    assert [spark.conf.get(n) for n in names] == before


def test_extra_columns_do_not_clash(spark, tables):
    more = {n: df.selectExpr("*", *[f"'x' as {c}" for c in ("space", "k1", "own", "t", "_child", "_cached") if c not in df.columns])
            for n, df in tables.items()}
    assert _rows(R.violations(more, RULES)) == EXPECTED


def test_empty_tables_break_nothing(tables):
    assert _rows(R.violations({n: df.limit(0) for n, df in tables.items()}, RULES)) == []


def test_ledger_rules_equal_the_single_jobs(spark):
    L = Ledger(spark, SF_SMALL)
    got = _rows(I.violations_all(L))
    single = I.fk_orphans(L).selectExpr("'fk' as rule", "fk as entity", "child_key as entity_key", "parent_key as detail")
    single = single.unionByName(I.duplicate_keys(L).selectExpr(
        "'unique' as rule", "constraint_name as entity", "key as entity_key", "cast(n as string) as detail"))
    assert [r for r in got if r[0] in ("fk", "unique")] == _rows(single)


def test_every_table_is_scanned_once(spark, tables):
    compiled = R.Compiled(RULES)
    for name, df in tables.items():
        plan = compiled.of(name, df)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LogicalRDD") == 1 and plan.count("Generate") == 1
