"""Edges out of hand-made legs, cycles against plain enumeration, strong cores."""

import datetime as dt
import random
from decimal import Decimal as D
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.operators import graph as G

TS = dt.datetime(2026, 6, 15)


def test_ledger_edges_pair_the_ends_of_a_transaction(spark):
    wallets = spark.createDataFrame([("wa", "A"), ("wb", "B"), ("wm", "M"), ("rev", "R"), ("fxv", "X"), ("fxu", "X")],
                                    "wallet_id string, account_id string")
    accounts = spark.createDataFrame([("A", "CUSTOMER"), ("B", "CUSTOMER"), ("M", "MERCHANT_PAYABLE"), ("R", "PLATFORM_REVENUE"),
                                      ("X", "FX_POSITION")], "account_id string, type string")
    legs = [("t1", "wa", "DEBIT", "101", "VND"), ("t1", "wb", "CREDIT", "100", "VND"), ("t1", "rev", "CREDIT", "1", "VND"),
            ("t2", "wa", "DEBIT", "27500", "VND"), ("t2", "rev", "CREDIT", "500", "VND"), ("t2", "fxv", "CREDIT", "27000", "VND"),
            ("t2", "fxu", "DEBIT", "1", "USD"), ("t2", "wb", "CREDIT", "1", "USD"),
            ("t3", "wa", "DEBIT", "5", "VND"), ("t3", "wm", "CREDIT", "5", "VND"),              # to a merchant
            ("t4", "wb", "DEBIT", "7", "VND"), ("t4", "wa", "CREDIT", "7", "VND"),              # reversed
            ("t5", "wb", "DEBIT", "9", "VND"), ("t5", "wb", "CREDIT", "9", "VND")]              # to itself
    e = spark.createDataFrame([(t, f"{t}-{i}", w, k, D(a), c, TS) for i, (t, w, k, a, c) in enumerate(legs)],
                              "transaction_id string, entry_id string, wallet_id string, type string, amount decimal(19,4), "
                              "currency string, created_at timestamp")
    heads = spark.createDataFrame([(f"t{i}", "REVERSED" if i == 4 else "SETTLED") for i in range(1, 6)],
                                  "transaction_id string, status string")
    # few legs: every transaction is hot; many copies of t1 under other names: none is
    more = reduce(DataFrame.unionByName, [e.where("transaction_id = 't1'").withColumn("transaction_id", F.lit(f"u{i}")) for i in range(40)])
    for staged in (e, e.unionByName(more)):
        got = sorted(tuple(r) for r in G.ledger_edges(staged, heads, wallets, accounts).collect())
        assert got == [("t1", "A", "B", TS, D("100"), "VND"), ("t2", "A", "B", TS, D("27000"), "VND")]


def _edges(seed, nodes, n):
    rnd = random.Random(seed)
    return [(f"e{i:02d}", f"n{rnd.randrange(nodes)}", f"n{rnd.randrange(nodes)}", D(rnd.randint(50, 100))) for i in range(n)]


def _closed_walks(edges, ratio, most):
    out = []

    def walk(seed, path):
        if len(path) >= 2 and path[-1][2] == seed:
            out.append((seed, ",".join(e[0] for e in path), sum(e[3] for e in path)))
        if len(path) < most:
            for e in edges:
                if e[1] == path[-1][2] and e not in path and (ratio is None or e[3] >= ratio * path[-1][3]):
                    walk(seed, [*path, e])
    for e in edges:
        walk(e[1], [e])
    return sorted(out)


@pytest.mark.parametrize("ratio,most", [(None, 6), (D("0.80"), 5)])
def test_cycles_against_enumeration(spark, ratio, most):
    edges = _edges(3, 6, 13)
    df = spark.createDataFrame(edges, "txn_id string, src string, dst string, amount decimal(19,4)")
    got = sorted((r["ring_seed"], r["edge_list"], r["cycle_volume"]) for r in G.find_cycles(df, max_hops=most, ratio=ratio).collect())
    assert got == _closed_walks(edges, ratio, most) and got


def test_strong_core(spark):
    # two cycles with a bridge between them, a tail on either side, a self loop
    arcs = ["ab", "bc", "ca", "cd", "de", "ed", "xa", "ey", "zz"]
    df = spark.createDataFrame([(f"e{i}", s, d) for i, (s, d) in enumerate(arcs)], "txn_id string, src string, dst string")
    core = {r["src"] + r["dst"] for r in G.strong_core(df).collect()}
    assert core == {"ab", "bc", "ca", "de", "ed", "zz"}
    kept = {r["src"] + r["dst"] for r in G.strong_core(df, max_rounds=1).collect()}
    assert core <= kept                                          # reaches that did not settle drop nothing on a cycle
    assert G.strong_core(df.filter(F.col("src") > "zzz")).count() == 0
