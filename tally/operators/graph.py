"""Graph queries over the ledger projection: cycles, components, degrees.

All work is joins and aggregates on edge DataFrames.  Iterative steps cut
their lineage with ``checkpoint()`` (reliable, into ``spark.checkpoint.dir``)
so a lost executor recomputes one round, not the whole history.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tally.functions.columns import MONEY
from tally.functions.skew import hot_keys_of, join_back, join_beside, together
from tally.session import shared_dir


def _cut(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# ---- cycles (GR-2) -----------------------------------------------------------------

def ledger_edges(entries: DataFrame, transactions: DataFrame, wallets: DataFrame, accounts: DataFrame) -> DataFrame:
    """GR-1: one payer -> payee edge per transaction, out of its legs.

    Legs take their account through the wallet (those of hot platform wallets
    where they lie), and what each adds is shuffled once to its transaction: the
    largest customer debit pays; the largest customer credit of another account
    is paid, in whatever currency it arrives behind the FX wallets; the amount
    is what left the payer in its own currency without the revenue legs.
    Transactions without both ends (merchant payments) and reversed ones give
    no edge.
    """
    owner = (wallets.select("wallet_id", "account_id").join(accounts.select("account_id", F.col("type").alias("account_type")), "account_id"))
    named = entries.where("transaction_id is not null").select("transaction_id", "wallet_id", "type", "amount", "currency", "created_at")
    legs = join_beside(named, owner, ["wallet_id"])
    customer = F.col("account_type") == "CUSTOMER"
    role = (F.when(customer & (F.col("type") == "DEBIT"), "paid").when(customer & (F.col("type") == "CREDIT"), "got")
            .when((F.col("account_type") == "PLATFORM_REVENUE") & (F.col("type") == "CREDIT"), "fee"))
    legs = (legs.select("transaction_id", "created_at", "currency", "amount", "account_id", role.alias("role"))
            .select("transaction_id", "created_at", "role", *[F.when(F.col("role").isNotNull(), F.col(c)).alias(c) for c in ("currency", "amount")],
                    F.when(F.col("role") != "fee", F.col("account_id")).alias("account_id")))
    hot, n = hot_keys_of(named, ["transaction_id"])
    if not hot:                                         # else its legs are combined per task first
        legs = together(legs, "transaction_id", n)
    largest, fee = F.struct("amount", "account_id"), F.col("role") == "fee"
    per_ccy = legs.groupBy("transaction_id", "currency").agg(
        *[F.max(F.when(F.col("role") == r, largest)).alias(r) for r in ("paid", "got")],
        # a fee of no amount makes the sum unknown
        F.when(~F.coalesce(F.bool_or(fee & F.col("amount").isNull()), F.lit(False)),
               F.coalesce(F.sum(F.when(fee, F.col("amount"))), F.lit(0)).cast("decimal(38,4)")).alias("fees"),
        F.min("created_at").alias("transferred_at"))
    own_fees = F.when(F.col("currency").isNull(), F.lit(0).cast("decimal(38,4)")).otherwise(F.col("fees"))
    per = per_ccy.groupBy("transaction_id").agg(
        F.max(F.when(F.col("paid").isNotNull(), F.struct("paid.amount", "paid.account_id", "currency", own_fees.alias("fees")))).alias("paid"),
        F.max(F.when(F.col("got").isNotNull(), F.struct("got.amount", "got.account_id", "currency"))).alias("got"),
        F.min("transferred_at").alias("transferred_at"))
    live = transactions.filter(F.col("status") != "REVERSED").select("transaction_id")
    return (per.filter(F.col("paid").isNotNull() & F.col("got").isNotNull() & (F.col("paid.account_id") != F.col("got.account_id")))
            .join(live, "transaction_id", "left_semi")
            .select(F.col("transaction_id").alias("txn_id"), F.col("paid.account_id").alias("src"), F.col("got.account_id").alias("dst"),
                    "transferred_at", (F.col("paid.amount") - F.col("paid.fees")).cast(MONEY).alias("amount"),
                    F.col("paid.currency").alias("currency")))


def trim_to_cycle_candidates(edges: DataFrame, rounds: int = 3) -> DataFrame:
    """Drop edges that cannot lie on a cycle: the source needs an incoming and the target an
    outgoing edge.  A few rounds shrink chains; the result never loses a cycle."""
    e = edges
    for _ in range(rounds):
        has_in = e.select(F.col("dst").alias("src")).distinct()
        has_out = e.select(F.col("src").alias("dst")).distinct()
        e = e.join(has_in, "src", "left_semi").join(has_out, "dst", "left_semi")
    return e


def _half_paths(e: DataFrame, hops: int, ratio: Decimal | None) -> dict[int, DataFrame]:
    """Walks of 1 to ``hops`` edges, each edge once, every hop at least ``ratio`` x the one before; stored per length."""
    step = e.select(F.col("src").alias("end"), F.col("txn_id").alias("nx_txn"), F.col("dst").alias("nx_dst"),
                    F.col("amount").alias("nx_amount"))
    paths = {1: e.select(F.col("src").alias("start"), F.col("dst").alias("end"), F.array("txn_id").alias("edge_ids"),
                         F.array("src", "dst").alias("nodes"), F.col("amount").alias("first_amount"),
                         F.col("amount").alias("last_amount"), F.col("amount").cast("decimal(38,4)").alias("volume"))}
    for hop in range(2, hops + 1):
        cond = ~F.array_contains("edge_ids", F.col("nx_txn"))
        if ratio is not None:
            cond = cond & (F.col("nx_amount") >= F.lit(ratio) * F.col("last_amount"))
        paths[hop] = _cut(paths[hop - 1].join(step, "end").filter(cond)
                          .select("start", F.col("nx_dst").alias("end"),
                                  F.array_append("edge_ids", F.col("nx_txn")).alias("edge_ids"),
                                  F.array_append("nodes", F.col("nx_dst")).alias("nodes"), "first_amount",
                                  F.col("nx_amount").alias("last_amount"),
                                  (F.col("volume") + F.col("nx_amount")).cast("decimal(38,4)").alias("volume")))
    return paths


def find_cycles(edges: DataFrame, since=None, min_hops: int = 2, max_hops: int = 6,
                ratio: Decimal | None = Decimal("0.80"), strong: bool = False) -> DataFrame:
    """Closed walks seed -> ... -> seed of ``min_hops..max_hops`` edges, each edge used once per walk
    (nodes may repeat), every hop at least ``ratio`` x the previous hop's amount.

    Each rotation is its own row (the seed is the start node).  The search
    meets in the middle: only walks of up to half the hops are grown and
    stored; a cycle of h hops is a walk of ceil(h / 2) edges and one of the rest
    that leads back, found by one equi-join on both ends, with the edges of the
    two disjoint and the ratio held where they meet.  Open walks of more than
    half the hops never exist, and the closing joins are not written.
    ``strong``: search only inside strongly connected components (worth its
    rounds where most of what trimming leaves lies between components).
    """
    e = edges
    if since is not None:
        e = e.filter(F.col("transferred_at") >= F.lit(since))
    e = e.select("txn_id", "src", "dst", "amount")
    e = strong_core(e) if strong else _cut(trim_to_cycle_candidates(e))
    paths = _half_paths(e, (max_hops + 1) // 2, ratio)
    found = []
    for hops in range(max(min_hops, 2), max_hops + 1):
        there, back = paths[(hops + 1) // 2], paths[hops // 2]
        b = back.select(F.col("start").alias("end"), F.col("end").alias("start"), F.col("edge_ids").alias("b_edges"),
                        F.col("nodes").alias("b_nodes"), F.col("first_amount").alias("b_first"), F.col("volume").alias("b_volume"))
        cond = ~F.arrays_overlap("edge_ids", "b_edges")
        if ratio is not None:
            cond = cond & (F.col("b_first") >= F.lit(ratio) * F.col("last_amount"))
        found.append(there.join(b, ["start", "end"]).filter(cond).select(
            F.col("start").alias("ring_seed"),
            F.concat_ws(">", F.concat("nodes", F.slice("b_nodes", 2, hops))).alias("accounts_in_ring"),
            F.concat_ws(",", F.concat("edge_ids", "b_edges")).alias("edge_list"),
            (F.col("volume") + F.col("b_volume")).cast("decimal(38,4)").alias("cycle_volume"),
            F.lit(hops).cast("bigint").alias("hops")))
    if min_hops <= 1:
        loops = paths[1].filter(F.col("start") == F.col("end"))
        found.append(loops.select(F.col("start").alias("ring_seed"), F.concat_ws(">", "nodes").alias("accounts_in_ring"),
                                  F.concat_ws(",", "edge_ids").alias("edge_list"), F.col("volume").alias("cycle_volume"),
                                  F.lit(1).cast("bigint").alias("hops")))
    return reduce(DataFrame.unionByName, found)


def strong_core(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """The edges inside strongly connected components (self loops included).

    Forward reach: every node takes the smallest name among the nodes that
    reach it, by rounds of one join and one aggregate over the different (src,
    dst) pairs; the nodes of a component end with one name, so a pair whose
    ends differ is on no cycle and goes.  Backward reach does the same against
    the arrows.  Both repeat until no pair falls.  Where a reach is not settled
    after ``max_rounds`` rounds its names are not used: fewer edges go then,
    and none that is on a cycle.
    """
    pairs = _cut(trim_to_cycle_candidates(edges.select("src", "dst").distinct()))
    left = pairs.count()
    while left:
        before = left
        for a, b in (("src", "dst"), ("dst", "src")):
            names = _least_reaching(pairs, a, b, max_rounds)
            if names is not None:
                pairs = _cut(pairs.join(names.select(F.col("node").alias("src"), F.col("name").alias("_s")), "src")
                             .join(names.select(F.col("node").alias("dst"), F.col("name").alias("_d")), "dst")
                             .filter(F.col("_s") == F.col("_d")).select("src", "dst"))
        left = pairs.count()
        if left == before:
            break
    return _cut(edges.join(pairs, ["src", "dst"], "left_semi").select(*edges.columns))


def _least_reaching(pairs: DataFrame, a: str, b: str, max_rounds: int) -> DataFrame | None:
    """(node, name): the smallest node that reaches each along a -> b; None if it did not settle."""
    nodes = pairs.select(F.col("src").alias("node")).union(pairs.select(F.col("dst").alias("node"))).distinct()
    names = _cut(nodes.withColumn("name", F.col("node")))
    for _ in range(max_rounds):
        told = (pairs.join(names.select(F.col("node").alias(a), "name"), a)
                .groupBy(F.col(b).alias("node")).agg(F.min("name").alias("_told")))
        new = _cut(names.join(told, "node", "left")
                   .select("node", F.least("name", "_told").alias("name"), (F.col("_told") < F.col("name")).alias("moved")))
        settled = new.filter("moved").isEmpty()
        names = new.select("node", "name")
        if settled:
            return names
    return None


def top_rings(cycles: DataFrame, n: int = 50) -> DataFrame:
    """SORT-1: the n largest cycles by volume with a total tie-break (TakeOrderedAndProject)."""
    return (cycles.orderBy(F.col("cycle_volume").desc(), "ring_seed", "accounts_in_ring", "edge_list")
            .limit(n).drop("edge_list"))


# ---- connected components (GR-3, GR-4) ----------------------------------------------

def _canonical(edges: DataFrame) -> DataFrame:
    """Undirected edges as (a, b) with a > b, no self loops, no duplicates."""
    return (edges.select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b"))
            .filter(F.col("a") != F.col("b")).distinct())


def _large_star(E: DataFrame) -> DataFrame:
    # m(u) = min(u, neighbours of u); every larger neighbour v of u is re-attached to m(u)
    m = E.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    return (E.join(m, E.b == m.u, "left")
            .select("a", F.coalesce(F.col("m"), F.col("b")).alias("b")).distinct())


def _small_star(E: DataFrame) -> DataFrame:
    # m(u) = min of u's smaller neighbours; u and those neighbours are attached to m(u)
    m = E.groupBy("a").agg(F.min("b").alias("m"))
    return (E.join(m, "a")
            .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                    F.col("m").alias("b"))
            .distinct())


def connected_components(vertices: DataFrame, edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Weakly connected components: (id, component) with component = smallest id in it.

    Alternating large-star / small-star (Kiveris et al., SoCC 2014): every
    round is two aggregations and two joins on the edge list, with no
    per-component collection, so a giant component is as parallel as the
    edges it has.  Rounds stop when small-star leaves the edge set unchanged.
    """
    E = _cut(_canonical(edges))
    for _ in range(max_rounds):
        L_ = _large_star(E)
        S_ = _cut(_small_star(L_))
        changed = (S_.join(E, ["a", "b"], "left_anti").limit(1).count()
                   + E.join(S_, ["a", "b"], "left_anti").limit(1).count())
        E = S_
        if not changed:
            break
    else:
        raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
    labels = E.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = E.select(F.col("b").alias("id"), F.col("b").alias("component"))
    lab = labels.unionByName(roots).distinct()
    return (vertices.select("id").distinct().join(lab, "id", "left")
            .select("id", F.coalesce("component", "id").alias("component")))


def component_summary(labels: DataFrame, prefix: str = "C", sample: int = 10) -> DataFrame:
    """Size and the ``sample`` smallest members of every component.

    ``row_number() <= sample`` plans a partial per-group limit before the
    shuffle, so even a giant component sends only a few rows per task.
    """
    sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("cluster_size"))
    w = Window.partitionBy("component").orderBy("id")
    firsts = (labels.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= sample)
              .groupBy("component")
              .agg(F.sort_array(F.collect_list(F.struct("rn", "id"))).alias("s")))
    return (sizes.join(firsts, "component")
            .select(F.concat(F.lit(prefix), F.col("component")).alias("component_id"), "component",
                    "cluster_size",
                    F.concat_ws(",", F.transform("s", lambda x: F.concat(F.lit(prefix), x["id"].cast("string"))))
                    .alias("sample_accounts")))


def top_clusters(summary: DataFrame, n: int = 20) -> DataFrame:
    """SORT-2: the n largest components, ties by smallest member."""
    return summary.orderBy(F.col("cluster_size").desc(), "component").limit(n).drop("component")


def key_of(col: str, prefix: str = "C") -> F.Column:
    return F.substring(F.col(col), len(prefix) + 1, 40).cast("bigint")


def star_edges(members: DataFrame, group_col: str) -> DataFrame:
    """Bipartite account -> group as star edges to the group's smallest member (not all pairs)."""
    m = members.groupBy(group_col).agg(F.min("id").alias("root"))
    return join_back(members, m, [group_col], spread=["id"]).select(F.col("id").alias("src"), F.col("root").alias("dst"))


# ---- degrees and lookups (GR-5, GR-6) ---------------------------------------------

def degrees(edges: DataFrame) -> DataFrame:
    """GR-6: out- and in-degree and volume per account (both directions, partial aggregates)."""
    out = edges.groupBy(F.col("src").alias("account_id")).agg(
        F.count(F.lit(1)).alias("out_degree"), F.sum("amount").cast("decimal(38,4)").alias("out_volume"))
    inn = edges.groupBy(F.col("dst").alias("account_id")).agg(
        F.count(F.lit(1)).alias("in_degree"), F.sum("amount").cast("decimal(38,4)").alias("in_volume"))
    return (out.join(inn, "account_id", "full_outer")
            .select("account_id", F.coalesce("out_degree", F.lit(0)).alias("out_degree"),
                    F.coalesce("in_degree", F.lit(0)).alias("in_degree"),
                    (F.coalesce("out_degree", F.lit(0)) + F.coalesce("in_degree", F.lit(0))).alias("degree"),
                    F.coalesce("out_volume", F.lit(0)).cast("decimal(38,4)").alias("out_volume"),
                    F.coalesce("in_volume", F.lit(0)).cast("decimal(38,4)").alias("in_volume")))


def account_transfers(edges: DataFrame, account_id: str) -> DataFrame:
    """GR-5: one-hop lookup -- every transfer into or out of one account (a filter, not a traversal)."""
    return (edges.filter((F.col("src") == account_id) | (F.col("dst") == account_id))
            .select("txn_id", "src", "dst", "transferred_at", "amount", "currency",
                    F.when(F.col("src") == account_id, "out").otherwise("in").alias("direction")))
