"""Registered graph queries (GR-1..6, JOIN-9, SORT-1/2, AGG-11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tally import constants as K
from tally.operators import graph as G
from tally.plans.registry import query


@query("transfer_edges", """
    SELECT txn_id, src, dst, transferred_at, CAST(amount AS DOUBLE) AS amount, currency FROM transfer_edges""")
def _transfer_edges(L):
    """GR-1: payer -> payee account edges (legs collapsed), REVERSED excluded."""
    return L.transfer_edges


CYCLES_SQL = f"""
    WITH RECURSIVE e AS (SELECT txn_id, src, dst, amount FROM transfer_edges
                         WHERE transferred_at >= TIMESTAMP '{K.CYCLE_WINDOW_START}'),
    paths(seed, cur, edge_ids, nodes, last_amount, volume, hops) AS (
      SELECT src, dst, [txn_id], [src, dst], amount, CAST(amount AS DECIMAL(38,4)), 1 FROM e
      UNION ALL
      SELECT p.seed, e.dst, list_append(p.edge_ids, e.txn_id), list_append(p.nodes, e.dst), e.amount,
             CAST(p.volume + e.amount AS DECIMAL(38,4)), p.hops + 1
      FROM paths p JOIN e ON e.src = p.cur
      WHERE p.hops < {K.CYCLE_MAX_HOPS} AND NOT list_contains(p.edge_ids, e.txn_id) {{ratio}})
    SELECT seed AS ring_seed, array_to_string(nodes, '>') AS accounts_in_ring, CAST(volume AS DOUBLE) AS cycle_volume,
           CAST(hops AS BIGINT) AS hops
    FROM paths WHERE cur = seed AND hops >= {K.CYCLE_MIN_HOPS}"""


@query("fraud_rings", CYCLES_SQL.format(ratio=f"AND e.amount >= {K.CYCLE_RATIO} * p.last_amount") + """
    ORDER BY volume DESC, ring_seed, accounts_in_ring, array_to_string(edge_ids, ',') LIMIT 50""")
def _fraud_rings(L):
    """GR-2 / JOIN-9 / SORT-1: top 50 transfer cycles of 2-6 hops, each hop >= 0.80 x the previous."""
    cycles = G.find_cycles(L.transfer_edges, since=K.CYCLE_WINDOW_START, min_hops=K.CYCLE_MIN_HOPS,
                           max_hops=K.CYCLE_MAX_HOPS, ratio=K.CYCLE_RATIO)
    return G.top_rings(cycles, K.CYCLE_TOP)


@query("transfer_cycles", CYCLES_SQL.format(ratio=""))
def _transfer_cycles(L):
    """GR-2 without the ratio rule: every 2-6 hop cycle (no limit)."""
    return G.find_cycles(L.transfer_edges, since=K.CYCLE_WINDOW_START, min_hops=K.CYCLE_MIN_HOPS,
                         max_hops=K.CYCLE_MAX_HOPS, ratio=None).drop("edge_list")


def _wcc_sql(vertices: str, edges: str) -> str:
    return f"""
    WITH RECURSIVE v AS ({vertices}), und AS (SELECT src AS a, dst AS b FROM ({edges}) UNION SELECT dst, src FROM ({edges})),
    reach(node, label) AS (SELECT id, id FROM v UNION SELECT u.b, r.label FROM reach r JOIN und u ON u.a = r.node),
    lab AS (SELECT node AS id, min(label) AS component FROM reach GROUP BY node)"""


REF_V = "SELECT c_custkey AS id FROM customer"
REF_E = ("SELECT CAST(substr(src, 2) AS BIGINT) AS src, CAST(substr(dst, 2) AS BIGINT) AS dst "
         "FROM referral_edges")


@query("referral_clusters", _wcc_sql(REF_V, REF_E) + f"""
    SELECT 'C' || component AS component_id, COUNT(*) AS cluster_size,
           string_agg('C' || id, ',' ORDER BY id) FILTER (WHERE rn <= {K.CLUSTER_SAMPLE}) AS sample_accounts
    FROM (SELECT *, row_number() OVER (PARTITION BY component ORDER BY id) AS rn FROM lab)
    GROUP BY component ORDER BY cluster_size DESC, component LIMIT {K.CLUSTER_TOP}""")
def _referral_clusters(L):
    """GR-3 / AGG-11 / SORT-2: top 20 referral communities (WCC) with a 10-member sample."""
    v = L.raw("customer").select(F.col("c_custkey").alias("id"))
    e = L.referral_edges.select(G.key_of("src").alias("src"), G.key_of("dst").alias("dst"))
    labels = G.connected_components(v, e)
    return G.top_clusters(G.component_summary(labels, sample=K.CLUSTER_SAMPLE), K.CLUSTER_TOP)


@query("referral_components", _wcc_sql(REF_V, REF_E) + """
    SELECT 'C' || id AS account_id, 'C' || component AS component_id FROM lab""")
def _referral_components(L):
    """GR-3: component label of every account, isolated accounts included."""
    v = L.raw("customer").select(F.col("c_custkey").alias("id"))
    e = L.referral_edges.select(G.key_of("src").alias("src"), G.key_of("dst").alias("dst"))
    return (G.connected_components(v, e)
            .select(F.concat(F.lit("C"), "id").alias("account_id"),
                    F.concat(F.lit("C"), "component").alias("component_id")))


ID_V = "SELECT CAST(substr(account_id, 2) AS BIGINT) AS id FROM account_identity"
ID_E = """
    SELECT i.id AS src, m.root AS dst FROM
      (SELECT CAST(substr(account_id, 2) AS BIGINT) AS id, card FROM account_identity) i
      JOIN (SELECT card, min(CAST(substr(account_id, 2) AS BIGINT)) AS root FROM account_identity GROUP BY card) m
      ON m.card = i.card
    UNION ALL
    SELECT i.id, m.root FROM
      (SELECT CAST(substr(account_id, 2) AS BIGINT) AS id, device FROM account_identity) i
      JOIN (SELECT device, min(CAST(substr(account_id, 2) AS BIGINT)) AS root FROM account_identity GROUP BY device) m
      ON m.device = i.device"""


@query("shared_identity_rings", _wcc_sql(ID_V, ID_E) + """
    SELECT 'C' || id AS account_id, 'C' || component AS ring_id,
           COUNT(*) OVER (PARTITION BY component) AS ring_size
    FROM lab""")
def _shared_identity_rings(L):
    """GR-4: accounts linked by a shared card or device, as components (star edges, not all pairs)."""
    ident = L.account_identity.select(G.key_of("account_id").alias("id"), "card", "device")
    e = G.star_edges(ident, "card").unionByName(G.star_edges(ident, "device"))
    labels = G.connected_components(ident.select("id"), e)
    sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("ring_size"))
    return (labels.join(sizes, "component")
            .select(F.concat(F.lit("C"), "id").alias("account_id"), F.concat(F.lit("C"), "component").alias("ring_id"),
                    "ring_size"))


@query("supernodes", """
    SELECT account_id, COALESCE(o.n, 0) AS out_degree, COALESCE(i.n, 0) AS in_degree,
           COALESCE(o.n, 0) + COALESCE(i.n, 0) AS degree,
           CAST(COALESCE(o.v, 0) AS DOUBLE) AS out_volume, CAST(COALESCE(i.v, 0) AS DOUBLE) AS in_volume
    FROM (SELECT src AS account_id, COUNT(*) AS n, SUM(amount) AS v FROM transfer_edges GROUP BY src) o
    FULL OUTER JOIN (SELECT dst AS account_id, COUNT(*) AS n, SUM(amount) AS v FROM transfer_edges GROUP BY dst) i
    USING (account_id)""")
def _supernodes(L):
    """GR-6: degree report in both directions."""
    return G.degrees(L.transfer_edges)


@query("account_transfers", """
    WITH d AS (SELECT account_id, COUNT(*) AS n FROM (SELECT src AS account_id FROM transfer_edges
                                                      UNION ALL SELECT dst FROM transfer_edges) GROUP BY 1),
         top AS (SELECT account_id FROM d ORDER BY n DESC, account_id LIMIT 1)
    SELECT txn_id, src, dst, transferred_at, CAST(amount AS DOUBLE) AS amount, currency,
           CASE WHEN src = (SELECT account_id FROM top) THEN 'out' ELSE 'in' END AS direction
    FROM transfer_edges WHERE src = (SELECT account_id FROM top) OR dst = (SELECT account_id FROM top)""")
def _account_transfers(L):
    """GR-5: one-hop lookup of the busiest account."""
    d = G.degrees(L.transfer_edges)
    busiest = d.orderBy(F.col("degree").desc(), "account_id").select("account_id").first()[0]
    return G.account_transfers(L.transfer_edges, busiest)
