"""Embedding near-dedup: a robust-pruned flat graph per cluster shard, searched by range.

Vectors are compared within a label.  Equal vectors are one node.  Labels of
more than ``SHARD`` nodes are cut into clusters (centroids of a sample of at
most ``SAMPLE`` nodes); every node is a member of its ``OVERLAP`` nearest
clusters, so shards overlap, and a shard above twice the aim is split into
blocks by hash.  Each block gets a graph: candidates (nearest and random
members) pruned robustly to ``DEGREE`` edges, reverse edges added, and members
that the medoid cannot reach attached.  The adjacency lists of a node from all
its blocks are united.  Every node then searches all blocks of its nearest
cluster: greedily from the medoid with a beam, and from what it finds in range
on to all in range (past a beam full of them by comparing the whole block),
counting exact cosines in double precision.  Links between
nodes of two nearest clusters are found over the border: a node can only be
linked into clusters whose border (where both centroids are equally near) the
threshold's angle reaches.  Clusters are taken together in regions of about
``REGION`` nodes; a node asks the regions of such clusters, one region of each
two the other, where it is compared with all nodes at home, and a link counts
for both ends.  A search gives the number of links and a spanning forest, never the
pairs.  ``audit`` measures recall against brute force.

Nulls and edge cases: vectors that are null, empty, zero or hold a null or
non-finite component, and rows without label, link with nothing; vectors of
different lengths never link; equal vectors and repeated rows link with each
other; a null id names no component; an empty table gives an empty result.
Only the three named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.staging import stage, table
from tally.llm.vectors import matrix, rows_of, spherical_means
from tally.operators.graph import connected_components

THRESHOLD = 0.98
SHARD = 2000
SAMPLE = 40_000
OVERLAP = 3
DEGREE = 24
#: Nodes of one side of a border search.
REGION = 20_000
BEAM = 32
ALPHA = 1.2
NEAREST, RANDOM = 64, 32
#: What a node is in a cluster: at home in its nearest, a member of the next ones, or only asking over the border.
NEAR, MEMBER, ASKS = 0, 1, 2


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, v): unit vectors as float64 bytes, null where a vector takes no part."""
    for batch in batches:
        out = []
        for v, label in zip(rows_of(batch.column(2)), batch.column(1).to_pylist(), strict=True):
            if v is not None and label is not None:
                v = v / np.abs(v).max()
                out.append((v / np.sqrt(v @ v)).tobytes())
            else:
                out.append(None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                         names=["vec_id", "label", "v"])


def _placed(batches: Iterator[pa.RecordBatch], centres: dict, threshold: float, per: int) -> Iterator[pa.RecordBatch]:
    """(node, space, cluster, region, role, v, times): a row for each cluster that a node is a member of, and one for
    each region (``per`` clusters) that it must ask; an asking row has the node's nearest cluster."""
    reach = np.sqrt(1 - threshold ** 2) if threshold > 0 else np.inf
    lengths = {s: (own * own).sum(axis=1) for s, own in centres.items()}
    for batch in batches:
        nodes, blobs, times = batch.column(0).to_numpy(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
        rows: list[tuple] = []
        for k, space in enumerate(batch.column(1).to_pylist()):
            own = centres.get(space)
            if own is None:
                rows.append((nodes[k], space, 0, 0, NEAR, blobs[k], times[k]))
                continue
            sims = own @ np.frombuffer(blobs[k])
            order = np.argsort(-sims, kind="stable")[:OVERLAP]
            rows += [(nodes[k], space, int(c), int(c) // per, MEMBER if i else NEAR, blobs[k], times[k])
                     for i, c in enumerate(order)]
            # the home of a linked node: the border to it is no farther than the threshold's angle reaches
            first = int(order[0])
            apart = np.sqrt(np.maximum(lengths[space] + lengths[space][first] - 2 * (own @ own[first]), 0))
            near = (sims[first] - sims <= reach * apart + 1e-7) if threshold > 0 else np.ones(len(own), bool)
            near[first] = False
            mine = first // per
            for r in np.unique(np.flatnonzero(near) // per).tolist():
                if r == mine or (r > mine) ^ ((r + mine) % 2 == 1):  # one of two regions asks the other
                    rows.append((nodes[k], space, first, r, ASKS, blobs[k], times[k]))
        cols = list(zip(*rows, strict=True)) or [[]] * 7
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                         names=["node", "space", "cluster", "region", "role", "v", "times"])


def medoid(x: np.ndarray) -> int:
    return int(np.argmax(x @ x.mean(axis=0)))


def robust_graph(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> list[np.ndarray]:
    """Neighbours of each row of unit vectors: robust prune over near and random candidates, both directions."""
    n = len(x)
    if n == 1:
        return [np.zeros(0, np.int64)]
    near = min(NEAREST, n - 1)
    random = np.random.default_rng(11)
    candidates = np.empty((n, near + RANDOM), np.int64)
    sims = np.empty((n, near + RANDOM))
    for a in range(0, n, 512):
        z = min(n, a + 512)
        s = x[a:z] @ x.T
        s[np.arange(z - a), np.arange(a, z)] = -np.inf
        top = np.argpartition(-s, near - 1, axis=1)[:, :near]
        both = np.concatenate((top, random.integers(0, n, (z - a, RANDOM))), axis=1)
        value = np.take_along_axis(s, both, axis=1)
        order = np.argsort(-value, axis=1, kind="stable")
        candidates[a:z], sims[a:z] = np.take_along_axis(both, order, axis=1), np.take_along_axis(value, order, axis=1)
    alive = sims > -np.inf
    distance = np.arccos(np.clip(sims, -1, 1))
    edges: list[list[np.ndarray]] = []
    rows = np.arange(n)
    for _ in range(degree):
        first = alive.argmax(axis=1)
        some = np.flatnonzero(alive[rows, first])
        if not len(some):
            break
        chosen = candidates[some, first[some]]
        edges.append([some, chosen])
        for a in range(0, len(some), 256):  # candidates nearer to the chosen one than to the row go
            r, c = some[a:a + 256], chosen[a:a + 256]
            between = np.arccos(np.clip(np.einsum("rd,rkd->rk", x[c], x[candidates[r]]), -1, 1))
            alive[r] &= (alpha * between > distance[r]) & (candidates[r] != c[:, None])
    src = np.concatenate([e[0] for e in edges])
    dst = np.concatenate([e[1] for e in edges])
    src, dst = np.concatenate((src, dst)), np.concatenate((dst, src))
    pair = np.unique(src * n + dst)
    src, dst = pair // n, pair % n
    out = np.split(dst, np.searchsorted(src, np.arange(1, n)))
    return _attached(x, out)


def _attached(x: np.ndarray, out: list[np.ndarray]) -> list[np.ndarray]:
    """Edges to every part that the medoid does not reach, from the reached row nearest to it."""
    seen = np.zeros(len(x), bool)
    front = [medoid(x)]
    while True:
        while front:
            seen[front] = True
            front = [int(v) for v in np.unique(np.concatenate([out[u] for u in front])) if not seen[v]]
        left = np.flatnonzero(~seen)
        if not len(left):
            return out
        have = np.flatnonzero(seen)
        u = int(left[0])
        v = int(have[np.argmax(x[have] @ x[u])])
        out[u], out[v] = np.append(out[u], v), np.append(out[v], u)
        front = [u]


def range_search(queries: np.ndarray, x: np.ndarray, out: list[np.ndarray], threshold: float,
                 beam: int = BEAM) -> np.ndarray:
    """Which rows of ``x`` each query reaches with a cosine of ``threshold`` or more (query x row)."""
    n, m = len(x), len(queries)
    width = max(1, max(len(o) for o in out))
    table_ = np.full((n, width), -1, np.int64)
    for k, o in enumerate(out):
        table_[k, :len(o)] = o
    seen = np.zeros((m, n), bool)
    hit = np.zeros((m, n), bool)
    start = medoid(x)
    seen[:, start] = True
    ids = np.full((m, beam), -1, np.int64)
    sims = np.full((m, beam), -np.inf)
    done = np.ones((m, beam), bool)
    ids[:, 0], sims[:, 0], done[:, 0] = start, queries @ x[start], False
    hit[:, start] = sims[:, 0] >= threshold
    while True:  # greedy: all queries expand their best open row at once
        best = np.where(done, -np.inf, sims).argmax(axis=1)
        active = np.flatnonzero(~done[np.arange(m), best])
        if not len(active):
            break
        at = ids[active, best[active]]
        done[active, best[active]] = True
        near = table_[at]
        fresh = (near >= 0) & ~seen[active[:, None], near]
        q, k = np.nonzero(fresh)
        if not len(q):
            continue
        row = near[q, k]
        seen[active[q], row] = True
        value = np.einsum("ij,ij->i", queries[active[q]], x[row])
        hit[active[q], row] = value >= threshold
        more = np.full(near.shape, -np.inf)
        more[q, k] = value
        all_ids = np.concatenate((ids[active], near), axis=1)
        all_sims = np.concatenate((sims[active], more), axis=1)
        all_done = np.concatenate((done[active], ~fresh), axis=1)
        top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        ids[active], sims[active], done[active] = (np.take_along_axis(v, top, axis=1) for v in (all_ids, all_sims, all_done))
    crowded = np.flatnonzero(hit.sum(axis=1) >= beam)  # more than the beam in range: every row is compared
    for a in range(0, len(crowded), 500):
        hit[crowded[a:a + 500]] = queries[crowded[a:a + 500]] @ x.T >= threshold
    open_ = hit.copy()
    open_[crowded] = False
    front = np.nonzero(open_)
    while len(front[0]):  # on from all in range, until nothing new is in range
        found_q, found_row = [], []
        for a in range(0, len(front[0]), 20_000):
            q, near = front[0][a:a + 20_000], table_[front[1][a:a + 20_000]]
            i, k = np.nonzero((near >= 0) & ~seen[q[:, None], near])
            pair = np.unique(q[i] * n + near[i, k])
            q, row = pair // n, pair % n
            seen[q, row] = True
            ok = np.einsum("ij,ij->i", queries[q], x[row]) >= threshold
            hit[q[ok], row[ok]] = True
            found_q.append(q[ok])
            found_row.append(row[ok])
        front = (np.concatenate(found_q), np.concatenate(found_row))
    return hit


def _built(block: pa.Table) -> pa.Table:
    nodes = block.column("node").to_numpy()
    graph = robust_graph(matrix(block.column("v")))
    return pa.table({"node": nodes, "near": pa.array([nodes[g] for g in graph], pa.list_(pa.int64()))})


def _parts(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component of each row and of each column of a bipartite graph, named by a row; -1 without a hit."""
    row_of, col_of = np.full(hit.shape[0], -1), np.full(hit.shape[1], -1)
    some = hit.any(axis=1)
    for start in np.flatnonzero(some):
        front = [start] if row_of[start] < 0 else []
        while len(front):
            row_of[front] = start
            cols = np.flatnonzero(hit[front].any(axis=0) & (col_of < 0))
            col_of[cols] = start
            front = np.flatnonzero(hit[:, cols].any(axis=1) & (row_of < 0))
    return row_of, col_of


class Forest:
    """Union-find over nodes, fed with hits of rows against columns."""

    def __init__(self) -> None:
        self.label: dict[int, int] = {}

    def find(self, u: int) -> int:
        while self.label.setdefault(u, u) != u:
            self.label[u] = u = self.label[self.label[u]]
        return u

    def tie(self, hit: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> None:
        row_of, col_of = _parts(hit)
        for of, names in ((row_of, rows), (col_of, cols)):
            for k in np.flatnonzero(of >= 0):
                low, high = sorted((self.find(int(names[k])), self.find(int(rows[of[k]]))))
                self.label[high] = low

    def counted(self, nodes: list[np.ndarray], counts: list[np.ndarray]) -> pa.Table:
        """(node, n, root) of all counted or tied nodes."""
        tied = np.array(list(self.label), np.int64)
        node, back = np.unique(np.concatenate([*nodes, tied]), return_inverse=True)
        n = np.zeros(len(node), np.int64)
        np.add.at(n, back, np.concatenate([*counts, np.zeros(len(tied), np.int64)]))
        return pa.table({"node": pa.array(node, pa.int64()), "n": pa.array(n, pa.int64()),
                         "root": pa.array([self.find(u) if u in self.label else u for u in node.tolist()], pa.int64())})


def _searched(work: pa.Table, threshold: float) -> pa.Table:
    """(node, n, root): links of the queries with nodes at home in the block, and a forest of all links found."""
    work = work.combine_chunks()
    is_query = np.array(work.column("query").to_pylist(), bool)
    x = matrix(work.column("v"))
    nodes = work.column("node").to_numpy()
    q_at, g_at = np.flatnonzero(is_query), np.flatnonzero(~is_query)
    forest, counts = Forest(), []
    if not len(q_at) or not len(g_at):
        return forest.counted([], [])
    members = nodes[g_at]
    order = np.argsort(members)
    lists = work.column("near").to_pylist()
    out = []
    for k in g_at:
        near = np.array(lists[k] or [], np.int64)
        at = np.minimum(np.searchsorted(members[order], near), len(order) - 1)
        out.append(order[at[members[order][at] == near]])
    out = _attached(x[g_at], out)
    # a node counts in its nearest cluster only; over the border _crossed counts it
    times = np.where(work.column("role").to_numpy() == NEAR, work.column("times").to_numpy(), 0)[g_at]
    for a in range(0, len(q_at), 1000):
        some = q_at[a:a + 1000]
        hit = range_search(x[some], x[g_at], out, threshold)
        hit &= members[None, :] != nodes[some][:, None]
        counts.append(hit @ times)
        forest.tie(hit, nodes[some], members)
    return forest.counted([nodes[q_at]], counts)


def _crossed(work: pa.Table, threshold: float) -> pa.Table:
    """(node, n, root): links between asking nodes and nodes at home in other clusters, for both ends, and a forest."""
    work = work.combine_chunks()
    asks = work.column("role").to_numpy() == ASKS
    x = matrix(work.column("v"))
    nodes, times, cluster, mine = (work.column(c).to_numpy() for c in ("node", "times", "cluster", "mine"))
    q_at, h_at = np.flatnonzero(asks), np.flatnonzero(~asks)
    forest, ends, counts = Forest(), [], []
    homes = x[h_at]
    for a in range(0, len(q_at) if len(h_at) else 0, 500):
        some = q_at[a:a + 500]
        hit = x[some] @ homes.T >= threshold
        # within a region the lower cluster's nodes ask
        hit &= ~mine[some][:, None] | (cluster[some][:, None] < cluster[h_at][None, :])
        ends += [nodes[some], nodes[h_at]]
        counts += [hit @ times[h_at], times[some] @ hit]
        forest.tie(hit, nodes[some], nodes[h_at])
    return forest.counted(ends, counts)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, shard: int = SHARD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    units = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                           F.col(vec_col).alias("v"))
    units = (units.mapInArrow(_units, "vec_id long, label string, v binary")
             .withColumn("space", F.when(F.col("v").isNotNull(), F.concat_ws("|", "label", F.length("v"))))
             .withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("space", "v"))))
    units = stage(units, "units")
    nodes = units.where("node is not null").groupBy("node").agg(
        F.min("space").alias("space"), F.min("v").alias("v"), F.count(F.lit(1)).alias("times"))
    nodes = stage(nodes, "nodes")
    large = nodes.groupBy("space").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard)
    sample = (nodes.join(large, "space").select("space", "n", "v", "node")
              .orderBy(F.xxhash64("node"), "node").limit(SAMPLE).collect())
    centres = {}
    for space, n in sorted({(r["space"], r["n"]) for r in sample}):
        x = np.array([np.frombuffer(r["v"]) for r in sample if r["space"] == space])
        centres[space] = spherical_means(x, min(-(-n * OVERLAP // shard), max(1, len(x) // 8)))
    per = max(1, REGION * OVERLAP // shard)
    placed = nodes.select("node", "space", "v", "times").mapInArrow(
        lambda it: _placed(it, centres, threshold, per),
        "node long, space string, cluster int, region int, role int, v binary, times long")
    placed = stage(placed.withColumn("shard", F.xxhash64("space", "cluster"))
                   .withColumn("region", F.xxhash64("space", "region", F.lit("region")))
                   .withColumn("mine", F.col("region") == F.xxhash64("space", F.floor(F.col("cluster") / per).cast("int"),
                                                                      F.lit("region"))), "placed")
    cut = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    members = placed.where(F.col("role") != ASKS).select("shard", "node", "role", "v", "times")
    sizes = members.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / (2 * shard)).alias("blocks"))
    members = stage(members.join(sizes, "shard").withColumn("block", cut("blocks")), "members")
    near = (members.groupBy("shard", "block").applyInArrow(_built, "node long, near array<long>")
            .groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))
    graph = (members.join(near, "node").withColumn("part", each("blocks"))
             .select("shard", F.col("block").alias("to"), "part", "node", "role", "v", "near", "times", F.lit(False).alias("query")))
    asked = (members.where(F.col("role") == NEAR).withColumn("to", each("blocks"))
             .select("shard", "to", F.col("block").alias("part"), "node", "role", "v",
                     F.lit(None).cast("array<long>").alias("near"), "times", F.lit(True).alias("query")))
    inside = graph.unionByName(asked).groupBy("shard", "to", "part").applyInArrow(
        lambda t: _searched(t, threshold), "node long, n long, root long")
    ends_of = lambda role: F.ceil(F.count(F.when(F.col("role") == role, 1)) / max(REGION, shard))
    regions = (placed.where(F.col("role") != MEMBER).groupBy("region")
               .agg(ends_of(NEAR).alias("blocks"), ends_of(ASKS).alias("parts")).where("blocks > 0 and parts > 0"))
    border = placed.where(F.col("role") != MEMBER).join(regions, "region")
    asks = F.col("role") == ASKS
    border = (border.withColumn("to", F.when(asks, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(cut("blocks"))))
              .withColumn("part", F.when(asks, F.array(cut("parts"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
              .withColumn("to", F.explode("to")).withColumn("part", F.explode("part"))
              .select("region", "to", "part", "node", "role", "cluster", "mine", "v", "times"))
    over = border.groupBy("region", "to", "part").applyInArrow(
        lambda t: _crossed(t, threshold), "node long, n long, root long")
    found = stage(inside.union(over), "found")
    links = found.where("node != root").select(F.col("node").alias("src"), F.col("root").alias("dst")).distinct()
    ends = links.select(F.col("src").alias("id")).union(links.select(F.col("dst").alias("id"))).distinct()
    named = connected_components(ends, links).select(F.col("id").alias("node"), "component")
    counted = found.groupBy("node").agg(F.sum("n").alias("n"))
    rows = (units.select("vec_id", "node").join(counted, "node", "left").join(nodes.select("node", "times"), "node", "left")
            .join(named, "node", "left").withColumn("component", F.coalesce("component", "node")))
    names = rows.where("component is not null").groupBy("component").agg(F.min("vec_id").alias("name"))
    out = (rows.join(names, "component", "left")
           .withColumn("component_id", F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("name")))
           .withColumn("n_links", F.coalesce(F.col("n") + F.col("times") - 1, F.lit(0).cast("long"))))
    return out.select("vec_id", "n_links", "component_id",
                      F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def audit(vectors: DataFrame, found: DataFrame, threshold: float = THRESHOLD, queries: int = 500) -> DataFrame:
    """(links_found, links, recall) over a bounded set of vectors (smallest hashed ids), by brute force over all rows."""
    rows = (vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").alias("v"))
            .mapInArrow(_units, "vec_id long, label string, v binary"))
    some = rows.where("v is not null").orderBy(F.xxhash64("vec_id")).limit(queries).collect()
    asked = [(r["vec_id"], r["label"], bytes(r["v"])) for r in some]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, label, v = (batch.column(k).to_pylist() for k in range(3))
            n = [sum(own[k] != i and v[k] is not None and label[k] == lab and len(v[k]) == len(b)
                     and float(np.frombuffer(v[k]) @ np.frombuffer(b)) >= threshold for k in range(len(own)))
                 for i, lab, b in asked]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _, _ in asked], pa.int64()), pa.array(n, pa.int64())],
                                             names=["vec_id", "n"])

    true = rows.mapInArrow(compared, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n"))
    return (found.join(true, "vec_id").agg(F.sum(F.least("n", "n_links")).alias("links_found"), F.sum("n").alias("links"))
            .withColumn("recall", F.col("links_found") / F.greatest(F.col("links"), F.lit(1))))


def op9_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
