"""Approximate nearest neighbours with learned partitions.

On a sample of at most ``SAMPLE`` vectors the exact neighbour graph is cut into
balanced parts: a capacity-bound start from centroids, then rounds in which a
vector moves to the part that holds most of its neighbours while that part has
room.  A small network (one hidden layer) learns, from a vector, the shares of
its neighbours' parts.  Every row is indexed under its most probable part, and
a query goes to its most probable parts; how many is read off a part of the
sample kept apart, so that ``COVER`` of true neighbours lie in the parts asked.
Candidates are reranked by exact inner products in double precision.

The index is a table: parts above ``BLOCK`` rows (a hot group of look-alikes is
one part) are split into blocks by hash, the queries of a part into blocks too,
and each (part, row block, query block) is one task's work with a top-k as its
result; the top-k of a query are merged at the end.  Nothing but the sample and
the network (both bounded) passes through the driver.

Nulls and edge cases: vectors that are null, empty, zero or hold a null or
non-finite component, and rows with a null id, take no part; only vectors of a
query's length are its candidates; equal scores go by the smaller id; fewer
candidates than ``k`` are all returned; rows that share an id are separate
candidates, but never candidates of their own id; an empty table gives an empty
result.  Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.staging import stage, table
from tally.llm.vectors import matrix, rows_of, spherical_means

K = 20
SAMPLE = 8192
MAX_PARTS = 512
PART_ROWS = 2000
BLOCK = 4096
QUERY_BLOCK = 1024
GRAPH = 10
COVER = 0.96


@dataclass
class Router:
    """One hidden layer; ``probes``: the number of parts that a query asks."""

    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k rows of largest inner product with each row, itself left out."""
    n = len(x)
    out = np.empty((n, k), np.int64)
    for a in range(0, n, 1024):
        z = min(n, a + 1024)
        s = x[a:z] @ x.T
        s[np.arange(z - a), np.arange(a, z)] = -np.inf
        out[a:z] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 1.05, rounds: int = 15) -> np.ndarray:
    """Part of each row: at most ``slack`` times the mean size, few edges of ``graph`` between parts."""
    n = len(x)
    room = int(np.ceil(slack * n / parts))
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    sims = unit @ spherical_means(unit, parts).T
    parts = sims.shape[1]
    own, size = np.full(n, -1), np.zeros(parts, np.int64)
    for i in np.argsort(-sims.max(axis=1), kind="stable"):  # surest rows first
        for p in np.argsort(-sims[i], kind="stable"):
            if size[p] < room:
                own[i] = p
                size[p] += 1
                break
    # edges in both directions
    src = np.concatenate((np.repeat(np.arange(n), graph.shape[1]), graph.ravel()))
    dst = np.concatenate((graph.ravel(), np.repeat(np.arange(n), graph.shape[1])))
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.int32)
        np.add.at(votes, (src, own[dst]), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), own]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[own[i]] -= 1
                size[best[i]] += 1
                own[i] = best[i]
                moved += 1
        if not moved:
            break
    return own


def fit_router(x: np.ndarray, parts: int, k: int = K, hidden: int = 128, steps: int = 400, cover: float = COVER) -> Router:
    """Parts of the sample's neighbour graph and the network that predicts them."""
    n, dim = x.shape
    scale = float(np.sqrt(dim) / max(np.sqrt((x * x).sum(axis=1)).mean(), 1e-12))
    graph = neighbour_graph(x, min(GRAPH, n - 1))
    own = balanced_parts(x, graph, parts)
    parts = int(own.max()) + 1
    target = np.zeros((n, parts))
    np.add.at(target, (np.repeat(np.arange(n), graph.shape[1]), own[graph].ravel()), 1.0)
    target[np.arange(n), own] += graph.shape[1]
    target /= target.sum(axis=1, keepdims=True)
    random = np.random.default_rng(5)
    apart = np.zeros(n, bool)
    apart[random.permutation(n)[: n // 5]] = True
    net = [random.normal(0, np.sqrt(2 / dim), (dim, hidden)), np.zeros(hidden),
           random.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
    first, second = [np.zeros_like(w) for w in net], [np.zeros_like(w) for w in net]
    xs, ys = (x * scale)[~apart], target[~apart]
    for step in range(1, steps + 1):
        some = random.integers(0, len(xs), min(1024, len(xs)))
        a, y = xs[some], ys[some]
        h = np.maximum(a @ net[0] + net[1], 0)
        s = h @ net[2] + net[3]
        p = np.exp(s - s.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d = (p - y) / len(a)
        back = (d @ net[2].T) * (h > 0)
        for i, g in enumerate((a.T @ back, back.sum(axis=0), h.T @ d, d.sum(axis=0))):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            net[i] = net[i] - 0.003 * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    router = Router(scale, *net, probes=parts)
    # how many parts hold ``cover`` of the neighbours of the rows kept apart, every row under its most probable part
    logits = router.logits(x)
    indexed = logits.argmax(axis=1)
    test = np.flatnonzero(apart)
    if len(test):
        near = indexed[neighbour_graph(x, min(k, n - 1))[test]]
        rank = np.empty_like(logits[test], dtype=np.int64)
        order = np.argsort(-logits[test], axis=1, kind="stable")
        np.put_along_axis(rank, order, np.arange(parts)[None, :].repeat(len(test), 0), axis=1)
        place = np.sort(np.take_along_axis(rank, near, axis=1).ravel())
        router.probes = int(place[min(len(place) - 1, int(np.ceil(cover * len(place))))]) + 1
    return router


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [None if v is None else v.astype(np.float64).tobytes() for v in rows_of(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "v"])


def _routed(batches: Iterator[pa.RecordBatch], routers: dict[int, Router], probes: bool) -> Iterator[pa.RecordBatch]:
    """(vec_id, v, dim, part): one row for the most probable part, or for each part that a query asks."""
    for batch in batches:
        ids, blobs = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        dims = np.array([len(b) // 8 for b in blobs], dtype=np.int64)
        for dim in np.unique(dims).tolist():
            some = np.flatnonzero(dims == dim)
            router = routers.get(dim)
            if router is None:
                parts = np.zeros((len(some), 1), np.int64)
            else:
                logits = router.logits(np.frombuffer(b"".join(blobs[k] for k in some)).reshape(len(some), dim))
                parts = np.argsort(-logits, axis=1, kind="stable")[:, :router.probes if probes else 1]
            rows = np.repeat(some, parts.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[rows]), pa.array([blobs[k] for k in rows], pa.binary()),
                 pa.array(np.full(len(rows), dim, np.int64)), pa.array(parts.ravel())], names=["vec_id", "v", "dim", "part"])


def top_k(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
    """(query id, id, score) of each query's k best rows, exact inner products, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    x, ids = x[order], ids[order]
    for a in range(0, len(queries), 256):
        s = queries[a:a + 256] @ x.T
        s[query_ids[a:a + 256, None] == ids[None, :]] = -np.inf
        best = np.argsort(-s, axis=1, kind="stable")[:, :k]
        value = np.take_along_axis(s, best, axis=1)
        q, j = np.nonzero(value > -np.inf)
        yield query_ids[a:a + 256][q], ids[best[q, j]], value[q, j]


def _reranked(work: pa.Table, k: int) -> pa.Table:
    """(query_id, found): the block's best rows of each query in one list."""
    work = work.combine_chunks()
    asks = np.array(work.column("query").to_pylist(), bool)
    x, ids = matrix(work.column("v")), work.column("vec_id").to_numpy()
    parts = list(top_k(x[asks], ids[asks], x[~asks], ids[~asks], k)) if asks.any() and not asks.all() else []
    q, i, s = (np.concatenate([p[c] for p in parts]) if parts else np.zeros(0) for c in range(3))
    q, i, s = q.astype(np.int64), i.astype(np.int64), s.astype(np.float64)
    cuts = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
    found = pa.StructArray.from_arrays([pa.array(-s), pa.array(i)], names=["minus", "vec_id"])
    return pa.table({"query_id": pa.array(q[cuts]), "found": pa.ListArray.from_arrays(
        pa.array(np.append(cuts, len(q)).astype(np.int32)), found)})


def search(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for every row of ``queries``, both with the same columns."""
    def stored(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v")).where("vec_id is not null")
        return stage(rows.mapInArrow(_values, "vec_id long, v binary").where("v is not null"), name)

    rows, asked = stored(vectors, "vectors"), stored(queries, "queries")
    counts = rows.groupBy(F.length("v").alias("bytes")).agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["bytes"] // 8: r["n"] for r in counts.orderBy(F.desc("n"), "bytes").limit(16).collect()}
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    routers: dict[int, Router] = {}
    for dim, n in sizes.items():
        x = np.array([np.frombuffer(r["v"]) for r in sample if len(r["v"]) == 8 * dim]).reshape(-1, dim)
        parts = min(MAX_PARTS, len(x) // 64, n // PART_ROWS)
        if parts > 1:
            routers[dim] = fit_router(x, parts, k)
    schema = "vec_id long, v binary, dim long, part long"
    index = stage(rows.mapInArrow(lambda it: _routed(it, routers, False), schema), "index")
    routed = stage(asked.mapInArrow(lambda it: _routed(it, routers, True), schema), "routed")
    blocks = (index.groupBy("dim", "part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("row_blocks")).join(
        routed.groupBy("dim", "part").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("query_blocks")), ["dim", "part"]))

    def dealt(df: DataFrame, own: str, other: str, query: bool) -> DataFrame:
        return (df.join(blocks, ["dim", "part"]).withColumn(own, F.pmod(F.xxhash64("vec_id"), F.col(f"{own}s")))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}s") - 1)))
                .select("dim", "part", "row_block", "query_block", "vec_id", "v", F.lit(query).alias("query")))

    work = dealt(index, "row_block", "query_block", False).unionByName(dealt(routed, "query_block", "row_block", True))
    best = work.groupBy("dim", "part", "row_block", "query_block").applyInArrow(
        lambda t: _reranked(t, k), "query_id long, found array<struct<minus:double,vec_id:long>>")
    merged = best.groupBy("query_id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, k).alias("found"))
    return (merged.select("query_id", F.posexplode("found").alias("at", "f"))
            .select("query_id", (F.col("at") + 1).alias("rank"), "f.vec_id", (-F.col("f.minus")).alias("score")))


def op7_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 20 = 0"))
