"""Nearest neighbours: exact where all parts are asked, recall where not."""

import numpy as np

from tally.llm import nearest
from tests.llm import brute, data


def _exact(rows, asked, k):
    out = []
    for q, v in asked:
        near = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v))[:k]
        out += [(q, n, i) for n, (_, i) in enumerate(near, 1)]
    return brute.ordered(out)


def test_search_edge_cases(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(70)]
    rows += [(200, rows[1][1]), (220, rows[1][1])]  # ties
    odd = [(240, None), (260, [0.0] * 6), (280, [1.0, None] * 3), (None, rows[2][1]), (300, [1.0, 2.0]), (320, []), (340, [float("inf")] * 6)]
    df = data.clash(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"))
    got = nearest.search(df, df.where("vec_id % 20 = 0"), k=7)
    rows.append((300, [1.0, 2.0]))
    assert brute.ordered(got.select("query_id", "rank", "vec_id").collect()) == _exact(
        rows, [r for r in rows if r[0] % 20 == 0], 7)
    assert nearest.search(df.where("false"), df.where("false")).count() == 0


def test_recall_of_learned_parts(spark, monkeypatch):
    for name, value in (("PART_ROWS", 300), ("BLOCK", 200), ("QUERY_BLOCK", 50)):
        monkeypatch.setattr(nearest, name, value)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + 0.4 * rng.normal(size=16)).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest.search(df, df.where("vec_id % 20 = 0"), k=10).collect()
    want = _exact(rows, [r for r in rows if r[0] % 20 == 0], 10)
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert np.mean([(q, i) in found for q, _, i in want]) >= 0.9
    assert len(got) == len(want)


def test_parts_are_balanced():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1000, 8))
    own = nearest.balanced_parts(x, nearest.neighbour_graph(x, 10), 8)
    assert np.bincount(own).max() <= np.ceil(1.05 * 1000 / 8)
