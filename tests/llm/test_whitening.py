"""Whitening against two plain passes with exact integers."""

from collections import defaultdict

import numpy as np
import pytest

from tally.llm import whitening
from tally.llm.staging import table
from tests.conftest import SF_SMALL
from tests.llm import brute, data

SCHEMA = "vec_id long, embedding array<double>, label int"


def _check(found, rows, components=8):
    ids, deviations, white, explained = brute.whitened(rows, components)
    by = defaultdict(list)
    for r in found:
        by[r["vec_id"]].append(r)
    assert sorted(map(str, by)) == sorted(set(map(str, ids)))
    assert sum(map(len, by.values())) == len(ids)
    signs = None
    for d, dev, w in zip(ids, deviations, white, strict=True):
        match = [r for r in by[d] if int(r["deviation"]) == dev]
        assert match and all(r["n"] == len(ids) for r in match)
        got = np.array([p["whitened"] for p in match[0]["parts"]])
        assert [p["component"] for p in match[0]["parts"]] == list(range(1, len(w) + 1))
        if signs is None and (np.abs(w) > 1e-3).all():
            signs = np.sign(got * w)
        if len(by[d]) == 1 and signs is not None:
            assert np.allclose(got, w * signs, atol=1e-7)
        assert np.allclose([p["explained"] for p in match[0]["parts"]], explained, rtol=1e-9)
        assert match[0]["identity_error"] < 1e-9
    return by


def _rows(n=400, dim=12, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim)) * np.linspace(2, 0.1, dim) @ np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[5][1], 1) for i in range(300)]           # a hot vector
    rows += [(2000, [0.0] * dim, 1), (None, rows[8][1], None), (3, rows[3][1], 0)]
    return rows


BAD = [(3000, None, 1), (3001, [1.0, None] * 6, 1), (3002, [float("nan")] * 12, 2), (3003, [float("inf")] + [0.0] * 11, 1)]


def test_whitening(spark):
    rows = _rows()
    df = data.clash(spark.createDataFrame(rows + BAD, SCHEMA)).withColumnRenamed("label", "weight")
    _check(whitening.whiten(df).collect(), [r[:2] for r in rows])


def test_deviations_beyond_64_bits(spark):
    rows = [(i, [float((-1) ** i * (i + 1)) * 2.0 ** 40, float(i % 5), 1e30 if i == 3 else 0.5 * i]) for i in range(30)]
    found = whitening.whiten(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)).collect()
    held = [(d, [float(np.clip(c, -(2.0 ** 42), 2.0 ** 42)) for c in v]) for d, v in rows]
    ids, deviations, _, _ = brute.whitened(held, 3)
    assert {r["vec_id"]: int(r["deviation"]) for r in found} == dict(zip(ids, deviations, strict=True))
    assert max(deviations) > 1 << 63


def test_fit_on_different_vectors_only(spark):
    rows = _rows()
    seen = {tuple(x): (d, v) for (d, x), (_, v, _) in zip(brute.integer_rows([r[:2] for r in rows]), rows, strict=True)}
    ids, deviations, _, _ = brute.whitened(list(seen.values()))
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA), weights="one").collect()
    assert len(found) == len(rows) and {r["n"] for r in found} == {len(seen)}
    got = {r["vec_id"]: int(r["deviation"]) for r in found}
    assert all(got[d] == dev for d, dev in zip(ids, deviations, strict=True))
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame(rows, SCHEMA), weights="all")


def test_no_variance_other_lengths_and_empty(spark):
    rows = [(1, [1.0, 2.0, 3.0], 1), (2, [1.0, 2.0, 3.0], 1), (3, [], 1), (4, [5.0], 1), (5, [6.0], 1), (6, [1.0, 1.0], 2), (7, [2.0, 2.0], 2)]
    found = {r["vec_id"]: r for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(found) == {1, 2, 4, 5, 6, 7} and [found[d]["n"] for d in (1, 4, 6)] == [2, 2, 2]
    assert found[1]["deviation"] == 0 and all(p["whitened"] is None for p in found[1]["parts"]) and found[1]["identity_error"] is None
    assert abs(abs(found[4]["parts"][0]["whitened"]) - 1) < 1e-12 and found[4]["parts"][0]["explained"] == 1
    assert found[6]["parts"][1]["whitened"] is None and found[6]["parts"][1]["explained"] == 0 and found[6]["identity_error"] < 1e-9
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0


def test_on_embeddings(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "embeddings").select("vec_id", "embedding").collect()]
    found = whitening.op11_embedding_whitening(spark, SF_SMALL)
    assert found.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(found.dtypes)["deviation"] == dict(found.dtypes)["n"] == "bigint" and dict(found.dtypes)["component"] == "int"
    assert found.count() == 8 * len(rows) and found.where("deviation is null or deviation <> deviation_exact").count() == 0
    _check(whitening.whiten(table(spark, SF_SMALL, "embeddings")).collect(), rows)
