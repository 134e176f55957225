"""Classifiers: held-out accuracy, brute-force inference, edge cases."""

import itertools
import random
import zlib

import numpy as np
import pytest

from tally.llm import langid, quality, toxicity
from tally.llm.staging import table
from tests.llm import data

SF = "/root/testdata/sf0.01"


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    x, first = rng.normal(size=37) * 2, np.zeros(37, bool)
    first[[0, 5, 6, 30]] = True
    transition, start = rng.normal(size=(2, 2)), 0.3
    got = toxicity.marginals(x, first, transition, start)
    cuts = [0, 5, 6, 30, 37]
    for a, z in zip(cuts[:-1], cuts[1:], strict=True):
        if z - a > 12:
            continue
        total, toxic = 0.0, np.zeros(z - a)
        for y in itertools.product((0, 1), repeat=z - a):
            s = start * y[0] + sum(x[a + i] * y[i] for i in range(z - a))
            s += sum(transition[y[i - 1], y[i]] for i in range(1, z - a))
            total += np.exp(s)
            toxic += np.exp(s) * np.array(y)
        assert np.allclose(got[a:z], toxic / total)


def test_toxicity_held_out(spark):
    marks = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    rows = [r for r in toxicity.op3_toxicity(spark, SF).collect() if r["doc_id"] in marks]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    apart = [r for r in rows if r["held_out"]]
    clean = [r for r in apart if marks[r["doc_id"]] == 0]
    toxic = [r for r in apart if marks[r["doc_id"]] == 1]
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    assert sum(r["predicted"] for r in toxic) >= 0.7 * len(toxic)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_toxic_spans_and_edge_cases(spark):
    rnd = random.Random(6)
    plain = lambda n: " ".join("".join(rnd.choice("abdeiklmnorstu") for _ in range(rnd.randint(2, 7))) for _ in range(n))
    rows = [(i, plain(20) + (" you vile loser now " if i % 2 else " ") + plain(5)) for i in range(80)]
    docs = data.clash(spark.createDataFrame([*rows, (None, None), (900, ""), (901, "!!")], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    found = toxicity.score(docs, labels).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == 83
    hit = by_id[1]
    assert any("loser" in rows[1][1][s["start"]:s["end"]] for s in hit["spans"])
    assert hit["score"] > by_id[2]["score"] and not by_id[2]["spans"]
    assert by_id[None]["spans"] == [] and by_id[900]["score"] == by_id[901]["score"] < 0.5
    none = toxicity.score(docs, labels.where("toxic = 0")).collect()
    assert {r["score"] for r in none} == {0.0}


def test_language_held_out(spark):
    lang = {r["doc_id"]: r["lang"] for r in table(spark, SF, "documents").select("doc_id", "lang").collect()}
    rows = langid.op8_language_id(spark, SF).collect()
    apart = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in apart]) > 0.97


def test_language_edge_cases(spark):
    rows = [(i, "the thing with words" if i % 2 else "der die das und", "en" if i % 2 else "de") for i in range(40)]
    rows += [(None, None, None), (100, "", "en"), (101, "12 !?", None), (102, "the words", None), (5, "the thing", "en")]
    docs = data.clash(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert got[None]["lang_pred"] == got[100]["lang_pred"] == got[101]["lang_pred"] == "und"
    assert got[101]["score"] == 0.0 and got[102]["lang_pred"] == "en"
    none = langid.identify(docs, docs.where("false")).collect()
    assert {r["lang_pred"] for r in none} == {"und"} and len(none) == len(rows)
    assert langid.identify(docs.where("false")).count() == 0


def _kneser_ney(counts: dict[int, int], order: int):
    """Dictionary version of the interpolated model."""
    tables = []
    grams = dict(counts)
    for o in range(order, 0, -1):
        n = [sum(c == k for c in grams.values()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else None
        raw = [None if y is None else (k + 1) - (k + 2) * y * max(n[k + 1], 1) / max(n[k], 1) for k in range(3)]
        d = [min(max(0.5 if r is None else r, 0.05), top) for r, top in zip(raw, (0.95, 1.9, 2.85), strict=True)]
        off = {g: d[min(c, 3) - 1] for g, c in grams.items()}
        total, left = {}, {}
        for g, c in grams.items():
            total[g >> 6] = total.get(g >> 6, 0) + c
            left[g >> 6] = left.get(g >> 6, 0) + off[g]
        tables.append(({g: (c - off[g]) / total[g >> 6] for g, c in grams.items()}, {h: left[h] / total[h] for h in total}))
        lower: dict[int, int] = {}
        for g in grams:
            lower[g & ((1 << 6 * (o - 1)) - 1)] = lower.get(g & ((1 << 6 * (o - 1)) - 1), 0) + 1
        grams = lower
    tables.reverse()

    def logp(g: int) -> float:
        p = 1 / quality.CLASSES
        for o, (share, weight) in enumerate(tables, 1):
            own = g & ((1 << 6 * o) - 1)
            if own >> 6 in weight:
                p = share.get(own, 0.0) + weight[own >> 6] * p
        return float(np.log(p))
    return logp


def test_kneser_ney_matches_dictionaries(spark):
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcde .")) for _ in range(3000)).encode()
    _, codes = quality._codes(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    g, n = np.unique(codes, return_counts=True)
    counts = dict(zip(g.tolist(), n.tolist(), strict=True))
    asked = [*g.tolist()[:200], 5, 1 << 20, 64 * 64 * 3 + 7]
    frame = spark.createDataFrame([("x", k, v) for k, v in counts.items()], "lang string, gram long, n long")
    want = spark.createDataFrame([("x", k) for k in asked], "lang string, gram long")
    got = {r["gram"]: r["logp"] for r in quality.log_probabilities(want, frame).collect()}
    plain = _kneser_ney(counts, quality.ORDER)
    assert all(abs(got[k] - plain(k)) < 1e-9 for k in asked)
    context = g[0] >> 6  # probabilities of one context add up to one
    everything = spark.createDataFrame([("x", int(context << 6 | c)) for c in range(1, quality.CLASSES + 1)], want.schema)
    assert sum(np.exp(r["logp"]) for r in quality.log_probabilities(everything, frame).collect()) == pytest.approx(1, abs=0.02)


def test_quality_on_documents(spark):
    marks = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    rows = quality.op6_quality_classifier(spark, SF).collect()
    assert len(rows) == table(spark, SF, "documents").count()
    good = [r for r in rows if marks.get(r["doc_id"]) == 1]
    bad = [r for r in rows if marks.get(r["doc_id"]) == 0]
    assert np.mean([r["rejected"] for r in good]) < 0.05
    assert np.mean([r["rejected"] for r in bad]) > 0.7


def test_quality_edge_cases(spark):
    rows = [(i, f"some plain text number {i} of the usual kind. " * 5, "en") for i in range(40)]
    rows += [(50, "#$%& @@@@ ####", "en"), (51, None, "en"), (52, "", None), (53, "texte sans modèle", "fr"), (None, "some text", None), (3, "other text", "en")]
    docs = data.clash(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(50, 0), (51, None), (None, 1), (7, 0)], "doc_id long, quality int")
    got = quality.perplexities(docs, quality.trusted_ids(labels)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] != 3}
    assert not by_id[51]["rejected"] and not by_id[52]["rejected"] and not by_id[53]["rejected"]
    assert by_id[53]["threshold"] is None and not by_id[7]["trusted"]
    assert by_id[50]["perplexity"] > by_id[1]["perplexity"]
    assert quality.perplexities(docs.where("false"), quality.trusted_ids(labels)).count() == 0
