"""Exact operators against brute force: suffixes, windows, Jaccard, embeddings."""

import random

import pytest
from pyspark.sql import functions as F

from tally.llm.jaccard import jaccard_components
from tally.llm.neardup_vectors import audit, near_duplicates
from tally.llm.staging import table
from tally.llm.substring import remove_repeats
from tally.llm.suffixes import op4_suffix_array_dedup, remove_repeated_bytes
from tally.llm.jaccard import op2_ngram_jaccard_join
from tally.llm.substring import op5_substring_dedup
from tests.conftest import SF_SMALL
from tests.llm import brute, data

TEXTS = "doc_id long, text string"


def _texts(spark, rows):
    return data.clash(spark.createDataFrame(rows, TEXTS))


def _bytes(df):
    return brute.ordered(df.select("doc_id", "n_bytes", "n_removed", F.size("spans").alias("n"), F.sha2("kept", 256)).collect())


@pytest.mark.parametrize("hot", [20_000, 2])
def test_suffixes_on_shared_passages(spark, hot):
    rows = data.passages()
    got = _bytes(remove_repeated_bytes(_texts(spark, rows), length=20, gram=5, hot_contents=hot))
    assert got == brute.repeated_bytes(rows, 20)


def test_suffixes_on_documents(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert brute.ordered(op4_suffix_array_dedup(spark, SF_SMALL).collect()) == brute.repeated_bytes(rows, 400)


def test_suffixes_of_a_text_longer_than_a_run(spark, monkeypatch):
    from tally.llm import suffixes
    monkeypatch.setattr(suffixes, "RUN", 200)
    rows = data.passages(n=25)
    rows.append((77, "".join(t or "" for _, t in rows)[:3000]))
    assert _bytes(remove_repeated_bytes(_texts(spark, rows), length=20, gram=5)) == brute.repeated_bytes(rows, 20)


@pytest.mark.parametrize("hot", [5_000, 1])
def test_windows(spark, hot):
    rows = data.words_sharing()
    found = remove_repeats(_texts(spark, rows), hot_docs=hot)
    got = brute.ordered(found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect())
    assert got == brute.repeated_words(rows, 13)
    for r in found.collect():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_cut_texts_shuffle_only_what_they_need(spark):
    """What finds the repeated windows is stored and gone when the texts are cut."""
    found = remove_repeats(_texts(spark, data.words_sharing()), hot_docs=1)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("MapInArrow") == 1 and plan.count("Join") == 1


def test_windows_on_documents(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert brute.ordered(op5_substring_dedup(spark, SF_SMALL).collect()) == brute.repeated_words(rows, 13)


def test_windows_carry_and_verbatim(spark):
    rows = [(1, "a  b\n" + "x y z " * 5, "p"), (2, "q " + "x y z " * 5 + " r", "q"), (None, " s  t ", "r")]
    df = spark.createDataFrame(rows, TEXTS + ", source string")
    got = {r["carried_0"]: r["kept_text"] for r in remove_repeats(df, carry=("source",), verbatim=True).collect()}
    assert got == {"p": rows[0][1], "q": "q r", "r": " s  t "}


@pytest.mark.parametrize("width,percent,chunk", [(3, 90, 1_000_000), (2, 80, 300)])
def test_jaccard(spark, width, percent, chunk):
    rows = data.near_copies()
    found = jaccard_components(_texts(spark, rows), width=width, percent=percent, chunk=chunk)
    assert brute.ordered(found.select("doc_id", "n_shingles", "component_id").collect()) == brute.jaccard(rows, width, percent)


def test_ties_of_near_copies_grow_with_their_number(spark, monkeypatch):
    """Near copies are tied to their smallest, not pair by pair, also where a passage ties families to each other."""
    from tally.llm import jaccard
    rnd = random.Random(5)
    rows, passage = [], [f"p{k}" for k in range(12)]
    for family in range(3):
        base = [f"f{family}w{k}" for k in range(160)] + passage
        for copy in range(60):
            own = list(base)
            own[rnd.randrange(160)] = f"x{family}_{copy}"
            rows.append((len(rows), " ".join(own)))
    found = jaccard_components(_texts(spark, rows))
    assert brute.ordered(found.select("doc_id", "n_shingles", "component_id").collect()) == brute.jaccard(rows, 3, 90)
    signed = _texts(spark, rows).select("text").mapInArrow(
        lambda it: jaccard._signed(it, 3, 90), "signature long, node long, tag int")
    assert jaccard._ties(signed).count() < 8 * len(rows)
    monkeypatch.setattr(jaccard, "BUCKET", 1)  # every signature of several families is a crowd
    found = jaccard_components(_texts(spark, rows))
    assert brute.ordered(found.select("doc_id", "n_shingles", "component_id").collect()) == brute.jaccard(rows, 3, 90)


def test_crowds_lose_no_link(spark, monkeypatch):
    from tally.llm import jaccard
    monkeypatch.setattr(jaccard, "BUCKET", 2)
    rows = data.near_copies(seed=6)
    found = jaccard_components(_texts(spark, rows), width=2, percent=80)
    assert brute.ordered(found.select("doc_id", "n_shingles", "component_id").collect()) == brute.jaccard(rows, 2, 80)


def test_a_passage_of_many_texts_makes_no_group(spark, monkeypatch):
    """Signatures of more families than are counted tie only those that could be linked by them alone."""
    from tally.llm import jaccard
    monkeypatch.setattr(jaccard, "BUCKET", 4)
    passage = [f"p{k}" for k in range(100)]
    rows = [(i, " ".join([f"w{i}_{k}" for k in range(230)] + passage)) for i in range(120)]
    rows += [(200 + i, rows[i][1].replace(f"w{i}_7 ", "x ")) for i in range(9)]
    found = jaccard_components(_texts(spark, rows), width=5, percent=80)
    assert brute.ordered(found.select("doc_id", "n_shingles", "component_id").collect()) == brute.jaccard(rows, 5, 80)
    signed = [_texts(spark, rows).select("text").mapInArrow(
        lambda it, own=share: jaccard._signed(it, 5, 80, own, 3), "signature long, node long, tag int") for share in range(3)]
    assert 9 <= jaccard._ties(*signed).count() < 40


def test_stored_tables_leave_nothing_shuffled(spark):
    """What a stored step has shuffled goes with its write, without the driver's garbage collection."""
    import time
    from pathlib import Path

    from tally.llm.staging import passing, stage
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    shuffled = lambda: {p for d in folders for p in Path(d).rglob("shuffle_*.data")}
    df = spark.range(200_000).groupBy((F.col("id") % 5000).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    before = shuffled()
    kept = stage(df, "kept")
    with passing(spark) as here:
        gone = here(kept.where("k < 10").groupBy("k").agg(F.sum("n").alias("n")), "gone")
        (path,) = {Path(f.removeprefix("file://")).parent for f in gone.inputFiles()}
        assert len(gone.collect()) == 10 and path.exists()
    for _ in range(50):
        if not (left := shuffled() - before):
            break
        time.sleep(0.2)
    assert not left and not path.exists()
    assert kept.agg(F.sum("n")).first()[0] == 200_000


def test_jaccard_on_documents(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    assert brute.ordered(op2_ngram_jaccard_join(spark, SF_SMALL).collect()) == brute.jaccard(rows, 3, 90)


def test_links_of_many_short_sets():
    """Memory of a large group of short near copies follows its sets, not their square."""
    import tracemalloc

    import numpy as np

    from tally.llm.jaccard import linked
    rng = np.random.default_rng(2)
    base = np.arange(100, dtype=np.uint64)
    sets = [np.sort(np.append(base[2:], rng.integers(1000, 1 << 50, 2).astype(np.uint64))) for _ in range(6000)]
    sets.append(np.arange(500, 600, dtype=np.uint64))
    for side in (np.zeros(6001, bool), np.arange(6001) % 2 == 1):
        tracemalloc.start()
        edges = linked(sets, side, 90)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 500 << 20
        assert len(edges) == 5999 and {x for e in edges for x in e} == set(range(6000))


@pytest.mark.parametrize("stripe", [2000, 7])
def test_links_against_pairs(stripe, monkeypatch):
    import numpy as np

    from tally.llm import jaccard
    monkeypatch.setattr(jaccard, "STRIPE", stripe, raising=False)
    monkeypatch.setattr(jaccard, "WINDOW", 16, raising=False)
    rng = np.random.default_rng(5)
    base = [rng.choice(1 << 40, 40, replace=False).astype(np.uint64) for _ in range(6)]
    sets = [np.sort(rng.choice(base[i % 6], int(rng.integers(34, 41)), replace=False)) for i in range(60)]
    for side in (np.zeros(60, bool), rng.random(60) < 0.4):
        names = list(range(60)), list(range(60))
        pairs = [(i, j) for i in range(60) for j in range(i) if (not side.any() or side[i] != side[j])
                 and 100 * (both := len(np.intersect1d(sets[i], sets[j]))) >= 85 * (len(sets[i]) + len(sets[j]) - both)]
        edges = jaccard.linked(sets, side, 85)
        assert len(pairs) > len(edges) > 0
        for name, found in zip(names, (pairs, edges), strict=True):
            for a, b in found:
                old, new = name[a], name[b]
                name[:] = [new if n == old else n for n in name]
        assert len(set(names[0])) == 60 - len(edges)
        assert all((names[0][i] == names[0][j]) == (names[1][i] == names[1][j]) for i in range(60) for j in range(i))


def test_signatures_meet_for_every_linked_pair():
    """PartEnum loses no pair: sets at exactly the allowed difference share a signature."""
    import numpy as np

    from tally.llm.jaccard import TAG, signatures
    rng = np.random.default_rng(4)
    for size in (5, 9, 10, 14, 22, 30, 47, 80, 200, 700):
        for percent in (80, 90):
            for _ in range(20):
                a = rng.choice(1 << 50, size, replace=False).astype(np.uint64)
                cut = int(rng.integers(0, size * (100 - percent) // 100 + 1))
                room = size * 100 // percent - size  # add shingles while the pair stays linked
                b = a[cut:] if rng.random() < 0.5 else np.append(a, rng.choice(1 << 50, room, replace=False).astype(np.uint64))
                both = len(np.intersect1d(a, b))
                if 100 * both < percent * (len(a) + len(b) - both) or len(a) == len(b):
                    continue
                row = np.repeat([0, 1], [len(a), len(b)])
                r, s, tag = signatures(row, np.concatenate((np.sort(a), np.sort(b))), 2, percent)
                enough = False  # in one group of bands they share as many as both ask for
                for group in set((tag // TAG).tolist()):
                    own = tag // TAG == group
                    common = set(s[own & (r == 0)].tolist()) & set(s[own & (r == 1)].tolist())
                    enough |= bool(common) and len(common) >= (tag[own] % TAG).max()
                assert enough, (size, percent)


@pytest.mark.parametrize("shard", [2000, 20])
def test_near_vectors(spark, shard):
    rows = data.near_vectors()
    df = data.clash(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    found = near_duplicates(df, shard=shard)
    got = brute.ordered(found.select("vec_id", "n_links", "component_id").collect())
    assert got == brute.near_vectors(rows, 0.98)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in found.collect())


def test_near_vectors_audit(spark):
    rows = [r for r in data.near_vectors() if r[0] is not None][:120]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = audit(df, near_duplicates(df)).first()
    assert found["links"] > 0 and found["recall"] == 1.0


def test_near_vectors_of_a_dense_group(spark):
    """A group that its label's centroids cut up keeps all links, and so do its rim and the scattered rest."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    rest = unit(rng.normal(size=(6_000, 64)))
    x = unit(np.concatenate((unit(rng.normal(size=(1, 64))) + rng.normal(size=(10_000, 64)) * 0.012, rest,
                             rest[:1500] + rng.normal(size=(1500, 64)) * 0.02)))
    true = np.concatenate([(x[a:a + 500] @ x.T >= 0.98).sum(axis=1) - 1 for a in range(0, len(x), 500)])
    vectors = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 64).cast(pa.list_(pa.float64()))
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": vectors,
                                         "label": np.zeros(len(x), np.int64)}))
    got = {r["vec_id"]: r["n_links"] for r in near_duplicates(df).select("vec_id", "n_links").collect()}
    found = np.array([got[i] for i in range(len(x))])
    assert true[:10_000].min() > 9_000 and (found <= true).all()
    assert found.sum() >= 0.999 * true.sum() and (found == true).mean() > 0.99


def test_empty_tables(spark):
    texts = spark.createDataFrame([], TEXTS)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert remove_repeated_bytes(texts).count() == 0
    assert remove_repeats(texts).count() == 0
    assert jaccard_components(texts).count() == 0
    assert near_duplicates(vectors).count() == 0
