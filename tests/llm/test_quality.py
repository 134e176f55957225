"""The quality model over whole characters: what a folded alphabet cannot tell apart."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tally.llm import quality


def _grams(texts):
    raw = "".join(texts).encode()
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    text, code, whole = quality._symbol_grams(np.frombuffer(raw, np.uint8), offsets)
    return text, whole(code)


def _plain(texts):
    out = []
    for t in texts:
        padded = [0] * (quality.ORDER - 1) + [ord(c) + 1 for c in t]
        for i in range(len(t)):
            c4, c3, c2, c1 = padded[i:i + quality.ORDER]
            out.append((c4, c3 << 42 | c2 << 21 | c1))
    return out


def test_every_character_is_a_symbol_of_its_own():
    texts = ["Ab1 aB2", "", "жш\x00Ж語\U0001F600", "\U0010FFFF\U0001F600xyz", "A"]
    text, grams = _grams(texts)
    assert list(zip(*grams.tolist())) == _plain(texts)
    assert np.bincount(text, minlength=5).tolist() == [len(t) for t in texts]


def test_more_characters_than_four_numbers_hold():
    every = [chr(c) for c in range(1, 0x11500) if not 0xD800 <= c < 0xE000]
    texts = ["".join(every), "aba"]
    assert len(every) > 1 << 16
    assert list(zip(*_grams(texts)[1].tolist())) == _plain(texts)


def test_shuffled_letters_and_digits_are_judged(spark):
    """Letters 20 code points apart, like these, were one class, and so were all digits and all capitals."""
    rows = [(i, "ада мир год 1111 ABBA " * 8, "ru") for i in range(60)]
    swap = str.maketrans({"а": "ф", "1": "7", "B": "Q"})
    rows += [(100, rows[0][1], "ru"), (101, rows[0][1].translate(swap), "ru")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(60)], "doc_id long")
    got = {r["doc_id"]: r for r in quality.perplexities(docs, trusted).collect()}
    assert not got[100]["rejected"] and got[101]["rejected"]
    assert got[101]["perplexity"] > 2 * got[100]["perplexity"]


def test_answers_are_those_of_the_model(spark):
    """Scores add up the joined probabilities of each character's n-gram."""
    rows = [(i, "Der Weg 12 ist weit. " * 3 + "é語" * (i % 3), "de") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(20)], "doc_id long")
    got = {r["doc_id"]: r for r in quality.perplexities(docs, trusted).collect()}
    learn = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    judge = [r for r in rows if not zlib.crc32(str(r[0]).encode()) % 5]
    counts = Counter(g for r in learn for g in _plain([r[1]]))
    schema = "lang string, high int, gram long"
    frame = spark.createDataFrame([("de", *g, n) for g, n in counts.items()], schema + ", n long")
    asked = spark.createDataFrame([("de", *g) for g in {g for r in rows for g in _plain([r[1]])}], schema)
    logp = {(r["high"], r["gram"]): r["logp"] for r in quality.log_probabilities(asked, frame, quality.WHOLE).collect()}
    nll = {r[0]: -sum(logp[g] for g in _plain([r[1]])) for r in rows}
    mean = sum(nll[r[0]] for r in judge) / sum(len(r[1]) for r in judge)
    for i, t, _ in rows:
        assert abs(got[i]["perplexity"] - np.exp((nll[i] + quality.PRIOR * mean) / (len(t) + quality.PRIOR))) < 1e-6


def test_dealt_texts_are_compressed_together():
    """Row by row, as a shuffle compresses them, such texts took half as much again."""
    rnd = np.random.default_rng(3)
    stems = ["".join(rnd.choice(list("abdeiklmnorst"), k)) for k in rnd.integers(3, 9, 3000)]
    texts = [" ".join(rnd.choice(stems, 600)) for _ in range(300)] + ["", None]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i, None], "text": [texts[i], texts[-1 - i]], "lang": ["en", "de"],
                                           "part": pa.array([i % 3, 1], pa.int64())}) for i in range(len(texts))]
    (dealt,) = quality._dealt(iter(batches))
    assert sorted(dealt.column("part").to_pylist()) == [0, 1, 2]
    got = [(p, *r.values()) for p, b in zip(dealt.column("part").to_pylist(), dealt.column("block"), strict=True)
           for r in quality._opened(b).to_pylist()]
    want = [(r["part"], r["doc_id"], r["text"], r["lang"]) for b in batches for r in b.to_pylist()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    plain = sum(len(t or "") for b in batches for t in b.column("text").to_pylist())
    lz4 = pa.Codec("lz4")
    rowwise = sum(len(lz4.compress("".join(t or "" for t in b.column("text").to_pylist()).encode(), asbytes=True)) for b in batches)
    held = sum(len(b.as_buffer()) for b in dealt.column("block"))
    assert held < 0.7 * rowwise and held < 0.5 * plain
