"""Packing and sampled segmentation."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tally.llm import packing, sampling
from tests.llm import brute, data

WORDS = [None, "", " \t", "<|endoftext|> a<|startoftext|>b", "İstanbul ΣΑΣ ΟΔΟΣ", "日本語 テスト😀 a‍b", "́x ñÑ ß ÿ Ÿ ſ ŉ",
         "don't I'll 12.5 x² a\x1cb c\x85d e\xa0f é ﬁ ½ '''s", "a\x00b \x7f ~!! 's 't The THE the, THE! l'été", "x" * 3000]


@pytest.mark.parametrize("cap", [10, 64, 4096])
def test_runs_are_best_fit_decreasing(cap):
    rnd = random.Random(cap)
    for _ in range(15):
        lengths = [rnd.choice([1, 2, 3, cap, rnd.randint(1, cap)]) for _ in range(rnd.randint(0, 300))]
        held = defaultdict(list)
        for length, lo, hi, first, per, offset in packing.best_fit_runs(dict(Counter(lengths)), cap):
            for r in range(lo, hi):
                held[first + (r - lo) // per].append((offset + (r - lo) % per * length, length))
        for pieces in held.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= cap
        assert sorted(sum(n for _, n in p) for p in held.values()) == brute.best_fit(lengths, cap)


def _ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return tok.encode(text or "", add_special_tokens=False).ids + [1]


def test_other_tokenizer_takes_whole_texts(spark):
    import json

    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        assert not packing._knows_rules(json.load(file))
    tok = Tokenizer.from_file(path)
    docs = spark.createDataFrame(list(enumerate(WORDS)), "doc_id long, text string")
    got = {(r["doc_id"], r["piece"]): bytes(r["ids"]) for r in packing.tokenize_pieces(docs, path, max_len=50).collect()}
    for d, t in enumerate(WORDS):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        assert b"".join(got[d, p] for p in range(-(-len(ids) // 50))) == np.array(ids, "<u4").tobytes()


def test_kept_words_turn_over(monkeypatch):
    import sys

    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    sys.__dict__.pop("_tally_text_ids", None)
    monkeypatch.setattr(packing, "KEPT_WORDS", 3)
    text_ids = packing._text_ids(path)
    for t in ["one two three four five", "two six", "Two, seven one", "eight nine two ten", "one"] * 3:
        assert text_ids(t.encode()) == np.array(_ids(t)[:-1], "<u4").tobytes()
    sys.__dict__.pop("_tally_text_ids", None)


def test_pack(spark):
    import public_tokenizers
    rnd = random.Random(2)
    rows = [(i, t) for i, t in enumerate(WORDS)] + [(None, "a b"), (3, "c"), (3, "c")]
    rows += [(100 + i, " ".join(rnd.choice(["ab", "cd", "Ef."]) for _ in range(rnd.randint(0, 120)))) for i in range(60)]
    docs = data.clash(spark.createDataFrame(rows, "doc_id long, text string"))
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.tokenize_pieces(docs, path, max_len=50)
    placed = packing.pack(docs, max_len=50)
    got = [tuple(r) for r in placed.select("doc_id", "piece", "start", "length", "ids_crc32").collect()]
    want = []
    for d, t in rows:
        ids = _ids(t)
        for p, at in enumerate(range(0, len(ids), 50)):
            part = np.array(ids[at:at + 50], "<u4")
            want.append((d, p, at, len(part), zlib.crc32(part.tobytes())))
    assert brute.ordered(got) == brute.ordered(want)
    held = defaultdict(list)
    for r in placed.collect():
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 50
    assert len(held) == len(brute.best_fit([w[3] for w in want], 50))
    whole = packing.sequences(pieces, placed).collect()
    assert len(whole) == len(held)
    assert all(len(r["ids"]) == 4 * sum(n for _, n in held[r["sequence_id"]]) for r in whole)
    assert packing.pack(docs.where("false")).count() == 0


TEXTS = ["", " ", "  a b", "▁a ▁▁ x", "é́日本語😀\x00\n\n\t", "a" * 400, "▁", " lead  and trail  ", "Plain words, here.\nAnd there."]


def test_sampled_pieces_round_trip(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null key"), (50, None), (2, TEXTS[2])]
    docs = data.clash(spark.createDataFrame(rows, "doc_id long, text string"))
    encoded = sampling.encode(docs)
    assert all(r["lossless"] for r in encoded.collect())
    assert brute.ordered(sampling.decode(encoded).collect()) == brute.ordered((d, t or "") for d, t in rows)
    again = sampling.encode(docs.repartition(3))
    assert brute.ordered(encoded.select("doc_id", "ids").collect()) == brute.ordered(again.select("doc_id", "ids").collect())
    assert sampling.encode(docs.where("false")).count() == 0


def test_samples_follow_the_lattice():
    """Shares of the segmentations of a word against all its paths."""
    v = sampling.vocabulary(sampling.default_model(), 0.5)
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=sampling.default_model())
    word, n = "thing", 60_000
    paths: dict[tuple, float] = {}

    def walk(rest: str, ids: tuple, weight: float) -> None:
        if not rest:
            paths[ids] = np.exp(weight)
        for k in range(1, len(rest) + 1):
            i = model.piece_to_id(rest[:k])
            if model.id_to_piece(i) == rest[:k]:
                walk(rest[k:], (*ids, i), weight + v.weight[i])

    walk("▁" + word, (), 0.0)
    raw = np.frombuffer((word * n).encode(), np.uint8)
    ids, upto = sampling.sampled(raw, np.arange(n + 1) * len(word), np.arange(n), v)
    seen = Counter(tuple(ids[upto[k]:upto[k + 1]].tolist()) for k in range(n))
    total = sum(paths.values())
    assert set(seen) <= set(paths) and len(seen) > 3
    assert max(abs(seen[p] / n - w / total) for p, w in paths.items()) < 0.01
