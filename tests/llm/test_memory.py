"""What a task's Python holds beside its batch, and what it writes for copies."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from tally.llm import jaccard, langid, packing, quality, substring


def _texts(n=700, words=1000):
    rnd = random.Random(8)
    stems = [f"{a}{b}{c}" for a in ("ban", "lor", "tem", "sil") for b in ("do", "ra", "mi", "tu") for c in ("x", "va", "ke")]
    return [" ".join(rnd.choices(stems, k=words)) for _ in range(n)]


def _peak(fn, batch) -> float:
    for _ in fn(iter([batch])):     # tables that a worker keeps
        pass
    tracemalloc.start()
    for _ in fn(iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_memory_follows_a_slice_and_not_the_batch():
    texts = _texts()
    batch = pa.RecordBatch.from_pydict({"text": texts})
    assert batch.nbytes > 4_000_000
    assert _peak(lambda it: jaccard._signed(it, 5, 80), batch) < 25
    assert _peak(langid._document_frequencies, batch) < 130
    batch = pa.RecordBatch.from_pydict({"part": [0] * len(texts), "lang": ["en"] * len(texts), "text": texts})
    assert _peak(quality._gram_counts, batch) < 100


def test_texts_that_repeat_are_looked_for_in_small_slices():
    batch = pa.RecordBatch.from_pydict({"doc_id": range(700), "text": _texts()})
    assert _peak(lambda it: substring._anchors(it, 13, 3), batch) < 40


def test_grams_are_made_of_small_slices():
    batch = pa.RecordBatch.from_pydict({"part": [0] * 700, "lang": ["en"] * 700, "text": _texts()})
    assert _peak(quality._gram_counts, batch) < 50


def test_a_worker_keeps_few_words():
    assert 2 * packing.KEPT_WORDS * 200 <= 50e6


def test_scoring_opens_one_block_at_a_time(monkeypatch):
    texts, blocks = _texts(100), []
    rows = [{"part": 0, "doc_id": i, "text_key": i, "lang": "en", "text": t} for i, t in enumerate(texts)]
    for k in range(0, 100, 10):
        (dealt,) = quality._dealt(iter([pa.RecordBatch.from_pylist(rows[k:k + 10])]))
        blocks.append(dealt)
    dealt = pa.Table.from_batches(blocks)
    (asked,) = quality._asked(iter(blocks))
    answers = pa.Table.from_batches([asked]).append_column("logp", pa.array(np.linspace(-3, -1, len(asked))))
    held, opened = [], quality._opened

    def watched(block):
        held.append(pa.total_allocated_bytes())
        return opened(block)
    monkeypatch.setattr(quality, "_opened", watched)
    scored = quality._scored(dealt, answers)
    assert len(held) == 10 and held[-1] - held[0] < 2 * sum(map(len, texts[:10]))
    of = dict(zip(zip(asked.column("high").to_pylist(), asked.column("gram").to_pylist(), strict=True),
                  answers.column("logp").to_pylist(), strict=True))
    points = lambda t: [0, 0, 0, *(ord(c) + 1 for c in t)]
    want = {i: -sum(of[p[j], p[j + 1] << 42 | p[j + 2] << 21 | p[j + 3]] for p in [points(texts[i])] for j in range(len(texts[i])))
            for i in (0, 55)}
    got = dict(zip(scored.column("doc_id").to_pylist(), scored.column("nll").to_pylist(), strict=True))
    assert len(got) == 100 and all(abs(got[i] - x) < 1e-6 * x for i, x in want.items())


def test_equal_sets_of_a_task_sign_once():
    texts = _texts(5, 300)
    once = [pa.RecordBatch.from_pydict({"text": texts})]
    again = [pa.RecordBatch.from_pydict({"text": [t.upper(), t]}) for t in texts * 3]
    rows = lambda it: [r for b in jaccard._signed(iter(it), 5, 80) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert sorted(rows(again)) == sorted(rows(once))
