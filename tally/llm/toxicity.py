"""Toxicity: a linear-chain conditional random field over the words of a text.

Two states, clean and toxic.  A word's emission is a sum of hashed features
(the word, its first 3 to 6 letters, its last 3); transitions are learned too.
Forward-backward marginals of every word give the spans (runs of words at or
above one half, as character offsets) and, through a small logistic model of
the largest marginal and of the expected number of toxic words, the document's
score.

Only documents are labelled, so the labelled words come from them: among the
learning documents a feature names toxicity where at least ``MIN_TEXTS`` toxic
texts and (almost) no clean text have it, and a word of a toxic text with such
a feature is labelled toxic.  Near copies would make any word of theirs look
so; of learning rows with one smallest shingle hash only one teaches.

The model is fitted on at most ``TOXIC_ROWS`` and ``CLEAN_ROWS`` learning rows
of at most ``LEARN_CHARS`` characters (those with the smallest hashed id).
Scoring is one pass over whole texts; the model has a fixed size.

Nulls and edge cases: a null or empty text has no word and gets the score of
none; null labels and null ids teach nothing; a null id is held out; an id with
different labels counts as toxic if one says so; without toxic or without clean
learning rows every score is 0; empty tables give an empty result.  Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.staging import table
from tally.llm.textcols import BASE, BASE_INV, codepoints, letters, mix, powers, text_slices, window_hashes

FEATURE_BITS = 20
PREFIXES = (3, 4, 5, 6)
SUFFIX = 3
MIN_TEXTS = 4
PURITY = 0.97
TOXIC_ROWS = 1000
CLEAN_ROWS = 2000
LEARN_CHARS = 10_000
SEQUENCE = 128
THRESHOLD = 0.7


@dataclass
class Model:
    weights: np.ndarray  # of each hashed feature: log-odds of toxic over clean
    bias: float
    transition: np.ndarray  # 2 x 2, log: from state, to state
    start: float
    judge: np.ndarray  # logistic: bias, largest marginal (log-odds), log(1 + expected words)


def tokens(raw: np.ndarray, offsets: np.ndarray):
    """Runs of letters: text, first and past-last character in the text, and the feature hashes (a row each)."""
    alpha, lower = letters()
    points, upto = codepoints(raw, offsets)
    n = len(points)
    is_letter = alpha[points]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(upto))
    edge = np.ones(n + 1, bool)
    edge[1:n] = text[1:] != text[:-1]
    padded = np.concatenate(([False], is_letter, [False]))
    s = np.flatnonzero(padded[1:-1] & (~padded[:-2] | edge[:n]))
    e = np.flatnonzero(padded[1:-1] & (~padded[2:] | edge[1:])) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((lower[points].astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=total[1:])
    back = powers(BASE_INV, n + 1)
    hashed = [mix((total[e] - total[s]) * back[s])]
    for k in PREFIXES:
        hashed.append(mix((total[np.minimum(s + k, e)] - total[s]) * back[s] + np.uint64(k)))
    tail = np.maximum(s, e - SUFFIX)
    hashed.append(mix((total[e] - total[tail]) * back[tail] + np.uint64(99)))
    owner = text[s] if n else s
    return owner, s - upto[owner], e - upto[owner], np.stack(hashed)


def _slots(hashed: np.ndarray) -> np.ndarray:
    return (hashed >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _scan(a00, a01, a10, a11) -> np.ndarray:
    """Running products of 2x2 matrices applied to (1, 1), each normalised: share of the second component.

    Blocks of about sqrt(n) matrices are multiplied side by side, joined one after another, then run again
    from the vector that enters each of them, so it is exact and linear.
    """
    n = len(a00)
    width = max(1, int(np.sqrt(n)))
    blocks = -(-n // width)
    pad = blocks * width - n
    square = [np.concatenate((x, np.full(pad, one))).reshape(blocks, width).T.copy()
              for x, one in ((a00, 1.0), (a01, 0.0), (a10, 0.0), (a11, 1.0))]
    m00, m01, m10, m11 = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
    for j in range(width):
        x00, x01, x10, x11 = (s[j] for s in square)
        m00, m01, m10, m11 = (x00 * m00 + x01 * m10, x00 * m01 + x01 * m11, x10 * m00 + x11 * m10, x10 * m01 + x11 * m11)
        scale = m00 + m01 + m10 + m11
        m00, m01, m10, m11 = m00 / scale, m01 / scale, m10 / scale, m11 / scale
    v0, v1 = np.empty(blocks), np.empty(blocks)
    p, q = 0.5, 0.5
    for k, (b00, b01, b10, b11) in enumerate(zip(m00.tolist(), m01.tolist(), m10.tolist(), m11.tolist(), strict=True)):
        v0[k], v1[k] = p, q
        p, q = b00 * p + b01 * q, b10 * p + b11 * q
        p, q = p / (p + q), q / (p + q)
    out = np.empty((width, blocks))
    for j in range(width):
        v0, v1 = square[0][j] * v0 + square[1][j] * v1, square[2][j] * v0 + square[3][j] * v1
        scale = v0 + v1
        v0, v1 = v0 / scale, v1 / scale
        out[j] = v1
    return out.T.ravel()[:n]


def marginals(emission: np.ndarray, first: np.ndarray, transition: np.ndarray, start: float) -> np.ndarray:
    """Probability of the toxic state at every word; ``first``: whether it begins a text."""
    if not len(emission):
        return np.zeros(0)
    e = np.exp(np.clip(emission, -30, 30))
    t = np.exp(transition)
    a00, a01 = np.where(first, 1.0, t[0, 0]), np.where(first, 1.0, t[1, 0])
    a10, a11 = np.where(first, np.exp(start), t[0, 1]) * e, np.where(first, np.exp(start), t[1, 1]) * e
    ahead = _scan(a00, a01, a10, a11)
    # backward: the transposed matrices from the end; the vector before word t is what word t - 1 needs
    back = _scan(a00[::-1], a10[::-1], a01[::-1], a11[::-1])[::-1]
    behind = np.append(back[1:], 0.5)
    toxic, clean = ahead * behind, (1 - ahead) * (1 - behind)
    return toxic / (toxic + clean)


def _chunks(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and place of every word when texts are cut into sequences of SEQUENCE words."""
    begin = np.searchsorted(owner, owner)
    place = np.arange(len(owner)) - begin
    new = place % SEQUENCE == 0
    return np.cumsum(new) - 1, place % SEQUENCE


def fit_crf(slots: np.ndarray, owner: np.ndarray, labels: np.ndarray, epochs: int = 4, batch: int = 256,
            rate: float = 0.3, l2: float = 1e-5) -> tuple[np.ndarray, float, np.ndarray, float]:
    """Emission weights, bias, transitions and start by AdaGrad on the conditional log-likelihood."""
    sequence, place = _chunks(owner)
    size = 1 << FEATURE_BITS
    w, seen = np.zeros(size), np.full(size, 1e-3)
    small, small_seen = np.zeros(6), np.full(6, 1e-3)  # bias, start, transitions row by row
    small[0], small[1], small[2:] = -2.0, 0.0, [1.0, -1.0, 0.5, -0.5]
    n_seq = int(sequence[-1]) + 1
    cuts = np.searchsorted(sequence, np.arange(n_seq + 1))
    random = np.random.default_rng(7)
    for _ in range(epochs):
        for some in np.array_split(random.permutation(n_seq), max(1, n_seq // batch)):
            some = np.sort(some)
            rows = np.concatenate([np.arange(cuts[k], cuts[k + 1]) for k in some])
            x = w[slots[:, rows]].sum(axis=0) + small[0]
            first = place[rows] == 0
            y = labels[rows]
            transition = small[2:].reshape(2, 2)
            p = marginals(x, first, transition, small[1])
            grad = p - y
            n = len(some)
            g = np.bincount(slots[:, rows].ravel(), np.tile(grad, len(slots)), minlength=size) / n
            touched = np.flatnonzero(g)
            g = g[touched] + l2 * w[touched]
            seen[touched] += g * g
            w[touched] -= rate * g / np.sqrt(seen[touched])
            inner = np.flatnonzero(~first)
            pair = _pair_marginals(x, first, transition, small[1], inner)
            true = np.array([((y[inner - 1] == a) & (y[inner] == b)).sum() for a in (0, 1) for b in (0, 1)])
            h = np.concatenate(([grad.sum()], [grad[first].sum()], pair - true)) / n
            small_seen += h * h
            small -= 0.1 * h / np.sqrt(small_seen)
    return w, float(small[0]), small[2:].reshape(2, 2), float(small[1])


def _pair_marginals(x, first, transition, start, inner) -> np.ndarray:
    """Expected number of each transition over the words ``inner`` (not first in their text)."""
    e, t = np.exp(np.clip(x, -30, 30)), np.exp(transition)
    a00, a01 = np.where(first, 1.0, t[0, 0]), np.where(first, 1.0, t[1, 0])
    a10, a11 = np.where(first, np.exp(start), t[0, 1]) * e, np.where(first, np.exp(start), t[1, 1]) * e
    ahead = _scan(a00, a01, a10, a11)
    behind = np.append(_scan(a00[::-1], a10[::-1], a01[::-1], a11[::-1])[::-1][1:], 0.5)
    f, b, ei = ahead[inner - 1], behind[inner], e[inner]
    each = np.stack([(1 - f) * t[0, 0] * (1 - b), (1 - f) * t[0, 1] * ei * b,
                     f * t[1, 0] * (1 - b), f * t[1, 1] * ei * b])
    return (each / each.sum(axis=0)).sum(axis=1)


def _summary(p: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """(1, log-odds of the largest marginal, log(1 + expected toxic words)) of each text."""
    top, total = np.zeros(n), np.bincount(owner, p, minlength=n)
    np.maximum.at(top, owner, p)
    # marginals of clean words add up in long texts: count what is above a tenth
    total = np.bincount(owner, np.where(p >= 0.1, p, 0), minlength=n)
    top = np.clip(top, 1e-4, 1 - 1e-4)
    return np.stack([np.ones(n), np.log(top / (1 - top)) / 4, np.log1p(total)], axis=1)


def fit_judge(x: np.ndarray, y: np.ndarray, l2: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(w))
        w = w - np.linalg.solve(h, x.T @ (p - y) + l2 * w)
    return w


def fit(texts: list[str], toxic: np.ndarray) -> Model | None:
    """A model from whole texts and their labels; None without both kinds."""
    if not toxic.any() or toxic.all():
        return None
    column = pa.array(texts, pa.string())
    parts = []
    for a, _, raw, offsets in text_slices(column):
        owner, _, _, hashed = tokens(raw, offsets)
        parts.append((owner + a, hashed))
    owner = np.concatenate([o for o, _ in parts])
    hashed = [[h[r] for _, h in parts] for r in range(len(parts[0][1]))]
    del parts
    slots = np.empty((len(hashed), len(owner)), np.int32)
    marked = np.zeros(len(owner), bool)
    is_toxic = toxic.astype(bool)[owner]
    n_toxic, n_clean = int(toxic.sum()), int((1 - toxic).sum())
    need = MIN_TEXTS if n_toxic >= 20 * MIN_TEXTS else 2
    for r in range(len(hashed)):  # a row at a time, so that the driver holds few of them
        row, hashed[r] = np.concatenate(hashed[r]), []
        slots[r] = _slots(row)
        if r == len(hashed) - 1:  # the last letters alone name nothing
            break
        u, back = np.unique(row, return_inverse=True)
        pair = np.unique(back.astype(np.int64) * (len(texts) + 1) + owner)
        f, t = pair // (len(texts) + 1), toxic[pair % (len(texts) + 1)]
        in_toxic = np.bincount(f, t, minlength=len(u))
        in_clean = np.bincount(f, 1 - t, minlength=len(u))
        rate = in_toxic / n_toxic
        marked |= ((in_toxic >= need) & (rate / (rate + in_clean / n_clean) >= PURITY))[back] & is_toxic
    w, bias, transition, start = fit_crf(slots, owner, marked.astype(float))
    p = marginals(sum(w[row] for row in slots) + bias, np.append(True, owner[1:] != owner[:-1]), transition, start)
    judge = fit_judge(_summary(p, owner, len(texts)), toxic.astype(float))
    return Model(w.astype(np.float32), bias, transition, start, judge)


def _scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    for batch in batches:
        for a, z, raw, offsets in text_slices(batch.column(1)):
            owner, s, e, hashed = tokens(raw, offsets)
            x = np.full(len(owner), model.bias)
            for row in hashed:
                x += model.weights[_slots(row)]
            first = np.append(True, owner[1:] != owner[:-1])[:len(owner)]
            p = marginals(x, first, model.transition, model.start)
            score = 1 / (1 + np.exp(-_summary(p, owner, z - a) @ model.judge))
            bad = p >= 0.5
            opens = np.flatnonzero(bad & (first | ~np.append(False, bad[:-1])[:len(bad)]))
            closes = np.flatnonzero(bad & np.append(first[1:] | ~bad[1:], True)[:len(bad)])
            top = np.maximum.reduceat(p, np.stack([opens, closes + 1], 1).ravel()[:-1])[::2] if len(opens) else p[:0]
            spans = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(owner[opens], np.arange(z - a + 1)).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(s[opens]), pa.array(e[closes]), pa.array(top)],
                                           fields=list(span)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a), pa.array(score), spans],
                                             names=["doc_id", "score", "spans"])


def _smallest_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, toxic, copy): copy is the smallest hash of three consecutive words."""
    for batch in batches:
        for a, z, raw, offsets in text_slices(batch.column(2)):
            owner, _, _, hashed = tokens(raw, offsets)
            h = window_hashes(hashed[0], 3)
            own = owner[:len(h)] == owner[2:] if len(h) else np.zeros(0, bool)
            least = np.full(z - a, np.iinfo(np.uint64).max)
            np.minimum.at(least, owner[:len(h)][own], h[own])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a), batch.column(1).slice(a, z - a),
                                              pa.array(least.view(np.int64))], names=["doc_id", "toxic", "copy"])


def learning_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], np.ndarray]:
    """Texts and labels of the bounded sample; ``docs``: doc_id, text; ``labels``: doc_id, toxic."""
    marks = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("toxic")))
    by_hash = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    limit = F.when(F.col("toxic") == 1, TOXIC_ROWS).otherwise(CLEAN_ROWS)
    # twice the rows that are wanted, as near copies go
    chosen = marks.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= 2 * limit).drop("rank")
    some = (docs.join(F.broadcast(chosen), "doc_id")  # at most 2 * (TOXIC_ROWS + CLEAN_ROWS) rows
            .where(F.length("text").between(1, LEARN_CHARS)).select("doc_id", "toxic", "text"))
    copies = some.mapInArrow(_smallest_shingle, "doc_id long, toxic int, copy long")
    one = (copies.groupBy("copy", "toxic").agg(F.min("doc_id").alias("doc_id"))
           .withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= limit).select("doc_id"))
    rows = some.join(F.broadcast(one), "doc_id").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return [r["text"] for r in rows], np.array([r["toxic"] for r in rows], dtype=np.int64)


def score(docs: DataFrame, labels: DataFrame, learn=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, spans) of every row; ``learn``: condition on doc_id of the label rows to learn from."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    model = fit(*learning_sample(texts, marks if learn is None else marks.where(learn)))
    schema = "doc_id long, score double, spans array<struct<start:long,end:long,score:double>>"
    if model is None:
        return texts.select("doc_id", F.lit(0.0).alias("score"), F.array().cast(schema[schema.index("array"):]).alias("spans"))
    return texts.mapInArrow(lambda it: _scores(it, model), schema)


def held_out(id_col: str = "doc_id"):
    """Whether the checksum of the id as text leaves 1 modulo 3; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    found = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out())
    return found.select("doc_id", held_out().alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                        F.size("spans").cast("long").alias("n_spans"))
