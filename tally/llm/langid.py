"""Language ID: multinomial logistic regression on TF-IDF character n-grams.

Features are hashed 1- to 3-grams of lower-case letters (anything else is one
boundary mark).  Document frequencies are counted over all learning rows in
Spark; the weights are fitted by follow-the-regularised-leader (FTRL-proximal
with an elastic net, so most weights are exactly zero) on at most
``PER_LANGUAGE`` rows of each language, those with the smallest hashed id;
a temperature, fitted on a part of that sample kept apart, calibrates the
probabilities.  Prediction is one pass over the texts; the weights, at most
``2**FEATURE_BITS`` values a language, go to the tasks.

Nulls and edge cases: a text that is null or has no letter is ``und`` with
score 0; null lang and null id teach nothing; a null id counts as held out;
ties go to the first language by name; with nothing to learn from every row is
``und``; empty tables give an empty result.  Only the three named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.staging import table
from tally.llm.textcols import SMALL_SLICE, codepoints, letters, mix, text_slices

FEATURE_BITS = 16
ORDERS = (1, 2, 3)
#: Learning rows of each language; the first CALIBRATION share of them sets the temperature only.
PER_LANGUAGE = 1000
CALIBRATION = 0.2
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # feature x language, inverse document frequency included
    bias: np.ndarray
    temperature: float


def _grams(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: text and feature of every n-gram that holds a letter."""
    alpha, lower = letters()
    points, upto = codepoints(raw, offsets)
    is_letter = alpha[points]
    sign = np.where(is_letter, lower[points], 32).astype(np.uint64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(upto))
    for order in ORDERS:
        n = len(sign) - order + 1
        if n <= 0:
            continue
        code = np.full(n, order, np.uint64)
        some = np.zeros(n, bool)
        for k in range(order):
            code = (code << np.uint64(21)) | sign[k:k + n]
            some |= is_letter[k:k + n]
        some &= text[:n] == text[order - 1:]
        yield text[:n][some], (mix(code[some]) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, number of texts with it) of a task's texts, and their number as feature -1."""
    total, n = np.zeros(1 << FEATURE_BITS, np.int64), 0
    for batch in batches:
        for a, z, raw, offsets in text_slices(batch.column(0), SMALL_SLICE):
            found = list(_grams(raw, offsets))
            cuts = [np.searchsorted(t, np.arange(z - a + 1)) for t, _ in found]
            for k in range(z - a):
                has = np.zeros(1 << FEATURE_BITS, bool)
                for (_, f), c in zip(found, cuts, strict=True):
                    has[f[c[k]:c[k + 1]]] = True
                total += has
            n += z - a
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], n))],
                                     names=["feature", "n"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, key, features, counts) of each text as int32 arrays."""
    for batch in batches:
        for a, z, raw, offsets in text_slices(batch.column(2), SMALL_SLICE):
            found = list(_grams(raw, offsets))
            cuts = [np.searchsorted(t, np.arange(z - a + 1)) for t, _ in found]
            features, counts = [], []
            for k in range(z - a):
                own = np.zeros(1 << FEATURE_BITS, np.int32)
                for (_, f), c in zip(found, cuts, strict=True):
                    own += np.bincount(f[c[k]:c[k + 1]], minlength=1 << FEATURE_BITS).astype(np.int32)
                some = np.flatnonzero(own).astype(np.int32)
                features.append(some.tobytes())
                counts.append(own[some].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a), batch.column(1).slice(a, z - a),
                                              pa.array(features, pa.binary()), pa.array(counts, pa.binary())],
                                             names=["lang", "key", "features", "counts"])


def fit_ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], n_classes: int, epochs: int = 3, alpha: float = 1.0,
             beta: float = 1.0, l1: float = 0.01, l2: float = 0.01) -> tuple[np.ndarray, np.ndarray]:
    """Weights (feature x class) and bias by FTRL-proximal, one row at a time in the given order."""
    size = 1 << FEATURE_BITS
    z, n = np.zeros((size + 1, n_classes)), np.zeros((size + 1, n_classes))

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - l1, 0)
        return -shrunk / ((beta + np.sqrt(ns)) / alpha + l2)

    for _ in range(epochs):
        for label, index, value in rows:
            at, x = np.append(index, size), np.append(value, 1.0)
            w = weights(z[at], n[at])
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[label] -= 1
            g = x[:, None] * p
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
    w = weights(z, n)
    return w[:size], w[size]


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of least log loss, by golden section on its logarithm."""
    def loss(t: float) -> float:
        s = scores / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), labels]))

    if not len(labels):
        return 1.0
    low, high, ratio = np.log(0.05), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(rows: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """``rows``: key, text, lang of the learning rows.  None if there are none."""
    rows = rows.where("lang is not null and text is not null and key is not null")
    frequencies = (rows.select("text").mapInArrow(_document_frequencies, "feature long, n long")
                   .groupBy("feature").agg(F.sum("n").alias("n")).collect())  # at most 2**FEATURE_BITS + 1 rows
    df, total = np.zeros(1 << FEATURE_BITS), 0
    for r in frequencies:
        if r["feature"] < 0:
            total = r["n"]
        else:
            df[r["feature"]] = r["n"]
    if not total:
        return None
    idf = np.log((1 + total) / (1 + df)) + 1
    order = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key")
    chosen = rows.select("lang", "key").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language)
    # at most per_language rows of each language
    sample = (rows.join(F.broadcast(chosen.select("lang", "key").distinct()), ["lang", "key"]).select("lang", "key", "text")
              .mapInArrow(_counts, "lang string, key long, features binary, counts binary").collect())
    languages = sorted({r["lang"] for r in sample})
    of = {x: k for k, x in enumerate(languages)}
    vectors = []
    for r in sorted(sample, key=lambda r: (mix_key(r["key"]), r["key"], r["lang"])):
        f, c = np.frombuffer(r["features"], np.int32), np.frombuffer(r["counts"], np.int32)
        if len(f):
            vectors.append((of[r["lang"]], f, c / c.sum() * idf[f]))
    apart = int(len(vectors) * CALIBRATION)
    weights, bias = fit_ftrl(vectors[apart:], len(languages))
    scores = np.array([v @ weights[f] + bias for _, f, v in vectors[:apart]]).reshape(apart, len(languages))
    temperature = fit_temperature(scores, np.array([k for k, _, _ in vectors[:apart]], dtype=int))
    return Model(languages, weights * idf[:, None], bias, temperature)


def mix_key(key: int) -> int:
    return int(mix(np.array([key], np.int64).view(np.uint64))[0])


def _predicted(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    n_lang = len(model.languages)
    for batch in batches:
        for a, z, raw, offsets in text_slices(batch.column(1), SMALL_SLICE):
            sums, size = np.zeros((z - a, n_lang)), np.zeros(z - a)
            for text, feature in _grams(raw, offsets):
                size += np.bincount(text, minlength=z - a)
                for k in range(n_lang):
                    sums[:, k] += np.bincount(text, weights=model.weights[:, k][feature], minlength=z - a)
            scores = (sums / np.maximum(size, 1)[:, None] + model.bias) / model.temperature
            scores -= scores.max(axis=1, keepdims=True)
            p = np.exp(scores)
            p /= p.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            named = [model.languages[k] if size[i] else UNKNOWN for i, k in enumerate(best)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, z - a), pa.array(named, pa.string()),
                 pa.array(np.where(size > 0, p[np.arange(z - a), best], 0.0)), batch.column(2).slice(a, z - a)],
                names=["doc_id", "lang_pred", "score", "text_key"])


def identify(docs: DataFrame, learn: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """(doc_id, lang_pred, score, text_key) of every row (``text_key``: hash of the text), by a model fitted on ``learn`` (default: all of ``docs``)."""
    named = (F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    learn = docs if learn is None else learn
    model = fit(learn.select(named[0].alias("key"), named[1].alias("text"), F.col(lang_col).cast("string").alias("lang")))
    texts = docs.select(named[0].alias("doc_id"), named[1].alias("text"), F.xxhash64(named[1]).alias("text_key"))
    if model is None:
        return texts.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), "text_key")
    return texts.mapInArrow(lambda it: _predicted(it, model),
                            "doc_id long, lang_pred string, score double, text_key long")


def held_out(id_col: str = "doc_id"):
    """Whether the checksum of the id as text is a multiple of 5; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, docs.where(~held_out())).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
