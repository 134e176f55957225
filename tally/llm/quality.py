"""Quality classifier: perplexity under a Kneser-Ney model of trusted text.

The model of each language is an interpolated modified Kneser-Ney model of
character 4-grams over all of Unicode: every code point is a symbol of its own,
none is folded into another, so the count tables grow with what the trusted
text holds.  Tasks count the n-grams of all trusted rows, Spark sums the
counts, and the lower orders (distinct left neighbours), discounts and back-off
weights are grouped and joined from them by (language, n-gram): no table is
collected or broadcast.

An n-gram of whole symbols has 84 bits: ``high`` is its first symbol, ``gram``
the other three.  The same model over a folded alphabet of 61 classes
(``FOLDED``) has its n-gram in ``gram`` alone.

Scoring joins the other way round.  Texts are dealt to batches of about
``BATCH_BYTES``; each batch asks for its distinct (language, n-gram) pairs, the
pairs of all batches get their probability from the sharded count tables once,
and the answers go back to the batch, where each text adds up its own.  The
texts are shuffled once, those that a task deals to one batch compressed
together (row by row they take half as much again on disk), and what is joined
follows the distinct n-grams of batches, not the corpus' characters.

A text's perplexity per character is smoothed towards its language's mean by
``PRIOR`` characters, as short texts vary.  The threshold of a language is the
``QUANTILE`` of that perplexity over the trusted rows of one fold (checksum of
the id modulo 5 is 0) that the counts leave out; rows above it are rejected.

Nulls and edge cases: a null or empty text has the mean perplexity and is kept;
a null language is a language of its own (``und``); a language without trusted
rows has no threshold and keeps its rows, one whose trusted rows are all in one
fold takes that fold for both; labels that are null or disagree for an id are
not trusted; rows that share an id are scored each; empty tables give an empty
result.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.staging import stage, table, text_batches
from tally.llm.textcols import codepoints, letters, text_slices

ORDER = 4
BITS = 6
CLASSES = 61


class Alphabet(NamedTuple):
    """Bits of a symbol in an n-gram, and the number of symbols (0 is none of them: it stands before a text)."""
    bits: int
    size: int


FOLDED = Alphabet(BITS, CLASSES)
WHOLE = Alphabet(21, 0x110000)
PRIOR = 200
QUANTILE = 0.995
BATCH_BYTES = 16 << 20
#: Bytes of texts whose n-grams are made at once, a dozen 8-byte values a character.
GRAM_SLICE = 256 << 10
#: Bytes of rows that a task holds before it deals them to their batches, and of blocks that it hands on at once.
DEAL_BYTES = 16 << 20
SEND_BYTES = 1 << 20
#: Trusted ids sent to every task up to this number (16 bytes each); beyond it they are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def _classes() -> np.ndarray:
    """Class 1..61 of every code point; 0 stands for what is before a text."""
    import sys

    kept = sys.__dict__.setdefault("_tally_classes", [])
    if not kept:
        alpha, lower = letters()
        points = np.arange(0x110000)
        of = np.full(0x110000, 61, np.uint8)
        other = alpha & (points > 127)
        of[other] = 40 + points[other] % 20
        of[97:123] = np.arange(1, 27)
        of[alpha & (lower != points)] = 27
        of[48:58] = 28
        of[[32, 10]] = 29, 30
        for k, c in enumerate(".,;:!?-'\""):
            of[ord(c)] = 31 + k
        kept.append(of)
    return kept[0]


def _codes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and n-gram code (the class and the ORDER - 1 before it) of every character."""
    points, upto = codepoints(raw, offsets)
    sign = _classes()[points].astype(np.uint32)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(upto))
    at = np.arange(len(sign)) - upto[text]
    code = sign.copy()
    for k in range(1, ORDER):
        before = np.zeros(len(sign), np.uint32)
        before[k:] = sign[:-k] if k < len(sign) else 0
        before[at < k] = 0
        code |= before << np.uint32(BITS * k)
    return text, code


def _symbol_grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, Callable]:
    """Text and local code of the n-gram of every character, and what turns codes into (high, gram), as two rows.

    Symbols are code points + 1.  A code packs the numbers of the slice's different symbols, or, where four of those do
    not fit 64 bits, the numbers of its different pairs.
    """
    points, upto = codepoints(raw, offsets)
    seen = np.zeros(WHOLE.size, bool)
    seen[points] = True
    kinds = np.flatnonzero(seen)
    number = np.zeros(WHOLE.size, np.uint64)
    number[kinds] = np.arange(1, len(kinds) + 1)
    sign, bits = number[points], max(1, len(kinds).bit_length())
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(upto))
    at = np.arange(len(sign)) - upto[text]
    back = [sign]
    for k in range(1, ORDER):
        before = np.zeros(len(sign), np.uint64)
        before[k:] = sign[:-k] if k < len(sign) else 0
        before[at < k] = 0
        back.append(before)
    symbols = np.concatenate(([0], kinds + 1)).astype(np.uint64)
    wide = np.uint64(WHOLE.bits)

    def joined(last: list[np.ndarray]) -> np.ndarray:
        c1, c2, c3, c4 = (symbols[c.astype(np.int64)] for c in last)
        return np.stack((c4, c3 << wide << wide | c2 << wide | c1))
    if bits * ORDER <= 64:
        of, one = [np.uint64(bits * k) for k in range(ORDER)], np.uint64((1 << bits) - 1)
        code = back[0] | back[1] << of[1] | back[2] << of[2] | back[3] << of[3]
        return text, code, lambda codes: joined([codes >> k & one for k in of])
    half, one = np.uint64(32), np.uint64((1 << WHOLE.bits) - 1)
    ends, end = np.unique(back[0] | back[1] << wide, return_inverse=True)
    heads, head = np.unique(back[2] | back[3] << wide, return_inverse=True)

    def split(codes):
        e, h = ends[(codes & np.uint64((1 << 32) - 1)).astype(np.int64)], heads[(codes >> half).astype(np.int64)]
        return joined([e & one, e >> wide, h & one, h >> wide])
    return text, end.astype(np.uint64) | head.astype(np.uint64) << half, split


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, block): a task's rows of each part, compressed together without ``part``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= DEAL_BYTES:
            yield from _blocks(held)
            held, size = [], 0
    if held:
        yield from _blocks(held)


def _blocks(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(held)
    part = rows.column("part").to_numpy()
    order = np.argsort(part, kind="stable")
    parts, first = np.unique(part[order], return_index=True)
    rows, names, blocks = rows.drop_columns("part"), [], []
    for n, x, y in zip(parts.tolist(), first, np.append(first[1:], len(order)), strict=True):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
            out.write_table(rows.take(pa.array(order[x:y])).combine_chunks())
        names.append(n)
        blocks.append(sink.getvalue().to_pybytes())
        if n == parts[-1] or sum(map(len, blocks)) >= SEND_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(blocks, pa.binary())], names=["part", "block"])
            names, blocks = [], []


def _opened(block: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(block.as_buffer()).read_all()


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_gram_counts`` of dealt rows."""
    def rows():
        for batch in batches:
            for part, block in zip(batch.column("part").to_pylist(), batch.column("block"), strict=True):
                for some in _opened(block).to_batches():
                    yield some.append_column("part", pa.array(np.full(len(some), part, np.int64)))
    return _gram_counts(rows())


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, lang, high, gram, n) of a task's rows (with part, lang and text)."""
    sums: dict[tuple, list] = {}
    for batch in batches:
        parts, langs = batch.column("part").to_numpy(zero_copy_only=False), batch.column("lang").to_pylist()
        for a, z, raw, offsets in text_slices(batch.column("text"), GRAM_SLICE):
            text, code, whole = _symbol_grams(raw, offsets)
            keys = list(zip(parts[a:z].tolist(), langs[a:z], strict=True))
            number = {k: i for i, k in enumerate(dict.fromkeys(keys))}
            own = np.array([number[k] for k in keys])[text]
            for key, i in number.items():
                found, n = np.unique(code[own == i], return_counts=True)
                held = sums.setdefault(key, [])
                held.append((whole(found), n))
                # what is held stays within twice the different n-grams, and few n-grams are merged often
                if len(held) > 8 and sum(len(x) for _, x in held[1:]) > len(held[0][1]):
                    sums[key] = [_merged(held)]
    for (part, lang), held in sums.items():
        gram, n = _merged(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), part, np.int64)), pa.array([lang] * len(n), pa.string()),
             pa.array(gram[0].astype(np.int32)), pa.array(gram[1].astype(np.int64)), pa.array(n.astype(np.int64))],
            names=["part", "lang", "high", "gram", "n"])


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gram, n = np.concatenate([g for g, _ in found], axis=1), np.concatenate([n for _, n in found])
    order = np.lexsort(gram)
    gram, n = gram[:, order], n[order]
    first = np.flatnonzero(np.append(True, (gram[:, 1:] != gram[:, :-1]).any(axis=0))[:len(n)])
    return gram[:, first], np.add.reduceat(n, first) if len(first) else n


def _last(order: int, a: Alphabet) -> Column:
    """The last ``order`` symbols (fewer than ORDER)."""
    return F.col("gram").bitwiseAND(F.lit((1 << (a.bits * order)) - 1))


def _before(order: int, a: Alphabet) -> Column:
    """All symbols of an n-gram of ``order`` but its last."""
    shorter = F.shiftright("gram", a.bits)
    return shorter.bitwiseOR(F.shiftleft(F.col("high").cast("long"), (ORDER - 2) * a.bits)) if _split(order, a) else shorter


def _split(order: int, a: Alphabet) -> bool:
    """Whether n-grams of ``order`` have their first symbol apart."""
    return order == ORDER and a.bits * ORDER > 63


def _key(order: int, a: Alphabet) -> list[str]:
    return ["lang", "high", "gram"] if _split(order, a) else ["lang", "gram"]


def kneser_ney(counts: DataFrame, alphabet: Alphabet = FOLDED) -> list[tuple[DataFrame, DataFrame]]:
    """From (lang, high and gram, n) of the highest order: for each order 1..ORDER the table (lang, gram, share) of
    discounted shares and the table (lang, before, weight) of back-off weights per context."""
    tables, grams = [], counts
    for order in range(ORDER, 0, -1):
        key = _key(order, alphabet)
        n = [F.sum((F.col("n") == k).cast("double")) for k in (1, 2, 3, 4)]
        ones, twos, threes, fours = (F.greatest(F.col(f"n{k}"), F.lit(1.0)) for k in (1, 2, 3, 4))
        y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
        bounded = lambda d, top: F.greatest(F.lit(0.05), F.least(F.coalesce(d, F.lit(0.5)), F.lit(top)))
        rates = (grams.groupBy("lang").agg(*[x.alias(f"n{k}") for k, x in enumerate(n, 1)])
                 .select("lang", bounded(1 - 2 * y * twos / ones, 0.95).alias("d1"),
                         bounded(2 - 3 * y * threes / twos, 1.9).alias("d2"),
                         bounded(3 - 4 * y * fours / threes, 2.85).alias("d3")))
        off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        cut = (grams.join(rates, "lang").withColumn("off", off)
               .select(*key, "n", "off", _before(order, alphabet).alias("before")))
        before = (cut.groupBy("lang", "before").agg(F.sum("n").alias("total"), F.sum("off").alias("left"))
                  .select("lang", "before", "total", (F.col("left") / F.col("total")).alias("weight")))
        shares = (cut.join(before, ["lang", "before"])
                  .select(*key, ((F.col("n") - F.col("off")) / F.col("total")).alias("share")))
        # stored, so that neither plans nor work pile up over the orders
        tables.append((stage(shares, f"shares-{order}"), stage(before.select("lang", "before", "weight"), f"weights-{order}")))
        if order > 1:
            grams = stage(grams.groupBy("lang", _last(order - 1, alphabet).alias("gram"))
                          .agg(F.count(F.lit(1)).alias("n")), f"grams-{order - 1}")
    return tables[::-1]


def log_probabilities(asked: DataFrame, counts: DataFrame, alphabet: Alphabet = FOLDED) -> DataFrame:
    """(lang, high and gram, logp) of the distinct n-grams of ``asked``."""
    key = _key(ORDER, alphabet)
    out = asked.select(*key).distinct().withColumn("p", F.lit(1.0 / alphabet.size))
    for order, (shares, weights) in enumerate(kneser_ney(counts, alphabet), 1):
        if order == ORDER:
            out, own = out.withColumn("before", _before(order, alphabet)), key
        else:
            out = out.withColumn("own", _last(order, alphabet)).withColumn("before", F.shiftright("own", alphabet.bits))
            shares, own = shares.withColumnRenamed("gram", "own"), ["lang", "own"]
        out = (out.join(shares, own, "left")
               .join(weights, ["lang", "before"], "left")
               .withColumn("p", F.coalesce(F.coalesce("share", F.lit(0.0)) + F.col("weight") * F.col("p"), F.col("p")))
               .select(*key, "p"))
    return out.select(*key, F.log("p").alias("logp"))


def _lookup(known: np.ndarray, values: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """What gives each (high, gram) its value; all that are asked are among ``known``."""
    highs, grams = np.unique(known[0]), np.unique(known[1])

    def number(of):
        return np.searchsorted(grams, of[1]) * len(highs) + np.searchsorted(highs, of[0])
    ids = number(known)
    order = np.argsort(ids)
    ids, values = ids[order], values[order]
    return lambda asked: values[np.searchsorted(ids, number(asked))]


def _scored(dealt: pa.Table, answers: pa.Table) -> pa.Table:
    """Characters and summed negative log probability of each text of a batch; one block of texts is open at a time."""
    answers = answers.combine_chunks()
    asked = np.array(answers.column("lang").to_pylist(), dtype=object)
    gram = np.stack([answers.column(c).to_numpy().astype(np.uint64) for c in ("high", "gram")])
    logp = answers.column("logp").to_numpy()
    found = {lang: _lookup(gram[:, own], logp[own]) for lang in dict.fromkeys(asked.tolist()) for own in [asked == lang]}
    out = []
    for chunk in dealt.column("block").chunks:
        for block in chunk:
            texts = _opened(block).combine_chunks()
            langs = np.array([x or "" for x in texts.column("lang").to_pylist()], dtype=object)
            for lang in dict.fromkeys(langs.tolist()):
                rows = pa.array(np.flatnonzero(langs == lang))
                n, sums = _sums(texts.column("text").take(rows), found.get(lang))
                out.append(pa.table({"doc_id": texts.column("doc_id").take(rows), "text_key": texts.column("text_key").take(rows),
                                     "lang": pa.array([lang] * len(rows), pa.string()), "n_chars": pa.array(n), "nll": pa.array(sums)}))
    return pa.concat_tables(out).combine_chunks()


def _sums(column: pa.ChunkedArray, value: Callable | None) -> tuple[np.ndarray, np.ndarray]:
    n, sums = np.zeros(len(column), np.int64), np.zeros(len(column))
    for a, z, raw, offsets in text_slices(column, GRAM_SLICE):
        text, code, whole = _symbol_grams(raw, offsets)
        if not len(code):
            continue
        kinds, at = np.unique(code, return_inverse=True)
        n[a:z] = np.bincount(text, minlength=z - a)
        sums[a:z] = -np.bincount(text, value(whole(kinds))[at], minlength=z - a)
    return n, sums


def perplexities(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 lang_col: str = "lang", quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, lang, n_chars, perplexity, threshold, trusted, rejected, text_key) of every row; ``trusted``: ids in
    ``doc_id``; ``text_key``: hash of the text, which tells rows that share an id apart."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("text_key"))
    ids = trusted.select(F.col("doc_id").cast("long")).where("doc_id is not null").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    schema = "part long, lang string, high int, gram long, n long"
    known = rows.join(ids, "doc_id", "left_semi")
    by_fold = stage(known.select(learn.cast("long").alias("part"), "lang", "text").mapInArrow(_gram_counts, schema)
                    .groupBy("part", "lang", "high", "gram").agg(F.sum("n").alias("n")), "gram-counts")
    # the threshold fold is left out, unless a language has nothing else
    use = by_fold.groupBy("lang").agg(F.max("part").alias("part"))
    counts = stage(by_fold.join(use, ["lang", "part"]).select("lang", "high", "gram", "n"), "counts")

    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // BATCH_BYTES))
    dealing = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)))
    with text_batches(docs.sparkSession):
        dealt = dealing.mapInArrow(_dealt, "part long, block binary").repartition(parts, "part")
        # all columns of ``dealt``: asking and scoring then read one shuffle of the texts; a part is one task's, so its
        # pairs are distinct
        asked = dealt.mapInArrow(_asked, schema).select("part", "lang", "high", "gram")
        answers = (asked.join(log_probabilities(asked, counts, WHOLE), _key(ORDER, WHOLE))
                   .select("part", "lang", "high", "gram", "logp"))
        scored = stage(dealt.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
            _scored, "doc_id long, text_key long, lang string, n_chars long, nll double")
            .join(ids.withColumn("trusted", F.lit(True)), "doc_id", "left")
            .withColumn("trusted", F.coalesce("trusted", F.lit(False))), "nll")

    judges = scored.where("trusted").withColumn("part", learn.cast("long"))
    judges = judges.join(judges.groupBy("lang").agg(F.min("part").alias("part")), ["lang", "part"])
    mean = judges.groupBy("lang").agg((F.sum("nll") / F.greatest(F.sum("n_chars"), F.lit(1))).alias("mean"))
    smooth = lambda df: df.join(mean, "lang", "left").withColumn("perplexity", F.exp(
        (F.col("nll") + PRIOR * F.coalesce("mean", F.log(F.lit(WHOLE.size)))) / (F.col("n_chars") + PRIOR)))
    limits = smooth(judges).groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"))
    return (smooth(scored).join(limits, "lang", "left")
            .select("doc_id", "lang", "n_chars", "perplexity", "threshold", "trusted",
                    F.coalesce(F.col("perplexity") > F.col("threshold"), F.lit(False)).alias("rejected"), "text_key"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids whose labels all say good quality."""
    return (labels.groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"))
            .where("q = 1").select("doc_id"))


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return perplexities(table(spark, sf_dir, "documents"), trusted_ids(table(spark, sf_dir, "labels")))
