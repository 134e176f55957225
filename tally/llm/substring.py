"""Substring dedup: repeated token windows found by Rabin-Karp hashes.

Every window of ``width`` consecutive words has a rolling 64-bit hash; a
window is removed where the same word sequence also starts in a document with
a smaller id, and overlapping windows merge into maximal removal intervals.

Counting every window of a corpus in one shuffle would move several times the
corpus, so the count has two steps, both over all windows:

1.  A window's anchor is the smallest hash of its ``GRAM``-word grams.  Equal
    windows have equal anchors, so a window whose anchor occurs in one document
    only cannot repeat.  About one (anchor, document) row per six windows is
    shuffled.
2.  Windows with a shared anchor are compared by their own hashes.  Rows are
    grouped by anchor in shards; an anchor in more than ``HOT_DOCS`` documents
    goes another way: its windows are aggregated to the smallest document per
    window (combined before the shuffle) and joined back, which Spark can split.

The lists of shared anchors and the repeated windows are stored, the latter in
``SHARES`` shares of the anchors one after another, so that what finds them is
gone from disk when the texts are cut.

Nulls and edge cases: null text is empty; a text of fewer than ``width`` words
has no window; a null id is no number, so its row loses nothing and takes
nothing from others; rows that share an id are not smaller than each other and
lose the same windows; an empty table gives an empty result.  Only the two
named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.llm.staging import passing, shuffle_width, stage, text_batches
from tally.llm.textcols import SMALL_SLICE, ranges, text_slices, window_hashes, word_hashes, words

WIDTH = 13
GRAM = 3
HOT_DOCS = 5_000
#: Shares of the anchors whose windows are shuffled one after another; each deals the texts anew.
SHARES = 2

RESULT = ("doc_id long, n_words long, n_removed long, "
          "spans array<struct<start:long,end:long>>, kept_text string")


def _windows(hashes: np.ndarray, row: np.ndarray, width: int, gram: int):
    """Row, hash and anchor position of every window, in order; ``row``: the text of each word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    own = np.flatnonzero(row[:n] == row[width - 1:])
    grams = window_hashes(hashes, gram)
    # leftmost smallest gram of each window
    best, at = grams[:n].copy(), np.arange(n)
    for shift in range(1, width - gram + 1):
        other = grams[shift:shift + n]
        less = other < best
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + shift
    return own, window_hashes(hashes, width)[own], at[own], best[own]


def _anchors(batches: Iterator[pa.RecordBatch], width: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for a, z, raw, offsets in text_slices(batch.column(1), SMALL_SLICE):
            s, e, upto = words(raw, offsets)
            row = np.repeat(np.arange(z - a), np.diff(upto))
            own, _, _, anchor = _windows(word_hashes(raw, s, e), row, width, gram)
            if not len(own):
                continue
            pairs = np.unique(np.rec.fromarrays([row[own], anchor], names="row,anchor"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs["anchor"].view(np.int64)), pa.array(ids[a:z][pairs["row"]].astype(np.int64))],
                names=["anchor", "place"])


def _shared_windows(batches: Iterator[pa.RecordBatch], width: int, gram: int) -> Iterator[pa.RecordBatch]:
    """(anchor, doc_id, hashes) for each text and each of its shared anchors."""
    for batch in batches:
        batch = batch.filter(batch.column(0).is_valid())
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        lists = batch.column(2)
        for a, z, raw, offsets in text_slices(batch.column(1), SMALL_SLICE):
            s, e, upto = words(raw, offsets)
            row = np.repeat(np.arange(z - a), np.diff(upto))
            own, hashes, _, anchor = _windows(word_hashes(raw, s, e), row, width, gram)
            if not len(own):
                continue
            part = lists.slice(a, z - a)
            shared = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            of = np.repeat(np.arange(z - a), part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            keep = _among(row[own], anchor, of, shared)
            r, h, g = row[own][keep], hashes[keep], anchor[keep]
            order = np.lexsort((h, g, r))
            r, h, g = r[order], h[order], g[order]
            first = np.ones(len(r), bool)
            first[1:] = (r[1:] != r[:-1]) | (g[1:] != g[:-1]) | (h[1:] != h[:-1])
            r, h, g = r[first], h[first], g[first]
            head = np.ones(len(r), bool)
            head[1:] = (r[1:] != r[:-1]) | (g[1:] != g[:-1])
            starts = np.flatnonzero(head)
            yield pa.RecordBatch.from_arrays(
                [pa.array(g[starts].view(np.int64)), pa.array(ids[a:z][r[starts]].astype(np.int64)),
                 _binaries(h, np.append(starts, len(h)))], names=["anchor", "doc_id", "hashes"])


def _binaries(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary column whose entries are the 8-byte values between the cuts."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1,
                                 [None, pa.py_buffer((cuts * 8).astype(np.int32)), pa.py_buffer(values.tobytes())])


def _among(row: np.ndarray, value: np.ndarray, of: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Whether (row, value) is one of the pairs (of, listed)."""
    if not len(listed) or not len(row):
        return np.zeros(len(row), bool)
    salt = lambda r: r.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    have = np.sort(listed + salt(of))
    want = value + salt(row)
    at = np.minimum(np.searchsorted(have, want), len(have) - 1)
    return have[at] == want


def _repeated_in_shard(group: pa.Table) -> pa.Table:
    """(doc_id, hashes) of the windows that a smaller document of the shard also has."""
    group = group.combine_chunks()
    doc = group.column("doc_id").to_numpy()
    column = group.column("hashes").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    h = np.frombuffer(column.buffers()[2], np.uint64, (offsets[-1] - offsets[0]) // 8, offsets[0])
    d = np.repeat(doc, np.diff(offsets) // 8)
    order = np.lexsort((d, h))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    lowest = d[new][np.cumsum(new) - 1]
    again = d > lowest
    h, d = h[again], d[again]
    order = np.argsort(d, kind="stable")
    h, d = h[order], d[order]
    starts = np.flatnonzero(np.append(True, d[1:] != d[:-1])) if len(d) else np.zeros(0, np.int64)
    return pa.table({"doc_id": pa.array(d[starts]), "hashes": _binaries(h, np.append(starts, len(h)))})


def _cut(batches: Iterator[pa.RecordBatch], width: int, verbatim: bool) -> Iterator[pa.RecordBatch]:
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
              ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string())]
    for batch in batches:
        schema = pa.schema(fields + [(n, c.type) for n, c in zip(batch.schema.names[3:], batch.columns[3:], strict=True)])
        lists = batch.column(2)
        for a, z, raw, offsets in text_slices(batch.column(1), SMALL_SLICE):
            s, e, upto = words(raw, offsets)
            row = np.repeat(np.arange(z - a), np.diff(upto))
            n = len(s)
            gone = np.zeros(n + 1, np.int64)
            part = lists.slice(a, z - a)
            named = batch.column(0).slice(a, z - a).is_valid().to_pylist()
            blobs = [b"".join(x) if x and y else b"" for x, y in zip(part.to_pylist(), named, strict=True)]
            of = np.repeat(np.arange(z - a), [len(x) // 8 for x in blobs])
            listed = np.frombuffer(b"".join(blobs), np.uint64)
            if len(listed):
                hashes = window_hashes(word_hashes(raw, s, e), width)
                own = np.flatnonzero(row[:len(hashes)] == row[width - 1:])
                hit = own[_among(row[own], hashes[own], of, listed)]
                np.add.at(gone, hit, 1)
                np.add.at(gone, hit + width, -1)
            removed = np.cumsum(gone[:n]) > 0
            total = np.concatenate(([0], np.cumsum(removed)))
            n_removed = total[upto[1:]] - total[upto[:-1]]
            edge = np.zeros(n + 1, bool)
            edge[upto] = True
            open_ = np.flatnonzero(removed & (~np.append(False, removed[:-1]) | edge[:n]))
            close = np.flatnonzero(removed & (~np.append(removed[1:], False) | edge[1:])) + 1
            owner = row[open_]
            spans = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(owner, np.arange(z - a + 1)).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(open_ - upto[owner]), pa.array(close - upto[owner])],
                                           names=["start", "end"]))
            kept = _joined(raw, s, e, upto, ~removed)
            if verbatim:
                kept = pc.if_else(pa.array(n_removed == 0), batch.column(1).slice(a, z - a), kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, z - a).cast(pa.int64()), pa.array(np.diff(upto)), pa.array(n_removed), spans, kept,
                 *(c.slice(a, z - a) for c in batch.columns[3:])], schema=schema)


def _joined(raw: np.ndarray, s: np.ndarray, e: np.ndarray, upto: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each text joined by one space."""
    row = np.repeat(np.arange(len(upto) - 1), np.diff(upto))[kept]
    s, e = s[kept], e[kept]
    last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    size = e - s + ~last
    out = raw[np.minimum(ranges(s, size), max(len(raw) - 1, 0))] if len(raw) else raw
    ends = np.cumsum(size)
    if len(out):
        out[(ends - 1)[~last]] = 32
    cuts = np.concatenate(([0], ends))[np.searchsorted(row, np.arange(len(upto)))]
    return pa.Array.from_buffers(pa.string(), len(upto) - 1,
                                 [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(out.tobytes())])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                   gram: int = GRAM, hot_docs: int = HOT_DOCS, carry: tuple[str, ...] = (), verbatim: bool = False) -> DataFrame:
    """One row per text: word counts, removal spans in words, and the kept text.

    A window of ``width`` words is removed where a row with a smaller id has it too.  The columns ``carry`` go along
    as ``carried_0``, ``carried_1`` and so on.  ``verbatim``: a text that loses nothing is kept as it is, white space
    included; otherwise kept words are joined by one space.
    """
    spark = docs.sparkSession
    carried = [F.col(c).alias(f"carried_{k}") for k, c in enumerate(carry)]
    own = F.col(id_col).cast("long")
    # joins go by ``place``, spread where there is no id
    texts = docs.select(own.alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.coalesce(own, F.xxhash64(F.col(text_col).cast("string"))).alias("place"), *carried)
    others = texts.columns[3:]
    anchors = texts.where("doc_id is not null").select("doc_id", "text").mapInArrow(
        lambda it: _anchors(it, width, gram), "anchor long, place long")
    shared = (anchors.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("anchor")))
              .where("n > 1").withColumn("hot", F.col("n") > hot_docs))

    shards = 8 * shuffle_width(spark)
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards))
    cold = [F.when(~F.col("hot") & (F.pmod(shard, F.lit(SHARES)) == k), F.col("anchor")) for k in range(SHARES)]
    hot = F.when(F.col("hot"), F.col("anchor"))
    with passing(spark) as here, text_batches(spark):
        lists = here(shared.groupBy("place").agg(*[F.collect_list(c).alias(f"cold_{k}") for k, c in enumerate(cold)],
                                                 F.collect_list(hot).alias("hot")), "anchors")

        def found(which: str) -> DataFrame:
            own = lists.where(F.size(which) > 0).select("place", F.col(which).alias("anchors"))
            return (texts.select("doc_id", "text", "place").join(own, "place").select("doc_id", "text", "anchors")
                    .mapInArrow(lambda it: _shared_windows(it, width, gram), "anchor long, doc_id long, hashes binary"))

        again = [stage(found(f"cold_{k}").withColumn("shard", shard).groupBy("shard")
                       .applyInArrow(_repeated_in_shard, "doc_id long, hashes binary"), "repeated") for k in range(SHARES)]
        if not lists.where(F.size("hot") > 0).isEmpty():
            each = here(found("hot").select(
                "doc_id", F.explode(F.transform(F.sequence(F.lit(0), (F.length("hashes") / 8).cast("int") - 1),
                                                lambda i: F.substring("hashes", i * 8 + 1, F.lit(8)))).alias("hashes")), "each")
            lowest = each.groupBy("hashes").agg(F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest"))
            again.append(stage(each.join(lowest.where("lowest < highest"), "hashes").where("doc_id > lowest")
                               .select("doc_id", "hashes"), "repeated"))
    repeated = (reduce(DataFrame.unionByName, again).groupBy(F.col("doc_id").alias("place"))
                .agg(F.collect_list("hashes").alias("hashes")))
    schema = RESULT + "".join(f", {f.name} {f.dataType.simpleString()}" for f in texts.schema.fields[3:])
    return (texts.join(repeated, "place", "left").select("doc_id", "text", "hashes", *others)
            .mapInArrow(lambda it: _cut(it, width, verbatim), schema))


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    from tally.llm.staging import table
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
