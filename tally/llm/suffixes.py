"""Suffix dedup: byte strings of ``length`` that start more than once in the collection.

The order of all suffixes is built column by column, right to left, one symbol
per string and round, with the common prefixes of neighbours carried along
(Bauer, Cox and Rosone's construction for string collections).  Over whole
documents that is one pass over the collection's transform per byte of the
longest document, so the collection is first cut, without loss, into short
strings that can be worked on apart:

*   A window (a string of ``length`` bytes) has an anchor: the smallest hash of
    its ``GRAM``-byte grams, leftmost on ties.  Equal windows have equal anchors
    at equal distances.  A segment is a run of windows with one anchor; every
    window is in exactly one segment, at most ``2 * length - GRAM`` bytes long.
*   Segments of equal content are counted in Spark; where there are two or
    more, all their windows repeat.  An anchor with one content is done.
*   The contents of each other anchor, one copy each and aligned at the anchor,
    are the strings of the column-wise construction.  The shuffle's sorted files
    bring them shard by shard; a round touches one column, so a task holds one
    shard.  A neighbour that shares ``length`` symbols repeats a window.
*   An anchor with more than ``HOT_CONTENTS`` contents would be one large shard;
    its windows are counted by their own hashes, which Spark combines and splits.

All tests are on the input, never on what is left.

Nulls and edge cases: null text is empty; shorter texts have no window; rows of
equal text (also under one id) are separate documents and repeat each other;
the result of a row depends on its text only, so a null id is no special case;
an empty table gives an empty result.  Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.staging import shuffle_width, stage, table
from tally.llm.textcols import BASE, BASE_INV, mix, powers, ranges, text_slices

LENGTH = 400
GRAM = 32
HOT_CONTENTS = 20_000
SHARD_SEGMENTS = 4_000
#: Anchors are compared by the upper bits of their hash, then by place in a run of 2**PLACE_BITS bytes.
PLACE_BITS = 22
RUN = 1 << (PLACE_BITS - 1)

SEGMENT = "anchor long, content long, k1 long, k2 long, start long, n_windows long, lead long, n long"


def _sums(raw: np.ndarray) -> np.ndarray:
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(raw)), out=total[1:])
    return total


def _hash(total: np.ndarray, start: np.ndarray, size) -> np.ndarray:
    return mix((total[start + size] - total[start]) * powers(BASE_INV, len(total))[start])


def _window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values: block prefixes and suffixes."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    square = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    square[:len(values)] = values
    square = square.reshape(blocks, width)
    prefix = np.minimum.accumulate(square, axis=1).ravel()
    suffix = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[:n], prefix[width - 1:width - 1 + n])


def _runs(raw: np.ndarray, offsets: np.ndarray, length: int):
    """(first text, bytes, offsets, place of the first byte in its text): texts longer than RUN go in
    overlapping runs, so that each window is in one of them."""
    if len(offsets) == 2 and offsets[1] > RUN:
        step = RUN - length + 1
        for at in range(0, max(1, int(offsets[1]) - length + 1), step):
            part = raw[at:at + RUN]
            yield part, np.array([0, len(part)]), at
    else:
        yield raw, offsets, 0


def segments_of(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """text, start, windows, distance from the start to the anchor, anchor and content hash of every segment."""
    n = len(raw) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    total = _sums(raw)
    grams = _hash(total, np.arange(len(raw) - gram + 1), gram)
    places = np.uint64((1 << PLACE_BITS) - 1)
    grams = (grams & ~places) | np.arange(len(grams), dtype=np.uint64)
    least = _window_minimum(grams, length - gram + 1)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = text[:n] == text[length - 1:]
    new = inside.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    start = np.flatnonzero(new)
    stop = inside.copy()
    stop[:-1] &= (least[1:] != least[:-1]) | ~inside[1:]
    windows = np.flatnonzero(stop) - start + 1
    lead = (least[start] & places).astype(np.int64) - start
    content = _hash(total, start, windows + length - 1) ^ mix((lead * 65536 + windows).astype(np.uint64))
    return text[start], start, windows, lead, least[start] >> np.uint64(PLACE_BITS), content


def _segments(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "content", "k1", "k2", "start", "n_windows", "lead", "n"]
    for batch in batches:
        k1, k2 = (batch.column(k).to_numpy() for k in (0, 1))
        for a, z, raw, offsets in text_slices(batch.column(2), RUN // 2):
            # equal texts of the slice once, with their number
            _, first, copies = np.unique(np.rec.fromarrays([k1[a:z], k2[a:z]]), return_index=True, return_counts=True)
            n = np.zeros(z - a, np.int64)
            n[first] = copies
            for part, cuts, base in _runs(raw, offsets, length):
                text, start, windows, lead, anchor, content = segments_of(part, cuts, length, gram)
                keep = n[text] > 0
                text, start, windows, lead, anchor, content = (
                    x[keep] for x in (text, start, windows, lead, anchor, content))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                    anchor.view(np.int64), content.view(np.int64), k1[a:z][text], k2[a:z][text],
                    start - cuts[text] + base, windows, lead, n[text])], names=names)


def _fetched(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The wanted segments with their bytes."""
    names = ["anchor", "k1", "k2", "start", "n_windows", "lead", "single", "hot", "bytes"]
    for batch in batches:
        for row in batch.to_pylist():
            text = (row["text"] or "").encode()
            out = [(w["anchor"], row["k1"], row["k2"], w["start"], w["n_windows"], w["lead"], w["single"], w["hot"],
                    text[w["start"]:w["start"] + w["n_windows"] + length - 1]) for w in row["wanted"]]
            for at in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out[at:at + 20_000], strict=True)], names=names)


def shared_windows(strings: list[bytes], group: np.ndarray, lead: np.ndarray, length: int) -> list[np.ndarray]:
    """For each string, which of its windows another string of its group has at the same distance from the anchor.

    Round by round from the last column to the first: each string that has a symbol there puts it before its
    suffix; a stable sort by (group, symbol) keeps the suffixes ordered, and the common prefix of two new
    neighbours is one more than the least common prefix between their old places.
    """
    size = np.array([len(s) for s in strings])
    flat = np.frombuffer(b"".join(strings), np.uint8)
    at0 = np.concatenate(([0], np.cumsum(size)[:-1])) + lead  # flat place of column 0
    last, first = size - lead - 1, -lead
    hits = [np.zeros(max(0, n - length + 1), bool) for n in size]
    found_s: list[np.ndarray] = []
    found_c: list[int] = []
    starts_at = np.argsort(-last, kind="stable")
    nxt = 0
    order = np.zeros(0, np.int64)  # suffixes in order
    common = np.zeros(0, np.int64)  # common prefix with the one before
    for column in range(int(last.max()), int(first.min()) - 1, -1):
        begin = nxt
        while nxt < len(starts_at) and last[starts_at[nxt]] >= column:
            nxt += 1
        live = first[order] <= column
        if not live.all():  # a string has ended: its neighbours' common prefix is the least across it
            keep = np.flatnonzero(live)
            if len(keep):
                common = np.minimum.reduceat(common[:keep[-1] + 1], np.concatenate(([0], keep[:-1] + 1)))
            else:
                common = common[:0]
            order = order[keep]
        if nxt > begin:  # empty suffixes come first
            fresh = starts_at[begin:nxt]
            order = np.concatenate((fresh, order))
            common = np.concatenate((np.zeros(len(fresh), np.int64), common))
            if len(fresh) < len(common):
                common[len(fresh)] = 0
        if not len(order):
            continue
        key = group[order] * 256 + flat[at0[order] + column]
        by = np.argsort(key, kind="stable")
        key = key[by]
        same = np.zeros(len(by), bool)
        same[1:] = key[1:] == key[:-1]
        fresh_common = np.zeros(len(by), np.int64)
        k = np.flatnonzero(same)
        if len(k):
            p, q = by[k - 1], by[k]
            near = q == p + 1
            value = common[q]
            far = np.flatnonzero(~near)
            if len(far):
                cuts = np.empty(2 * len(far), np.int64)
                cuts[0::2], cuts[1::2] = p[far] + 1, q[far] + 1
                value[far] = np.minimum.reduceat(np.append(common, 0), cuts)[0::2]
            fresh_common[k] = value + 1
        order, common = order[by], fresh_common
        long_ = common >= length
        if long_.any():
            found = long_.copy()
            found[:-1] |= long_[1:]
            found_s.append(order[found])
            found_c.append(column)
    for s, c in zip(found_s, found_c, strict=True):
        for x in s:
            hits[x][c + lead[x]] = True
    return hits


def _columnwise(shard: pa.Table, length: int) -> pa.Table:
    strings = shard.column("bytes").to_pylist()
    _, group = np.unique(shard.column("anchor").to_numpy(), return_inverse=True)
    lead = shard.column("lead").to_numpy()
    single = shard.column("single").to_pylist()
    k1, k2, start = (shard.column(c).to_numpy() for c in ("k1", "k2", "start"))
    out: list[tuple] = []
    for x, hit in enumerate(shared_windows(strings, group.astype(np.int64), lead, length)):
        if single[x] and hit.any():
            edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
            out += [(k1[x], k2[x], start[x] + b, e - b) for b, e in zip(edge[::2], edge[1::2], strict=True)]
    cols = list(zip(*out, strict=True)) or [[], [], [], []]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("k1", "k2", "start", "n_windows"), cols, strict=True)})


def _window_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(hash, number, place) of every window of the segments of hot anchors."""
    for batch in batches:
        for row in batch.to_pylist():
            raw = np.frombuffer(row["bytes"], np.uint8)
            n = row["n_windows"]
            total = _sums(raw)
            first = _hash(total, np.arange(n), length)
            second = mix(first ^ _hash(total, np.arange(n) + length // 2, length // 2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), pa.array(np.full(n, row["k1"])),
                 pa.array(np.full(n, row["k2"])), pa.array(row["start"] + np.arange(n)),
                 pa.array(np.full(n, 1 if row["single"] else 2))], names=["h1", "h2", "k1", "k2", "start", "n"])


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        ("kept", pa.binary())])
    for batch in batches:
        lists = batch.column(2)
        for a, z, raw, offsets in text_slices(batch.column(1)):
            part = lists.slice(a, z - a)
            of = np.repeat(np.arange(z - a), part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            pairs = part.flatten()
            begin = pairs.field("start").to_numpy(zero_copy_only=False).astype(np.int64) + offsets[of]
            count = pairs.field("n_windows").to_numpy(zero_copy_only=False).astype(np.int64)
            n = len(raw)
            cover = np.zeros(n + 1, np.int32)
            np.add.at(cover, begin, 1)
            np.add.at(cover, begin + count + length - 1, -1)
            gone = np.cumsum(cover[:n]) > 0
            edge = np.zeros(n + 1, bool)
            edge[offsets] = True
            opens = np.flatnonzero(gone & (~np.append(False, gone[:-1]) | edge[:n]))
            closes = np.flatnonzero(gone & (~np.append(gone[1:], False) | edge[1:])) + 1
            total = np.concatenate(([0], np.cumsum(closes - opens)))
            owner = np.searchsorted(offsets, opens, side="right") - 1
            upto = np.searchsorted(owner, np.arange(z - a + 1))
            n_removed = total[upto[1:]] - total[upto[:-1]]
            sizes = np.diff(offsets)
            cuts = np.concatenate(([0], np.cumsum(sizes - n_removed)))
            kept = pa.Array.from_buffers(pa.binary(), z - a, [
                None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(raw[~gone].tobytes())])
            spans = pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.StructArray.from_arrays(
                [pa.array(opens - offsets[owner]), pa.array(closes - offsets[owner])], names=["start", "end"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, z - a), pa.array(sizes), pa.array(n_removed), spans, kept], schema=schema)


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                          gram: int = GRAM, hot_contents: int = HOT_CONTENTS) -> DataFrame:
    """One row per text: its bytes, removed spans and the kept bytes.

    Every byte that a string of ``length`` bytes covers which also starts elsewhere in the collection is removed.
    """
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                        F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))
    segments = stage(texts.select("k1", "k2", "text").mapInArrow(lambda it: _segments(it, length, gram), SEGMENT),
                     "segments")
    contents = segments.groupBy("anchor", "content").agg(
        F.sum("n").alias("n"), F.min(F.struct("k1", "k2", "start", "n_windows", "lead")).alias("one"))
    repeated = segments.join(contents.where("n > 1").select("anchor", "content"), ["anchor", "content"]) \
        .select("k1", "k2", "start", "n_windows").distinct()
    anchors = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("n_contents")).where("n_contents > 1")
    mixed = stage(contents.join(anchors, "anchor").select(
        "one.k1", "one.k2", "anchor", "one.start", "one.n_windows", "one.lead", (F.col("n") == 1).alias("single"),
        (F.col("n_contents") > hot_contents).alias("hot")), "mixed")
    shards = max(shuffle_width(docs.sparkSession), mixed.count() // SHARD_SEGMENTS)
    wanted = mixed.groupBy("k1", "k2").agg(F.collect_list(F.struct(
        "anchor", "start", "n_windows", "lead", "single", "hot")).alias("wanted"))
    # all columns of texts: its joins then shuffle one and the same frame, which Spark does once
    one_each = texts.join(wanted, ["k1", "k2"]).select("k1", "k2", "text", "wanted", "doc_id")

    def fetched(hot: bool) -> DataFrame:
        some = one_each.withColumn("wanted", F.filter("wanted", lambda w: w["hot"] == F.lit(hot)))
        return (some.where(F.size("wanted") > 0).mapInArrow(
            lambda it: _fetched(it, length), "anchor long, k1 long, k2 long, start long, n_windows long, lead long, "
                                             "single boolean, hot boolean, bytes binary"))

    spans = "k1 long, k2 long, start long, n_windows long"
    # copies of a text bring the same segments: one is kept
    cold = (fetched(False).dropDuplicates(["anchor", "k1", "k2", "start"])
            .withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard")
            .applyInArrow(lambda t: _columnwise(t, length), spans))
    rows = fetched(True).dropDuplicates(["anchor", "k1", "k2", "start"]).mapInArrow(
        lambda it: _window_rows(it, length), "h1 long, h2 long, k1 long, k2 long, start long, n long")
    often = rows.groupBy("h1", "h2").agg(F.sum("n").alias("n")).where("n > 1").select("h1", "h2")
    hot = rows.join(often, ["h1", "h2"]).select("k1", "k2", "start", F.lit(1).cast("long").alias("n_windows")).distinct()
    spans_by_text = repeated.unionByName(cold).unionByName(hot).groupBy("k1", "k2").agg(
        F.collect_list(F.struct("start", "n_windows")).alias("spans"))
    return (texts.join(spans_by_text, ["k1", "k2"], "left").select("doc_id", "text", "spans").mapInArrow(
        lambda it: _cut(it, length), "doc_id long, n_bytes long, n_removed long, "
                                     "spans array<struct<start:long,end:long>>, kept binary"))


def op4_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.col("kept"), 256).alias("kept_sha256"))
