"""N-gram Jaccard join with PartEnum signatures.

A text's set is its distinct hashed shingles of ``width`` words.  Texts of
equal sets are one node.  Node sizes fall in bands whose ends are ``1 / J``
apart, so that linked sets lie in one band or in two neighbouring ones; a set
signs for its own band and for the next.  Within a band, linked sets differ in
at most ``k`` shingles (``k = (1 - J) / (1 + J) * 2 * largest size``), and:

*   ``k`` up to 4: the shingle domain is cut into 8 parts and every choice of
    ``8 - k`` parts is a signature; ``k`` differences leave one choice untouched.
*   larger ``k``: the domain is cut into ``k + 1 + spare`` parts, each part a
    signature; at least ``spare + 1`` parts are untouched.  An empty part says
    little, so it signs only in sets with more than ``spare`` empty parts: two
    linked sets share a part that is not empty, or both have that many.

So linked sets always share a signature, and mostly many: of ``k + 1 + spare``
parts at least ``spare + 1`` are untouched, and of those no more are empty than
in either set.  First each set of a signature is paired with the signature's
smallest set only; pairs that share as many signatures as the bound asks make
families, so a group of near copies costs a row per set and signature and not its
square.  Then a signature of up to ``BUCKET`` families gives their pairs, and a
pair stays if it shares as many signatures as the least demanding members ask;
sets that share one passage share one or two and go.  A signature of more
families (a crowd) is not counted and lowers the bound of its families' other
pairs by one.  A pair that shares crowds only can be linked only if both
families are in as many crowds as they must share signatures, so crowds are
looked at again with those families alone: one of up to ``BUCKET`` gives its
pairs, and in a larger one each family that is still in as many is tied to the
smallest (a star, not all pairs).  So a passage of very many texts makes no
group of them.  The components of the ties are the candidate groups.  The
shingles of the texts in a group are then fetched and all pairs of a group are
compared by exact intersection counts, in blocks: a group of more than ``CHUNK``
shingles or ``SETS`` sets is split into chunks and each pair of chunks is a
task's work, done in stripes of ``STRIPE`` sets.  A block gives a spanning forest
of its links, never the pairs.

Nulls and edge cases: null and empty texts have no set and link with nothing;
a text of fewer words than ``width`` is one shingle; equal texts and repeated
rows are one node; a null id can be no component's name, so a component of null
ids only is null; an empty table gives an empty result.  Only the two named
columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations, combinations_with_replacement, product
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.staging import passing, shuffle_width, stage, table, text_batches
from tally.llm.textcols import LOWER, SMALL_SLICE, mix, text_slices, window_hashes, word_hashes, words
from tally.operators.graph import connected_components

WIDTH = 3
PERCENT = 90
PARTS = 8
FULL_ENUMERATION = 4
#: Sets of a signature whose pairs are counted.
BUCKET = 64
#: Shares of the signatures, shuffled one after another: on disk is one share at a time, and each signs the texts anew.
SHARES = 2
#: Keys of candidate texts sent to every task up to this number; beyond it all texts are shuffled.
BROADCAST_KEYS = 2_000_000
#: A signature row's tag: band group times this, plus the number of signatures that a linked set must share.
TAG = 64
#: Shingles of a group that one block holds from each side.
CHUNK = 1_000_000
#: Sets that one block holds from each side, and sets and shingles of a comparison.
SETS = 20_000
STRIPE, WINDOW = 2000, 2048
#: A set's hashes keep 52 bits: the upper 12 number the texts of a slice.
KEEP = np.uint64((1 << 52) - 1)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of the distinct shingles, sorted by both; at most 4096 texts."""
    low = LOWER[raw]
    s, e, upto = words(low, offsets)
    h = word_hashes(low, s, e)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(upto))
    whole = window_hashes(h, width)
    own = np.flatnonzero(row[:len(whole)] == row[width - 1:]) if len(whole) else np.zeros(0, np.int64)
    row_of, value = [row[own]], [whole[own]]
    count = np.diff(upto)
    for n in range(1, width):  # shorter texts: the whole sequence
        short = np.flatnonzero(count == n)
        if len(short):
            row_of.append(short)
            value.append(mix(window_hashes(h, n)[upto[short]] + np.uint64(n)))
    key = (np.concatenate(row_of).astype(np.uint64) << np.uint64(52)) | (np.concatenate(value) >> np.uint64(12))
    key.sort()
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    return (key >> np.uint64(52)).astype(np.int64), key & KEEP


def set_digests(row: np.ndarray, value: np.ndarray, n_rows: int) -> np.ndarray:
    """64-bit digest of each row's set (order-free sum of mixed hashes, mixed with the size)."""
    sums = np.zeros(n_rows, np.uint64)
    np.add.at(sums, row, mix(value + np.uint64(0x51ED270B)))
    return mix(sums ^ mix(np.bincount(row, minlength=n_rows).astype(np.uint64)))


def bands(percent: int, upto: int, _kept: dict = {}) -> list[tuple[int, int]]:
    """Size bands (smallest, largest): neighbours hold every size linked to a size of the band.

    Results are kept in a default argument: it travels with a function that is pickled by value, as a cache wrapper's
    function does not.
    """
    if (percent, upto) in _kept:
        return _kept[percent, upto]
    out, low = [], 1
    while low <= upto:
        high = max(low, low * 100 // percent)
        out.append((low, high))
        low = high + 1
    _kept[percent, upto] = out
    return out


def plan(percent: int, group: int, upto: int, _kept: dict = {}) -> tuple[int, int, int]:
    """(differences, parts, spare) for sets of bands ``group - 1`` and ``group``."""
    if (percent, group, upto) not in _kept:
        _kept[percent, group, upto] = _plan(percent, group, upto)
    return _kept[percent, group, upto]


def _plan(percent: int, group: int, upto: int) -> tuple[int, int, int]:
    sizes = bands(percent, upto)
    high = sizes[group][1]
    low = sizes[max(0, group - 1)][0]
    k = 2 * high * (100 - percent) // (100 + percent)
    if k <= FULL_ENUMERATION:
        return k, PARTS, 0
    spare = 0
    while True:  # the fewest spare parts that leave about one set in a thousand signing for empty parts
        parts = k + 1 + spare
        mean = parts * exp(-low / parts)
        term = total = exp(-mean)
        for j in range(1, spare + 1):
            term *= mean / j
            total += term
        if 1 - total < 1e-3 or spare >= k:
            return k, parts, spare
        spare += 1


def signatures(row: np.ndarray, value: np.ndarray, n_rows: int, percent: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, signature and tag, for every signature of every row's set."""
    size = np.bincount(row, minlength=n_rows)
    upto = max(2 * int(size.max(initial=1)), 16)
    upto = 1 << upto.bit_length()
    ends = np.array([b for _, b in bands(percent, upto)])
    band = np.searchsorted(ends, size)
    out_row, out_sig, out_tag = [], [], []
    for shift in (0, 1):
        group = band + shift
        used = np.unique(group[size > 0])
        plans = {g: plan(percent, int(g), upto) for g in used.tolist()}
        k, parts, spare = (np.zeros(n_rows, np.int64) for _ in range(3))
        for g, (a, b, c) in plans.items():
            own = group == g
            k[own], parts[own], spare[own] = a, b, c
        # sets that may differ in no shingle are linked as equal sets already
        signs = (size > 0) & (k > 0)
        at = np.concatenate(([0], np.cumsum(np.where(signs, parts, 0))))
        keep = signs[row]
        r, v = row[keep], value[keep]
        spread = mix(v + np.uint64(0xA5A5)) >> np.uint64(32)
        slot = at[r] + ((spread * parts[r].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(at[-1], np.uint64)
        np.add.at(sums, slot, mix(v + np.uint64(0x77)))
        filled = np.bincount(slot, minlength=at[-1]) > 0
        of = np.repeat(np.arange(n_rows), np.where(signs, parts, 0))
        part = np.arange(at[-1]) - at[of]
        base = mix(group.astype(np.uint64) + np.uint64(1 << 32))
        # one part each
        single = k[of] > FULL_ENUMERATION
        empty = np.bincount(of[~filled], minlength=n_rows)
        take = np.flatnonzero(single & (filled | (empty > spare)[of]))
        need = np.where(k > FULL_ENUMERATION, np.clip(spare + 1 - empty, 1, TAG - 1), 1)
        tag = group * TAG + need
        out_row.append(of[take])
        out_tag.append(tag[of[take]])
        out_sig.append(mix(sums[take] + base[of[take]] + mix(part[take].astype(np.uint64))))
        # all choices of PARTS - k parts
        for n in range(1, FULL_ENUMERATION + 1):
            rows = np.flatnonzero(signs & (k == n))
            if not len(rows):
                continue
            block = sums[at[rows][:, None] + np.arange(PARTS)]
            block = mix(block + mix(np.arange(PARTS, dtype=np.uint64))[None, :])
            for number, chosen in enumerate(combinations(range(PARTS), PARTS - n)):
                out_row.append(rows)
                out_tag.append(tag[rows])
                out_sig.append(mix(block[:, chosen].sum(axis=1, dtype=np.uint64) + base[rows]
                                   + mix(np.array([1000 + number], np.uint64))))
    return np.concatenate(out_row), np.concatenate(out_sig), np.concatenate(out_tag)


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_key, n, node) of every row; node is null without a set."""
    for batch in batches:
        for a, z, raw, offsets in text_slices(batch.column(2), SMALL_SLICE, rows=4096):
            row, value = shingle_sets(raw, offsets, width)
            n = np.bincount(row, minlength=z - a)
            node = set_digests(row, value, z - a).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a), batch.column(1).slice(a, z - a),
                                              pa.array(n), pa.array(node, mask=n == 0)],
                                             names=["doc_id", "text_key", "n", "node"])


def _signed(batches: Iterator[pa.RecordBatch], width: int, percent: int, share: int = 0, shares: int = 1
            ) -> Iterator[pa.RecordBatch]:
    """(signature, node, tag), for one of so many shares of the signatures: equal sets of a task sign once."""
    known: set[int] = set()
    for batch in batches:
        for a, z, raw, offsets in text_slices(batch.column(0), SMALL_SLICE, rows=4096):
            row, value = shingle_sets(raw, offsets, width)
            node = set_digests(row, value, z - a)
            one = np.zeros(z - a, bool)
            for k, x in enumerate(node.tolist()):
                if x not in known:
                    known.add(x)
                    one[k] = True
            keep = one[row]
            r, sig, tag = signatures(row[keep], value[keep], z - a, percent)
            if shares > 1:
                own = np.flatnonzero(sig % np.uint64(shares) == share)
                r, sig, tag = r[own], sig[own], tag[own]
            for at in range(0, len(r), 50_000):
                some = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig[some].view(np.int64)), pa.array(node[r[some]].view(np.int64)),
                     pa.array(tag[some].astype(np.int32))], names=["signature", "node", "tag"])


def _shingles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(node, group, n_chunks, shingles) of the wanted texts."""
    for batch in batches:
        for a, z, raw, offsets in text_slices(batch.column(3), SMALL_SLICE, rows=4096):
            row, value = shingle_sets(raw, offsets, width)
            cuts = np.searchsorted(row, np.arange(z - a + 1))
            blobs = [value[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(a, z - a) for k in range(3)),
                                              pa.array(blobs, pa.binary())],
                                             names=["node", "group", "n_chunks", "shingles"])


def _links(left: tuple, right: tuple, percent: int) -> np.ndarray:
    """Which sets of two stripes reach ``percent``; a stripe is (sizes, owner, column), sorted by column."""
    (sizes, owner, column), (sizes_r, owner_r, column_r) = left, right
    total = np.zeros((len(sizes), len(sizes_r)), np.float32)
    both = np.intersect1d(column, column_r)
    for at in range(0, len(both), WINDOW):
        some = both[at:at + WINDOW]
        parts = []
        for n, own, col in ((len(sizes), owner, column), (len(sizes_r), owner_r, column_r)):
            x, y = np.searchsorted(col, [some[0], some[-1] + 1])
            place = np.searchsorted(some, col[x:y])
            ok = some[place] == col[x:y]
            part = np.zeros((n, len(some)), np.float32)
            part[own[x:y][ok], place[ok]] = 1
            parts.append(part)
        total += parts[0] @ parts[1].T
    union = sizes[:, None] + sizes_r[None, :] - total.astype(np.float64)
    return 100 * total.astype(np.float64) >= percent * union


def linked(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among ``sets``; where ``side`` has two values, only across them.  Stripes of sets
    are compared pair by pair, so memory does not grow with the square of their number."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat, back, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    upto = np.concatenate(([0], np.cumsum(sizes)))
    stripes: list[list] = [[], []]
    for k in (0, 1):
        rows = np.flatnonzero(side == bool(k))
        for a in range(0, len(rows), STRIPE):
            some = rows[a:a + STRIPE]
            entry = np.concatenate([back[upto[r]:upto[r + 1]] for r in some])
            owner = np.repeat(np.arange(len(some)), sizes[some])
            keep = shared[entry]
            owner, column = owner[keep], number[entry[keep]]
            order = np.argsort(column, kind="stable")
            stripes[k].append((some, (sizes[some], owner[order], column[order])))
    if side.any():
        pairs = product(*stripes)
    else:
        pairs = combinations_with_replacement(stripes[0], 2)
    component, edges = np.arange(m), []
    for (rows, left), (cols, right) in pairs:
        held = np.unique(component[np.concatenate((rows, cols))])
        if len(held) == 1:  # one class already
            continue
        link = _links(left, right, percent)
        open_ = np.ones(len(cols), bool)
        done = np.zeros(len(rows), bool)
        for start in np.flatnonzero(link.any(axis=1)):
            if done[start]:
                continue
            reached, front = [int(rows[start])], np.array([start])
            while len(front):
                done[front] = True
                found = np.flatnonzero(link[front].any(axis=0) & open_)
                open_[found] = False
                reached += cols[found].tolist()
                front = np.flatnonzero(link[:, found].any(axis=1) & ~done)
                reached += rows[front].tolist()
            names, first = np.unique(component[reached], return_index=True)
            if len(names) > 1:
                edges += [(reached[0], reached[int(x)]) for n, x in zip(names, first, strict=True) if n != component[reached[0]]]
                component[np.isin(component, names)] = names[0]
    return edges


def _verified(block: pa.Table, percent: int) -> pa.Table:
    """Link forest of the (group, i, j) works of a block: (src, dst)."""
    block = block.combine_chunks()
    node = block.column("node").to_numpy()
    key = np.stack([block.column(c).to_numpy() for c in ("group", "i", "j")], axis=1)
    chunk = block.column("chunk").to_numpy()
    order = np.lexsort((key[:, 2], key[:, 1], key[:, 0]))
    key = key[order]
    cuts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
    shingles = block.column("shingles")
    src, dst = [], []
    for x, y in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
        rows = order[x:y]
        if y - x < 2:
            continue
        sets = [np.frombuffer(shingles[int(r)].as_py(), np.uint64) for r in rows]
        i, j = key[x, 1], key[x, 2]
        for a, b in linked(sets, (chunk[rows] == j) & (i != j), percent):
            src.append(node[rows[a]])
            dst.append(node[rows[b]])
    return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})


def _ties(*signed: DataFrame) -> DataFrame:
    """(src, dst) from (signature, node, tag), in shares with signatures of their own: ties whose components hold every two
    nodes that may be linked.

    What a signature gathers is only ever combined map-side, or joined from a stored table straight into another one,
    where AQE splits a signature of very many rows.
    """
    with passing(signed[0].sparkSession) as here:
        return stage(_tied(signed, here), "ties")


def _tied(signed: tuple[DataFrame, ...], stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    met = []
    for share in signed:
        repeated = stage(share.groupBy("signature").agg(F.min("node").alias("first"), F.max("node").alias("last"))
                         .where("first != last").drop("last"), "repeated")
        met.append(stage(share.join(repeated.hint("merge"), "signature"), "met"))
    shared = stage(reduce(DataFrame.unionByName, met).groupBy("signature", "node")
                   .agg(F.min("tag").alias("tag"), F.min("first").alias("first")), "shared")

    # near copies: a node that shares enough signatures with their smallest node is of its family
    near = stage(shared.where("node != first").groupBy("node", "first", F.floor(F.col("tag") / TAG).alias("group"))
                 .agg(F.count(F.lit(1)).alias("times"), F.min(F.col("tag") % TAG).alias("need")).where("times >= need")
                 .select(F.col("node").alias("src"), F.col("first").alias("dst")).distinct(), "near")
    members = near.select(F.col("src").alias("id")).union(near.select(F.col("dst").alias("id"))).distinct()
    families = connected_components(members, near).select(F.col("id").alias("node"), F.col("component").alias("family"))
    cells = stage(shared.join(families, "node", "left").groupBy("signature", F.coalesce("family", "node").alias("family"))
                  .agg(F.min("tag").alias("tag")), "cells")

    # pairs of families, whose least demanding members stand for the rest
    several = stage(cells.groupBy("signature").agg(F.count(F.lit(1)).alias("n"), F.min("family").alias("first"))
                    .where("n > 1"), "several")
    cells = stage(cells.join(several.hint("merge"), "signature"), "families")
    counted, crowd = cells.where(F.col("n") <= BUCKET), cells.where(F.col("n") > BUCKET)
    group = F.floor(F.col("tag") / TAG).alias("group")
    of = ["family", "group"]
    rest = stage(crowd.groupBy("family", group).agg(F.count(F.lit(1)).alias("more"), F.min(F.col("tag") % TAG).alias("least")),
                 "rest")
    # a pair may share crowds only, if both families are in as many as their least demanding member must share
    able = rest.where("more >= least")
    again = stage(crowd.select("signature", "family", "tag", group).join(able.select(*of), of), "able")
    several = stage(again.groupBy("signature").agg(F.count(F.lit(1)).alias("n"), F.min("family").alias("first"))
                    .where("n > 1"), "several")
    again = stage(again.join(several.hint("merge"), "signature"), "crowds")
    left = again.where(F.col("n") > BUCKET).groupBy(*of).agg(F.count(F.lit(1)).alias("left"))
    able = stage(able.join(left, of, "left").select(*of, "least", F.coalesce("left", F.lit(0)).alias("left")), "left")

    counted = (counted.select("signature", "family", "tag")
               .union(again.where(F.col("n") <= BUCKET).select("signature", "family", "tag")))
    sets = (counted.groupBy("signature")
            .agg(F.sort_array(F.collect_list(F.struct("family", "tag"))).alias("m")))  # at most BUCKET
    pairs = (sets.select("m", F.posexplode("m").alias("i", "a"))
             .select("a", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("b"))
             .groupBy(F.col("a.family").alias("src"), F.col("b.family").alias("dst"),
                      F.floor(F.col("a.tag") / TAG).alias("group"))
             .agg(F.count(F.lit(1)).alias("times"), F.min(F.greatest(F.col("a.tag") % TAG, F.col("b.tag") % TAG)).alias("need")))
    rest = rest.join(able.select(*of, "left"), of, "left").select(*of, "more", "left")
    for end in ("src", "dst"):
        pairs = pairs.join(rest.withColumnsRenamed({c: end if c == "family" else f"{end}_{c}" for c in ("family", "more", "left")}),
                           [end, "group"], "left")
    # of two families that are able, all crowds but those left are counted
    more = F.when(F.col("src_left").isNotNull() & F.col("dst_left").isNotNull(), F.least("src_left", "dst_left")
                  ).otherwise(F.least(F.coalesce("src_more", F.lit(0)), F.coalesce("dst_more", F.lit(0))))
    stars = (again.where((F.col("n") > BUCKET) & (F.col("family") != F.col("first")))
             .join(able.where("left >= least").select(*of), of, "left_semi")
             .select(F.col("family").alias("src"), F.col("first").alias("dst")))
    return (pairs.where(F.col("times") + more >= F.col("need")).select("src", "dst").union(stars).distinct()
            .union(near))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                       percent: int = PERCENT, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_shingles, component_id, component, text_key) of every row: rows whose sets reach ``percent`` of
    Jaccard are linked.  ``component`` numbers the classes (null without a set), ``text_key`` is a hash of the text."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    with text_batches(spark):
        sets = stage(texts.mapInArrow(lambda it: _sets(it, width), "doc_id long, text_key long, n long, node long"), "sets")

        signed = [texts.select("text").mapInArrow(lambda it, own=share: _signed(it, width, percent, own, SHARES),
                                                  "signature long, node long, tag int") for share in range(SHARES)]
        ties = _ties(*signed)
        nodes = ties.select(F.col("src").alias("id")).union(ties.select(F.col("dst").alias("id"))).distinct()
        groups = connected_components(nodes, ties).select(F.col("id").alias("node"), F.col("component").alias("group"))

        one = sets.where("node is not null").groupBy("node").agg(F.min("text_key").alias("text_key"), F.max("n").alias("n"))
        wanted = one.join(groups, "node")
        shares = wanted.groupBy("group").agg(
            F.greatest(F.ceil(F.sum("n") / chunk), F.ceil(F.count(F.lit(1)) / SETS)).alias("n_chunks"))
        wanted = stage(wanted.join(shares, "group").select("text_key", "node", "group", "n_chunks", "n"), "wanted")
        total, found = wanted.agg(F.sum(F.col("n") * F.col("n_chunks")), F.count(F.lit(1))).first()
        blocks = max(shuffle_width(spark), (total or 0) // chunk + 1)
        if found <= BROADCAST_KEYS:  # others stay where they are
            texts = texts.join(F.broadcast(wanted.select("text_key")), "text_key", "left_semi")
        # one plan at every size: a few groups would else be broadcast and the texts stay where they are
        fetched = (texts.select("text_key", "text").join(wanted.drop("n").hint("merge"), "text_key")
                   .dropDuplicates(["text_key"])  # of copies one; where the join has put them
                   .select("node", "group", "n_chunks", "text").mapInArrow(
                       lambda it: _shingles(it, width), "node long, group long, n_chunks long, shingles binary"))
        own = F.pmod(F.xxhash64("node"), F.col("n_chunks"))
        dealt = (fetched.withColumn("chunk", own)
                 .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_chunks") - 1)))
                 .select("node", "group", "chunk", F.least("chunk", "other").alias("i"),
                         F.greatest("chunk", "other").alias("j"), "shingles")
                 .withColumn("block", F.pmod(F.xxhash64("group", "i", "j"), F.lit(blocks))))
        links = stage(dealt.groupBy("block").applyInArrow(lambda t: _verified(t, percent), "src long, dst long"), "links")

    ends = links.select(F.col("src").alias("id")).union(links.select(F.col("dst").alias("id"))).distinct()
    named = connected_components(ends, links).select(F.col("id").alias("node"), F.col("component"))
    of = sets.join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = of.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("name"))
    return (of.join(names, "component", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("name")).alias("component_id"),
                    "component", "text_key"))


def op2_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
