"""SentencePiece encoding by sampling, and decoding.

A text's segmentations form a lattice over its characters with an edge for
every vocabulary piece; characters without a piece fall back to byte pieces.
Forward filtering sums the weights of all paths into every position, backward
sampling draws edges from the end with those sums, so that a segmentation comes
up with its share of the total weight.  The draws are hashes of (row key, unit
number, step): a row's sample does not depend on batches, partitions or runs.

A vocabulary of merges ranks its pieces instead of scoring them; a piece then
weighs 1 / (1 + rank) (Zipf's law), to the power ``alpha``.  Where no piece
crosses a position, the lattice falls into units (a run of spaces and the word
after it, mostly).  A slice filters each distinct unit once and samples all its
occurrences side by side.

Encoding puts one space before the text and writes spaces as U+2581; a U+2581
of the text itself always goes by bytes, so decoding gives back every text.

Nulls and edge cases: a null text is encoded as the empty one, which has no ids;
a null key draws as 0; rows that share key and text get the same sample, equal
texts under other keys their own; an empty table gives an empty result.  Only
the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.llm.staging import table
from tally.llm.textcols import BASE, BASE_INV, codepoints, mix, powers, ranges, text_slices

ALPHA = 1.0
SPACE_MARK = 0x2581
SLICE = 2 << 20


class Vocabulary:
    """Pieces of a model file as arrays."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        scores = np.array([model.get_score(i) for i in range(size)])
        ranked = bool((scores == np.round(scores)).all())
        weight = alpha * (-np.log1p(-scores) if ranked else scores)
        self.byte_ids = np.full(256, -1, np.int64)
        decoded: list[bytes] = []
        known: dict[str, int] = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                decoded.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                decoded.append(b"")
            else:
                known[piece] = i
                decoded.append(piece.replace(chr(SPACE_MARK), " ").encode())
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary has no byte pieces, so not every text can be encoded")
        self.byte_weight = float(alpha * -np.log1p(size)) if ranked else float(scores.min()) * alpha
        starts = {p[:n] for p in known for n in range(1, len(p) + 1)}
        longer = {p[:n] for p in known for n in range(1, len(p))}
        self.longest = max(map(len, known))
        names = sorted(starts)
        hashes = np.array([self._hash(p) for p in names], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.piece = np.array([known.get(p, -1) for p in names])[order]
        self.goes_on = np.array([p in longer for p in names])[order]
        self.weight = weight
        self.sizes = np.array([len(d) for d in decoded])
        self.at = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.bytes = np.frombuffer(b"".join(decoded), np.uint8)
        # characters between which a piece can cross: no piece has them side by side with anything
        self.joined = np.zeros(0x110001, bool)
        for p in known:
            if len(p) > 1:
                self.joined[[ord(c) for c in p]] = True
        for p in known:  # units start at a space run: no piece may hold a mark after another character
            if chr(SPACE_MARK) in p.lstrip(chr(SPACE_MARK)):
                raise ValueError("a piece crosses a space")

    @staticmethod
    def _hash(piece: str) -> int:
        total = 0
        for k, c in enumerate(piece):
            total += (ord(c) + 1) * pow(int(BASE), k, 1 << 64)
        return int(mix(np.array([total % (1 << 64)], np.uint64))[0])


def vocabulary(path: str, alpha: float) -> Vocabulary:
    """Kept by the worker."""
    import sys

    kept = sys.__dict__.setdefault("_tally_vocabularies", {})
    if (path, alpha) not in kept:
        kept[path, alpha] = Vocabulary(path, alpha)
    return kept[path, alpha]


def lattice(points: np.ndarray, place: np.ndarray, size: np.ndarray, v: Vocabulary):
    """Edges (start node, piece or -1, weight) sorted by end node, and the first edge of every node.

    ``points``: characters of the units one after another; ``place``, ``size``: place in its unit and length of the
    unit of each.  Unit u's node after j characters is (its first character) + j + u.
    """
    n = len(points)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=total[1:])
    back = powers(BASE_INV, n + 1)
    unit = np.cumsum(place == 0) - 1
    node = np.arange(n) + unit
    active = np.arange(n)
    starts, ends, pieces = [], [], []
    lone = np.ones(n, bool)
    for length in range(1, v.longest + 1):
        active = active[place[active] + length <= size[active]]
        if not len(active):
            break
        h = mix((total[active + length] - total[active]) * back[active])
        at = np.minimum(np.searchsorted(v.hashes, h), len(v.hashes) - 1)
        ok = v.hashes[at] == h
        active, at = active[ok], at[ok]
        found = v.piece[at] >= 0
        starts.append(node[active[found]])
        ends.append(node[active[found]] + length)
        pieces.append(v.piece[at[found]])
        if length == 1:
            lone[active[found]] = False
        active = active[v.goes_on[at]]
    only = np.flatnonzero(lone)
    n_bytes = 1 + (points[only] > 0x7F) + (points[only] > 0x7FF) + (points[only] > 0xFFFF)
    weights = [v.weight[p] for p in pieces] + [n_bytes * v.byte_weight]
    starts.append(node[only])
    ends.append(node[only] + 1)
    pieces.append(np.full(len(only), -1))
    start, end, piece, weight = (np.concatenate(x) for x in (starts, ends, pieces, weights))
    order = np.argsort(end, kind="stable")
    nodes = n + (int(unit[-1]) + 1 if n else 0)
    first = np.searchsorted(end[order], np.arange(nodes + 1))
    return start[order], piece[order], weight[order], first, node


def filtered(start: np.ndarray, weight: np.ndarray, first: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Cumulative probability of each edge among those into its node, after summing all paths from the units' starts.

    ``depth``: characters before each node in its unit."""
    sums = np.zeros(len(depth))
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(int(depth.max(initial=0)) + 2))
    share = np.empty(len(start))
    for d in range(1, len(cuts) - 1):
        nodes = order[cuts[d]:cuts[d + 1]]
        n = first[nodes + 1] - first[nodes]
        edges = ranges(first[nodes], n)
        value = sums[start[edges]] + weight[edges]
        heads = np.concatenate(([0], np.cumsum(n)[:-1]))
        sums[nodes] = np.logaddexp.reduceat(value, heads)
        share[edges] = np.exp(value - np.repeat(sums[nodes], n))
    total = np.concatenate(([0.0], np.cumsum(share)))
    node = np.repeat(np.arange(len(depth)), np.diff(first[:len(depth) + 1]))
    return total[1:] - total[first[node]]


def sampled(raw: np.ndarray, offsets: np.ndarray, keys: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and the number of ids before each text (n + 1 values)."""
    points, upto = codepoints(raw, offsets)
    n_texts = len(offsets) - 1
    some = np.flatnonzero(np.diff(upto) > 0)
    if not len(some):
        return np.zeros(0, np.int64), np.zeros(n_texts + 1, np.int64)
    # one mark before each text that is not empty
    text = np.repeat(np.arange(n_texts), np.diff(upto))
    before = np.cumsum(np.diff(upto) > 0)
    chars = np.empty(len(points) + len(some), np.int64)
    at = np.arange(len(points)) + before[text]
    chars[at] = np.where(points == 32, SPACE_MARK, np.where(points == SPACE_MARK, 0x110000, points.astype(np.int64)))
    heads = upto[some] + np.arange(len(some))
    chars[heads] = SPACE_MARK
    is_head = np.zeros(len(chars), bool)
    is_head[heads] = True
    mark = chars == SPACE_MARK
    joins = v.joined[chars]
    cut = is_head | (mark & ~np.append(False, mark[:-1])) | ~joins | np.append(True, ~joins[:-1])
    first = np.flatnonzero(cut)
    size = np.diff(np.append(first, len(chars)))
    total = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(chars)), out=total[1:])
    h = mix((total[first + size] - total[first]) * powers(BASE_INV, len(chars) + 1)[first] + size.astype(np.uint64))
    _, one, unit = np.unique(h, return_index=True, return_inverse=True)

    units = chars[ranges(first[one], size[one])]
    place = ranges(np.zeros(len(one), np.int64), size[one])
    # a U+2581 of the text is no mark: outside of every piece, it goes by its bytes
    start, piece, weight, edge_of, node = lattice(units, place, np.repeat(size[one], size[one]), v)
    begin = np.concatenate(([0], np.cumsum(size[one] + 1)[:-1]))
    depth = ranges(np.zeros(len(one), np.int64), size[one] + 1)
    share = filtered(start, weight, edge_of, depth)

    owner = np.repeat(some, np.diff(np.append(heads, len(chars))))[first]
    number = np.arange(len(first)) - np.searchsorted(owner, owner)
    seed = mix(mix(keys.astype(np.int64).view(np.uint64))[owner] + mix(number.astype(np.uint64)))
    taken = np.full(len(chars), -2, np.int64)
    current, alive, step = (begin + size[one])[unit], np.arange(len(first)), 0
    while len(alive):
        step += 1
        draw = (mix(seed[alive] + np.uint64(step * 0x9E3779B9)) >> np.uint64(11)) * (1.0 / (1 << 53))
        edge, last = edge_of[current].copy(), edge_of[current + 1] - 1
        open_ = np.arange(len(alive))
        while len(open_):
            open_ = open_[(edge[open_] < last[open_]) & (share[edge[open_]] <= draw[open_])]
            edge[open_] += 1
        current = start[edge]
        offset = current - begin[unit[alive]]
        taken[first[alive] + offset] = piece[edge]
        go = offset > 0
        alive, current = alive[go], current[go]
    where = np.flatnonzero(taken > -2)
    ids = taken[where]
    lone = np.flatnonzero(ids < 0)
    cp = np.where(chars[where[lone]] == 0x110000, SPACE_MARK, chars[where[lone]])
    n_out = np.ones(len(ids), np.int64)
    n_out[lone] = 1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF)
    out = np.repeat(ids, n_out)
    spot = (np.cumsum(n_out) - n_out)[lone]
    for k in range(4):
        have = n_out[lone] > k
        c, n = cp[have], n_out[lone][have]
        shift = 6 * (n - 1 - k)
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[n]
        value = np.where(n == 1, c, np.where(k == 0, lead | (c >> shift), 0x80 | ((c >> shift) & 0x3F)))
        out[spot[have] + k] = v.byte_ids[value]
    text_of = np.repeat(some, np.diff(np.append(heads, len(chars))))[where]
    counts = np.bincount(text_of, n_out, minlength=n_texts).astype(np.int64)
    return out, np.concatenate(([0], np.cumsum(counts)))


def decoded(ids: np.ndarray, upto: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets: the pieces' text without the space put before each text."""
    size = v.sizes[ids]
    data = v.bytes[ranges(v.at[ids], size)]
    ends = np.concatenate(([0], np.cumsum(size)))[upto]
    keep = np.ones(len(data), bool)
    heads = ends[:-1][np.diff(ends) > 0]
    keep[heads[data[heads] == 32]] = False
    return data[keep], np.concatenate(([0], np.cumsum(keep)))[ends]


def _encoded(batches: Iterator[pa.RecordBatch], path: str, alpha: float) -> Iterator[pa.RecordBatch]:
    v = vocabulary(path, alpha)
    for batch in batches:
        keys = batch.column(0).cast(pa.int64())
        seeds = keys.fill_null(0).to_numpy(zero_copy_only=False)
        for a, z, raw, offsets in text_slices(batch.column(1), SLICE):
            ids, upto = sampled(raw, offsets, seeds[a:z], v)
            data, ends = decoded(ids, upto, v)
            equal = np.diff(ends) == np.diff(offsets)
            for k in np.flatnonzero(equal):
                equal[k] = np.array_equal(data[ends[k]:ends[k + 1]], raw[offsets[k]:offsets[k + 1]])
            yield pa.RecordBatch.from_arrays(
                [keys.slice(a, z - a), pa.array(np.diff(upto)), pa.Array.from_buffers(pa.binary(), z - a, [
                    None, pa.py_buffer((4 * upto).astype(np.int32)), pa.py_buffer(ids.astype("<u4").tobytes())]),
                 pa.array(equal)], names=["doc_id", "n_tokens", "ids", "lossless"])


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    v = vocabulary(path, ALPHA)
    for batch in batches:
        for a, z, raw, offsets in text_slices(batch.column(1), SLICE):
            data, ends = decoded(np.frombuffer(raw.tobytes(), "<u4").astype(np.int64), offsets // 4, v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, z - a), pa.Array.from_buffers(pa.string(), z - a, [
                    None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data.tobytes())])], names=["doc_id", "text"])


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, model_path: str | None = None, alpha: float = ALPHA, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, lossless): a sampled segmentation of every text as little-endian unsigned 32-bit ids;
    ``lossless``: whether decoding them gave the text back, byte for byte."""
    path = model_path or default_model()
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        lambda it: _encoded(it, path, alpha), "doc_id long, n_tokens long, ids binary, lossless boolean")


def decode(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    path = model_path or default_model()
    return encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids")).mapInArrow(
        lambda it: _decoded(it, path), "doc_id long, text string")


def op10_sampled_pieces(spark, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), "lossless")
