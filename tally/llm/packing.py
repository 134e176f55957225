"""Best-fit packing of tokenized documents into fixed-length training sequences.

Only documents longer than ``max_len`` are cut, into pieces of ``max_len``
(the last one may be shorter); every piece then goes whole into the tightest
open sequence that has room, longest pieces first (best-fit decreasing).

Pieces of one length are interchangeable, so the placement needs only how many
pieces there are of each length: at most ``max_len`` numbers, whatever the
corpus.  ``best_fit_runs`` keeps the open sequences by remaining capacity in a
segment tree and finds the tightest one in logarithmic time; it answers with
runs ("pieces number a to b of this length go to sequences s, s+1, ... m each").
The runs are bounded by ``max_len`` too.  Spark numbers the pieces of each
length (a window per (length, bucket), buckets prefix-summed, so that a length
held by a third of all pieces is many windows) and joins them to the runs.

Nulls and edge cases: a null or empty text is the end id alone; a text of
exactly ``max_len`` ids is one full piece; rows that share an id are packed
separately; an empty table gives an empty result.  Only the two named columns
are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tally.llm.staging import stage, table
from tally.llm.textcols import text_slices

MAX_LEN = 4096
END_ID = 1
#: Pieces numbered by one window, and ranks of one length joined to the runs by one key.
BUCKET_ROWS = 50_000
#: Distinct words of a generation; a Python worker keeps the ids of two (about 200 bytes a word), also when other stages
#: use it again.
KEPT_WORDS = 100_000

# The normaliser and splitter that ``_text_ids`` knows by its own rules, as tokenizer files state them.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": SPLIT_PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _knows_rules(spec: dict) -> bool:
    """Whether a tokenizer file has the rules under which a text's ids are its words' ids."""
    return (spec.get("normalizer") == NORMALIZER and spec.get("pre_tokenizer") == PRE_TOKENIZER
            and (spec.get("model") or {}).get("type") == "BPE" and not spec["model"].get("dropout")
            and not any(t.get("lstrip") or t.get("rstrip") or not t["content"].startswith("<|") or " " in t["content"]
                        for t in spec.get("added_tokens") or []))


def _text_ids(tokenizer_path: str):
    """bytes of a text -> its ids as little-endian unsigned 32-bit; kept by the worker.

    Under the rules above the tokenizer drops white space and no id spans it, so a text's ids are its words' ids.
    Plain Latin words take the normaliser's and splitter's rules in Python and only the tokenizer's model, other
    words the whole tokenizer.  A file with other rules gets whole texts.
    """
    import sys

    kept = sys.__dict__.setdefault("_tally_text_ids", {})
    if tokenizer_path in kept:
        return kept[tokenizer_path]
    import json
    import re

    import regex
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path)
    with open(tokenizer_path, encoding="utf-8") as file:
        by_words = _knows_rules(json.load(file))
    if not by_words:
        def whole(text: bytes) -> bytes:
            return np.array(tok.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, dtype="<u4").tobytes()

        kept[tokenizer_path] = whole
        return whole
    model = tok.model
    plain = re.compile(r"[!-~À-ÖØ-öø-ſ]+")
    split = regex.compile(SPLIT_PATTERN).findall
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_chars = {**{b: chr(b) for b in printable}, **{b: chr(256 + k) for k, b in enumerate(others)}}

    def as_bytes(part: str) -> str:
        return part if part.isascii() else part.encode().decode("latin-1").translate(byte_chars)

    class Words(dict):
        old: dict = {}

        def __missing__(self, word: bytes) -> bytes:
            out = self.old.get(word)
            if out is not None:
                self[word] = out
                return out
            text = word.decode("utf-8", "replace")
            if not plain.fullmatch(text) or "<|" in text:
                ids = tok.encode(text, add_special_tokens=False).ids
            elif text.isalpha():
                low = text.lower()
                if low != text:
                    self[word] = out = self[low.encode()]
                    return out
                ids = [t.id for t in model.tokenize(as_bytes(text))]
            elif text[-1] in ".,;:!?" and text[:-1].isalpha():
                self[word] = out = self[text[:-1].encode()] + self[text[-1].encode()]
                return out
            else:
                ids = [t.id for part in split(text.lower()) for t in model.tokenize(as_bytes(part))]
            self[word] = out = np.array(ids, dtype="<u4").tobytes()
            return out

    words = Words()

    def ids_of(text: bytes) -> bytes:
        if len(words) > KEPT_WORDS:  # words not met since the last turn go
            words.old = dict(words)
            words.clear()
        return b"".join(map(words.__getitem__, text.split()))

    kept[tokenizer_path] = ids_of
    return ids_of


def _tokenized(batches: Iterator[pa.RecordBatch], tokenizer_path: str, max_len: int, end_id: int,
               with_ids: bool) -> Iterator[pa.RecordBatch]:
    text_ids = _text_ids(tokenizer_path)
    end = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * max_len
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for a, z, raw, offsets in text_slices(batch.column(1)):
            rows: list[tuple] = []
            data = raw.tobytes()
            for k in range(z - a):
                own = text_ids(data[offsets[k]:offsets[k + 1]]) + end
                for p, at in enumerate(range(0, len(own), step)):
                    piece = own[at:at + step]
                    rows.append((ids[a + k], p, at // 4, len(piece) // 4, zlib.crc32(piece), piece if with_ids else None))
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(cols, kinds, strict=False)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays, names = [*arrays, pa.array(cols[5], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                    max_len: int = MAX_LEN, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pieces of at most ``max_len`` ids with their place in the document and checksum;
    ``ids``: the ids themselves as little-endian unsigned 32-bit, if ``with_ids``."""
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return texts.mapInArrow(lambda it: _tokenized(it, tokenizer_path, max_len, end_id, with_ids),
                            PIECES + (", ids binary" if with_ids else ""))


class CapacityTree:
    """Segment tree over remaining capacities 1..cap: how many open sequences have each."""

    def __init__(self, cap: int):
        self.size = 1 << cap.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, n: int) -> None:
        k = capacity + self.size
        while k:
            self.count[k] += n
            k >>= 1

    def tightest(self, need: int) -> int | None:
        """Smallest capacity >= need that an open sequence has."""
        k = need + self.size
        if self.count[k]:
            return need
        while k > 1:  # climb until a right sibling holds something, then go down leftmost
            if not k & 1 and self.count[k + 1]:
                k += 1
                while k < self.size:
                    k = 2 * k if self.count[2 * k] else 2 * k + 1
                return k - self.size
            k >>= 1
        return None


def best_fit_runs(lengths: dict[int, int], cap: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts per length.

    Runs (length, lo, hi, sequence, per, offset): pieces lo..hi-1 of the length go to the
    sequences from ``sequence`` on, ``per`` each, the first at ``offset`` of its sequence.
    The tightest sequence stays the tightest while it has room, so it takes pieces of one
    length until it has none; equally tight sequences are filled alike.
    """
    tree, opened, runs, next_seq = CapacityTree(cap), {}, [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            opened.setdefault(room, []).append((first, n))
            tree.add(room, n)

    for length in sorted(lengths, reverse=True):
        left, rank = lengths[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, per = cap, cap // length
                first, n = next_seq, -(-left // per)
                next_seq += n
            else:
                first, n = opened[room].pop()
                tree.add(room, -n)
                per = room // length
            full, rest = divmod(min(left, n * per), per)
            if full:
                runs.append((length, rank, rank + full * per, first, per, cap - room))
                put(room - per * length, first, full)
            if rest:
                runs.append((length, rank + full * per, rank + full * per + rest, first + full, rest, cap - room))
                put(room - rest * length, first + full, 1)
            used = full + bool(rest)
            put(room, first + used, n - used)
            rank += full * per + rest
            left -= full * per + rest
    return runs


def place(pieces: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """``pieces`` (with ``length``) with ``sequence_id`` and ``offset``.  It is read twice: pass a stored table."""
    spark = pieces.sparkSession
    lengths = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets = max(1, sum(lengths.values()) // BUCKET_ROWS)
    keyed = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = (keyed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.sum("_n").over(
                  Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)))
              .select("length", "_bucket", F.coalesce("_before", F.lit(0)).alias("_before")))
    order = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (keyed.withColumn("_number", F.row_number().over(order) - 1).join(before, ["length", "_bucket"])
              .withColumn("_rank", F.col("_number") + F.col("_before"))
              .withColumn("_block", F.floor(F.col("_rank") / BUCKET_ROWS)))
    runs = spark.createDataFrame(best_fit_runs(lengths, max_len),
                                 "length long, _lo long, _hi long, _seq long, _per long, _off long")
    runs = runs.withColumn("_block", F.explode(F.sequence(F.floor(F.col("_lo") / BUCKET_ROWS),
                                                          F.floor((F.col("_hi") - 1) / BUCKET_ROWS))))
    at = F.col("_rank") - F.col("_lo")
    placed = ranked.join(runs, ["length", "_block"]).where("_rank >= _lo and _rank < _hi")
    return placed.select(*pieces.columns, (F.col("_seq") + F.floor(at / F.col("_per"))).alias("sequence_id"),
                         (F.col("_off") + F.pmod(at, F.col("_per")) * F.col("length")).cast("long").alias("offset"))


def pack(docs: DataFrame, tokenizer_path: str | None = None, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents with their sequence and offset; pieces are stored once, without ids."""
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    return place(stage(tokenize_pieces(docs, tokenizer_path, max_len=max_len, end_id=end_id, with_ids=False), "pieces"),
                 max_len)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences: ids of each sequence in order, at most ``max_len`` of them.
    ``pieces`` has ``ids``; both have (doc_id, piece, ids_crc32)."""
    key = ["doc_id", "piece", "ids_crc32"]
    one = placed.groupBy(*key).agg(F.collect_list(F.struct("sequence_id", "offset")).alias("places"))
    own = pieces.select(*[F.col(k).alias(f"_{k}") for k in key], "ids").dropDuplicates([f"_{k}" for k in key])
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return (own.join(one, same).select("ids", F.explode("places").alias("p"))
            .groupBy("p.sequence_id").agg(F.sort_array(F.collect_list(F.struct("p.offset", "ids"))).alias("parts"))
            .select("sequence_id", F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))").alias("ids")))


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
