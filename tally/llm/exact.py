"""Exact dedup: two passes of a Bloom filter, and a shuffle of the rows that it could not clear.

Pass one sets, for every text's digest, positions in two bit planes: seen at
least once, seen at least twice.  Pass two asks the second plane: a digest with
one position not set twice occurs once, so its row is final and passes straight
through.  Only the other rows are shuffled and grouped by the whole digest, so
a false answer of the filter costs a shuffled row and never a result.  A hot
group is combined before its shuffle, and its one result row is joined back
over salted keys.

Texts are equal when they are identical after lower-casing A-Z; they are
compared by the SHA-256 of that.

Nulls and edge cases: null text is empty, and empty texts are equal; a null id
is smaller than any other, and a group of null ids has a null ``keep_id``; of
rows equal in id and text one is kept; an empty table gives an empty result.
Only the named columns are read, and carried columns are renamed, so other
columns cannot clash.  A text of any length is hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions.skew import join_back
from tally.llm.bloom import MAX_BITS, bits_for, holds, plane
from tally.llm.staging import stage, table
from tally.llm.textcols import LOWER, text_slices


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, digest, key, carried...): SHA-256 of the lower-cased bytes, and its first 64 bits."""
    for batch in batches:
        for a, z, raw, offsets in text_slices(batch.column(1)):
            low = memoryview(LOWER[raw].tobytes())
            found = [hashlib.sha256(low[x:y]).digest() for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
            keys = np.frombuffer(b"".join(found), np.int64)[::4]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, z - a), pa.array(found, pa.binary()), pa.array(keys),
                 *(c.slice(a, z - a) for c in batch.columns[2:])], names=["doc_id", "digest", "key", *batch.schema.names[2:]])


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                 most_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: its group's id, size and whether it is the one that stays (the largest id).

    The columns ``carry`` go along as ``carried_0``, ``carried_1`` and so on.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                      *[F.col(c).alias(f"carried_{k}") for k, c in enumerate(carry)])
    others = own.columns[2:]
    extra = "".join(f", {f.name} {f.dataType.simpleString()}" for f in own.schema.fields[2:])
    rows = stage(own.mapInArrow(_digests, "doc_id long, digest binary, key long" + extra)
                 .withColumn("row", F.monotonically_increasing_id()), "digests")
    twice = spark.sparkContext.broadcast(plane(rows.select("key"), bits_for(rows.count(), most_bits), repeats=True))

    def asked(batches: Iterator[pa.RecordBatch], again: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = holds(twice.value, batch.column("key").to_numpy().view(np.uint64))
            yield batch.filter(pa.array(found == again))

    single = rows.mapInArrow(lambda it: asked(it, False), rows.schema)
    maybe = stage(rows.mapInArrow(lambda it: asked(it, True), rows.schema), "maybe")
    groups = maybe.groupBy("digest").agg(F.max(F.struct(F.col("doc_id"), F.col("row"))).alias("keep"),
                                         F.count(F.lit(1)).alias("group_size"))
    told = join_back(maybe, groups, ["digest"], spread=["row"])

    def result(df: DataFrame, keep_id, size, kept) -> DataFrame:
        return df.select("doc_id", keep_id.alias("keep_id"), size.alias("group_size"), kept.alias("kept"),
                         F.lower(F.hex("digest")).alias("text_sha256"), *others)

    return result(single, F.col("doc_id"), F.lit(1).cast("long"), F.lit(True)).unionByName(
        result(told, F.col("keep.doc_id"), F.col("group_size"), F.col("row") == F.col("keep.row")))


def op13_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))
