"""Comparing two snapshots of a table by a tree of order-free digests.

A leaf is a month and a range of key hashes; its digest is the number of rows
and two sums over row hashes, the same in whatever order or files the rows lie.
A month's digest is the sum of its leaves.  Equal nodes are skipped: months that
differ name the directories that are opened again, leaves that differ name the
rows of them that are joined.  One pass over each side, combined before the
shuffle, and a second pass over the changed months only.

Digests are 128 bits of row hashes beside the count: two different leaves are
taken for equal with a chance of about one in 2**100.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.operators.integrity import immutability_audit

RANGES = 256


def key_range(key: str, ranges: int = RANGES) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(ranges))


def leaf_digests(df: DataFrame, key: str, month_col: str = "posting_month", ranges: int = RANGES) -> DataFrame:
    """(month, range, rows, first, second): one row per leaf that has rows.

    Columns enter by name order, nulls with a mark of their own, so neither the order of the columns nor a value that
    moves from one column to the next goes unseen.
    """
    cols = sorted(c for c in df.columns)
    values = [x for c in cols for x in (F.col(c), F.col(c).isNull())]
    whole = lambda seed: F.xxhash64(F.lit(seed), *values).cast("decimal(38,0)")
    return (df.groupBy(F.col(month_col).alias("month"), key_range(key, ranges).alias("range"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(whole(1)).alias("first"), F.sum(whole(2)).alias("second")))


def changed_leaves(old: DataFrame, new: DataFrame, key: str, month_col: str = "posting_month",
                   ranges: int = RANGES) -> DataFrame:
    """(month, range) of the leaves whose digests differ: at most ``ranges`` a month."""
    o, n = (leaf_digests(d, key, month_col, ranges) for d in (old.select(*sorted(old.columns)), new.select(*sorted(old.columns))))
    return (o.unionByName(n.select("month", "range", *[(-F.col(c)).alias(c) for c in ("rows", "first", "second")]))
            .groupBy("month", "range").agg(*[F.sum(c).alias(c) for c in ("rows", "first", "second")])
            .where("rows <> 0 or first <> 0 or second <> 0").select("month", "range"))


def snapshot_audit(old: DataFrame, new: DataFrame, key: str = "entry_id", month_col: str = "posting_month",
                   ranges: int = RANGES) -> DataFrame:
    """INT-7 / JOIN-13: rows deleted, added or changed, read again only in months and ranges that changed."""
    leaves = changed_leaves(old, new, key, month_col, ranges).collect()    # months x ranges at most
    months = sorted({r["month"] for r in leaves if r["month"] is not None})
    spark = old.sparkSession
    named = F.broadcast(spark.createDataFrame([(r["month"], r["range"]) for r in leaves], "_month string, _range long"))

    def part(df: DataFrame) -> DataFrame:
        own = F.col(month_col).isin(months)
        if any(r["month"] is None for r in leaves):
            own = own | F.col(month_col).isNull()
        return (df.where(own).join(named, F.col(month_col).eqNullSafe(F.col("_month")) & (key_range(key, ranges) == F.col("_range")), "left_semi"))
    return immutability_audit(part(old), part(new), key)


def multiset_difference(left: DataFrame, right: DataFrame, ranges: int = RANGES) -> tuple[int, int, int]:
    """SET-1: rows that only ``left`` has, rows that only ``right`` has (with multiplicity), and the rows of ``left``.

    Both sides are read once into the fingerprints of ``ranges`` ranges of row hashes -- number and two sums, the right
    side's subtracted -- in one pass.  Only where a fingerprint is not zero are the rows of that range compared.
    """
    cols = sorted(left.columns)
    values = [x for c in cols for x in (F.col(c), F.col(c).isNull())]
    own = F.pmod(F.xxhash64(F.lit(0), *values), F.lit(ranges))

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(own.alias("range"), F.lit(sign).alias("sign"),
                         *[(F.xxhash64(F.lit(s), *values).cast("decimal(38,0)") * sign).cast("decimal(38,0)").alias(f"h{s}") for s in (1, 2)])
    found = (side(left, 1).unionByName(side(right, -1)).groupBy("range")
             .agg(F.sum("sign").alias("rows"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"),
                  F.count_if(F.col("sign") > 0).alias("n")).collect())
    n = sum(r["n"] for r in found)
    apart = [r["range"] for r in found if r["rows"] or r["h1"] or r["h2"]]
    if not apart:
        return 0, 0, n
    a, b = left.select(*cols).where(own.isin(apart)), right.select(*cols).where(own.isin(apart))
    return a.exceptAll(b).count(), b.exceptAll(a).count(), n
