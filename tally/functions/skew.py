"""Joining a per-key summary back to rows of which one key may hold a large share.

``rows.groupBy(keys).agg(...)`` combines a hot key before its shuffle, but the
join of that one summary row back to the key's rows sends them all to one task,
and AQE cannot split it where an aggregate or a window fixes the partitioning.
``join_back`` finds the keys that are hot by a frequent-items sketch (combined
per task, of fixed size), gives their rows a salt and replicates their summary
row once per salt.  The sketch decides placement only: a key it misses or
overrates is joined just as rightly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys the sketch follows; it overrates a count by at most rows / TRACKED.
TRACKED = 8192
#: Rows that one task of ``together`` sorts: well packed rows hide their size from what sets a partition's bytes.
TOGETHER = 500_000


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_keys(rows: DataFrame, keys: list[str], tasks: int | None = None) -> list[tuple[int, int]]:
    """(key hash, number of salts) of the keys that hold more than half of an even share of the rows of one task.

    There are at most 2 x ``tasks`` of them, and their salts add up to at most 6 x ``tasks``, whatever the data.
    """
    return hot_keys_of(rows, keys, tasks)[0]


def hot_keys_of(rows: DataFrame, keys: list[str], tasks: int | None = None) -> tuple[list[tuple[int, int]], int]:
    """``hot_keys`` and the number of rows."""
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(2 * tasks, TRACKED // 2)
    found = rows.select(key_hash(keys).alias("_h")).agg(
        F.expr(f"approx_top_k(_h, {most}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [(t["item"], -(-4 * tasks * t["count"] // found["n"])) for t in found["top"] or []
            if t["count"] * 2 * tasks > found["n"]], found["n"]


def join_back(rows: DataFrame, summary: DataFrame, keys: list[str], how: str = "inner", spread: list[str] | None = None,
              tasks: int | None = None, hot: list[tuple[int, int]] | None = None) -> DataFrame:
    """``rows.join(summary, keys, how)`` (inner, left, left_semi or left_anti) whose tasks stay even on hot keys.

    ``summary`` has at most one row per key.  ``spread``: the columns of ``rows`` whose hash gives a row its salt
    (default: all of a type that can be hashed); rows equal in them share one.  ``rows`` is read once more for the
    sketch, so it should be stored or cheap; ``hot`` hands over what ``hot_keys`` found before.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join_back keeps the rows' side: {how}")
    hot = hot_keys(rows, keys, tasks) if hot is None else hot
    if not hot:
        return rows.join(summary, keys, how)
    spark = rows.sparkSession
    spread = spread or [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()
                        and "variant" not in f.dataType.simpleString()]
    # 2 x tasks rows at most, by the threshold of hot_keys
    salts = F.broadcast(spark.createDataFrame(hot, "_hot long, _salts long"))
    salted = (rows.withColumn("_h", key_hash(keys)).join(salts, F.col("_h") == F.col("_hot"), "left")
              .withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread]), F.coalesce("_salts", F.lit(1))))
              .drop("_h", "_hot", "_salts"))
    copies = (summary.withColumn("_h", key_hash(keys)).join(salts, F.col("_h") == F.col("_hot"), "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)) - 1)))
              .drop("_h", "_hot", "_salts"))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def join_beside(rows: DataFrame, summary: DataFrame, keys: list[str], how: str = "inner", tasks: int | None = None,
                hot: list[tuple[int, int]] | None = None) -> DataFrame:
    """Like ``join_back``, but the rows of hot keys are not shuffled: the few summary rows of these go to every task.

    ``rows`` is read twice more, so it should be stored or cheap; ``summary`` is made once for each part.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join_beside keeps the rows' side: {how}")
    hot = hot_keys(rows, keys, tasks) if hot is None else hot
    if not hot:
        return rows.join(summary, keys, how)
    is_hot = is_hot_key(keys, hot)
    there = rows.where(is_hot).join(F.broadcast(summary.where(is_hot)), keys, how)     # 2 x tasks keys at most
    return there.unionByName(rows.where(~is_hot).join(summary.where(~is_hot), keys, how))


def is_hot_key(keys: list[str], hot: list[tuple[int, int]]) -> Column:
    return key_hash(keys).isin([h for h, _ in hot])


def together(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows shuffled to their key, in partitions that grow in number with the rows."""
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // TOGETHER))
    return rows.repartition(tasks, key)
