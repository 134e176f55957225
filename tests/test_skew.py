"""join_back and join_beside: the plain join's rows, spread evenly."""

import pytest
from pyspark.sql import functions as F

from tally.functions.skew import hot_keys, join_back, join_beside, together


def _rows(spark, n=60_000):
    # a third of the rows on one key, some nulls, the rest on many keys
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit(-1)).when(i % 1000 == 1, F.lit(None)).otherwise(i % 5000)
    return spark.range(n, numPartitions=8).select(i, key.alias("key"), F.lit("x").alias("kind"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_a_plain_join(spark, how):
    rows = _rows(spark)
    summary = rows.groupBy("key", "kind").agg(F.count(F.lit(1)).alias("n")).where("key is null or key < 100")
    want = rows.join(summary, ["key", "kind"], how)
    for join in (join_back, join_beside):
        got = join(rows, summary, ["key", "kind"], how)
        assert got.columns == want.columns and got.count() == want.count()
        assert got.exceptAll(want).count() == 0


def test_no_task_holds_a_hot_key(spark):
    rows = _rows(spark)
    summary = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
                 for df in (rows.join(summary, "key"), join_back(rows, summary, ["key"], spread=["id"]))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    plain, salted = sizes
    assert sum(plain) == sum(salted) and plain[-1] > 3 * plain[len(plain) // 2]
    assert salted[-1] < 3 * salted[len(salted) // 2]


def test_hot_keys_are_few(spark):
    hot = hot_keys(_rows(spark), ["key"], tasks=50)
    assert len(hot) == 1 and 60 <= hot[0][1] <= 70
    assert hot_keys(spark.range(0).select(F.col("id").alias("key")), ["key"]) == []
    with pytest.raises(ValueError):
        join_back(spark.range(1), spark.range(1), ["id"], "full_outer")
    with pytest.raises(ValueError):
        join_beside(spark.range(1), spark.range(1), ["id"], "full_outer")


def test_partitions_grow_with_the_rows(spark):
    rows = spark.range(10).select(F.col("id").alias("key"))
    assert together(rows, "key", 10).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert together(rows, "key", 10_000_000).rdd.getNumPartitions() == 20
