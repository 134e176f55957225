"""Bloom planes: no repeated hash is missed, sizes are bounded."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tally.llm import bloom


@pytest.mark.parametrize("bits", [1 << 16, 1 << 22])
def test_repeats_are_never_missed(spark, bits):
    # every third number occurs twice, far apart and so in different tasks
    df = spark.range(30_000, numPartitions=6).select(F.col("id").alias("h")).unionByName(
        spark.range(0, 30_000, 3, numPartitions=5).select(F.col("id").alias("h")))
    twice = bloom.plane(df, bits, repeats=True)
    found = bloom.holds(twice, np.arange(30_000).astype(np.uint64))
    assert len(twice) == bits // 8 and found[::3].all()
    if bits == 1 << 22:
        assert found.sum() < 10_100
    once = bloom.plane(df, bits)
    assert bloom.holds(once, np.arange(30_000).astype(np.uint64)).all()
    if bits == 1 << 22:
        assert bloom.holds(once, np.arange(50_000, 80_000).astype(np.uint64)).sum() < 100


def test_a_hash_repeated_within_one_batch_and_an_empty_table(spark):
    df = spark.createDataFrame([(5,), (5,), (6,)], "h long").coalesce(1)
    twice = bloom.plane(df, 1 << 16, repeats=True)
    assert bloom.holds(twice, np.array([5, 6], np.uint64)).tolist() == [True, False]
    assert not bloom.plane(df.where("h < 0"), 1 << 16).any()


def test_sizes():
    assert bloom.bits_for(0) == bloom.MIN_BITS and bloom.bits_for(10**12) == bloom.MAX_BITS
    assert 16 * 100_000 <= bloom.bits_for(100_000) < 32 * 100_000
