"""Reading the driver's tables and cutting lineage through the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tally.session import drop_path, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the folder of ``spark.checkpoint.dir`` and read it back.

    What the write shuffled is deleted when it is done; else it lies on disk, beside what later writes shuffle, until the
    driver happens to collect its garbage.
    """
    return _stored(df, scratch_path(df.sparkSession, f"llm-{name}"))


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A ``stage`` whose tables are deleted when this ends: nothing may read them later."""
    paths = []

    def stage_here(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_path(spark, f"llm-{name}"))
        return _stored(df, paths[-1])

    try:
        yield stage_here
    finally:
        for path in paths:
            drop_path(spark, path)


def _stored(df: DataFrame, path: str) -> DataFrame:
    with _held(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def text_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """While it holds, Arrow batches have at most ``rows`` rows, for plans that are run inside it.

    A batch's buffers lie outside the heap, on both sides of the pipe and at up to twice their size while they grow; ten
    thousand long texts are too many.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(name))
    with _held(spark, name, str(min(rows, before) if before > 0 else rows)):
        yield


@contextmanager
def _held(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
