"""Stream sources: the driver tables (or a landing folder) read with ``readStream``.

A file stream needs a directory or a glob; the driver tables are single
parquet files, so a one-character glob names the file without changing what
is read.  On a cluster the same reader points at a landing directory that an
upstream system keeps appending to; ``max_files`` then bounds each
micro-batch so state and shuffle per batch stay bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _stream_path(spark: SparkSession, path: str) -> str:
    """A single file becomes a one-character glob (the file source wants a folder or a pattern)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if "[" not in path and fs.isFile(p):
        return f"{path[:-1]}[{path[-1]}]"
    return path


def stream_table(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """``readStream`` over a parquet file or folder, with the schema of its batch twin."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(_stream_path(spark, path))


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need TIMESTAMP (the parquet files hold TIMESTAMP_NTZ); the session zone is UTC."""
    return df.withColumn(column, F.col(column).cast("timestamp"))
