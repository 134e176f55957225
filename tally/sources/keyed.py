"""Month-partitioned tables with unique keys: an index of key filters per batch and month, appends that can be replayed.

Layout: ``<path>/rows/batch=<id>/<month>=YYYY-MM`` and, beside it,
``<path>/index-<words>/batch=<id>/<month>=YYYY-MM`` with one row per used word
of a Bloom filter: a key sets four bits of one 64-bit word that its hash names
(``bit_or`` over equal words, combined before the shuffle).  Words without a
key are not stored, so a filter costs 16 bytes a key or less and ``words`` can
be large; with n keys in a month a foreign key is let through with a chance of
about n / words / 600,000.

A lookup joins the asked keys with the index by word, learns from it which
batches and months may hold one of them, and opens only those directories for
the exact semi-join.  Asked keys that no filter lets through open nothing.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tally.operators.migrate import _children, _drop, _fs, _rename
from tally.session import path_exists
from tally.sources.storage import write_by_month

WORDS = 1 << 26
BITS_PER_KEY = 4


class KeyedTable:
    """Rows unique by ``keys``.  A null key is no key: such rows are kept and never found."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], month_col: str = "posting_month",
                 words: int = WORDS):
        self.spark, self.path, self.keys, self.month_col, self.words = spark, path.rstrip("/"), keys, month_col, words
        self.columns = [f.name for f in schema]
        # the folders' names are strings, whatever they look like
        self.schema = StructType([f for f in schema if f.name != month_col]).add("batch", "string").add(month_col, "string")
        self.rows_path, self.index_path = f"{self.path}/rows", f"{self.path}/index-{words}"

    # ---- the filter ------------------------------------------------------------
    def _whole(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])

    def _word(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.words))

    def _bits(self) -> Column:
        other = F.xxhash64(F.lit("bits"), *self.keys)
        each = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(other, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
                for i in range(BITS_PER_KEY)]
        return reduce(lambda a, b: a.bitwiseOR(b), each)

    def index_of(self, rows: DataFrame) -> DataFrame:
        """(month, word, bits) of the rows' keys."""
        return (rows.where(self._whole()).select(self.month_col, self._word().alias("word"), self._bits().alias("bits"))
                .groupBy(self.month_col, "word").agg(F.bit_or("bits").alias("bits")))

    # ---- reading ---------------------------------------------------------------
    def exists(self) -> bool:
        return path_exists(self.spark, self.rows_path) and bool(_children(self.spark, self.rows_path))

    def read(self, parts: list[tuple[str, str]] | None = None) -> DataFrame:
        """All rows, or those of the (batch, month) directories named."""
        df = self.spark.read.schema(self.schema).parquet(self.rows_path)
        if parts is not None:
            months, batches = sorted({m for _, m in parts}), sorted({b for b, _ in parts})
            pair = F.concat_ws("|", F.col("batch"), F.col(self.month_col))
            # each list prunes by itself; the pairs cut what both let through together
            df = df.where(F.col(self.month_col).isin(months) & F.col("batch").isin(batches) & pair.isin([f"{b}|{m}" for b, m in parts]))
        return df.select(*self.columns, "batch")

    def parts_holding(self, asked: DataFrame) -> list[tuple[str, str]]:
        """The (batch, month) directories that may hold one of the asked keys: at most as many as there are directories."""
        if not self.exists():
            return []
        index = self.spark.read.schema(f"word long, bits long, batch string, {self.month_col} string").parquet(self.index_path)
        probes = asked.where(self._whole()).select(self._word().alias("word"), self._bits().alias("_ask")).distinct()
        hit = probes.join(index, "word").where(F.col("bits").bitwiseAND(F.col("_ask")) == F.col("_ask"))
        found = hit.select("batch", F.col(self.month_col).alias("month")).distinct().collect()
        committed = set(_children(self.spark, self.rows_path))        # an index without rows is a batch that died
        return sorted((r["batch"], r["month"]) for r in found if f"batch={r['batch']}" in committed)

    def holds(self, asked: DataFrame) -> DataFrame:
        """The different asked keys that the table has."""
        keys = asked.select(*self.keys).where(self._whole()).distinct()
        parts = self.parts_holding(asked)
        if not parts:
            return keys.where(F.lit(False))
        return keys.join(self.read(parts).select(*self.keys), self.keys, "left_semi")

    def held(self, rows: DataFrame) -> DataFrame:
        """The rows whose key the table has."""
        rows = rows.where(self._whole())
        parts = self.parts_holding(rows)
        return rows.join(self.read(parts).select(*self.keys), self.keys, "left_semi") if parts else rows.where(F.lit(False))

    # ---- writing ---------------------------------------------------------------
    def absent(self, rows: DataFrame, order: list[str]) -> DataFrame:
        """The rows to append: of each new key its first row by ``order``; rows with a null key all stay."""
        from tally.operators.postings import first_per_key
        payload = [c for c in rows.columns if c not in self.keys and c not in order]
        first = first_per_key(rows.where(self._whole()), self.keys, order, payload).select(*rows.columns)
        return (first.join(self.holds(rows), self.keys, "left_anti")
                .unionByName(rows.where(~self._whole())))

    def append_absent(self, rows: DataFrame, batch: str, order: list[str]) -> bool:
        """Append what is absent as the batch ``batch``; False where that batch is there already.

        Rows and index are staged, then the index is renamed into place and the rows after it: the rows' folder is the
        commit.  A run that died before it leaves at most an index without rows, which nothing opens and a rerun replaces.
        """
        name = f"batch=b-{batch}"            # never read back as a number
        target = f"{self.rows_path}/{name}"
        if path_exists(self.spark, target):
            return False
        stage = f"{self.path}/_stage-{uuid.uuid4().hex[:12]}"
        rows = rows.select(*self.columns).withColumn(self.month_col, F.coalesce(self.month_col, F.lit("none")))
        write_by_month(self.absent(rows, order), f"{stage}/rows", month_col=self.month_col)
        staged = self.spark.read.schema(rows.schema).parquet(f"{stage}/rows")
        write_by_month(self.index_of(staged), f"{stage}/index", month_col=self.month_col)
        for folder in (self.index_path, self.rows_path):
            fs, p = _fs(self.spark, folder)
            fs.mkdirs(p)
        _drop(self.spark, f"{self.index_path}/{name}")
        _rename(self.spark, f"{stage}/index", f"{self.index_path}/{name}")
        _rename(self.spark, f"{stage}/rows", target)
        _drop(self.spark, stage)
        return True
