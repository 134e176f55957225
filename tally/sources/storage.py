"""Partitioned storage of the ledger: month layout, routing, month overwrite, conversion, generator.

Layout: ``<path>/posting_month=YYYY-MM/part-*.parquet``.  A month is the unit
of pruning, of rollup refresh and of backfill commits.  Writers rebalance by
month (AQE sizes the files and splits a heavy month over several tasks), so a
heavy month is neither one task nor one giant file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally import constants as K
from tally.functions.columns import MONEY



def write_by_month(df: DataFrame, path: str, month_col: str = "posting_month", key_col: str = "entry_id",
                   files_per_month: int | None = None, mode: str = "overwrite", dynamic: bool = False) -> None:
    """Write month directories with files sized by the data, not by a constant.

    Default: ``REBALANCE(month)`` -- AQE coalesces small months into one task
    (one file per month) and splits a heavy month into advisory-size pieces,
    so a month holding a third of the rows is written by many tasks.  With
    ``files_per_month`` the rows of a month are spread over exactly that many
    tasks by a hash of ``key_col``.  ``dynamic`` replaces only the months of ``df``.
    """
    if files_per_month:
        spread = F.pmod(F.xxhash64(key_col), F.lit(files_per_month))
        out = df.repartition(month_col, spread)
    else:
        out = df.hint("rebalance", month_col)
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy(month_col).parquet(path))


def read_months(spark: SparkSession, path: str, months: list[str] | None = None,
                month_col: str = "posting_month") -> DataFrame:
    """Read a month-partitioned table; the month list becomes a partition filter."""
    df = spark.read.parquet(path)
    if months is not None:
        df = df.filter(F.col(month_col).isin(months))
    return df


def partition_key(created_at: F.Column, first: str = K.FIRST_PARTITION_MONTH,
                  last: str = K.LAST_PARTITION_MONTH) -> F.Column:
    """SNK-1: the month partition a row belongs to, or DEFAULT outside the provisioned window."""
    m = F.date_format(created_at, "yyyy-MM")
    return F.when((m >= first) & (m <= last), m).otherwise(F.lit(K.DEFAULT_PARTITION))


def route(df: DataFrame, first: str = K.FIRST_PARTITION_MONTH, last: str = K.LAST_PARTITION_MONTH) -> DataFrame:
    return df.withColumn("entry_partition", partition_key(F.col("created_at"), first, last))


def write_routed(df: DataFrame, path: str, first: str = K.FIRST_PARTITION_MONTH,
                 last: str = K.LAST_PARTITION_MONTH) -> None:
    write_by_month(route(df, first, last), path, month_col="entry_partition")


def overwrite_months(df: DataFrame, path: str, month_col: str = "month", key_col: str = "wallet_id") -> None:
    """SNK-2: replace exactly the months present in ``df`` (dynamic partition overwrite)."""
    write_by_month(df, path, month_col=month_col, key_col=key_col, dynamic=True)


def flat_to_partitioned(spark: SparkSession, flat_path: str, out_path: str) -> DataFrame:
    """SRC-4: rewrite a flat entries table month-partitioned; returns the partitioned reader."""
    flat = spark.read.parquet(flat_path)
    if "posting_month" not in flat.columns:
        flat = flat.withColumn("posting_month", F.date_format("created_at", "yyyy-MM"))
    write_by_month(flat, out_path)
    return spark.read.parquet(out_path)


# The published shape of the benchmark ledger.
GEN_STATUS_PERCENT = (("SETTLED", 85), ("PENDING", 10), ("REVERSED", 5))
GEN_CURRENCIES = ("USD", "VND", "EUR")
GEN_START, GEN_DAYS = "2024-07-01 00:00:00", 730
GEN_WALLETS = 200_000


def draw(seed: Column, lane: int, n: int) -> Column:
    """A number below ``n`` from one of the four 32-bit lanes of the seed's md5."""
    return F.conv(F.substring(F.md5(seed), 8 * lane + 1, 8), 16, 10).cast("bigint") % n


def generate_ledger(ids: DataFrame, id_col: str = "i", n_wallets: int = GEN_WALLETS) -> tuple[DataFrame, DataFrame]:
    """SRC-3: the benchmark ledger -- its status mix over its months, one payer and one payee leg per header.

    ``ids`` is any DataFrame of integer ids (``spark.range`` in the benchmark,
    order keys when registered as a query).  Everything about a header is
    drawn from the lanes of one md5 of its id, so the values are the same
    wherever and however often it is generated: status, posting second, amount
    and currency, payer; the payee is another wallet at a drawn distance.
    """
    name = F.concat(F.lit("G"), F.lpad(F.col(id_col).cast("string"), 12, "0"))
    percent, top, status = draw(name, 0, 100), 0, F.lit(None).cast("string")
    for value, share in GEN_STATUS_PERCENT:
        top += share
        status = F.coalesce(status, F.when(percent < top, value))
    second = draw(name, 1, GEN_DAYS * 86_400)
    drawn = ids.select(
        name.alias("transaction_id"), status.alias("status"),
        (F.lit(GEN_START).cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), second.cast("decimal(18,6)"))).alias("created_at"),
        ((draw(name, 2, 10_000_000) + 100) / F.lit(100)).cast(MONEY).alias("amount"),
        F.element_at(F.array(*map(F.lit, GEN_CURRENCIES)), (draw(name, 2, len(GEN_CURRENCIES)) + 1).cast("int")).alias("currency"),
        draw(name, 3, n_wallets).alias("payer"), (1 + draw(name, 0, n_wallets - 1)).alias("distance"))
    drawn = drawn.withColumn("posting_month", F.date_format("created_at", "yyyy-MM"))
    headers = drawn.select("transaction_id", "status", "created_at", "posting_month")

    def leg(kind: str, wallet: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), F.concat(F.lit("GW-"), wallet.cast("string")).alias("wallet_id"))

    payee = (F.col("payer") + F.col("distance")) % n_wallets
    entries = (drawn.select("transaction_id", "amount", "currency", "created_at", "posting_month",
                            F.inline(F.array(leg("DEBIT", F.col("payer")), leg("CREDIT", payee))))
               .select(F.concat_ws("-", "transaction_id", "type").alias("entry_id"), "transaction_id", "wallet_id", "type",
                       "amount", "currency", "created_at", "posting_month"))
    return headers, entries
