"""Query registry: key -> (Spark job over a Ledger, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.plans.oracle_views import with_views
from tally.session import configure
from tally.sources.fixtures import Ledger


@dataclass
class Query:
    key: str
    build: Callable[[Ledger], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(ledger) -> DataFrame`` under ``key`` with its oracle SQL body."""
    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def present(df: DataFrame) -> DataFrame:
    """Interface types for result comparison: exact decimals -> double (after exact
    arithmetic), dates -> ISO strings, small integers -> bigint."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def run(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    _load_all()
    configure(spark)
    return present(REGISTRY[key].build(Ledger(spark, sf_dir)))


def spark_callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: (lambda spark, sf_dir, _k=k: run(_k, spark, sf_dir)) for k in REGISTRY}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: with_views(q.sql) for k, q in REGISTRY.items() if q.sql}


def _load_all() -> None:
    # importing the catalogue modules registers their queries
    from tally.plans import (catalog_audit, catalog_graph, catalog_integrity,  # noqa: F401
                             catalog_migrate, catalog_monitor, catalog_postings, catalog_reports,
                             catalog_storage, catalog_stream)
