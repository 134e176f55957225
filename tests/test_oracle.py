"""Every registered query against its DuckDB twin on the smallest fixture (the driver's gate at sf0.01)."""

import duckdb
import pytest

from tally.plans.registry import oracle_sql, spark_callables

from ._compare import norm_rows
from .conftest import SF_SMALL  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
QUERIES = spark_callables()
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle_or_is_declared():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == set(), "queries without a DuckDB oracle"


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    cols = df.columns
    got = norm_rows([tuple(r) for r in df.collect()], cols)
    rel = duck.execute(ORACLE[key])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == sorted(cols)
    want = norm_rows(rel.fetchall(), dcols)
    assert got == want
