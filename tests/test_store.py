"""The stored ledger equals its derivation and is written once per input fingerprint."""

from pyspark.sql import functions as F

from tally.sources.fixtures import Ledger

from .conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stored_equals_derived_and_is_reused(spark):
    stored, derived = Ledger(spark, SF_SMALL), Ledger(spark, SF_SMALL, stored=False)
    assert stored.entries_with_keys.columns == derived.entries_with_keys.columns
    types = [(f.name, f.dataType) for f in stored.entries_with_keys.schema.fields]
    assert types == [(f.name, f.dataType) for f in derived.entries_with_keys.schema.fields]
    assert _rows(stored.entries_with_keys) == _rows(derived.entries_with_keys)
    assert _rows(stored.order_flow) == _rows(derived.order_flow)
    again = Ledger(spark, SF_SMALL)
    assert again.store_root == stored.store_root
    files = again.entries_with_keys.select(F.input_file_name()).distinct().count()
    assert files >= 1


def test_month_filter_prunes_the_stored_layout(spark):
    e = Ledger(spark, SF_SMALL).entries.filter(F.col("posting_month") == "1998-06")
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(posting_month" in plan
