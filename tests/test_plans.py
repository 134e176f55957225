"""Plan assertions: pruning reaches the scan, small dimensions broadcast, no Python in batch hot paths."""

import pytest
from pyspark.sql import functions as F

from tally.operators import reports as R
from tally.session import scratch_path
from tally.sources.fixtures import Ledger
from tally.sources.storage import write_by_month

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def partitioned(spark):
    L = Ledger(spark, SF_SMALL)
    path = scratch_path(spark, "plan-entries")
    write_by_month(L.entries, path)
    hdr = scratch_path(spark, "plan-headers")
    L.transactions.write.parquet(hdr)
    return spark.read.parquet(path), spark.read.parquet(hdr)


def test_month_report_prunes_partitions_and_columns(partitioned):
    entries, headers = partitioned
    p = plan(R.settlement_report(entries, headers, "1998-06"))
    scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln and "posting_month" in ln][0]
    assert "PartitionFilters: [isnotnull(posting_month" in scan and "1998-06" in scan
    assert "PushedFilters: [" in scan and "created_at" in scan
    assert "entry_id" not in scan.split("ReadSchema:")[1]      # only the needed columns are read


def test_header_side_gets_its_own_range(partitioned):
    entries, headers = partitioned
    p = plan(R.settlement_report(entries, headers, "1998-06"))
    hdr_scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln and "posting_month" not in ln][0]
    assert "EqualTo(status,SETTLED)" in hdr_scan and "GreaterThanOrEqual(created_at" in hdr_scan


def test_batch_jobs_stay_in_the_jvm(spark):
    L = Ledger(spark, SF_SMALL)
    from tally.operators import integrity as I
    for df in (I.violations_all(L), R.monthly_rollup(L.entries, L.transactions), L.activity_audit):
        p = plan(df)
        assert "EvalPython" not in p and "PythonUDF" not in p


def test_fixed_size_dimensions_are_broadcast(spark):
    L = Ledger(spark, SF_SMALL)
    from tally.operators import postings as P
    p = plan(P.fx_enriched(L.transactions, L.exchange_rates, L.currencies))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_flagship_entry_schema(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["posting_month", "wallet_id", "currency", "settled_total"]
    assert df.count() == 226


def test_registered_report_prunes_both_sides(spark):
    from tally.plans import registry
    scans = [ln for ln in plan(registry.run("settlement_report", spark, SF_SMALL)).splitlines() if "FileScan parquet" in ln]
    assert len(scans) == 2
    assert all("PartitionFilters: [isnotnull(posting_month" in ln and "1998-06" in ln for ln in scans)


def test_routing_reads_the_stored_rollup(spark):
    from tally.plans import registry
    p = plan(registry.run("settlement_routed", spark, SF_SMALL))
    assert "routed-rollup" in p


def _shuffles(df):
    """The exchanges by hash of a plan before it runs."""
    return [ln for ln in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in ln]


def test_gate_and_edges_shuffle_the_legs_once_to_their_transaction(spark):
    from tally.operators import integrity as I
    from tally.operators.graph import ledger_edges
    L = Ledger(spark, SF_SMALL)
    accepted = _shuffles(I.posting_accepted(L.entries_staged, L.transactions, L.wallet_dim))
    assert len([ln for ln in accepted if "unit" in ln]) <= 3 and len(accepted) <= 8, accepted    # legs, headers, strays; wallets
    edges = ledger_edges(L.entries, L.transactions, L.wallet_dim, L.accounts)
    # no lists, which are sorted and spilled before they are shuffled
    assert "collect_list" not in edges._jdf.queryExecution().executedPlan().toString()
    assert len([ln for ln in _shuffles(edges) if "transaction_id" in ln]) == 2, _shuffles(edges)     # legs and headers
