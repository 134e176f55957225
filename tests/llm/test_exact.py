"""Exact dedup against a plain grouping."""

import random

import pytest
from pyspark.sql import functions as F

from tally.llm.exact import exact_groups, op13_exact_dedup
from tally.llm.staging import table
from tests.conftest import SF_SMALL
from tests.llm import brute, data

TEXTS = "doc_id long, text string"


def _rows():
    rnd = random.Random(11)
    texts = ["", None, " ", "A b", "a B", "É", "é", "x" * 200_000, "X" * 200_000, "İ", "K", "k"]
    rows = [(i, rnd.choice(texts)) for i in range(80)]
    rows += [(200 + i, f"only {i}") for i in range(300)]
    rows += [(1000 + i, "Hot Text") for i in range(400)]              # half of the rows
    return rows + [(None, "a b"), (None, "null id only"), (None, "null id only"), (7, rows[7][1]), (200, "only 0")]


@pytest.mark.parametrize("most_bits", [1 << 29, 1 << 16])
def test_groups(spark, most_bits):
    rows = _rows()
    df = data.clash(spark.createDataFrame(rows, TEXTS)).withColumns({"digest": F.lit(1), "row": F.lit("r"), "keep": F.lit(None)})
    found = exact_groups(df, most_bits=most_bits)
    assert brute.ordered(found.select("doc_id", "keep_id", "group_size", "text_sha256").collect()) == brute.equal_texts(rows)
    kept = found.where("kept").collect()
    assert len(kept) == len({r["text_sha256"] for r in kept}) == len({r[-1] for r in brute.equal_texts(rows)})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    from tally.llm import bloom
    monkeypatch.setattr(bloom, "MIN_BITS", 64)
    rows = _rows()
    found = exact_groups(spark.createDataFrame(rows, TEXTS), most_bits=64)
    assert brute.ordered(found.select("doc_id", "keep_id", "group_size", "text_sha256").collect()) == brute.equal_texts(rows)


def test_carried_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "A", "p"), (2, "a", "q"), (3, "b", None)], TEXTS + ", text_sha256 string")
    got = {r["doc_id"]: (r["carried_0"], r["carried_1"], r["kept"]) for r in exact_groups(df, carry=("text_sha256", "text")).collect()}
    assert got == {1: ("p", "A", False), 2: ("q", "a", True), 3: (None, "b", True)}
    assert exact_groups(df.where("doc_id > 5")).count() == 0


def test_on_documents(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    got = op13_exact_dedup(spark, SF_SMALL).select("doc_id", "keep_id", "group_size", "text_sha256").collect()
    assert brute.ordered(got) == brute.equal_texts(rows)
