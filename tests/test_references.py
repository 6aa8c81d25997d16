"""Referential checks in one pass, against plain counting; scans and shuffles of what is written."""

import re

import pytest
from pyspark.sql import functions as F

from martloom.operators.references import Reference, dangling
from martloom.plans import quality_suite
from martloom.plans.mart import Mart
from tests import samples
from tests.test_mart import START


def test_counts_of_several_references(make):
    rows = make("a int, b string, c long", [(1, "x", 5), (1, "y", None), (2, None, 5), (3, "x", 6), (3, "x", 6)])
    other = make("c long", [(6,), (None,)])
    ids = make("a int, name string", [(1, "x"), (2, "x"), (2, "z"), (None, None)])
    got = dangling(
        [
            Reference("a", rows, "a", ids, "a"),
            Reference("b", rows, "b", ids, "name"),
            Reference("c", rows, "c", other, "c", other_unique=True),
            Reference("back", other, "c", rows, "c"),
            Reference("none", ids.where("a = 1"), "a", rows, "a"),
        ]
    )
    assert {r["item"]: r["value"] for r in got.collect()} == {"a": 2, "b": 2, "c": 3, "back": 1, "none": 0}


def test_empty_tables(make):
    rows = make("a int", [])
    assert [tuple(r) for r in dangling([Reference("a", rows, "a", rows, "a")], "x", "n").collect()] == [("a", 0)]
    assert dangling([Reference("a", make("a int", [(1,), (None,)]), "a", rows, "a")]).first()["value"] == 2


def test_keys_of_an_unbroken_run_meet_no_join(make, operators):
    """Gapless keys match by their bounds; a gap, a key below or above, NULL and the unknown member go on to the join."""
    fact = make("a int, b long", [(1, 1), (2, 2), (3, 4), (4, 3), (None, None), (-1, -1), (-2, 9)])
    gapless = make("a long", [(3,), (1,), (2,), (2,), (-1,), (None,)])
    gap = make("b int", [(1,), (2,), (2,), (4,), (-1,)])  # as many rows as an unbroken 1 to 4 with the unknown member
    got = dangling([Reference("a", fact, "a", gapless, "a"), Reference("b", fact, "b", gap, "b", other_unique=True)])
    assert {r["item"]: r["value"] for r in got.collect()} == {"a": 3, "b": 3}
    assert "array_compact" in operators(got) or "subquery" in operators(got).lower()


@pytest.fixture
def written(spark, monkeypatch):
    """Executed plans of everything the quality suite stages."""
    plans = []

    def kept(df, name):
        staged = original(df, name)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged

    original = quality_suite.stage
    monkeypatch.setattr(quality_suite, "stage", kept)
    return plans


def scans(plan, table):
    return len(re.findall(rf"Scan parquet [^\n]*Location: [^\n]*{table}", plan))


def test_validation_reads_the_item_fact_twice(spark, written, operators):
    mart = Mart(spark, samples.feeds(spark), START)
    final = quality_suite.validate(mart)
    plan = operators(final)
    assert sum(scans(p, "fact_order_items") for p in written) + scans(plan, "fact_order_items") == 2
    assert sum(scans(p, "fact_payments") for p in written) == 1
    keys = next(p for p in written if "_target" in p)
    assert "partial_count" in keys and keys.count("LeftAnti") <= 2  # Spark may push the join below the union of both facts
    final.agg(F.count("*")).collect()
