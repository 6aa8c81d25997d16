"""Properties every plan must have to work on large data."""

import os
import re

import pytest

import __spark_entry__ as contract
from catalogue.queries import CATALOGUE
from martloom.plans.mart import Mart
from martloom.sources.driver_tables import driver_feeds
from tests.test_catalogue import SF_DIR
from tests.test_mart import START

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")

# Operators that pair all rows, leave the JVM, or gather a table in one task.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroups")


def lines(plan):
    return [re.sub(r"^[\s:+-]*(\*\(\d+\) )?", "", line) for line in plan.splitlines()]


# Queries of the warehouse need no Python in their tasks; the plans of other parts are tested beside them.
@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_plan_scales(spark, operators, name):
    plan = operators(contract.queries()[name](spark, SF_DIR))
    for operator in FORBIDDEN:
        assert operator not in plan, operator
    # One task may receive the partial results of a total, never rows to be sorted for a window.
    steps = lines(plan)
    for above, exchange in zip(steps, steps[1:]):
        if exchange.startswith("Exchange SinglePartition"):
            assert not above.startswith(("Sort", "Window")), above


@pytest.fixture(scope="module")
def mart(spark):
    return Mart(spark, driver_feeds(spark, SF_DIR), START)


def test_scans_read_only_the_needed_columns(mart, operators):
    plan = operators(mart.feeds["order_items"].agg({"price": "sum"}))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_returnflag:string>" in plan


def test_item_fact_shuffles_items_once_when_dimensions_are_small(mart, operators):
    plan = operators(mart.fact_order_items_plan())
    assert plan.count("Exchange hashpartitioning(order_id") == 1


def test_large_dimensions_are_not_broadcast(spark, mart, operators):
    """Beyond the size limit the lookups become shuffle joins with the same result."""
    small = {r["product_sk"]: r["count"] for r in mart.fact_order_items_plan().groupBy("product_sk").count().collect()}
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in before:
        spark.conf.set(k, "-1")
    try:
        fact = mart.fact_order_items_plan()
        assert "Broadcast" not in operators(fact)
        assert {r["product_sk"]: r["count"] for r in fact.groupBy("product_sk").count().collect()} == small
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_increment_scans_the_item_feed_without_shuffling_it(spark, mart, operators):
    orders = mart.feeds["orders"].where("order_purchase_timestamp > timestamp_ntz'2001-06-01 00:00:00'")
    fact = mart.new_order_items_plan(orders)
    assert 0 < fact.count() < mart.feeds["order_items"].count()
    assert "Exchange hashpartitioning" not in operators(fact)


def test_composite_keys_are_counted_without_multiplying_rows(spark, operators):
    plan = operators(contract.queries()["profile_composite_key"](spark, SF_DIR))
    assert "Expand" not in plan and "partial_count" in plan
