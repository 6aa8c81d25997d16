"""Repeated orders and customers: no item is multiplied in a full build, an increment or a stream."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martloom.operators.lookup import one_per_key, settle_repeats
from martloom.plans.mart import Mart
from martloom.sources.tables import Warehouse
from martloom.streaming.fact_stream import file_stream, stream_fact
from tests import samples
from tests.test_mart import START


def test_one_row_per_key(make, collect):
    rows = make("k int, t timestamp_ntz, v string", [(1, datetime(2020, 1, 1), "b"), (1, datetime(2020, 1, 2), "a"), (2, None, "x"), (2, None, None), (None, None, "n"), (None, None, "m")])
    assert collect(one_per_key(rows, ["k"], ["t"]).select("k", "v")) == [(1, "a"), (2, "x"), (None, "n")]
    kept, repeated = settle_repeats(rows, ["k"], ["t"])
    assert collect(kept.select("k", "v")) == [(1, "a"), (2, "x"), (None, "m"), (None, "n")]
    assert collect(repeated) == [(1, 2), (2, 2)]
    kept, repeated = settle_repeats(rows.where("v in ('a', 'x', 'm')"), ["k"])
    assert repeated is None and kept.count() == 3


def test_the_key_is_shuffled_once(make, operators):
    rows = make("k string, t int, v string", [("a", 1, "x"), ("a", 2, None), (None, 3, "y")])
    best = one_per_key(rows, ["k"], ["t"])
    assert best.columns == ["k", "t", "v"] and sorted(map(tuple, best.collect()), key=repr) == [("a", 2, None), (None, 3, "y")]
    assert "named_struct(k" not in best._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, one_per_key(rows.select("k"), ["k"]).collect()), key=repr) == [("a",), (None,)]


@pytest.fixture(scope="module")
def doubled(spark):
    """Every order and customer twice, the second time with another status and place."""
    feeds = samples.feeds(spark)
    again = feeds["orders"].withColumn("order_status", F.lit("a"))  # less than every status, so the first row counts
    moved = feeds["customers"].withColumn("customer_zip_code_prefix", F.lit("0"))
    return feeds | {"orders": feeds["orders"].unionByName(again), "customers": feeds["customers"].unionByName(moved)}


def test_items_stay_single(spark, doubled, tmp_path, collect):
    plain = Mart(spark, samples.feeds(spark), START)
    mart = Mart(spark, doubled, START)
    items = mart.feeds["order_items"]
    keys = ["order_id", "order_item_id", "date_sk", "product_sk"]
    whole = collect(plain.fact_order_items_plan().select(*keys))

    increment = mart.order_increment(mart.feeds["orders"].where("order_id < 'o4'"))
    assert collect(increment.rows.select(*keys)) == [r for r in whole if r[0] < "o4"]
    assert increment.slices == (-1, 201801) or set(increment.slices) >= {-1, 201801}
    assert {(r["feed"], r["key"], r["rows"]) for q in mart.quarantined for r in q.collect()} >= {("orders", "o1", 2), ("customers", "c1", 2)}

    folder, warehouse = str(tmp_path / "items"), Warehouse(spark, str(tmp_path / "warehouse"))
    items.where("order_id < 'o4'").unionByName(items.where("order_id = 'o1'")).coalesce(1).write.parquet(folder)
    items.where("order_id >= 'o3'").coalesce(1).write.mode("append").parquet(folder)
    failed = []

    def once(batch):
        if not failed:
            failed.append(batch)
            raise RuntimeError("lost after writing")

    def run():
        stream = file_stream(spark, folder, items.schema, files_per_batch=1)
        stream_fact(stream, mart.item_batch_plan, warehouse, "fact_order_items", str(tmp_path / "progress"), after_write=once)

    with pytest.raises(Exception, match="lost after writing"):
        run()
    run()
    got = warehouse.read("mart", "fact_order_items")
    assert collect(got.select(*keys)) == whole
    assert warehouse._batches("mart", "fact_order_items", 1)[0].attempt == 2

    mart.settle_feeds()
    assert collect(mart.fact_order_items_plan().select(*keys)) == whole
    assert mart.fact_delivery_reviews_plan().count() == len(samples.ORDERS)
