from datetime import datetime

import pytest
from pyspark.sql import functions as F

from martloom.operators.lookup import (
    DuplicateKeys,
    count_unmatched,
    latest_per_key,
    lookup,
    require_unique,
    unmatched,
    with_unknown_member,
)


@pytest.fixture
def dim(make):
    members = make("sk bigint, code string, is_current int", [(1, "a", 1), (2, "b", 0), (3, "b", 1), (4, "c", 0)])
    return with_unknown_member(members, "sk", {"code": "UNKNOWN", "is_current": 1})


def test_lookup_keeps_every_row_and_routes_misses_to_unknown(make, dim, collect):
    facts = make("id int, code string", [(1, "a"), (2, "b"), (3, "c"), (4, "zz"), (5, None), (6, "UNKNOWN")])
    got = lookup(facts, dim, {"code": "code"}, "sk", where=F.col("is_current") == 1)
    assert collect(got.select("id", "sk")) == [(1, 1), (2, 3), (3, -1), (4, -1), (5, -1), (6, -1)]


def test_unknown_member_is_one_row_with_defaults(dim):
    assert [tuple(r) for r in dim.where("sk = -1").collect()] == [(-1, "UNKNOWN", 1)]


def test_repeated_lookup_keys_are_refused(make):
    rows = make("k string, v int", [("a", 1), ("a", 2), ("b", 1)])
    with pytest.raises(DuplicateKeys, match="products"):
        require_unique(rows, ["k"], "products")
    assert require_unique(rows, ["k", "v"], "products") is rows


def test_unmatched_counts_null_keys_and_repeats(make, collect):
    left = make("id int, k string", [(1, "a"), (2, "x"), (3, "x"), (4, None)])
    right = make("key string", [("a",), ("a",), (None,)])
    assert collect(unmatched(left, right, {"k": "key"}).select("id")) == [(2,), (3,), (4,)]
    assert count_unmatched(left, right, {"k": "key"}, "n").first()["n"] == 3
    assert count_unmatched(left.where("id = 1"), right, {"k": "key"}, "n").first()["n"] == 0
    assert count_unmatched(left.where("id > 9"), right, {"k": "key"}, "n").first()["n"] == 0


def test_latest_per_key_orders_nulls_last_and_breaks_ties(make, collect, operators):
    data = [
        ("o1", 1, datetime(2020, 1, 1)),
        ("o1", 2, datetime(2020, 1, 2)),
        ("o1", 3, datetime(2020, 1, 2)),
        ("o2", 4, None),
        ("o2", 5, datetime(2019, 1, 1)),
        ("o3", 6, None),
    ]
    reviews = make("order_id string, id int, t timestamp_ntz", data)
    got = latest_per_key(reviews, ["order_id"], [F.col("t").desc_nulls_last(), F.col("id").desc_nulls_last()])
    assert collect(got.select("order_id", "id")) == [("o1", 3), ("o2", 5), ("o3", 6)]
    # Rows are pruned to one per key before they are shuffled.
    plan = operators(got)
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_hot_join_keys_are_split(spark, dim, make):
    """A third of the rows on one key: the adaptive plan splits that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "10",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        code = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        facts = spark.range(0, 60000, 1, 8).select("id", code.alias("code"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        members = spark.range(0, 60000, 1, 4).select(F.col("id").alias("sk"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("code"))
        got = lookup(facts, members, {"code": "code"}, "sk")
        unknown = got.groupBy((F.col("sk") == -1).alias("unknown")).count()
        assert {r["unknown"]: r["count"] for r in unknown.collect()} == {True: 20000, False: 40000}
        got.write.format("noop").mode("overwrite").save()
        counted = got.where("length(pad) = 64").select("id", "sk", "pad")
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
        orphans = unmatched(facts, members, {"code": "code"})
        assert len(orphans.collect()) == 20000
        assert "skew=true" in orphans._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
