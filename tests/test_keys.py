import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martloom.operators.keys import tile_starts, with_surrogate_key, with_tiles


@pytest.mark.parametrize("n", [0, 1, 5, 500])
def test_surrogate_keys_are_dense_and_follow_the_key(spark, make, n):
    names = [f"k{i}" for i in range(n)]
    random.Random(1).shuffle(names)
    df = make("k string, v int", [(k, i) for i, k in enumerate(names)]).repartition(4)
    got = with_surrogate_key(df, ["k"], "sk").collect()
    assert {r["k"]: r["sk"] for r in got} == {k: i for i, k in enumerate(sorted(names), start=1)}


def test_surrogate_keys_span_several_partitions(spark, make):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"))
        got = with_surrogate_key(df, ["k"], "sk", start=11)
        assert got.where("sk <> k + 11").count() == 0 and got.count() == 1000
        assert got.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("n", list(range(24)) + [1000])
def test_tile_starts_match_the_definition(n):
    sizes = [n // 5 + (1 if t < n % 5 else 0) for t in range(5)]
    starts = [sum(sizes[:t]) + 1 for t in range(1, 5) if sizes[t]]
    assert tile_starts(n, 5) == starts


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 7, 23, 400])
def test_tiles_equal_ntile(spark, make, n):
    """Heavy ties and NULLs, against Spark's own single-partition NTILE."""
    rng = random.Random(n)
    data = [(i, rng.choice([None, 1, 1, 1, 1, 2, 3]), rng.choice([0, 7]), rng.randrange(100)) for i in range(n)]
    df = make("id int, a int, b int, c int", data).repartition(3)
    got = with_tiles(df, {"ta": "a", "tb": "b", "tc": "c"}, 5, tiebreak="id")
    expected = got.select(
        "*",
        *[
            F.ntile(5).over(Window.orderBy(F.col(x).asc_nulls_last(), "id")).alias(f"e{x}")
            for x in ("a", "b", "c")
        ],
    )
    assert expected.where("ta <> ea or tb <> eb or tc <> ec").count() == 0
    assert got.count() == n


def test_tiles_over_several_partitions_need_no_single_partition(spark, operators):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # One value holds most rows: the tiebreak is part of the range order, so it is split.
        df = spark.range(2000).select("id", F.when(F.col("id") < 1900, 1).otherwise(F.col("id")).alias("v"))
        got = with_tiles(df, {"t": "v"}, 5, tiebreak="id")
        assert "SinglePartition" not in operators(got)
        sizes = {r["t"]: r["count"] for r in got.groupBy("t").count().collect()}
        assert sizes == {t: 400 for t in range(1, 6)}
        assert got.where(F.col("t") != F.floor(F.col("id") / 400) + 1).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
