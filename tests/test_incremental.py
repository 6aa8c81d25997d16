from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.plans import build
from martloom.plans.dimensions import dim_date, fixed_bounds
from martloom.plans.facts import ITEM_KEYS
from martloom.plans.incremental import LoadControl, expected_new_rows, incremental_load, newer_than, undated_items
from martloom.plans.reports import monthly_trend
from martloom.sources.tables import Warehouse
from tests import samples

MOMENT = "order_purchase_timestamp"
NOW = datetime(2019, 1, 1)
SCHEMA = "order_id string, order_item_id int, t timestamp_ntz"


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def day(n):
    return datetime(2018, 1, 1) + timedelta(days=n)


def load(warehouse, source, **options):
    return incremental_load(warehouse, "fact", source, "t", lambda new: new, ITEM_KEYS, NOW, **options)


def test_first_load_takes_everything_then_only_newer_rows(warehouse, make):
    source = make(SCHEMA, [("a", 1, day(1)), ("b", 1, day(2)), ("u", 1, None)])
    assert load(warehouse, source) == 3
    assert load(warehouse, source) == 0
    # Same moment as the mark is not newer; an undated row never is.
    more = source.unionByName(make(SCHEMA, [("c", 1, day(2)), ("d", 1, day(3)), ("d", 2, day(3)), ("v", 1, None)]))
    assert load(warehouse, more) == 2
    fact = warehouse.read("mart", "fact")
    assert {r["order_id"]: r["load_batch"] for r in fact.collect()} == {"a": 1, "b": 1, "u": 1, "d": 3}
    state = LoadControl(warehouse).state("fact")
    assert (state.watermark, state.rows, state.batch) == (day(3), 2, 3)


def test_lookback_picks_up_late_rows_once(warehouse, make):
    load(warehouse, make(SCHEMA, [("a", 1, day(1)), ("b", 1, day(10))]))
    late = make(SCHEMA, [("a", 1, day(1)), ("b", 1, day(10)), ("late", 1, day(8))])
    assert load(warehouse, late, lookback=timedelta(days=5)) == 1
    assert load(warehouse, late, lookback=timedelta(days=5)) == 0


def test_rolled_back_mark_reloads_without_duplicates(warehouse, make):
    source = make(SCHEMA, [("a", 1, day(1)), ("b", 1, day(40))])
    load(warehouse, source)
    control = LoadControl(warehouse)
    control.roll_back("fact", 30)
    assert control.state("fact").watermark == day(10) and control.state("fact").rows == 2
    assert load(warehouse, source) == 0
    assert warehouse.read("mart", "fact").count() == 2
    control.roll_back("fact", 30)
    assert load(warehouse, source, dedup=False) == 1
    assert warehouse.read("mart", "fact").where("order_id = 'b'").count() == 2


def test_failed_load_is_repeated_under_the_same_batch(warehouse, make, monkeypatch):
    source = make(SCHEMA, [("a", 1, day(1))])
    load(warehouse, source)
    more = source.unionByName(make(SCHEMA, [("b", 1, day(2))]))
    with monkeypatch.context() as patch:
        patch.setattr(LoadControl, "record", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            load(warehouse, more)
    assert load(warehouse, more) == 1
    assert {(r["order_id"], r["load_batch"]) for r in warehouse.read("mart", "fact").collect()} == {("a", 1), ("b", 2)}


def test_mark_never_becomes_null(warehouse, make):
    load(warehouse, make(SCHEMA, [("a", 1, day(1))]))
    load(warehouse, make(SCHEMA, [("u", 1, None)]))
    assert LoadControl(warehouse).state("fact").watermark == day(1)


def test_mark_filter_reaches_the_parquet_scan(warehouse, make, operators):
    source = warehouse.write(make(SCHEMA, [("a", 1, day(1))]), "staging", "orders")
    plan = newer_than(source, "t", day(0))
    plan.collect()
    assert "GreaterThan(t,2018-01-01T00:00)" in operators(plan)


def test_snapshots_replace_and_keep_reading_the_old_files(warehouse, make, collect):
    first = warehouse.write(make("v int", [(1,)]), "mart", "t")
    second = warehouse.write(first.withColumn("v", F.col("v") + 1), "mart", "t")
    assert collect(first) == [(1,)] and collect(second) == [(2,)] and warehouse.version("mart", "t") == 2
    with pytest.raises(LookupError):
        warehouse.read("mart", "missing")
    with pytest.raises(ValueError):
        warehouse.write(first, "nowhere", "t")


def write_feeds(spark, folder):
    """The sample feeds as CSV files, as the sources deliver them."""
    paths = {}
    for feed, df in samples.feeds(spark).items():
        paths[feed] = f"{folder}/{feed}"
        df.select(*[F.col(c).cast("string") for c in df.columns]).write.option("header", True).option("escape", '"').csv(paths[feed])
    return paths


def test_full_build_refresh_and_checks(spark, warehouse, tmp_path, collect):
    rejects = build.load_staging(warehouse, write_feeds(spark, tmp_path / "csv"))
    assert set(rejects) == set(samples.ROWS) and not any(rejects.values())
    assert dict(warehouse.read("staging", "orders").dtypes)[MOMENT] == "timestamp_ntz"

    mart = build.build_warehouse(warehouse, date(2016, 1, 1), NOW)
    fact = warehouse.read("mart", "fact_order_items")
    assert fact.count() == len(samples.ITEMS)
    assert {r["month_sk"] for r in fact.select("month_sk").distinct().collect()} == {201801, 201802, -1}
    assert warehouse.read("mart", "dim_customer").where("rfm_segment is null").count() == 0
    assert warehouse.read("intermediate", "rfm_segments").count() == 3
    checks = build.run_quality_checks(warehouse, mart, NOW)
    assert checks.where("status = 'FAIL'").count() == 0 and checks.count() == 11
    assert build.run_staging_checks(warehouse, 6, NOW).count() == 2

    # Nothing new; then a period again; then a really new order.
    assert build.refresh_order_items(warehouse, date(2016, 1, 1), NOW) == 0
    control = LoadControl(warehouse)
    control.roll_back("fact_order_items", 30)
    orders, items = warehouse.read("staging", "orders"), warehouse.read("staging", "order_items")
    assert expected_new_rows(items, orders, MOMENT, control.state("fact_order_items").watermark).first()[0] == 3
    assert build.refresh_order_items(warehouse, date(2016, 1, 1), NOW) == 0
    assert undated_items(items, orders, MOMENT).first()[0] == 2
    new_order = spark.createDataFrame(
        [("o9", "c4", "shipped", samples.day(50), None, None, None, samples.day(60))], samples.typed_schema("orders")
    )
    new_item = spark.createDataFrame(
        [("o9", 1, "p1", "s1", None, Decimal("5.00"), Decimal("1.00"))], samples.typed_schema("order_items")
    )
    warehouse.write(orders.unionByName(new_order), "staging", "orders")
    warehouse.write(items.unionByName(new_item), "staging", "order_items")
    assert build.refresh_order_items(warehouse, date(2016, 1, 1), NOW) == 1
    loaded = warehouse.read("mart", "fact_order_items").where("order_id = 'o9'").first()
    assert (loaded["date_sk"], loaded["month_sk"], loaded["freight_pct"]) == (20180301, 201803, Decimal("0.2000"))
    assert loaded["customer_sk"] > 0 and loaded["product_sk"] > 0

    # A seller moves: its old version expires and new items get the new version.
    moved = spark.createDataFrame([("s1", "01000", "santos", "SP")], samples.typed_schema("sellers"))
    merged = build.refresh_sellers(warehouse, moved, date(2018, 4, 1))
    assert merged.where("seller_id = 's1'").count() == 2

    # The rebuild can be repeated: it replaces the item fact with one batch.
    build.build_warehouse(warehouse, date(2016, 1, 1), NOW)
    again = warehouse.read("mart", "fact_order_items")
    assert again.count() == len(samples.ITEMS) + 1 and collect(again.select("load_batch").distinct()) == [(1,)]


def test_trend_reads_only_its_months(warehouse, spark, make, operators):
    schema = "date_sk int, price decimal(18,2), freight_value decimal(18,2)"
    fact = make(schema, [(20180110, Decimal(1), Decimal(1)), (20180210, Decimal(2), Decimal(1)), (-1, Decimal(3), Decimal(1))])
    stored = warehouse.write(fact.withColumn("month_sk", build.month_key(F.col("date_sk"))), "mart", "f", ["month_sk"])
    calendar = dim_date(fixed_bounds(spark, date(2018, 1, 1), date(2018, 12, 31)))
    trend = monthly_trend(stored, calendar, date(2018, 2, 1), date(2018, 2, 28))
    assert [(r["month"], r["items"]) for r in trend.collect()] == [(2, 1)]
    plan = operators(trend)
    assert "month_sk#" in plan and ">= 201802)" in plan.split("PartitionFilters:")[1]


def test_partitioned_fact_is_pruned_by_month(warehouse, make, operators):
    fact = make("date_sk int, price int", [(20180110, 1), (20180210, 2), (-1, 3)])
    stored = warehouse.write(fact.withColumn("month_sk", build.month_key(F.col("date_sk"))), "mart", "f", ["month_sk"])
    january = stored.where("month_sk = 201801")
    assert january.count() == 1
    assert "PartitionFilters: [isnotnull(month_sk" in operators(january)


def test_tables_without_rows_are_read_back(warehouse, make):
    rows = make("month_sk int, v string", [(1, "a")])
    assert warehouse.write(rows.where("v = 'b'"), "mart", "none", ["month_sk"]).count() == 0
    warehouse.append(rows.where("v = 'b'"), "mart", "later", 1, ["month_sk"])
    assert warehouse.read("mart", "later").count() == 0
    warehouse.append(rows, "mart", "later", 2, ["month_sk"])
    got = warehouse.read("mart", "later").select("v", "month_sk", "load_batch").collect()
    assert [tuple(r) for r in got] == [("a", 1, 2)]


def test_unrecorded_batches_are_not_read(warehouse, make, monkeypatch):
    rows = make("v int", [(1,)])
    warehouse.append(rows, "mart", "t", 1)

    def lost(*args, **values):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(warehouse, "_record", lost)
        for batch in (1, 2):
            with pytest.raises(RuntimeError, match="driver lost"):
                warehouse.append(rows.selectExpr("v + 1 as v"), "mart", "t", batch)
    read = lambda: sorted(tuple(r) for r in warehouse.read("mart", "t").collect())
    assert read() == [(1, 1)]
    warehouse.append(rows.selectExpr("v + 2 as v"), "mart", "t", 1)
    warehouse.append(rows.selectExpr("v + 3 as v"), "mart", "t", 2)
    assert read() == [(3, 1), (4, 2)]


def test_own_keys_go_on_after_a_failed_attempt(warehouse, make, monkeypatch):
    source = make(SCHEMA, [("b", 1, day(1)), ("a", 2, day(1)), ("a", 1, day(1))])
    assert load(warehouse, source, key="sk") == 3
    more = source.unionByName(make(SCHEMA, [("0", 1, day(2)), ("c", 1, day(3))]))
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_record", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            load(warehouse, more, key="sk")
    assert load(warehouse, more, key="sk") == 2
    assert load(warehouse, more, key="sk") == 0
    last = more.unionByName(make(SCHEMA, [("d", 1, day(4))]))
    assert load(warehouse, last, key="sk") == 1
    got = warehouse.read("mart", "fact").select("sk", "order_id", "order_item_id").collect()
    assert sorted(map(tuple, got)) == [(1, "a", 1), (2, "a", 2), (3, "b", 1), (4, "0", 1), (5, "c", 1), (6, "d", 1)]


def test_replaced_partitions_hide_earlier_batches(warehouse, make, operators):
    rows = make("month int, v string", [(1, "a"), (2, "b"), (3, "c"), (-1, "u")])
    assert warehouse.append(rows, "mart", "t", 1, ["month"]) == 4
    assert warehouse.append(rows.where("month = 2"), "mart", "t", 2, ["month"]) == 1
    assert warehouse.append(make("month int, v string", [(2, "new"), (3, "also")]), "mart", "t", 3, ["month"], replaces=("month", [2, 3])) == 2
    assert warehouse.append(rows.where("v = 'c'"), "mart", "t", 4, ["month"]) == 1
    read = warehouse.read("mart", "t")
    assert sorted((r["month"], r["v"], r["load_batch"]) for r in read.collect()) == [(-1, "u", 1), (1, "a", 1), (2, "new", 3), (3, "also", 3), (3, "c", 4)]
    plan = operators(read)
    assert "PartitionFilters: [((load_batch" in plan and "DataFilters: []" in plan
    # Emptied by a batch without rows; a column that doesn't partition the table can't be replaced by.
    assert warehouse.append(rows.where("v = 'none'"), "mart", "t", 5, ["month"], replaces=("month", [1])) == 0
    assert warehouse.read("mart", "t").where("month = 1").count() == 0
    with pytest.raises(ValueError):
        warehouse.append(rows, "mart", "t", 6, replaces=("month", [1]))


def test_stored_increment_prunes_months_and_reads_items_once(spark, warehouse, tmp_path, collect, monkeypatch):
    build.load_staging(warehouse, write_feeds(spark, tmp_path / "csv"))
    build.build_warehouse(warehouse, date(2016, 1, 1), NOW, keyed=True)
    whole = collect(warehouse.read("mart", "fact_order_items").drop("load_batch", "order_item_sk"))
    assert sorted(r["payment_sk"] for r in warehouse.read("mart", "fact_payments").collect()) == [1, 2, 3, 4]
    assert warehouse.read("mart", "fact_delivery_reviews").agg(F.max("delivery_review_sk")).first()[0] == len(samples.ORDERS)
    control = LoadControl(warehouse)
    plans = []
    write = Warehouse._write_files

    def watched(self, df, path, *rest):
        if "fact_order_items" in path:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, path, *rest)

    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)  # whole paths in plans
    monkeypatch.setattr(Warehouse, "_write_files", watched)
    monkeypatch.setattr("martloom.plans.incremental.with_surrogate_key", lambda rows, keys, name, start: rows.withColumn(name, F.lit(start)))
    control.roll_back("fact_order_items", 30)
    assert build.refresh_order_items(warehouse, date(2016, 1, 1), NOW) == 0
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    (plan,) = plans
    assert plan.count("staging/order_items/") == 1
    (fact,) = [line for line in plan.splitlines() if "mart/fact_order_items/" in line]
    assert "month_sk" in fact.split("PartitionFilters: ")[1].split("]")[0]
    monkeypatch.undo()

    # Appended again, then the touched months replaced: the same rows as at first, keys unique and going on.
    control.roll_back("fact_order_items", 30)
    again = build.refresh_order_items(warehouse, date(2016, 1, 1), NOW, dedup=False)
    assert again == 3 and warehouse.read("mart", "fact_order_items").count() == len(whole) + 3
    control.roll_back("fact_order_items", 30)
    build.reload_order_items(warehouse, date(2016, 1, 1), NOW)
    fact = warehouse.read("mart", "fact_order_items")
    assert collect(fact.drop("load_batch", "order_item_sk")) == whole
    assert fact.select("order_item_sk").distinct().count() == len(whole)


def test_rebuilds_keep_the_disk_constant(warehouse, make):
    rows = make("month int, v string", [(1, "a"), (2, "b")])
    root = warehouse.root

    def folders():
        return sorted(p for p in (f"{root}/mart/t/{n}" for n, _ in warehouse._folders(f"{root}/mart/t")) if "version=" in p)

    for _ in range(4):
        warehouse.write(rows, "mart", "t", ["month"])
        warehouse.tidy("mart", "t", timedelta(0))
        assert len(folders()) == 1
    old = warehouse.write(rows, "mart", "t", ["month"])
    assert warehouse.tidy("mart", "t", timedelta(hours=1)) == []  # a reader may still be at it
    assert old.count() == 2 and warehouse.read("mart", "t").count() == 2


def test_batches_are_merged_and_repeated_attempts_removed(warehouse, make, collect):
    rows = make("month int, sk long, v string", [(1, 1, "a"), (2, 2, "b"), (-1, 3, "u")])
    for batch in (1, 2):
        warehouse.append(rows.withColumn("sk", F.col("sk") + 3 * (batch - 1)), "mart", "t", batch, ["month"], key="sk")
    warehouse.append(rows.where("sk = 3"), "mart", "t", 2, ["month"], key="sk")
    (gone,) = warehouse.tidy("mart", "t", timedelta(0))
    assert gone.endswith("load_batch=2/load_attempt=1")
    warehouse.append(make("month int, sk long, v string", [(1, 7, "new")]), "mart", "t", 3, ["month"], key="sk", replaces=("month", [1, 2]))
    before = collect(warehouse.read("mart", "t").drop("load_batch"))
    warehouse.compact("mart", "t", ["month"])
    warehouse.tidy("mart", "t", timedelta(0))
    assert collect(warehouse.read("mart", "t").drop("load_batch")) == before == [(-1, 3, "u"), (-1, 3, "u"), (1, 7, "new")] or len(before) == 3
    assert warehouse.last_batch("mart", "t") == 3 and warehouse.last_key("mart", "t", 4) == 7
    assert warehouse.append(rows, "mart", "t", 4, ["month"], key="sk") == 3 and warehouse.read("mart", "t").count() == 6
