"""Every query by name: (session, folder of driver tables) -> DataFrame.

Results are presented with plain types (64-bit integers, doubles, text dates) so that they
compare with the SQL in ``catalogue.oracle`` value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce, wraps

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.columns import (
    count_where,
    has_accent,
    joined_key,
    month_key,
    visible_length,
)
from martloom.operators import scd2
from martloom.operators.keys import with_surrogate_key
from martloom.operators.lookup import unmatched
from martloom.operators.profiling import blanks, distribution, grain, key_sketches, nested_grain, ranges, row_counts, sketched_distinct
from martloom.operators.quality import status_summary
from martloom.operators.references import Reference, dangling
from martloom.plans import dimensions, facts, quality_suite, reports, rfm
from martloom.plans.incremental import (
    LoadControl,
    expected_new_rows,
    incremental_load,
    newest_moment,
    reload_slices,
    undated_items,
)
from martloom.plans.build import FACT_DAYS, ITEM_FACT, build_warehouse, load_staging, month_of, run_quality_checks
from martloom.plans.mart import Mart
from martloom.schemas import STAGING
from martloom.session import configure, folder_bytes, scratch_path, size_shuffles, stage
from martloom.sources.csv_feeds import load_csv, load_feed, type_timestamps
from martloom.sources.driver_tables import driver_feeds, driver_reader, order_items, sellers_feed
from martloom.sources.tables import Warehouse
from martloom.streaming.fact_stream import file_stream, stream_fact

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the catalogue; the SQL uses the same ones.
SELLERS_EFFECTIVE = date(1995, 1, 1)
SELLERS_AS_OF = date(2001, 9, 1)
TREND_FIRST, TREND_LAST = date(1996, 1, 1), date(2000, 12, 31)
REHEARSAL_DAYS = 30
LOADED_AT = datetime(2002, 1, 1)
ACCENTS = ("á", "ç", "é", "ã")
MOMENT = "order_purchase_timestamp"
# Bytes of rows as shuffled per byte of a compressed file, roughly.
COMPRESSED = 8

_marts: dict[tuple[str, str], Mart] = {}


def mart(spark: SparkSession, sf_dir: str) -> Mart:
    """The warehouse over a folder of driver tables, shared by the queries of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _marts:
        size_shuffles(spark, COMPRESSED * folder_bytes(spark, sf_dir))
        _marts[key] = Mart(configure(spark), driver_feeds(spark, sf_dir), SELLERS_EFFECTIVE)
    return _marts[key]


def present(df: DataFrame) -> DataFrame:
    """Plain types: numbers as bigint or double, dates and moments as text."""

    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


CATALOGUE: dict[str, Query] = {}


def query(build: Callable[[Mart], DataFrame]) -> Callable[[Mart], DataFrame]:
    """Register a function of the mart as the query of the same name."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(mart(spark, sf_dir)))

    CATALOGUE[build.__name__] = run
    return build


def source_query(build: Query) -> Query:
    """Register a function of (session, folder) as the query of the same name."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(configure(spark), sf_dir))

    CATALOGUE[build.__name__] = run
    return build


# --- feeds: counts, profiles, orphans -------------------------------------------------------


@query
def load_counts(m: Mart) -> DataFrame:
    return row_counts(m.feeds)


GRAINS = {
    "customers": {"distinct_key": "customer_id", "distinct_other": "customer_unique_id"},
    "orders": {"distinct_key": "order_id"},
    "products": {"distinct_key": "product_id"},
    "sellers": {"distinct_key": "seller_id"},
    "order_reviews": {"distinct_key": "review_id", "distinct_other": "order_id"},
    "geolocation": {"distinct_key": "geolocation_zip_code_prefix"},
}


@query
def profile_grain(m: Mart) -> DataFrame:
    profiles = []
    for feed, keys in GRAINS.items():
        profile = grain(m.feeds[feed], keys)
        if "distinct_other" not in keys:
            profile = profile.withColumn("distinct_other", F.lit(None).cast("bigint"))
        profiles.append(profile.select(F.lit(feed).alias("table_name"), "total", "distinct_key", "distinct_other"))
    return reduce(DataFrame.unionByName, profiles)


@query
def profile_composite_key(m: Mart) -> DataFrame:
    items = nested_grain(m.feeds["order_items"], "order_id", "order_item_id", "distinct_orders", "distinct_key")
    payments = nested_grain(m.feeds["order_payments"], "order_id", "payment_sequential", "distinct_orders", "distinct_key")
    return items.withColumn("table_name", F.lit("order_items")).unionByName(
        payments.withColumn("table_name", F.lit("order_payments"))
    )


@query
def profile_sketches(m: Mart) -> DataFrame:
    """Distinct keys of the items from sketches stored per month, and whether they are within 3 % of the exact counts."""
    items = m.feeds["order_items"].withColumn("month", F.date_trunc("month", "shipping_limit_date"))
    keys = {"order_id": F.col("order_id"), "product_id": F.col("product_id"), "item": joined_key(F.col("order_id"), F.col("order_item_id"))}
    stored = stage(key_sketches(items, keys, "month"), "item-sketches")
    about = sketched_distinct(stored, *keys)
    exact = stage(nested_grain(items, "order_id", "order_item_id", "order_id", "item"), "item-grain")
    exact = exact.withColumn("product_id", items.select("product_id").distinct().agg(F.count("product_id")).scalar())
    near = lambda name: F.abs(F.col(name) - about.select(name).scalar()) <= F.col(name) * 0.03
    rows = [F.struct(F.lit(name).alias("key"), F.col(name).alias("distinct_values"), near(name).alias("sketch_is_near")) for name in keys]
    return exact.select(F.inline(F.array(*rows)))


@query
def profile_nulls(m: Mart) -> DataFrame:
    return m.feeds["orders"].agg(
        *blanks(
            {
                "null_delivered": "order_delivered_customer_date",
                "null_approved": "order_approved_at",
                "null_carrier": "order_delivered_carrier_date",
            }
        ),
        F.count("*").alias("total"),
    )


@query
def profile_price_ranges(m: Mart) -> DataFrame:
    return m.feeds["order_items"].agg(
        *ranges({"price": "price", "freight": "freight_value"}),
        count_where(F.col("freight_value") == 0).alias("zero_freight_rows"),
    )


@query
def status_distribution(m: Mart) -> DataFrame:
    return distribution(m.feeds["orders"], "order_status").orderBy(F.desc("cnt"), "order_status")


@query
def review_score_distribution(m: Mart) -> DataFrame:
    return distribution(m.feeds["order_reviews"], "review_score").orderBy("review_score")


@query
def products_without_category(m: Mart) -> DataFrame:
    return m.feeds["products"].agg(*blanks({"products_no_category": "product_category_name"}))


ORPHANS = {
    "items_without_order": ("order_items", "orders", "order_id"),
    "items_without_product": ("order_items", "products", "product_id"),
    "items_without_seller": ("order_items", "sellers", "seller_id"),
    "orders_without_customer": ("orders", "customers", "customer_id"),
    "orders_without_items": ("orders", "order_items", "order_id"),
    "orders_without_review": ("orders", "order_reviews", "order_id"),
    "orders_without_payment": ("orders", "order_payments", "order_id"),
}


@query
def orphan_counts(m: Mart) -> DataFrame:
    references = [Reference(name, m.feeds[rows], key, m.feeds[other], key) for name, (rows, other, key) in ORPHANS.items()]
    return dangling(references, "relation", "found")


@query
def orphan_items(m: Mart) -> DataFrame:
    """The items themselves, not just their number."""
    items = m.feeds["order_items"].select("order_id", "order_item_id", "price")
    return unmatched(items, m.feeds["orders"], {"order_id": "order_id"})


@query
def orders_without_items(m: Mart) -> DataFrame:
    orders = m.feeds["orders"].select("order_id", "order_status")
    return unmatched(orders, m.feeds["order_items"], {"order_id": "order_id"})


@query
def untranslated_categories(m: Mart) -> DataFrame:
    category = "product_category_name"
    categories = m.feeds["products"].where(F.col(category).isNotNull()).select(category).distinct()
    return unmatched(categories, m.feeds["category_translation"], {category: category})


# --- dimensions -----------------------------------------------------------------------------


@query
def dim_date(m: Mart) -> DataFrame:
    return m.dim_date


@query
def holiday_list(m: Mart) -> DataFrame:
    return m.dim_date.where("is_holiday = 1").select("full_date", "holiday_name").orderBy("full_date")


@query
def weekday_counts(m: Mart) -> DataFrame:
    return distribution(m.dim_date, "weekday_name", "is_weekend").orderBy("is_weekend", "weekday_name")


@query
def dim_order_status(m: Mart) -> DataFrame:
    return m.dim_order_status


@query
def dim_product(m: Mart) -> DataFrame:
    return m.dim_product


@query
def unknown_category_products(m: Mart) -> DataFrame:
    unknown = m.dim_product.where(F.col("category_en") == "unknown")
    return unknown.agg(F.count("*").alias("with_unknown_member"), count_where(F.col("product_sk") > 0).alias("real_products"))


@query
def dim_customer(m: Mart) -> DataFrame:
    return m.dim_customer.drop("rfm_segment")


@query
def dim_customer_latest(m: Mart) -> DataFrame:
    """City and state of the record with the newest order, not each the largest value."""
    return dimensions.dim_customer(m.feeds["customers"], m.feeds["orders"])


@query
def dim_geography(m: Mart) -> DataFrame:
    return rounded(m.dim_geography, 8, "latitude", "longitude")


@query
def scd2_init(m: Mart) -> DataFrame:
    return m.dim_seller


@source_query
def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_sellers(spark, sf_dir)


@source_query
def seller_version_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution(_merged_sellers(spark, sf_dir), "is_current")


def _merged_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = sellers_feed(driver_reader(spark, sf_dir))
    dim = mart(spark, sf_dir).dim_seller
    return scd2.scd2_merge(dim, feed, "seller_id", ["seller_city", "seller_state"], "seller_sk", SELLERS_AS_OF)


# --- facts ----------------------------------------------------------------------------------


@query
def fact_order_items(m: Mart) -> DataFrame:
    return m.fact_order_items_plan()


@query
def fact_payments(m: Mart) -> DataFrame:
    return m.fact_payments_plan()


@query
def fact_delivery_reviews(m: Mart) -> DataFrame:
    return m.fact_delivery_reviews_plan()


@query
def fact_order_items_keyed(m: Mart) -> DataFrame:
    return facts.with_fact_key(m.fact_order_items_plan(), facts.ITEM_KEYS, "order_item_sk")


@query
def fact_payments_keyed(m: Mart) -> DataFrame:
    return facts.with_fact_key(m.fact_payments_plan(), facts.PAYMENT_KEYS, "payment_sk")


@query
def fact_delivery_reviews_keyed(m: Mart) -> DataFrame:
    return facts.with_fact_key(m.fact_delivery_reviews_plan(), facts.DELIVERY_KEYS, "delivery_review_sk")


# --- reports --------------------------------------------------------------------------------


@query
def unknown_routing(m: Mart) -> DataFrame:
    return reports.unknown_routing(m.fact_order_items)


@query
def freight_overall(m: Mart) -> DataFrame:
    return rounded(reports.freight_overall(m.fact_order_items), 6, "freight_share")


@query
def freight_by_category(m: Mart) -> DataFrame:
    return rounded(reports.freight_by_category(m.fact_order_items, m.dim_product), 6, "freight_share")


@query
def freight_by_state(m: Mart) -> DataFrame:
    return rounded(reports.freight_by_state(m.fact_order_items, m.dim_geography), 6, "freight_share")


@query
def freight_heavy_items(m: Mart) -> DataFrame:
    return rounded(reports.freight_heavy_items(m.fact_order_items), 6, "heavy_share")


@query
def freight_over_price_products(m: Mart) -> DataFrame:
    return reports.freight_over_price_products(m.fact_order_items)


@query
def items_per_order(m: Mart) -> DataFrame:
    summary = reports.items_per_order(m.fact_order_items, m.feeds["orders"])
    return rounded(summary, 6, "items_per_order", "multi_item_share", "items_per_any_order")


@query
def repeat_customers(m: Mart) -> DataFrame:
    return reports.repeat_customers(m.feeds["customers"], m.fact_delivery_reviews)


@query
def delivery_rate(m: Mart) -> DataFrame:
    return rounded(reports.delivery_rate(m.fact_delivery_reviews), 6, "delivery_rate")


@query
def monthly_trend(m: Mart) -> DataFrame:
    return rounded(reports.monthly_trend(m.fact_order_items, m.dim_date, TREND_FIRST, TREND_LAST), 6, "freight_share")


@query
def payments_total(m: Mart) -> DataFrame:
    return reports.payments_total(m.fact_payments)


@query
def payments_by_type(m: Mart) -> DataFrame:
    return reports.payments_by_type(m.fact_payments)


@query
def payments_by_installments(m: Mart) -> DataFrame:
    return reports.payments_by_installments(m.fact_payments)


@query
def score_by_late(m: Mart) -> DataFrame:
    return reports.score_by_late(m.fact_delivery_reviews)


@query
def score_by_delay_bucket(m: Mart) -> DataFrame:
    return reports.score_by_delay_bucket(m.fact_delivery_reviews)


# --- customer segmentation ------------------------------------------------------------------


@query
def rfm_base(m: Mart) -> DataFrame:
    return m.rfm_base_plan()


@query
def rfm_summary(m: Mart) -> DataFrame:
    return rounded(rfm.rfm_summary(m.rfm_base), 4, "avg_frequency", "avg_monetary")


@query
def rfm_scores(m: Mart) -> DataFrame:
    return rfm.rfm_scores(m.rfm_base)


@query
def rfm_segments(m: Mart) -> DataFrame:
    return m.rfm_segments


@query
def rfm_top_spenders(m: Mart) -> DataFrame:
    return rfm.top_spenders(m.rfm_scores)


@query
def dim_customer_segmented(m: Mart) -> DataFrame:
    return rfm.with_segments(m.dim_customer, m.rfm_segments)


@query
def segment_distribution(m: Mart) -> DataFrame:
    return rfm.segment_distribution(m.dim_customer_segmented)


@query
def segment_spend(m: Mart) -> DataFrame:
    return rfm.segment_spend(m.rfm_segments, m.rfm_base)


@query
def segment_satisfaction(m: Mart) -> DataFrame:
    return reports.segment_satisfaction(m.fact_delivery_reviews, m.dim_customer_segmented)


# --- quality --------------------------------------------------------------------------------


@source_query
def dq_staging_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expected number of orders is the number of rows delivered, before any load."""
    delivered = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    return quality_suite.staging_checks(mart(spark, sf_dir).feeds, expected_orders=delivered)


@query
def dq_checks(m: Mart) -> DataFrame:
    return quality_suite.quality_checks(m).orderBy("check_category", "check_id")


@query
def dq_status_summary(m: Mart) -> DataFrame:
    return status_summary(quality_suite.quality_checks(m))


@query
def unknown_members(m: Mart) -> DataFrame:
    return quality_suite.unknown_members(m)


@query
def dangling_keys(m: Mart) -> DataFrame:
    return quality_suite.dangling_keys(m)


@query
def final_validation(m: Mart) -> DataFrame:
    return quality_suite.validate(m)


# --- incremental loads ----------------------------------------------------------------------


def _rehearsal(m: Mart, key: str | None = None) -> Warehouse:
    """A warehouse whose item fact, partitioned by month, is loaded up to a mark 30 days before the newest order,
    then loaded again.

    The first load takes everything up to the mark, with the items that have no purchase time;
    the second must add exactly the rest.
    """
    warehouse = Warehouse(m.spark, scratch_path(m.spark, "rehearsal"))
    control, table, orders = LoadControl(warehouse), ITEM_FACT, m.feeds["orders"]
    mark = newest_moment(orders, MOMENT) - timedelta(days=REHEARSAL_DAYS)
    recent = orders.where(F.col(MOMENT) > F.lit(mark).cast("timestamp_ntz"))
    first = m.fact_order_items_plan(unmatched(m.feeds["order_items"], recent, {"order_id": "order_id"}, other_unique=True))
    if key:
        first = with_surrogate_key(first, facts.ITEM_KEYS, key)
    first = first.withColumn(facts.MONTH, month_key(F.col("date_sk")))
    control.record(table, mark, warehouse.append(first, "mart", table, 1, [facts.MONTH], key=key), LOADED_AT, 1)
    _load_increment(m, warehouse, key=key)
    return warehouse


def _load_increment(m: Mart, warehouse: Warehouse, dedup: bool = True, key: str | None = None) -> int:
    orders = m.feeds["orders"]
    return incremental_load(
        warehouse, ITEM_FACT, orders, MOMENT, m.order_increment, facts.ITEM_KEYS, LOADED_AT, dedup=dedup, partition_by=[facts.MONTH], key=key
    )


@query
def incremental_expected(m: Mart) -> DataFrame:
    mark = newest_moment(m.feeds["orders"], MOMENT) - timedelta(days=REHEARSAL_DAYS)
    return expected_new_rows(m.feeds["order_items"], m.feeds["orders"], MOMENT, mark)


@query
def incremental_undated(m: Mart) -> DataFrame:
    return undated_items(m.feeds["order_items"], m.feeds["orders"], MOMENT)


@query
def incremental_loaded(m: Mart) -> DataFrame:
    return _rehearsal(m).read("mart", ITEM_FACT).drop(facts.MONTH)


@query
def incremental_keyed(m: Mart) -> DataFrame:
    """The fact's own keys over two batches: the second goes on from the first."""
    return _rehearsal(m, facts.ITEM_KEY).read("mart", ITEM_FACT).select(facts.ITEM_KEY, *facts.ITEM_KEYS, "load_batch")


@query
def incremental_reload(m: Mart) -> DataFrame:
    """Rows loaded and rows in the fact after each step: the mark rolled back and the period loaded again, without what is there
    already, then with it (as the source does), and last the touched months replaced, which leaves the whole fact once."""
    warehouse = _rehearsal(m)
    control, orders = LoadControl(warehouse), m.feeds["orders"]
    steps: list[tuple[str, int]] = [("increment", control.state(ITEM_FACT).rows)]

    def rolled_back(step: str, load: Callable[[], int]) -> None:
        control.roll_back(ITEM_FACT, REHEARSAL_DAYS)
        steps.append((step, load()))

    stored = {}
    for step, load in (
        ("reload", lambda: _load_increment(m, warehouse)),
        ("append_again", lambda: _load_increment(m, warehouse, dedup=False)),
        ("replace_months", lambda: reload_slices(warehouse, ITEM_FACT, orders, MOMENT, month_of, m.order_increment, facts.ITEM_KEYS, LOADED_AT, facts.MONTH)),
    ):
        stored[steps[-1][0]] = warehouse.read("mart", ITEM_FACT)
        rolled_back(step, load)
    stored[steps[-1][0]] = warehouse.read("mart", ITEM_FACT)
    reports = [
        stored[step].agg(F.lit(step).alias("step"), F.lit(n).alias("rows_loaded"), F.count("*").alias("fact_rows"), F.sum("price").alias("revenue"))
        for step, n in steps
    ]
    return reduce(DataFrame.unionByName, reports)


@query
def load_control_after(m: Mart) -> DataFrame:
    return LoadControl(_rehearsal(m)).current().select("table_name", "last_watermark", "last_load_time", "rows_last_loaded")


class Interrupted(RuntimeError):
    pass


def _item_files(spark: SparkSession, sf_dir: str, folder: str) -> int:
    """The line items as files, the returned ones delivered twice; gives the number of files of a third of them."""
    lines = driver_reader(spark, sf_dir)("lineitem")
    (lines if lines.rdd.getNumPartitions() >= 3 else lines.repartition(3)).write.parquet(folder)
    lines.where("l_returnflag = 'R'").write.mode("append").parquet(folder)
    return -(-len(spark.read.parquet(folder).inputFiles()) // 4)


@source_query
def incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item fact built from a stream of item files in several micro-batches, with items delivered again and one batch
    replayed after a failure; it must equal the batch fact."""
    m = mart(spark, sf_dir)
    folder, progress = scratch_path(spark, "stream-items"), scratch_path(spark, "stream-progress")
    files = _item_files(spark, sf_dir, folder)
    schema = spark.read.parquet(folder).schema
    warehouse = Warehouse(spark, scratch_path(spark, "stream"))
    broken: list[int] = []

    def interrupt(batch: int) -> None:
        if batch == 1 and not broken:
            broken.append(batch)
            raise Interrupted("after batch 1 was written, before the stream took note of it")

    def run() -> None:
        items = order_items(lambda table: file_stream(spark, folder, schema, files)).select(*facts.ITEM_COLUMNS)
        stream_fact(items, m.item_batch_plan, warehouse, ITEM_FACT, progress, after_write=interrupt)

    try:
        run()
    except StreamingQueryException:
        if not broken:
            raise
    run()
    return warehouse.read("mart", ITEM_FACT).drop("load_batch")


# --- repeated keys in looked-up feeds ---------------------------------------------------------


def _repeating_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Canceled orders come again as shipped, customers in the building trade again from another place."""
    feeds = driver_feeds(spark, sf_dir)
    orders, customers = feeds["orders"], feeds["customers"]
    shipped = orders.where("order_status = 'canceled'").withColumn("order_status", F.lit("shipped"))
    moved = customers.where("customer_city = 'BUILDING'").withColumn("customer_zip_code_prefix", F.lit("0"))
    return feeds | {"orders": orders.unionByName(shipped), "customers": customers.unionByName(moved)}


def _settled(spark: SparkSession, sf_dir: str) -> Mart:
    m = Mart(configure(spark), _repeating_feeds(spark, sf_dir), SELLERS_EFFECTIVE)
    m.settle_feeds()
    return m


@source_query
def quarantine_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated keys per feed, and their rows."""
    found = reduce(DataFrame.unionByName, _settled(spark, sf_dir).quarantined)
    return found.groupBy("feed").agg(F.count("*").alias("repeated_keys"), F.sum("rows").alias("rows"))


@source_query
def fact_after_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items by status: each item once, although its order or customer came twice."""
    m = _settled(spark, sf_dir)
    joined = m.fact_order_items_plan().join(m.dim_order_status, "order_status_sk")
    known = count_where(F.col("customer_sk") > 0)
    return joined.groupBy("order_status").agg(F.count("*").alias("items"), known.alias("with_customer"), F.sum("price").alias("revenue"))


# --- CSV feeds, from CSV files that Spark first writes from the given tables ------------------


def _write_csv(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, f"csv-{name}")
    (
        df.write.option("header", True)
        .option("compression", "gzip")  # a file per task, so as many as the table has splits
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


SPOILT_REVIEWS = 7  # fewer than the review feed tolerates


def _csv_feeds(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """All nine feeds as CSV. Item ids are the line numbers, as declared; the first reviews have text for a score."""
    feeds = driver_feeds(spark, sf_dir)
    line = F.element_at(F.split("order_item_id", "-"), 1)
    score = F.when(F.col("review_id").cast("bigint") < SPOILT_REVIEWS, "none").otherwise(F.col("review_score").cast("string"))
    feeds["order_items"] = feeds["order_items"].withColumn("order_item_id", line)
    feeds["order_reviews"] = feeds["order_reviews"].withColumns(
        {"review_score": score, "review_comment_title": F.lit(None).cast("string"), "review_comment_message": F.lit('said ",\n" twice')}
    )
    return {feed: _write_csv(df.select(*[F.col(c).cast("string") for c in STAGING[feed].names]), feed) for feed, df in feeds.items()}


_stored_marts: dict[tuple[str, str], tuple[Warehouse, dict[str, int], Mart]] = {}


def _stored(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, dict[str, int], Mart]:
    """A warehouse loaded from CSV feeds and built from its staging tables, once for the queries of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored_marts:
        warehouse = Warehouse(spark, scratch_path(spark, "stored"))
        size_shuffles(spark, COMPRESSED * folder_bytes(spark, sf_dir))
        rejected = load_staging(warehouse, _csv_feeds(spark, sf_dir))
        built = build_warehouse(warehouse, SELLERS_EFFECTIVE, LOADED_AT)
        run_quality_checks(warehouse, built, LOADED_AT)
        _stored_marts[key] = (warehouse, rejected, built)
    return _stored_marts[key]


@source_query
def csv_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and rejected rows of all nine feeds, and the characters of their first column."""
    warehouse, _, _ = _stored(spark, sf_dir)

    def counted(feed: str) -> DataFrame:
        rows, first = warehouse.read("staging", feed), STAGING[feed].names[0]
        rejected = warehouse.rejects("staging", feed).agg(F.count("*"))
        total = rows.agg(F.count("*").alias("rows"), F.sum(F.length(first)).alias("characters"))
        return total.select(F.lit(feed).alias("table_name"), "rows", rejected.scalar().alias("rejected"), "characters")

    return reduce(DataFrame.unionByName, [counted(feed) for feed in STAGING])


@source_query
def warehouse_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every stored mart table."""
    warehouse, _, _ = _stored(spark, sf_dir)
    tables = ("dim_date", "dim_order_status", "dim_product", "dim_customer", "dim_geography", "dim_seller", *FACT_DAYS)
    return row_counts({table: warehouse.read("mart", table) for table in tables})


@source_query
def dq_results_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored results of the quality suite."""
    warehouse, _, _ = _stored(spark, sf_dir)
    return warehouse.read("dq", "check_results")


def _text_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as the free-text review feed, through CSV: quotes, commas, accents, line breaks."""
    documents = driver_reader(spark, sf_dir)("documents").select(
        F.col("doc_id").cast("string").alias("review_id"),
        F.col("doc_id").cast("string").alias("order_id"),
        (1 + F.col("n_chars") % 5).cast("int").alias("review_score"),
        F.concat_ws(", ", "lang", "source").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        F.lit("2000-01-01 00:00:00").alias("review_creation_date"),
        F.lit(None).cast("string").alias("review_answer_timestamp"),
    )
    return load_feed(spark, "order_reviews", _write_csv(documents, "reviews")).rows


@source_query
def csv_text_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = _text_reviews(spark, sf_dir)
    message = F.col("review_comment_message")
    return reviews.select(
        "review_id", "review_score", "review_comment_title", F.length(message).alias("chars"), F.md5(message).alias("digest")
    )


@source_query
def csv_accent_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of the reviews whose text kept its accents."""
    accented = _text_reviews(spark, sf_dir).where(has_accent(F.col("review_comment_message"), ACCENTS))
    return accented.select("review_comment_title").distinct()


@source_query
def csv_text_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five reviews with a text of more than 20 characters."""
    message = F.col("review_comment_message")
    texts = _text_reviews(spark, sf_dir).where(message.isNotNull() & (visible_length(message) > 20))
    return texts.select("review_id", "review_comment_message").orderBy("review_id").limit(5)


@source_query
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payment feed in which failed payments have text where a number belongs."""
    failed = F.col("payment_type") == "error"
    payments = driver_feeds(spark, sf_dir)["order_payments"]
    broken = payments.withColumn(
        "payment_installments", F.when(failed, "none").otherwise(F.col("payment_installments").cast("string"))
    )
    rows = payments.count()
    loaded = load_csv(spark, _write_csv(broken, "payments"), STAGING["order_payments"], name="payments", max_errors=rows)
    good = loaded.rows.agg(F.lit("loaded").alias("outcome"), F.count("*").alias("rows"), F.sum("payment_value").alias("payment_value"))
    value = F.element_at(F.split("raw_row", ","), -1).cast("decimal(18,2)")
    bad = loaded.rejects.agg(F.lit("rejected").alias("outcome"), F.count("*").alias("rows"), F.sum(value).alias("payment_value"))
    return good.unionByName(bad)


@source_query
def purchase_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through CSV with text timestamps; those without a purchase time carry unparsable text."""
    orders = driver_feeds(spark, sf_dir)["orders"]
    as_text = orders.select(*[F.col(c).cast("string") for c in orders.columns])
    as_text = as_text.withColumn(MOMENT, F.coalesce(MOMENT, F.lit("n/a")))
    loaded = load_feed(spark, "orders", _write_csv(as_text, "orders")).rows
    typed = type_timestamps("orders", loaded)
    return typed.agg(
        F.min(MOMENT).alias("earliest"),
        F.max(MOMENT).alias("latest"),
        count_where(F.col(MOMENT).isNull()).alias("unparseable"),
    )
