"""The warehouse's quality suite, staging checks and end-to-end validation."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.columns import MONEY, UNKNOWN_KEY, count_where, percent
from martloom.operators.lookup import count_unmatched, duplicate_keys
from martloom.operators.profiling import row_counts
from martloom.operators.quality import WARN, Check, evaluate, none_found
from martloom.operators.references import Reference, dangling
from martloom.plans.mart import Mart
from martloom.session import stage

# Check categories and the largest accepted share of items without a known place.
RECONCILIATION, INTEGRITY, UNIQUENESS = "reconciliation", "integrity", "uniqueness"
VALIDITY, COMPLETENESS = "validity", "completeness"
UNKNOWN_PLACE_LIMIT = 5


@dataclass(frozen=True)
class Findings:
    """What the checks need of the facts: one row of item measures, and the number of dangling keys by name."""

    items: DataFrame
    dangling: DataFrame


def findings(mart: Mart) -> Findings:
    """Two passes over the item fact and one over the payments, written down for all checks to share."""
    unknown_place = percent(count_where(F.col("geography_sk") == UNKNOWN_KEY), F.count("*"))
    items = mart.fact_order_items.agg(
        F.count("*").alias("rows"),
        F.sum("price").cast(MONEY).alias("revenue"),
        F.coalesce(count_where(F.col("price") < 0), F.lit(0)).alias("negative_prices"),
        unknown_place.alias("unknown_place"),
    )
    return Findings(stage(items, "item-measures"), stage(dangling_keys(mart), "dangling-keys"))


def quality_checks(mart: Mart, found: Findings | None = None) -> DataFrame:
    """The eleven checks. Expected row counts come from the feeds, not from literals."""
    found = found or findings(mart)
    items, payments = mart.feeds["order_items"], mart.feeds["order_payments"]
    reviews = mart.feeds["order_reviews"]
    source = items.agg(F.count("*").alias("source_rows"), F.sum("price").cast(MONEY).alias("source_revenue"))
    item_measures = found.items.withColumns({c: source.select(c).scalar() for c in source.columns})
    item_checks = [
        _equal(1, "fact_order_items row count", "source_rows", "rows"),
        _equal(2, "fact revenue matches staging", "source_revenue", "revenue"),
        none_found(9, VALIDITY, "no negative prices", "negative_prices"),
        Check(
            11,
            COMPLETENESS,
            "geography unknown rate",
            F.lit(f"<{UNKNOWN_PLACE_LIMIT}%"),
            F.concat(F.col("unknown_place").cast("decimal(5,2)").cast("string"), F.lit("%")),
            F.col("unknown_place") < UNKNOWN_PLACE_LIMIT,
            WARN,
        ),
    ]
    payment_measures = mart.fact_payments.agg(F.count("*").alias("rows")).withColumn(
        "source_rows", payments.agg(F.count("*")).scalar()
    )
    score = F.col("review_score")
    bad_scores = F.coalesce(count_where((score < 1) | (score > 5)), F.lit(0))
    current_sellers = mart.dim_seller.where("is_current = 1")
    return evaluate(
        [
            (item_measures, item_checks),
            (payment_measures, [_equal(3, "fact_payments row count", "source_rows", "rows")]),
            _resolves(4, found, "product_sk", "oi_bad_product"),
            _resolves(5, found, "customer_sk", "oi_bad_customer"),
            _resolves(6, found, "date_sk", "oi_bad_date"),
            _unique(7, "dim_customer unique_id no dupes", mart.dim_customer, "customer_unique_id"),
            _unique(8, "dim_seller one current per seller_id", current_sellers, "seller_id"),
            (
                reviews.agg(bad_scores.alias("found")),
                [none_found(10, VALIDITY, "review scores in 1-5 (staging)", "found")],
            ),
        ]
    )


def _equal(check_id: int, name: str, expected: str, actual: str) -> Check:
    return Check(check_id, RECONCILIATION, name, F.col(expected), F.col(actual), F.col(expected) == F.col(actual))


def _resolves(check_id: int, found: Findings, key: str, item: str):
    name = f"fact_order_items {key} valid"
    count = found.dangling.where(F.col("item") == item).select(F.col("value").alias("found"))
    return count, [none_found(check_id, INTEGRITY, name, "found")]


def _unique(check_id: int, name: str, rows: DataFrame, key: str):
    return duplicate_keys(rows, [key]).agg(F.count("*").alias("found")), [none_found(check_id, UNIQUENESS, name, "found")]


def staging_checks(feeds: dict[str, DataFrame], expected_orders: int) -> DataFrame:
    """Two checks on the raw feeds; they warn rather than fail."""
    orders, items = feeds["orders"], feeds["order_items"]
    count = orders.agg(F.count("*").alias("rows"))
    orphans = count_unmatched(items, orders, {"order_id": "order_id"}, "found")
    results = evaluate(
        [
            (count, [Check(1, "staging", "orders_row_count", F.lit(expected_orders), F.col("rows"), F.col("rows") == expected_orders, WARN)]),
            (orphans, [none_found(2, "staging", "orphaned_order_items", "found", WARN)]),
        ]
    )
    return results.select("check_name", F.col("actual").alias("check_result"), F.col("status").alias("check_status"))


def warehouse_counts(mart: Mart, found: Findings) -> DataFrame:
    counts = row_counts(
        {
            "dim_date": mart.dim_date,
            "dim_customer": mart.dim_customer,
            "dim_product": mart.dim_product,
            "dim_seller": mart.dim_seller,
            "dim_geography": mart.dim_geography,
            "dim_order_status": mart.dim_order_status,
            "fact_payments": mart.fact_payments,
        },
        "item",
        "value",
    )
    return counts.unionByName(found.items.select(F.lit("fact_order_items").alias("item"), F.col("rows").alias("value")))


def _dimension_keys(mart: Mart) -> dict[str, tuple[DataFrame, str]]:
    return {
        "date": (mart.dim_date, "date_sk"),
        "customer": (mart.dim_customer, "customer_sk"),
        "product": (mart.dim_product, "product_sk"),
        "seller": (mart.dim_seller, "seller_sk"),
        "geography": (mart.dim_geography, "geography_sk"),
        "order_status": (mart.dim_order_status, "order_status_sk"),
    }


def unknown_members(mart: Mart) -> DataFrame:
    """How often each dimension has its unknown member; 1 everywhere in a sound warehouse."""
    members = {name: dim.where(F.col(key) == UNKNOWN_KEY) for name, (dim, key) in _dimension_keys(mart).items()}
    return row_counts(members, "item", "value")


def dangling_keys(mart: Mart) -> DataFrame:
    """Fact rows whose key has no dimension row, per key; 0 everywhere in a sound warehouse."""
    items, payments = mart.fact_order_items, mart.fact_payments
    starts = {
        "oi_bad_product": (items, "product_sk", mart.dim_product),
        "oi_bad_seller": (items, "seller_sk", mart.dim_seller),
        "oi_bad_customer": (items, "customer_sk", mart.dim_customer),
        "oi_bad_geo": (items, "geography_sk", mart.dim_geography),
        "oi_bad_date": (items, "date_sk", mart.dim_date),
        "oi_bad_status": (items, "order_status_sk", mart.dim_order_status),
        "pay_bad_customer": (payments, "customer_sk", mart.dim_customer),
        "pay_bad_date": (payments, "date_sk", mart.dim_date),
    }
    return dangling([Reference(name, fact, key, dim, key, other_unique=True) for name, (fact, key, dim) in starts.items()])


def segment_gaps(dim_customer: DataFrame) -> DataFrame:
    gaps = F.coalesce(count_where(F.col("rfm_segment").isNull()), F.lit(0)).cast("bigint")
    return dim_customer.agg(
        F.inline(
            F.array(
                F.struct(F.lit("null_segments").alias("item"), gaps.alias("value")),
                F.struct(F.lit("distinct_segments").alias("item"), F.count_distinct("rfm_segment").alias("value")),
            )
        )
    )


def validate(mart: Mart) -> DataFrame:
    """The whole end-to-end validation as (section, item, value)."""
    found = findings(mart)
    statuses = quality_checks(mart, found).groupBy(F.col("status").alias("item")).agg(F.count("*").alias("value"))
    sections = {
        "rows": warehouse_counts(mart, found),
        "unknown_member": unknown_members(mart),
        "dangling_keys": found.dangling,
        "segments": segment_gaps(mart.dim_customer_segmented),
        "check_status": statuses,
    }
    labelled = [df.select(F.lit(name).alias("section"), "item", "value") for name, df in sections.items()]
    return reduce(DataFrame.unionByName, labelled)
