"""The benchmark's order/customer/part tables seen as the nine retail feeds.

Every driver row is kept. The driver data has no gaps, so gaps are made from attribute values:
some people and products are registered under an id nobody orders by, some orders have no
customer or purchase time, some prices are zero, some reviews have no score.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.columns import date_key

Reader = Callable[[str], DataFrame]


def driver_reader(spark: SparkSession, sf_dir: str) -> Reader:
    return lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _when_else(condition, value, otherwise):
    return F.when(condition, value).otherwise(otherwise)


def _id(key):
    """Ids are text, as in the feeds."""
    return key.cast("string")


def _own_id(key):
    """An id that occurs in no other table."""
    return _id(-1 - key)


def customers(read: Reader) -> DataFrame:
    """One record per customer row; two consecutive records are one person."""
    custkey, balance = F.col("c_custkey"), F.col("c_acctbal")
    return read("customer").select(
        _when_else(balance < -800, _own_id(custkey), _id(custkey)).alias("customer_id"),
        F.concat(F.lit("u"), F.expr("c_custkey div 2").cast("string")).alias("customer_unique_id"),
        _when_else(balance > 9500, F.lit("closed"), _zip()).alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("customer_state"),
    )


def _zip():
    """A postcode area: a nation and a thousand consecutive customers."""
    return F.concat_ws("-", F.col("c_nationkey").cast("string"), F.expr("c_custkey div 1000").cast("string"))


def geolocation(read: Reader) -> DataFrame:
    balance = F.col("c_acctbal").cast("decimal(18,2)")
    return read("customer").select(
        _zip().alias("geolocation_zip_code_prefix"),
        (balance * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,10)").alias("geolocation_lat"),
        (balance * F.lit(-0.01).cast("decimal(3,2)")).cast("decimal(18,10)").alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("geolocation_state"),
    )


def orders(read: Reader) -> DataFrame:
    key, total = F.col("o_orderkey"), F.col("o_totalprice")
    placed = F.col("o_orderdate") + F.expr("make_dt_interval(0, cast(o_orderkey % 24 as int))")
    purchased = F.when(total < 490000, placed)
    delivered = F.col("o_orderstatus") == "F"
    return read("orders").select(
        _id(key).alias("order_id"),
        F.when(total >= 6000, _id(F.col("o_custkey"))).alias("customer_id"),
        F.when(delivered, "delivered").when(F.col("o_orderstatus") == "O", "shipped").otherwise("canceled").alias("order_status"),
        purchased.alias("order_purchase_timestamp"),
        F.when(F.col("o_orderstatus") != "P", purchased + F.expr("interval 1 hour")).alias("order_approved_at"),
        F.when(delivered, placed + F.expr("interval 2 days")).alias("order_delivered_carrier_date"),
        F.when(
            delivered,
            F.col("o_orderdate")
            + F.expr("make_dt_interval(cast(4 + (o_orderkey * 7) % 25 as int), if(o_orderkey % 3 = 0, 10, 0))"),
        ).alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + F.expr("make_dt_interval(cast(10 + o_orderkey % 15 as int))")).alias("order_estimated_delivery_date"),
    )


def order_items(read: Reader) -> DataFrame:
    """Line items. Lines of 50 units are booked under an order id of their own."""
    key, price = F.col("l_orderkey"), F.col("l_extendedprice").cast("decimal(18,2)")
    refunded = (F.col("l_returnflag") == "R") & (F.col("l_quantity") == 1)
    return read("lineitem").select(
        _when_else(F.col("l_quantity") == 50, _own_id(key), _id(key)).alias("order_id"),
        # The line number alone repeats within an order; with part, supplier and ship date it does not.
        F.concat_ws(
            "-",
            F.col("l_linenumber").cast("string"),
            F.col("l_partkey").cast("string"),
            F.col("l_suppkey").cast("string"),
            date_key(F.col("l_shipdate")).cast("string"),
        ).alias("order_item_id"),
        _id(F.col("l_partkey")).alias("product_id"),
        _id(F.col("l_suppkey")).alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        _when_else(refunded, F.lit(0).cast("decimal(18,2)"), price).alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)") * 15).cast("decimal(18,2)").alias("freight_value"),
    )


def products(read: Reader) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return read("part").select(
        _when_else(size == 50, _own_id(key), _id(key)).alias("product_id"),
        F.when(F.col("p_brand") != "Brand#25", F.col("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_brand").alias("product_description_lenght"),
        F.lit(1).alias("product_photos_qty"),
        (size * 100).alias("product_weight_g"),
        size.alias("product_length_cm"),
        F.when(size < 45, size + 1).alias("product_height_cm"),
        (size + 2).alias("product_width_cm"),
    )


def category_translation(read: Reader) -> DataFrame:
    """Every category but one has a translation."""
    category = F.col("p_type").alias("product_category_name")
    english = F.concat(F.lower("p_type"), F.lit("_en")).alias("product_category_name_english")
    return read("part").where(F.col("p_type") != "PROMO").select(category, english).distinct()


def sellers(read: Reader) -> DataFrame:
    key, balance, nation = F.col("s_suppkey"), F.col("s_acctbal"), F.col("s_nationkey").cast("string")
    return read("supplier").select(
        _when_else(balance < -400, _own_id(key), _id(key)).alias("seller_id"),
        nation.alias("seller_zip_code_prefix"),
        F.when(balance < 9000, F.concat(F.lit("C"), nation)).alias("seller_city"),
        F.concat(F.lit("N"), nation).alias("seller_state"),
    )


def sellers_feed(read: Reader) -> DataFrame:
    """A second delivery: sellers of nations 0 to 4 moved, NULL cities arrive blank, and every
    customer in the building trade has become a seller."""
    known = sellers(read).select(
        "seller_id",
        "seller_zip_code_prefix",
        F.coalesce("seller_city", F.lit("")).alias("seller_city"),
        _when_else(F.col("seller_zip_code_prefix").cast("int") < 5, F.lit("ZZ"), F.col("seller_state")).alias("seller_state"),
    )
    new = read("customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("seller_id"),
        F.col("c_nationkey").cast("string").alias("seller_zip_code_prefix"),
        F.col("c_mktsegment").alias("seller_city"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("seller_state"),
    )
    return known.unionByName(new)


def order_payments(read: Reader) -> DataFrame:
    """Two payments for every third order."""
    return read("events").select(
        _id(F.expr("event_id div 2 * 3")).alias("order_id"),
        (1 + F.col("event_id") % 2).cast("int").alias("payment_sequential"),
        F.col("event_type").alias("payment_type"),
        (1 + F.col("event_id") % 12).cast("int").alias("payment_installments"),
        F.col("value").cast("decimal(18,2)").alias("payment_value"),
    )


def order_reviews(read: Reader) -> DataFrame:
    """None, one or two reviews per order; two on the same day are common, some have no score."""
    early = F.col("event_type").isin("click", "view")
    return read("events").select(
        _id(F.col("event_id")).alias("review_id"),
        _id(_when_else(early, F.expr("event_id div 2 * 3"), F.expr("event_id * 3 div 2"))).alias("order_id"),
        F.when(F.col("event_type") != "error", (1 + F.floor("value") % 5).cast("int")).alias("review_score"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("review_creation_date"),
        F.col("ts").alias("review_answer_timestamp"),
    )


FEEDS: dict[str, Callable[[Reader], DataFrame]] = {
    "customers": customers,
    "geolocation": geolocation,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "sellers": sellers,
    "category_translation": category_translation,
}


def driver_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    read = driver_reader(spark, sf_dir)
    return {name: build(read) for name, build in FEEDS.items()}
