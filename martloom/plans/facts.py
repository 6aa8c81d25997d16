"""The three facts. Every row of the driving feed becomes a fact row; unmatched keys become -1.

Everything that hangs on the order (customer, place, status, purchase day) is resolved once per
order and then joined to the larger item and payment feeds, so those are shuffled by order_id
once instead of once per dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.columns import (
    MONEY,
    UNKNOWN_KEY,
    date_key_or_unknown,
    days_between,
    flag,
    share_of,
)
from martloom.operators.keys import with_surrogate_key
from martloom.operators.lookup import latest_per_key, lookup

ITEM_KEYS = ["order_id", "order_item_id"]
PAYMENT_KEYS = ["order_id", "payment_sequential"]
DELIVERY_KEYS = ["order_id"]

# Facts are partitioned by month, so a period filter reads its months only.
MONTH = "month_sk"
# The facts' own keys.
ITEM_KEY, PAYMENT_KEY, DELIVERY_KEY = "order_item_sk", "payment_sk", "delivery_review_sk"

ITEM_COLUMNS = [*ITEM_KEYS, "product_id", "seller_id", "price", "freight_value"]
ORDER_ITEM_KEYS = ["date_sk", "customer_sk", "geography_sk", "order_status_sk"]


def customer_keys(customers: DataFrame, dims: dict[str, DataFrame], with_place: bool) -> DataFrame:
    """customer_id with the surrogate key of the person and, on request, of the place."""
    narrow = customers.select("customer_id", "customer_unique_id", "customer_zip_code_prefix")
    keyed = lookup(narrow, dims["dim_customer"], {"customer_unique_id": "customer_unique_id"}, "customer_sk")
    if not with_place:
        return keyed.select("customer_id", "customer_sk")
    keyed = lookup(keyed, dims["dim_geography"], {"customer_zip_code_prefix": "zip_code_prefix"}, "geography_sk")
    return keyed.select("customer_id", "customer_sk", "geography_sk")


def order_keys(
    orders: DataFrame,
    customers: DataFrame,
    dims: dict[str, DataFrame],
    with_place: bool = False,
    few_orders: bool = False,
) -> DataFrame:
    """Orders with the keys their facts need: customer_sk, order_status_sk, date_sk (and geography_sk).

    ``few_orders`` is for the orders of one increment: the customers are first reduced to theirs,
    so the whole customer feed is scanned but not shuffled.
    """
    if few_orders:
        customers = customers.join(orders.select("customer_id").distinct(), "customer_id", "left_semi")
    people = customer_keys(customers, dims, with_place)
    keys = [c for c in people.columns if c != "customer_id"]
    people = people.withColumnRenamed("customer_id", "_customer_id")
    with_people = orders.join(people, orders["customer_id"] == people["_customer_id"], "left").select(
        *orders.columns, *[F.coalesce(k, F.lit(UNKNOWN_KEY)).alias(k) for k in keys]
    )
    with_status = lookup(with_people, dims["dim_order_status"], {"order_status": "order_status"}, "order_status_sk")
    return with_status.withColumn("date_sk", date_key_or_unknown(F.col("order_purchase_timestamp")))


def orders_of(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """The orders some of these items belong to."""
    return orders.join(order_items.select("order_id").distinct(), "order_id", "left_semi")


def _with_order(rows: DataFrame, keyed_orders: DataFrame, keys: list[str]) -> DataFrame:
    """Left join to the order; the order's keys are -1 where there is no such order."""
    order = keyed_orders.select(F.col("order_id").alias("_order_id"), *keys)
    joined = rows.join(order, rows["order_id"] == order["_order_id"], "left")
    return joined.select(*rows.columns, *[F.coalesce(k, F.lit(UNKNOWN_KEY)).alias(k) for k in keys])


def fact_order_items(order_items: DataFrame, keyed_orders: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """One row per order item. ``keyed_orders`` must carry the place."""
    return _item_measures(_with_order(order_items.select(*ITEM_COLUMNS), keyed_orders, ORDER_ITEM_KEYS), dims)


def new_order_items(order_items: DataFrame, keyed_orders: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows of the items of the given (newly purchased) orders only."""
    new = keyed_orders.select("order_id", *ORDER_ITEM_KEYS)
    return _item_measures(order_items.select(*ITEM_COLUMNS).join(new, "order_id"), dims)


def _item_measures(rows: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Product and seller keys and derived measures, in the fact's column order."""
    rows = lookup(rows, dims["dim_product"], {"product_id": "product_id"}, "product_sk")
    rows = lookup(rows, dims["dim_seller"], {"seller_id": "seller_id"}, "seller_sk", where=F.col("is_current") == 1)
    return rows.select(
        *ITEM_KEYS,
        "date_sk",
        "product_sk",
        "seller_sk",
        "customer_sk",
        "geography_sk",
        "order_status_sk",
        "price",
        "freight_value",
        share_of(F.col("freight_value"), F.col("price")).alias("freight_pct"),
        (F.col("price") - F.col("freight_value")).cast(MONEY).alias("net_contribution"),
    )


def fact_payments(order_payments: DataFrame, keyed_orders: DataFrame) -> DataFrame:
    """One row per payment."""
    rows = _with_order(order_payments, keyed_orders, ["date_sk", "customer_sk", "order_status_sk"])
    return rows.select(
        *PAYMENT_KEYS,
        "date_sk",
        "customer_sk",
        "order_status_sk",
        "payment_type",
        "payment_installments",
        "payment_value",
    )


def latest_reviews(order_reviews: DataFrame) -> DataFrame:
    """The newest review of each order; of several at the same time, the one with the largest id."""
    narrow = order_reviews.select("order_id", "review_id", "review_creation_date", "review_score")
    newest = [F.col("review_creation_date").desc_nulls_last(), F.col("review_id").desc_nulls_last()]
    return latest_per_key(narrow, ["order_id"], newest).select("order_id", "review_score")


def fact_delivery_reviews(keyed_orders: DataFrame, order_reviews: DataFrame) -> DataFrame:
    """One row per order: delivery times against the estimate, and the latest review's score.

    ``is_late`` compares moments while the delay counts days, so an order delivered later on the
    estimated day is late with a delay of 0. Undelivered orders have is_late = 0.
    """
    purchase, estimate = F.col("order_purchase_timestamp"), F.col("order_estimated_delivery_date")
    delivery = F.col("order_delivered_customer_date")
    orders = keyed_orders.select(
        "order_id",
        "customer_sk",
        "order_status_sk",
        F.col("date_sk").alias("purchase_date_sk"),
        days_between(purchase, estimate).alias("estimated_days"),
        days_between(purchase, delivery).alias("actual_days"),
        days_between(estimate, delivery).alias("delivery_delay_days"),
        flag(delivery > estimate).alias("is_late"),
        flag(F.col("order_status") == "delivered").alias("is_delivered"),
    )
    return orders.join(latest_reviews(order_reviews), "order_id", "left").select(
        "order_id",
        "customer_sk",
        "order_status_sk",
        "purchase_date_sk",
        "review_score",
        "estimated_days",
        "actual_days",
        "delivery_delay_days",
        "is_late",
        "is_delivered",
    )


def with_fact_key(fact: DataFrame, business_key: list[str], name: str) -> DataFrame:
    """The fact with its own dense key. No report needs it, so it is not part of the default build:
    it costs a range sort of the whole fact."""
    return with_surrogate_key(fact, business_key, name)
