"""Reports over the mart.

Facts are summed per surrogate key before a dimension is joined: the join then moves one row per
key instead of one per fact row, and a key that holds much of the data is combined map-side.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.columns import UNKNOWN_KEY, count_where, exact_average
from martloom.functions.rules import delay_band

ROUTED_KEYS = {
    "unk_product": "product_sk",
    "unk_seller": "seller_sk",
    "unk_customer": "customer_sk",
    "unk_geography": "geography_sk",
    "unk_date": "date_sk",
    "unk_status": "order_status_sk",
}


def unknown_routing(fact_order_items: DataFrame) -> DataFrame:
    """Items routed to the unknown member, per key."""
    return fact_order_items.agg(*[count_where(F.col(k) == UNKNOWN_KEY).alias(n) for n, k in ROUTED_KEYS.items()])


def _share(part: Column, whole: Column) -> Column:
    """Ratio as a double, NULL when the whole is not positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def _freight_totals() -> list[Column]:
    revenue, freight = F.sum("price"), F.sum("freight_value")
    return [revenue.alias("revenue"), freight.alias("freight"), _share(freight, revenue).alias("freight_share")]


def freight_overall(fact_order_items: DataFrame) -> DataFrame:
    return fact_order_items.agg(*_freight_totals())


def _freight_by(fact: DataFrame, dim: DataFrame, key: str, label: str) -> DataFrame:
    per_key = fact.groupBy(key).agg(F.sum("price").alias("price"), F.sum("freight_value").alias("freight_value"), F.count("*").alias("n"))
    return per_key.join(dim.select(key, label), key).groupBy(label).agg(F.sum("n").alias("items"), *_freight_totals())


def freight_by_category(fact_order_items: DataFrame, dim_product: DataFrame) -> DataFrame:
    return _freight_by(fact_order_items, dim_product, "product_sk", "category_en")


def freight_by_state(fact_order_items: DataFrame, dim_geography: DataFrame) -> DataFrame:
    return _freight_by(fact_order_items, dim_geography, "geography_sk", "state")


def freight_heavy_items(fact_order_items: DataFrame) -> DataFrame:
    """Items whose freight is more than half their price (of those with a price)."""
    heavy = count_where(F.col("freight_value") * 2 > F.col("price"))
    return fact_order_items.where(F.col("price") > 0).agg(
        F.count("*").alias("items"), heavy.alias("heavy_items"), _share(heavy, F.count("*")).alias("heavy_share")
    )


def freight_over_price_products(fact_order_items: DataFrame) -> DataFrame:
    """Products sold at least once with freight above the price."""
    over = fact_order_items.where((F.col("freight_value") > F.col("price")) & (F.col("product_sk") != UNKNOWN_KEY))
    return over.agg(F.count_distinct("product_sk").alias("products"))


def items_per_order(fact_order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Average items per order with items and per order at all, and the share with several items."""
    per_order = fact_order_items.groupBy("order_id").agg(F.count("*").alias("items"))
    several = count_where(F.col("items") > 1)
    summary = per_order.agg(
        F.count("*").alias("orders_with_items"),
        F.sum("items").alias("items"),
        _share(F.sum("items"), F.count("*")).alias("items_per_order"),
        several.alias("multi_item_orders"),
        _share(several, F.count("*")).alias("multi_item_share"),
    )
    all_orders = orders.agg(F.count("*")).scalar()
    return summary.withColumn("all_orders", all_orders).withColumn(
        "items_per_any_order", _share(F.col("items"), F.col("all_orders"))
    )


def repeat_customers(customers: DataFrame, fact_delivery_reviews: DataFrame) -> DataFrame:
    """Two readings of 'repeat': customer records beyond one per person, and people with two or more orders."""
    records = customers.agg(
        F.count("customer_unique_id").alias("records"), F.count_distinct("customer_unique_id").alias("people")
    )
    per_person = fact_delivery_reviews.where(F.col("customer_sk") != UNKNOWN_KEY).groupBy("customer_sk").agg(F.count("*").alias("orders"))
    returning = per_person.agg(F.coalesce(count_where(F.col("orders") > 1), F.lit(0))).scalar()
    buyers = per_person.agg(F.count("*")).scalar()
    return records.select(
        "people",
        (F.col("records") - F.col("people")).alias("surplus_records"),
        buyers.alias("people_with_orders"),
        returning.alias("people_with_several_orders"),
    )


def delivery_rate(fact_delivery_reviews: DataFrame) -> DataFrame:
    delivered = count_where(F.col("is_delivered") == 1)
    return fact_delivery_reviews.agg(
        F.count("*").alias("orders"), delivered.alias("delivered"), _share(delivered, F.count("*")).alias("delivery_rate")
    )


def monthly_trend(fact_order_items: DataFrame, dim_date: DataFrame, first: date, last: date) -> DataFrame:
    """Items, revenue and freight share per month of a period in which the data is dense.

    The period also filters the fact itself, by its day key and, where the fact is stored by
    month, by its partitions, so files outside the period are not read.
    """
    days = dim_date.where(F.col("full_date").between(F.lit(first), F.lit(last))).select("date_sk", "year", "month")
    in_period = fact_order_items.where(F.col("date_sk").between(_key(first), _key(last)))
    if "month_sk" in fact_order_items.columns:
        in_period = in_period.where(F.col("month_sk").between(_key(first) // 100, _key(last) // 100))
    per_day = in_period.groupBy("date_sk").agg(
        F.sum("price").alias("price"), F.sum("freight_value").alias("freight_value"), F.count("*").alias("n")
    )
    return per_day.join(days, "date_sk").groupBy("year", "month").agg(F.sum("n").alias("items"), *_freight_totals())


def _key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def payments_total(fact_payments: DataFrame) -> DataFrame:
    return fact_payments.agg(F.count("*").alias("payments"), F.sum("payment_value").alias("payment_value"))


def payments_by_type(fact_payments: DataFrame) -> DataFrame:
    return fact_payments.groupBy("payment_type").agg(
        F.count("*").alias("payments"),
        F.sum("payment_value").alias("payment_value"),
        F.sum("payment_installments").alias("installments"),
        F.max("payment_installments").alias("max_installments"),
    )


def payments_by_installments(fact_payments: DataFrame) -> DataFrame:
    return fact_payments.groupBy("payment_installments").agg(
        F.count("*").alias("payments"), F.sum("payment_value").alias("payment_value")
    )


def _scored_deliveries(fact_delivery_reviews: DataFrame) -> DataFrame:
    return fact_delivery_reviews.where((F.col("is_delivered") == 1) & F.col("review_score").isNotNull())


def score_by_late(fact_delivery_reviews: DataFrame) -> DataFrame:
    return _scored_deliveries(fact_delivery_reviews).groupBy("is_late").agg(
        F.count("*").alias("orders"),
        exact_average(F.col("review_score"), 2).alias("avg_review_score"),
        exact_average(F.col("delivery_delay_days"), 1).alias("avg_delay_days"),
    )


def score_by_delay_bucket(fact_delivery_reviews: DataFrame) -> DataFrame:
    """Average score per delay band, from the earliest band to the latest."""
    delayed = _scored_deliveries(fact_delivery_reviews).where(F.col("delivery_delay_days").isNotNull())
    banded = delayed.withColumn("delivery_bucket", delay_band(F.col("delivery_delay_days")))
    return (
        banded.groupBy("delivery_bucket")
        .agg(
            F.count("*").alias("orders"),
            exact_average(F.col("review_score"), 2).alias("avg_score"),
            F.min("delivery_delay_days").alias("_earliest"),
        )
        .orderBy("_earliest")
        .drop("_earliest")
    )


def segment_satisfaction(fact_delivery_reviews: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders, scored orders and average score per customer segment."""
    score = F.col("review_score")
    per_customer = fact_delivery_reviews.groupBy("customer_sk").agg(
        F.count("*").alias("n"), F.count(score).alias("scored"), F.sum(score).alias("score_sum")
    )
    labelled = per_customer.join(dim_customer.select("customer_sk", "rfm_segment"), "customer_sk")
    scored, total = F.sum("scored"), F.sum("score_sum")
    return labelled.groupBy("rfm_segment").agg(
        F.sum("n").alias("orders"),
        scored.alias("scored_orders"),
        F.when(scored > 0, total.cast("decimal(20,6)") / scored.cast("decimal(20,0)")).cast("decimal(28,2)").alias("avg_score"),
    )
