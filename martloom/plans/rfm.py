"""Recency / frequency / monetary segmentation of customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.columns import days_between, exact_average, whole_average
from martloom.functions.rules import SEGMENT_UNKNOWN, customer_segment
from martloom.operators.keys import with_tiles

TILES = 5


def rfm_base(
    dim_customer: DataFrame, customers: DataFrame, orders: DataFrame, order_items: DataFrame
) -> DataFrame:
    """Per person with ordered items: days since the last order, number of orders, total spend.

    Items are summed per order before the join, and orders per customer after it; grouping by
    (order, person) keeps the order partitioning, so counting distinct orders costs no extra
    shuffle and a repeated order row is still counted once.
    """
    people = dim_customer.where("customer_sk > 0").select("customer_sk", "customer_unique_id")
    person_of = customers.select("customer_id", "customer_unique_id").join(people, "customer_unique_id")
    placed = orders.select("order_id", "customer_id", F.to_date("order_purchase_timestamp").alias("purchase_day"))
    spend = order_items.groupBy("order_id").agg(F.sum(F.col("price") + F.col("freight_value")).alias("spend"))
    per_order = (
        placed.join(person_of, "customer_id")
        .join(spend, "order_id")
        .groupBy("order_id", "customer_sk", "customer_unique_id")
        .agg(F.max("purchase_day").alias("purchase_day"), F.sum("spend").alias("spend"))
    )
    per_customer = per_order.groupBy("customer_sk", "customer_unique_id").agg(
        F.max("purchase_day").alias("last_day"),
        F.count("*").alias("frequency"),
        F.sum("spend").cast("decimal(28,2)").alias("monetary"),
    )
    newest_day = orders.agg(F.to_date(F.max("order_purchase_timestamp"))).scalar()
    return per_customer.select(
        "customer_sk",
        "customer_unique_id",
        days_between(F.col("last_day"), newest_day).alias("recency_days"),
        "frequency",
        "monetary",
    )


def rfm_summary(base: DataFrame) -> DataFrame:
    return base.agg(
        F.count("*").alias("customers"),
        whole_average(F.col("recency_days")).alias("avg_recency"),
        exact_average(F.col("frequency"), 6).alias("avg_frequency"),
        exact_average(F.col("monetary"), 6).alias("avg_monetary"),
    )


def rfm_scores(base: DataFrame) -> DataFrame:
    """Quintile scores 1 to 5, 5 best. Ties are split by customer_sk; no purchase day ranks last."""
    tiles = with_tiles(
        base,
        {"_recency": "recency_days", "f_score": "frequency", "m_score": "monetary"},
        TILES,
        tiebreak="customer_sk",
    )
    return tiles.select(*base.columns, (TILES + 1 - F.col("_recency")).alias("r_score"), "f_score", "m_score")


def rfm_segments(scores: DataFrame) -> DataFrame:
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scores.select(
        "customer_sk",
        "customer_unique_id",
        r,
        f,
        m,
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm_cell"),
        customer_segment(r, f, m).alias("rfm_segment"),
    )


def top_spenders(scores: DataFrame, n: int = 10) -> DataFrame:
    return scores.orderBy(F.desc("monetary"), "customer_sk").limit(n)


def with_segments(dim_customer: DataFrame, segments: DataFrame) -> DataFrame:
    """The customer dimension with its segments; people without one, and the unknown, are 'Unknown'."""
    scored = segments.select("customer_sk", F.col("rfm_segment").alias("_segment"))
    joined = dim_customer.join(scored, "customer_sk", "left")
    kept = [c for c in dim_customer.columns if c != "rfm_segment"]
    return joined.select(*kept, F.coalesce("_segment", "rfm_segment", F.lit(SEGMENT_UNKNOWN)).alias("rfm_segment"))


def segment_distribution(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.groupBy("rfm_segment").agg(F.count("*").alias("customers"))


def segment_spend(segments: DataFrame, base: DataFrame) -> DataFrame:
    return (
        segments.select("customer_sk", "rfm_segment")
        .join(base.select("customer_sk", "monetary"), "customer_sk")
        .groupBy("rfm_segment")
        .agg(F.count("*").alias("customers"), exact_average(F.col("monetary"), 2).alias("avg_spend"))
    )
