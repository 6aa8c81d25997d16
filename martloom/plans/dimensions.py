"""The six dimensions. Each has a dense surrogate key and, with key -1, an unknown member."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.columns import date_key, flag
from martloom.operators.keys import with_surrogate_key
from martloom.operators.lookup import with_unknown_member

# Holidays on the same day every year.
FIXED_HOLIDAYS = {
    (1, 1): "New Year",
    (4, 21): "Tiradentes",
    (5, 1): "Labour Day",
    (9, 7): "Independence",
    (10, 12): "Our Lady Aparecida",
    (11, 2): "All Souls",
    (11, 15): "Republic Day",
    (12, 25): "Christmas",
}

# Holidays on a given date. They win over the yearly ones.
DATED_HOLIDAYS = {
    date(2016, 2, 8): "Carnival",
    date(2016, 2, 9): "Carnival",
    date(2017, 2, 27): "Carnival",
    date(2017, 2, 28): "Carnival",
    date(2018, 2, 12): "Carnival",
    date(2018, 2, 13): "Carnival",
}

# Content of the unknown members.
UNKNOWN_CODE = "UNKNOWN"
UNKNOWN_TEXT = "unknown"
UNKNOWN_STATE = "XX"
UNKNOWN_LABEL = "Unknown"
UNKNOWN_DAY = date(1900, 1, 1)
OPEN_END = date(9999, 12, 31)


@dataclass(frozen=True)
class Holidays:
    yearly: Mapping[tuple[int, int], str]
    dated: Mapping[date, str]


DEFAULT_HOLIDAYS = Holidays(FIXED_HOLIDAYS, DATED_HOLIDAYS)


def calendar_bounds(moments: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """One row (lo, hi): first day of the earliest year to last day of the latest year in the data."""
    spans = [df.select(F.min(c).alias("lo"), F.max(c).alias("hi")) for df, c in moments]
    joined = spans[0]
    for span in spans[1:]:
        joined = joined.unionByName(span)
    first_day = F.to_date(F.trunc(F.min("lo"), "year"))
    last_day = F.add_months(F.to_date(F.trunc(F.max("hi"), "year")), 12)
    return joined.agg(first_day.alias("lo"), F.date_sub(last_day, 1).alias("hi"))


def fixed_bounds(spark: SparkSession, lo: date, hi: date) -> DataFrame:
    return spark.range(1).select(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))


def dim_date(bounds: DataFrame, holidays: Holidays = DEFAULT_HOLIDAYS) -> DataFrame:
    """One row per day between the bounds.

    Holidays are matched to calendar days only, so the unknown day, which is stored as
    1900-01-01, is not a New Year.
    """
    day = F.col("full_date")
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("full_date"))
    holiday = _holiday_name(day, holidays)
    weekday = F.date_format(day, "EEEE")
    calendar = days.select(
        date_key(day).alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        weekday.alias("weekday_name"),
        flag(weekday.isin("Saturday", "Sunday")).alias("is_weekend"),
        flag(holiday.isNotNull()).alias("is_holiday"),
        holiday.alias("holiday_name"),
    )
    return with_unknown_member(
        calendar,
        "date_sk",
        {
            "full_date": UNKNOWN_DAY,
            "year": UNKNOWN_DAY.year,
            "quarter": 1,
            "month": UNKNOWN_DAY.month,
            "month_name": UNKNOWN_LABEL,
            "day": UNKNOWN_DAY.day,
            "weekday_name": UNKNOWN_LABEL,
            "is_weekend": 0,
            "is_holiday": 0,
            "holiday_name": UNKNOWN_LABEL,
        },
    )


def _holiday_name(day, holidays: Holidays):
    yearly = F.create_map(*[F.lit(v) for (m, d), name in holidays.yearly.items() for v in (m * 100 + d, name)])
    dated = F.create_map(*[F.lit(v) for when, name in holidays.dated.items() for v in (when, name)])
    return F.coalesce(dated[day], yearly[F.month(day) * 100 + F.dayofmonth(day)])


def dim_order_status(orders: DataFrame) -> DataFrame:
    statuses = orders.where(F.col("order_status").isNotNull()).select("order_status").distinct()
    keyed = with_surrogate_key(statuses, ["order_status"], "order_status_sk")
    members = keyed.withColumn("is_delivered", flag(F.col("order_status") == "delivered"))
    return with_unknown_member(members, "order_status_sk", {"order_status": UNKNOWN_LABEL, "is_delivered": 0})


def dim_product(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with their category in both languages; untranslated categories become 'unknown'."""
    category = "product_category_name"
    translated = products.join(translation, category, "left").select(
        F.col("product_id"),
        F.col(category).alias("category_pt"),
        F.coalesce("product_category_name_english", F.lit(UNKNOWN_TEXT)).alias("category_en"),
        F.col("product_weight_g").alias("weight_g"),
        F.col("product_length_cm").alias("length_cm"),
        F.col("product_height_cm").alias("height_cm"),
        F.col("product_width_cm").alias("width_cm"),
    )
    members = with_surrogate_key(translated, ["product_id"], "product_sk")
    return with_unknown_member(
        members,
        "product_sk",
        {"product_id": UNKNOWN_CODE, "category_pt": UNKNOWN_TEXT, "category_en": UNKNOWN_TEXT},
    )


def latest_records(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Of each person the customer record with the newest order; of several the one with the largest id.

    One record wins as a whole, so city and state belong together. A record without a dated order loses to any with
    one. Both maxima combine map-side."""
    last = orders.where(F.col("customer_id").isNotNull()).groupBy(F.col("customer_id").alias("_ordered_by")).agg(F.max("order_purchase_timestamp").alias("_last"))
    dated = customers.join(last, customers["customer_id"] == last["_ordered_by"], "left")
    best = F.max(F.struct("_last", "customer_id", "customer_city", "customer_state")).alias("_best")
    return dated.groupBy("customer_unique_id").agg(best).select("customer_unique_id", "_best.customer_city", "_best.customer_state")


def dim_customer(customers: DataFrame, latest_by: DataFrame | None = None) -> DataFrame:
    """One row per person. City and state are each the largest value seen for the person, or, with the orders as
    ``latest_by``, those of the record with the newest order."""
    if latest_by is not None:
        people = latest_records(customers, latest_by)
    else:
        people = customers.groupBy("customer_unique_id").agg(
            F.max("customer_city").alias("customer_city"), F.max("customer_state").alias("customer_state")
        )
    members = with_surrogate_key(people, ["customer_unique_id"], "customer_sk")
    members = members.withColumn("rfm_segment", F.lit(None).cast("string"))
    return with_unknown_member(
        members,
        "customer_sk",
        {"customer_unique_id": UNKNOWN_CODE, "customer_city": UNKNOWN_TEXT, "customer_state": UNKNOWN_STATE},
    )


def dim_geography(geolocation: DataFrame) -> DataFrame:
    """One row per zip: the mean coordinates and the most frequent (city, state).

    Places are counted first, so a zip with a third of all rows is only a few rows in the
    second step. Equally frequent places are decided alphabetically. Rows without a zip are left out.
    """
    places = (
        geolocation.where(F.col("geolocation_zip_code_prefix").isNotNull())
        .groupBy(
            F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
            F.col("geolocation_city").alias("city"),
            F.col("geolocation_state").alias("state"),
        )
        .agg(
            F.count("*").alias("rows"),
            F.sum("geolocation_lat").alias("lat_sum"),
            F.count("geolocation_lat").alias("lat_rows"),
            F.sum("geolocation_lng").alias("lng_sum"),
            F.count("geolocation_lng").alias("lng_rows"),
        )
    )
    most_frequent = F.min(F.struct((-F.col("rows")).alias("order"), "city", "state"))
    zips = places.groupBy("zip_code_prefix").agg(
        most_frequent.alias("place"),
        _mean_coordinate("lat").alias("latitude"),
        _mean_coordinate("lng").alias("longitude"),
    )
    flat = zips.select("zip_code_prefix", "place.city", "place.state", "latitude", "longitude")
    members = with_surrogate_key(flat, ["zip_code_prefix"], "geography_sk")
    return with_unknown_member(
        members,
        "geography_sk",
        {"zip_code_prefix": UNKNOWN_CODE, "city": UNKNOWN_TEXT, "state": UNKNOWN_STATE},
    )


def _mean_coordinate(axis: str):
    total, rows = F.sum(f"{axis}_sum"), F.sum(f"{axis}_rows")
    return F.when(rows > 0, total.cast("decimal(28,10)") / rows.cast("decimal(10,0)")).cast("decimal(18,10)")


def dim_seller(sellers: DataFrame, effective: date) -> DataFrame:
    """First load of the versioned seller dimension: every seller with a key current and open-ended."""
    first_versions = sellers.where(F.col("seller_id").isNotNull()).select(
        "seller_id",
        "seller_city",
        "seller_state",
        F.lit(effective).alias("effective_date"),
        F.lit(OPEN_END).alias("expiry_date"),
        F.lit(1).alias("is_current"),
    )
    members = with_surrogate_key(first_versions, ["seller_id"], "seller_sk")
    return with_unknown_member(
        members,
        "seller_sk",
        {
            "seller_id": UNKNOWN_CODE,
            "seller_city": UNKNOWN_TEXT,
            "seller_state": UNKNOWN_STATE,
            "effective_date": UNKNOWN_DAY,
            "expiry_date": OPEN_END,
            "is_current": 1,
        },
    )
