"""Builds the whole warehouse from the nine feeds, each table once and on first use."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.columns import UNKNOWN_KEY, month_key
from martloom.operators.lookup import duplicate_keys, require_unique, settle_repeats
from martloom.plans import dimensions, facts, rfm
from martloom.plans.incremental import Increment
from martloom.session import stage

# Lookup tables whose keys must be unique, or a join to them would multiply fact rows.
LOOKUP_KEYS = {
    "orders": ["order_id"],
    "customers": ["customer_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "category_translation": ["product_category_name"],
}

# Which of several rows of one key counts: the one placed or approved last, then the greatest of all columns.
PREFERRED = {"orders": ["order_purchase_timestamp", "order_approved_at"]}

ALL_TABLES = (
    "dim_date",
    "dim_order_status",
    "dim_product",
    "dim_customer",
    "dim_geography",
    "dim_seller",
    "fact_order_items",
    "fact_payments",
    "fact_delivery_reviews",
    "rfm_base",
    "dim_customer_segmented",
)


def repeated_keys(feed: str, repeated: DataFrame, keys: list[str]) -> DataFrame:
    """(feed, key, rows) of keys that a feed holds more than once."""
    return repeated.select(F.lit(feed).alias("feed"), F.concat_ws("|", *keys).alias("key"), F.col("rows").cast("bigint").alias("rows"))


class Mart:
    """Dimensions and facts over one set of feeds.

    Dimensions and reported-on tables are written to the shared folder when first asked for;
    the ``*_plan`` methods give the facts as plans over the feeds, not yet computed. With ``latest_customers`` a person's
    city and state come from the record with the newest order.
    """

    latest_customers = False

    def __init__(self, spark: SparkSession, feeds: dict[str, DataFrame], effective: date):
        self.spark = spark
        self.feeds = feeds
        self.effective = effective
        self.quarantined: list[DataFrame] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table down once; a subclass may choose where."""
        return stage(df, name)

    def keep_dimension(self, df: DataFrame, name: str) -> DataFrame:
        """Dimensions are already written down when their keys are numbered."""
        return df

    def check_feeds(self) -> None:
        for feed, keys in LOOKUP_KEYS.items():
            require_unique(self.feeds[feed], keys, feed)

    def settle_feeds(self) -> None:
        """Instead of failing on a repeated key: keep one row of it and report the key."""
        for feed, keys in LOOKUP_KEYS.items():
            self.feeds[feed], repeated = settle_repeats(self.feeds[feed], keys, PREFERRED.get(feed, ()))
            if repeated is not None:
                self.quarantine(feed, repeated_keys(feed, repeated, keys))

    def quarantine(self, feed: str, repeated: DataFrame) -> None:
        """Keep the report of a feed's repeated keys; a subclass may write it somewhere."""
        self.quarantined = [*self.quarantined, repeated]

    def build_all(self) -> None:
        """Compute every table, dimensions first."""
        for name in ALL_TABLES:
            getattr(self, name)

    @cached_property
    def dim_date(self) -> DataFrame:
        bounds = dimensions.calendar_bounds(
            [
                (self.feeds["orders"], "order_purchase_timestamp"),
                (self.feeds["order_reviews"], "review_creation_date"),
            ]
        )
        return self.keep(dimensions.dim_date(bounds), "dim_date")

    @cached_property
    def dim_order_status(self) -> DataFrame:
        return self.keep_dimension(dimensions.dim_order_status(self.feeds["orders"]), "dim_order_status")

    @cached_property
    def dim_product(self) -> DataFrame:
        products = dimensions.dim_product(self.feeds["products"], self.feeds["category_translation"])
        return self.keep_dimension(products, "dim_product")

    @cached_property
    def dim_customer(self) -> DataFrame:
        orders = self.feeds["orders"] if self.latest_customers else None
        return self.keep_dimension(dimensions.dim_customer(self.feeds["customers"], orders), "dim_customer")

    @cached_property
    def dim_geography(self) -> DataFrame:
        return self.keep_dimension(dimensions.dim_geography(self.feeds["geolocation"]), "dim_geography")

    @cached_property
    def dim_seller(self) -> DataFrame:
        return self.keep_dimension(dimensions.dim_seller(self.feeds["sellers"], self.effective), "dim_seller")

    @property
    def dims(self) -> dict[str, DataFrame]:
        return {
            "dim_product": self.dim_product,
            "dim_seller": self.dim_seller,
            "dim_customer": self.dim_customer,
            "dim_geography": self.dim_geography,
            "dim_order_status": self.dim_order_status,
        }

    def keyed_orders_plan(
        self, orders: DataFrame | None = None, with_place: bool = False, few_orders: bool = False
    ) -> DataFrame:
        orders = self.feeds["orders"] if orders is None else orders
        return facts.order_keys(orders, self.feeds["customers"], self.dims, with_place, few_orders)

    def fact_order_items_plan(self, order_items: DataFrame | None = None) -> DataFrame:
        items = self.feeds["order_items"] if order_items is None else order_items
        return facts.fact_order_items(items, self.keyed_orders_plan(with_place=True), self.dims)

    def item_batch_plan(self, order_items: DataFrame) -> DataFrame:
        """Fact rows of one batch of items; only their orders and customers are resolved, each from one row."""
        keyed = self._new_orders(facts.orders_of(order_items, self.feeds["orders"]))
        return facts.fact_order_items(order_items, keyed, self.dims)

    def new_order_items_plan(self, orders: DataFrame) -> DataFrame:
        """Fact rows of the items of these (newly placed) orders.

        The orders with their keys are written down first. An increment is small, and then the
        planner knows it: the join broadcasts them and the whole item feed is scanned but not
        shuffled. An increment over the broadcast limit is joined by shuffle.
        """
        return facts.new_order_items(self.feeds["order_items"], self._new_orders(orders), self.dims)

    def _new_orders(self, orders: DataFrame) -> DataFrame:
        """The keys of these orders, one row per order, written down."""
        return self._one_per_order(self._keyed(orders, self.feeds["customers"]), orders)

    def _keyed(self, orders: DataFrame, customers: DataFrame) -> DataFrame:
        keyed = facts.order_keys(orders, customers, self.dims, with_place=True, few_orders=True)
        return stage(keyed.select("order_id", *facts.ORDER_ITEM_KEYS), "new_orders")

    def _one_per_order(self, keyed: DataFrame, orders: DataFrame) -> DataFrame:
        """``keyed`` itself, unless an order or its customer was delivered more than once: then the orders concerned are
        resolved again from one row each, and the repeated keys go to the quarantine. Usually one look at the written keys."""
        again = duplicate_keys(keyed.where("order_id is not null"), ["order_id"])
        if again.isEmpty():
            return keyed
        again = stage(again.select("order_id"), "repeated-orders")
        own, own_repeats = settle_repeats(orders.join(again, "order_id", "left_semi"), ["order_id"], PREFERRED["orders"])
        people, people_repeats = settle_repeats(self.feeds["customers"].join(own.select("customer_id").distinct(), "customer_id", "left_semi"), ["customer_id"])
        for feed, keys, repeated in (("orders", ["order_id"], own_repeats), ("customers", ["customer_id"], people_repeats)):
            if repeated is not None:
                self.quarantine(feed, repeated_keys(feed, repeated, keys))
        return stage(keyed.join(again, "order_id", "left_anti").unionByName(self._keyed(own, people)), "new_orders")

    def order_increment(self, orders: DataFrame, month: str = facts.MONTH) -> Increment:
        """The same rows with their month, and the months of the fact where rows of these orders can lie.

        An order keeps the month of its purchase once it has one; before, its items are in the unknown month, so that is
        looked at too. There are at most as many months as the calendar of the increment has.
        """
        new_orders = self._new_orders(orders)
        place = month_key(F.col("date_sk"))
        months = {r[0] for r in new_orders.select(place).distinct().collect()}
        rows = facts.new_order_items(self.feeds["order_items"], new_orders, self.dims).withColumn(month, place)
        return Increment(rows, new_orders.select("order_id"), month, tuple(sorted({*months, UNKNOWN_KEY})))

    def fact_payments_plan(self) -> DataFrame:
        return facts.fact_payments(self.feeds["order_payments"], self.keyed_orders_plan())

    def fact_delivery_reviews_plan(self) -> DataFrame:
        return facts.fact_delivery_reviews(self.keyed_orders_plan(), self.feeds["order_reviews"])

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return self.keep(self.fact_order_items_plan(), "fact_order_items")

    @cached_property
    def fact_payments(self) -> DataFrame:
        return self.keep(self.fact_payments_plan(), "fact_payments")

    @cached_property
    def fact_delivery_reviews(self) -> DataFrame:
        return self.keep(self.fact_delivery_reviews_plan(), "fact_delivery_reviews")

    def rfm_base_plan(self) -> DataFrame:
        return rfm.rfm_base(
            self.dim_customer, self.feeds["customers"], self.feeds["orders"], self.feeds["order_items"]
        )

    @cached_property
    def rfm_base(self) -> DataFrame:
        return self.keep(self.rfm_base_plan(), "rfm_base")

    @cached_property
    def rfm_scores(self) -> DataFrame:
        return rfm.rfm_scores(self.rfm_base)

    @cached_property
    def rfm_segments(self) -> DataFrame:
        return rfm.rfm_segments(self.rfm_scores)

    @cached_property
    def dim_customer_segmented(self) -> DataFrame:
        return self.keep(rfm.with_segments(self.dim_customer, self.rfm_segments), "dim_customer_segmented")
