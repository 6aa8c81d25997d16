"""End-to-end jobs over a warehouse folder: load the CSV feeds, build every table, refresh, check."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.columns import date_key_or_unknown, month_key
from martloom.operators.scd2 import scd2_merge
from martloom.plans.facts import DELIVERY_KEY, DELIVERY_KEYS, ITEM_KEY, ITEM_KEYS, MONTH, PAYMENT_KEY, PAYMENT_KEYS, with_fact_key
from martloom.plans.incremental import LoadControl, incremental_load, newest_moment, reload_slices
from martloom.plans.mart import Mart
from martloom.plans.quality_suite import quality_checks, staging_checks
from martloom.schemas import STAGING
from martloom.session import configure, folder_bytes, size_shuffles
from martloom.sources.csv_feeds import store_feed
from martloom.sources.tables import Warehouse

ITEM_FACT = "fact_order_items"
MOMENT = "order_purchase_timestamp"

FACT_DAYS = {ITEM_FACT: "date_sk", "fact_payments": "date_sk", "fact_delivery_reviews": "purchase_date_sk"}
# Business key and own key of each fact.
FACT_KEYS = {ITEM_FACT: (ITEM_KEYS, ITEM_KEY), "fact_payments": (PAYMENT_KEYS, PAYMENT_KEY), "fact_delivery_reviews": (DELIVERY_KEYS, DELIVERY_KEY)}


def load_staging(
    warehouse: Warehouse, csv_paths: Mapping[str, str], fold_keys: bool = False, crlf_rows: bool = False
) -> dict[str, int]:
    """Load the CSV feeds into typed staging tables; returns the number of rejected rows per feed.

    Each feed is parsed and written once; ``warehouse.rejects("staging", feed)`` gives its rejected rows as text.
    ``crlf_rows`` as in ``load_feed``.
    """
    spark = configure(warehouse.spark)
    size_shuffles(spark, sum(folder_bytes(spark, path) for path in csv_paths.values()))
    return {feed: store_feed(warehouse, feed, path, crlf_rows=crlf_rows, fold_keys=fold_keys) for feed, path in csv_paths.items()}


class StoredMart(Mart):
    """A mart whose tables live in a warehouse folder instead of the scratch folder.

    The item fact is kept in batches, which incremental loads extend. The segmented customer
    dimension is a new snapshot of ``dim_customer``. With ``keyed`` the facts have dense keys of their own.
    """

    TABLE_OF = {"dim_customer_segmented": "dim_customer"}
    INTERMEDIATE = ("rfm_base",)

    def __init__(self, warehouse: Warehouse, effective: date, keyed: bool = False):
        feeds = {feed: warehouse.read("staging", feed) for feed in STAGING}
        super().__init__(warehouse.spark, feeds, effective)
        self.warehouse = warehouse
        self.keyed = keyed

    def quarantine(self, feed: str, repeated: DataFrame) -> None:
        """Reports of all loads, a batch each, in ``dq.quarantine``."""
        self.warehouse.append(repeated, "dq", "quarantine", self.warehouse.last_batch("dq", "quarantine") + 1)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        layer, table = "intermediate" if name in self.INTERMEDIATE else "mart", self.TABLE_OF.get(name, name)
        day = FACT_DAYS.get(name)
        if day is None:
            return self.warehouse.write(df, layer, table)
        business_key, own_key = FACT_KEYS[name]
        by_month = (with_fact_key(df, business_key, own_key) if self.keyed else df).withColumn(MONTH, month_key(F.col(day)))
        if name != ITEM_FACT:
            return self.warehouse.write(by_month, layer, table, [MONTH])
        self.warehouse.append(by_month, layer, table, 1, [MONTH], fresh=True, key=own_key if self.keyed else None)
        return self.warehouse.read(layer, table)

    def keep_dimension(self, df: DataFrame, name: str) -> DataFrame:
        return self.warehouse.write(df, "mart", name)


def build_warehouse(warehouse: Warehouse, effective: date, loaded_at: datetime, keyed: bool = False, settle: bool = False) -> StoredMart:
    """Rebuild every mart table from staging. Can be run again at any time. ``keyed`` gives the facts their own keys, at
    the price of a range sort of each. A key repeated in a looked-up feed fails the build, or, with ``settle``, one row of it
    counts and the key goes to ``dq.quarantine``."""
    mart = StoredMart(warehouse, effective, keyed)
    if settle:
        mart.settle_feeds()
    else:
        mart.check_feeds()
    mart.build_all()
    warehouse.write(mart.rfm_scores, "intermediate", "rfm_scores")
    warehouse.write(mart.rfm_segments, "intermediate", "rfm_segments")
    newest = newest_moment(mart.feeds["orders"], MOMENT)
    LoadControl(warehouse).record(ITEM_FACT, newest, 0, loaded_at, 1)
    return mart


def refresh_sellers(warehouse: Warehouse, sellers: DataFrame, as_of: date) -> DataFrame:
    """Merge a new delivery of the seller feed into the versioned dimension."""
    dim = warehouse.read("mart", "dim_seller")
    merged = scd2_merge(dim, sellers, "seller_id", ["seller_city", "seller_state"], "seller_sk", as_of)
    return warehouse.write(merged, "mart", "dim_seller")


class RefreshMart(StoredMart):
    """Plans over new staging data that look up the dimensions already in the warehouse."""

    @property
    def dims(self) -> dict[str, DataFrame]:
        names = ("dim_product", "dim_seller", "dim_customer", "dim_geography", "dim_order_status")
        return {name: self.warehouse.read("mart", name) for name in names}


def refresh_order_items(
    warehouse: Warehouse,
    effective: date,
    loaded_at: datetime,
    lookback: timedelta = timedelta(0),
    dedup: bool = True,
) -> int:
    """Append the items of orders placed since the last load; returns the number of new rows."""
    mart = RefreshMart(warehouse, effective)
    return incremental_load(
        warehouse, ITEM_FACT, mart.feeds["orders"], MOMENT, mart.order_increment, ITEM_KEYS, loaded_at, lookback, dedup, [MONTH], _own_key(warehouse)
    )


def _own_key(warehouse: Warehouse) -> str | None:
    """The item fact's own key, if the stored fact has one."""
    return ITEM_KEY if ITEM_KEY in warehouse.read("mart", ITEM_FACT).columns else None


def month_of(moment: Column) -> Column:
    return month_key(date_key_or_unknown(moment))


def reload_order_items(warehouse: Warehouse, effective: date, loaded_at: datetime) -> int:
    """Build the months that hold orders placed after the mark again and put them in the place of the stored ones."""
    mart = RefreshMart(warehouse, effective)
    return reload_slices(
        warehouse, ITEM_FACT, mart.feeds["orders"], MOMENT, month_of, mart.order_increment, ITEM_KEYS, loaded_at, MONTH, _own_key(warehouse)
    )


def run_quality_checks(warehouse: Warehouse, mart: Mart, checked_at: datetime) -> DataFrame:
    """Run the suite and replace ``dq.check_results``."""
    stamped = quality_checks(mart).withColumn("checked_at", F.lit(checked_at).cast("timestamp_ntz"))
    return warehouse.write(stamped, "dq", "check_results")


def run_staging_checks(warehouse: Warehouse, expected_orders: int, checked_at: datetime) -> DataFrame:
    feeds = {feed: warehouse.read("staging", feed) for feed in ("orders", "order_items")}
    stamped = staging_checks(feeds, expected_orders).withColumn("checked_at", F.lit(checked_at).cast("timestamp_ntz"))
    return warehouse.write(stamped, "dq", "staging_checks")
