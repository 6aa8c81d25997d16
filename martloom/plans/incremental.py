"""High-water-mark loads: only rows newer than the last load, appended as a named batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.keys import with_surrogate_key
from martloom.sources.tables import Warehouse


@dataclass(frozen=True)
class Increment:
    """The fact rows of a load, and what is known about them without computing them.

    ``keys`` is a small written table of the first business key of every row; ``slice_column`` and ``slices``
    are the partitions of the fact in which rows with these keys can lie.
    """

    rows: DataFrame
    keys: DataFrame | None = None
    slice_column: str | None = None
    slices: tuple[int, ...] = ()


@dataclass(frozen=True)
class LoadState:
    watermark: datetime | None
    loaded_at: datetime | None
    rows: int
    batch: int


class LoadControl:
    """How far each table has been loaded.

    Stored as a log, one small row per load; the newest row of a table is its state. A load
    writes its data first and its log row last, so a load that failed half-way is not recorded
    and its batch is written again under the same number.
    """

    LAYER, TABLE = "dq", "load_control"

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse

    def current(self) -> DataFrame | None:
        """The state of every table, or None before the first load."""
        if not self.warehouse.exists(self.LAYER, self.TABLE):
            return None
        log = self.warehouse.read(self.LAYER, self.TABLE)
        newest = F.max_by(F.struct("last_watermark", "last_load_time", "rows_last_loaded", "data_batch"), "load_batch")
        return log.groupBy("table_name").agg(newest.alias("s"), F.max("load_batch").alias("load_batch")).select("table_name", "s.*", "load_batch")

    def state(self, table: str) -> LoadState:
        current = self.current()
        row = None if current is None else current.where(F.col("table_name") == table).first()
        if row is None:
            return LoadState(None, None, 0, 0)
        return LoadState(row["last_watermark"], row["last_load_time"], row["rows_last_loaded"], row["data_batch"])

    def record(self, table: str, watermark: datetime | None, rows: int, loaded_at: datetime | None, batch: int) -> None:
        current = self.current()
        last = 0 if current is None else (current.agg(F.max("load_batch")).first()[0] or 0)
        row = self.warehouse.spark.range(0, 1, 1, 1).select(
            F.lit(table).alias("table_name"),
            F.lit(watermark).cast("timestamp_ntz").alias("last_watermark"),
            F.lit(loaded_at).cast("timestamp_ntz").alias("last_load_time"),
            F.lit(rows).cast("bigint").alias("rows_last_loaded"),
            F.lit(batch).alias("data_batch"),
        )
        self.warehouse.append(row, self.LAYER, self.TABLE, last + 1)

    def roll_back(self, table: str, days: int) -> None:
        """Move only a table's mark back, so that the next load revisits that period."""
        state = self.state(table)
        if state.watermark is not None:
            self.record(table, state.watermark - timedelta(days=days), state.rows, state.loaded_at, state.batch)


def newest_moment(source: DataFrame, moment: str) -> datetime | None:
    return source.agg(F.max(moment)).first()[0]


def newer_than(source: DataFrame, moment: str, mark: datetime | None, lookback: timedelta = timedelta(0)) -> DataFrame:
    """Source rows after the mark; all of them when there is no mark yet.

    On typed Parquet the comparison is pushed into the scan. ``lookback`` reaches back behind the
    mark for rows that arrived late; loading drops what is already there.
    """
    if mark is None:
        return source
    return source.where(F.col(moment) > F.lit(mark - lookback).cast("timestamp_ntz"))


def not_yet_loaded(new: DataFrame, loaded: DataFrame, keys: Sequence[str], batch_keys: DataFrame | None = None) -> DataFrame:
    """New rows whose business key is not in the table.

    The table is first reduced to the batch's own keys, a semi join against the small batch,
    so the anti join never shuffles the whole table. ``batch_keys`` gives the batch's first keys where they are known
    beforehand; else ``new`` is computed once more for them.
    """
    if batch_keys is None:
        batch_keys = new.select(keys[0]).distinct()
    candidates = loaded.select(*keys).join(batch_keys, keys[0], "left_semi")
    return new.join(candidates, list(keys), "left_anti")


def _increment(built: DataFrame | Increment) -> Increment:
    return built if isinstance(built, Increment) else Increment(built)


def _numbered(warehouse: Warehouse, table: str, rows: DataFrame, keys: Sequence[str], name: str | None, batch: int) -> DataFrame:
    """The rows with the table's own key, going on from the last one that a recorded batch has given out.

    An attempt that failed is not recorded, so its numbers are given again and the keys stay dense."""
    return rows if name is None else with_surrogate_key(rows, keys, name, start=warehouse.last_key("mart", table, batch) + 1)


def incremental_load(
    warehouse: Warehouse,
    table: str,
    source: DataFrame,
    moment: str,
    build: Callable[[DataFrame], DataFrame | Increment],
    keys: Sequence[str],
    loaded_at: datetime,
    lookback: timedelta = timedelta(0),
    dedup: bool = True,
    partition_by: Sequence[str] = (),
    key: str | None = None,
) -> int:
    """Append the fact rows of all ``source`` rows newer than the table's mark; returns their number.

    ``build`` turns the selected source rows into fact rows. Keys already in the table are left
    out unless ``dedup`` is off; where ``build`` gives an ``Increment`` only its slices of the table are read for that, and
    the rows are computed once. ``key`` names the fact's own key, if it has one. Afterwards the mark is the newest
    moment in the source; it never moves to NULL.
    """
    control = LoadControl(warehouse)
    state = control.state(table)
    batch = state.batch + 1
    made = _increment(build(newer_than(source, moment, state.watermark, lookback)))
    rows = made.rows
    if dedup and warehouse.exists("mart", table):
        loaded = warehouse.read("mart", table).where(F.col("load_batch") < batch)
        if made.slice_column:
            loaded = loaded.where(F.col(made.slice_column).isin(*made.slices))
        rows = not_yet_loaded(rows, loaded, keys, made.keys)
    count = warehouse.append(_numbered(warehouse, table, rows, keys, key, batch), "mart", table, batch, partition_by, key=key)
    control.record(table, newest_moment(source, moment) or state.watermark, count, loaded_at, batch)
    return count


def reload_slices(
    warehouse: Warehouse,
    table: str,
    source: DataFrame,
    moment: str,
    slice_of: Callable[[Column], Column],
    build: Callable[[DataFrame], DataFrame | Increment],
    keys: Sequence[str],
    loaded_at: datetime,
    slice_column: str,
    key: str | None = None,
) -> int:
    """Build the partitions that hold anything newer than the table's mark again, whole, and put them in the place of what
    the table has there; returns their number of rows. All other partitions stay as they are.

    ``slice_of`` gives the partition of a moment. After a mark was rolled back this takes late and corrected rows in
    and leaves nothing twice, also where a period had been appended twice.
    """
    control = LoadControl(warehouse)
    state = control.state(table)
    batch = state.batch + 1
    place = slice_of(F.col(moment))
    touched = sorted(r[0] for r in newer_than(source.where(F.col(moment).isNotNull()), moment, state.watermark).select(place).distinct().collect())
    made = _increment(build(source.where(place.isin(*touched))))
    rows = _numbered(warehouse, table, made.rows, keys, key, batch)
    count = warehouse.append(rows, "mart", table, batch, [slice_column], key=key, replaces=(slice_column, touched))
    control.record(table, newest_moment(source, moment) or state.watermark, count, loaded_at, batch)
    return count


def expected_new_rows(order_items: DataFrame, orders: DataFrame, moment: str, mark: datetime) -> DataFrame:
    """How many items a load from this mark should find."""
    recent = newer_than(orders, moment, mark).select("order_id")
    return order_items.select("order_id").join(recent, "order_id").agg(F.count("*").alias("expected_new_rows"))


def undated_items(order_items: DataFrame, orders: DataFrame, moment: str) -> DataFrame:
    """Items a mark can never select: their order has no moment, or there is no order."""
    dated = orders.where(F.col(moment).isNotNull()).select("order_id")
    per_order = order_items.groupBy("order_id").agg(F.count("*").alias("n"))
    missing = per_order.join(dated, "order_id", "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("undated_items"))
