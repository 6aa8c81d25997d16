"""Loads new item files into the item fact as they arrive.

File-level progress in the checkpoint replaces the stored mark. Each micro-batch joins the static
dimensions and is written under its batch id, so a batch that is run again after a failure
replaces its own output: the batch log counts the attempts, and readers see the last recorded one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.lookup import one_per_key
from martloom.plans.facts import ITEM_KEYS
from martloom.plans.incremental import not_yet_loaded
from martloom.session import stage
from martloom.sources.tables import Warehouse


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_fact(
    items: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    warehouse: Warehouse,
    table: str,
    checkpoint: str,
    dedup: bool = True,
    first_batch: int = 0,
    partition_by: Sequence[str] = (),
    after_write: Callable[[int], None] | None = None,
) -> None:
    """Process everything available in ``items`` and stop.

    ``build`` turns a micro-batch of items into fact rows. The micro-batch is written down first, so its files are
    parsed once. With ``dedup`` an item delivered again is added once: of several in one micro-batch the greatest by price,
    freight and then all other columns, and what an earlier batch has stays. ``first_batch`` is the number of
    the stream's first batch; to extend a table that has batches already it must be above theirs
    and stay the same for the life of the checkpoint. ``after_write`` is called with a batch's number once it is
    recorded; if it fails, the batch is not committed to the checkpoint and the next run replays it.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        number = first_batch + batch_id
        items = stage(one_per_key(batch, ITEM_KEYS, ["price", "freight_value"]) if dedup else batch, "micro-batch")
        rows = build(items)
        if dedup and warehouse.exists("mart", table):
            loaded = warehouse.read("mart", table).where(F.col("load_batch") < number)
            rows = not_yet_loaded(rows, loaded, ITEM_KEYS, items.select(ITEM_KEYS[0]).distinct())
        warehouse.append(rows, "mart", table, number, partition_by)
        if after_write:
            after_write(number)

    query = (
        items.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
