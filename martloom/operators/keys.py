"""Dense surrogate keys and exact global tiles without a single-partition sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.session import stage

# monotonically_increasing_id() puts the partition number above bit 33 and counts up from 0
# inside each partition, so on range-sorted partitions it is the local rank.
_PARTITION_BITS = 33
_LOCAL_MASK = (1 << _PARTITION_BITS) - 1


def _globally_sorted(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Range-partition and sort ``df``; ``_slot`` then grows along the global order.

    The result is written down because the range bounds are sampled: the counting pass and the
    numbering pass must see the same partitions, also after an executor is lost.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ordered.withColumn("_slot", F.monotonically_increasing_id()), name)


def _partition_sizes(staged: DataFrame) -> list[tuple[int, int]]:
    """(partition, rows), in order: one small row per shuffle partition, whatever the data size."""
    part = F.shiftright("_slot", _PARTITION_BITS).alias("part")
    return [(r["part"], r["rows"]) for r in staged.groupBy(part).agg(F.count("*").alias("rows")).orderBy("part").collect()]


def with_surrogate_key(df: DataFrame, keys: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Number the rows ``start, start+1, ...`` in the order of ``keys`` (NULLs first)."""
    staged = _globally_sorted(df, [F.col(k).asc_nulls_first() for k in keys], name)
    first = _first_number(_partition_sizes(staged), start)
    local = F.col("_slot").bitwiseAND(F.lit(_LOCAL_MASK))
    return staged.select((first + local).alias(name), *df.columns)


def _first_number(sizes: list[tuple[int, int]], start: int) -> Column:
    """The number of the first row of a row's partition.

    A constant array indexed by the partition, not a join: the numbered table stays a plain
    projection of its files, so the optimizer still knows its size. One entry per partition.
    """
    if not sizes:
        return F.lit(start).cast("bigint")
    firsts = [start] * (sizes[-1][0] + 1)
    for (part, _), before in zip(sizes, accumulate((rows for _, rows in sizes), initial=0)):
        firsts[part] = start + before
    if len(firsts) == 1:
        return F.lit(start).cast("bigint")
    constant = F.split(F.lit(",".join(map(str, firsts))), ",").cast("array<bigint>")
    return constant[F.shiftright("_slot", _PARTITION_BITS).cast("int")]


def tile_starts(rows: int, tiles: int) -> list[int]:
    """1-based rank of the first row of tiles 2..n; the first ``rows % tiles`` tiles get one row more."""
    size, longer = divmod(rows, tiles)
    starts = [t * size + min(t, longer) + 1 for t in range(1, tiles)]
    return [s for s in starts if s <= rows]


def with_tiles(
    df: DataFrame,
    scores: Mapping[str, str],
    tiles: int,
    tiebreak: str,
    value_type: str = "decimal(38,2)",
) -> DataFrame:
    """Add ``NTILE(tiles) OVER (ORDER BY value NULLS LAST, tiebreak)`` for several columns at once.

    ``scores`` maps each new column to the column it ranks. All columns are ranked by one range
    sort of narrow (column, value, tiebreak) rows. Only the first row of each tile comes back
    to the driver, at most ``tiles - 1`` per column, and the wide rows are then scored against
    those constants without being moved. ``tiebreak`` must be unique.
    """
    names = list(scores)
    ranked_column = F.explode(
        F.array(*[F.struct(F.lit(i).alias("col"), F.col(scores[n]).cast(value_type).alias("value")) for i, n in enumerate(names)])
    )
    long = df.select(ranked_column.alias("s"), F.col(tiebreak).alias("tie")).select("s.col", "s.value", "tie")
    staged = _globally_sorted(long, [F.col("col"), F.col("value").asc_nulls_last(), F.col("tie")], f"tiles-{'-'.join(names)}")

    sizes = _partition_sizes(staged)
    rows = sum(n for _, n in sizes) // len(names)
    firsts = [i * rows + start for i in range(len(names)) for start in tile_starts(rows, tiles)]
    cuts = staged.where(F.col("_slot").isin(_slots_of_ranks(firsts, sizes))).drop("_slot").collect()

    tile_columns = {}
    for i, name in enumerate(names):
        value, tie = F.col(scores[name]).cast(value_type), F.col(tiebreak)
        tile = F.lit(1)
        for cut in sorted((c for c in cuts if c["col"] == i), key=lambda c: (c["value"] is None, c["value"] or 0, c["tie"])):
            tile = tile + F.when(_not_before(value, tie, cut["value"], cut["tie"], value_type), 1).otherwise(0)
        tile_columns[name] = tile
    return df.withColumns(tile_columns)


def _not_before(value: Column, tie: Column, cut_value, cut_tie, value_type: str) -> Column:
    """True for rows at or after the cut in the order (value NULLS LAST, tie)."""
    if cut_value is None:
        return value.isNull() & (tie >= cut_tie)
    bound = F.lit(cut_value).cast(value_type)
    return value.isNull() | (value > bound) | ((value == bound) & (tie >= cut_tie))


def _slots_of_ranks(ranks: list[int], sizes: list[tuple[int, int]]) -> list[int]:
    """``_slot`` of the rows with these 1-based global ranks."""
    slots, first = [], 1
    for part, rows in sizes:
        slots += [(part << _PARTITION_BITS) + rank - first for rank in ranks if first <= rank < first + rows]
        first += rows
    return slots
