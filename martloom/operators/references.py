"""Referential checks: how many rows of a table have a key that another table lacks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Reference:
    """Each ``key`` of ``rows`` should be an ``other_key`` of ``other`` (whose keys may be known to be unique)."""

    name: str
    rows: DataFrame
    key: str
    other: DataFrame
    other_key: str
    other_unique: bool = False


def _is_whole(rows: DataFrame, column: str) -> bool:
    return isinstance(rows.schema[column].dataType, (T.IntegerType, T.LongType))


def _unbroken_run(rows: DataFrame, key: str) -> Column:
    """(lo, hi) of the positive keys if each number between them is a key, else NULL."""
    value = F.col(key).cast("bigint")
    lo, hi = F.min(value), F.max(value)
    run = F.when(F.count_distinct(value) == hi - lo + 1, F.struct(lo.alias("lo"), hi.alias("hi")))
    return rows.where(value > 0).agg(run.alias("run")).scalar()


def dangling(references: Sequence[Reference], label: str = "item", count: str = "value") -> DataFrame:
    """Number of rows without a match for every reference, 0 included. A NULL key has no match.

    References that start from the same frame share one scan of it: its keys are turned into
    (reference, key) rows, which are counted before the shuffle, so a hot key crosses it as one row per
    task. All counts then meet all known keys, tagged by the frame they come from, in one anti join;
    a frame that several references point to is read once. Where the positive whole-number keys of a frame have no gap (as
    surrogate keys; looked at first), a key between the smallest and the largest has a match and needs no join.
    """
    targets: dict[tuple[int, str], int] = {}
    starts: dict[int, list[Reference]] = {}
    for r in references:
        targets.setdefault((id(r.other), r.other_key), len(targets))
        starts.setdefault(id(r.rows), []).append(r)

    def target(r: Reference) -> int:
        return targets[id(r.other), r.other_key]

    runs = {target(r): _unbroken_run(r.other, r.other_key) for r in references if _is_whole(r.rows, r.key) and _is_whole(r.other, r.other_key)}

    def open_key(r: Reference) -> Column:
        """A reference's key as (name, target, key), or NULL where it is known to have a match."""
        key = F.struct(F.lit(r.name).alias("_name"), F.lit(target(r)).alias("_target"), F.col(r.key).cast("string").alias("_key"))
        if not _is_whole(r.rows, r.key) or target(r) not in runs:
            return key
        run = runs[target(r)]
        return F.when(~F.coalesce(F.col(r.key).between(run["lo"], run["hi"]), F.lit(False)), key)

    counted = []
    for group in starts.values():
        long = group[0].rows.select(F.inline(F.array_compact(F.array(*[open_key(r) for r in group]))))
        counted.append(long.groupBy("_name", "_target", "_key").agg(F.count("*").alias("_n")))
    known = []
    for r in {target(r): r for r in references}.values():
        keys = r.other.select(F.lit(target(r)).alias("_target"), F.col(r.other_key).cast("string").alias("_key"))
        known.append(keys if r.other_unique else keys.distinct())
    found = reduce(DataFrame.unionByName, counted).join(reduce(DataFrame.unionByName, known), ["_target", "_key"], "left_anti")
    none = F.inline(F.array(*[F.struct(F.lit(r.name).alias("_name"), F.lit(0).cast("bigint").alias("_n")) for r in references]))
    zeros = references[0].rows.sparkSession.range(0, 1, 1, 1).select(none)
    return found.select("_name", "_n").unionByName(zeros).groupBy(F.col("_name").alias(label)).agg(F.sum("_n").alias(count))
