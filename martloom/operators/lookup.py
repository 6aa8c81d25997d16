"""Key lookups against dimensions, and the unknown member they fall back to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.columns import UNKNOWN_KEY
from martloom.session import stage


class DuplicateKeys(RuntimeError):
    pass


def with_unknown_member(members: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    """Add the row facts without a match point to. Columns without a default are NULL."""
    values: dict[str, object] = {key: UNKNOWN_KEY, **defaults}
    row = members.sparkSession.range(0, 1, 1, 1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in members.schema.fields]
    )
    return members.unionByName(row)


def lookup(
    rows: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    key: str,
    where: Column | None = None,
) -> DataFrame:
    """Add the dimension's surrogate ``key``, or -1 where the row has no match; no row is lost.

    ``on`` maps columns of ``rows`` to business-key columns of ``dim``. ``where`` restricts the
    dimension (for example to current versions) before the join. The unknown member itself is
    left out, so only real members match. No broadcast is forced: the planner chooses one from
    the dimension's file size, else it shuffles, and AQE splits the partitions of hot keys.
    """
    members = dim.where(F.col(key) != UNKNOWN_KEY)
    if where is not None:
        members = members.where(where)
    right = members.select(F.col(key), *[F.col(d).alias(f"_dim_{d}") for d in on.values()])
    matched = rows.join(right, [rows[r] == right[f"_dim_{d}"] for r, d in on.items()], "left")
    return matched.select(*rows.columns, F.coalesce(right[key], F.lit(UNKNOWN_KEY)).alias(key))


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def require_unique(rows: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Fail if a lookup table has a repeated key: it would silently multiply fact rows."""
    repeated = duplicate_keys(rows, keys).limit(3).collect()
    if repeated:
        raise DuplicateKeys(f"{table}: repeated {tuple(keys)}, for example {[tuple(r)[:-1] for r in repeated]}")
    return rows


def one_per_key(rows: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``prefer``, then by all other columns, so the choice never depends on their order.

    A maximum combines map-side, so a key repeated very often is no hot task; the key, the same in all rows compared, is
    shuffled once. NULL keys are keys here."""
    order = [c for c in [*prefer, *[c for c in rows.columns if c not in prefer]] if c not in keys]
    if not order:
        return rows.distinct()
    best = rows.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in rows.columns])


def settle_repeats(rows: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> tuple[DataFrame, DataFrame | None]:
    """(rows with one row per key, the repeated keys with their number of rows), or (rows, None) if no key repeats.

    Rows without a key never match in a lookup and stay. The repeated keys are few, and written: only their rows are compared,
    the others are not shuffled again where the keys can be broadcast."""
    known = [F.col(k).isNotNull() for k in keys]
    repeated = stage(duplicate_keys(rows.where(reduce(Column.__and__, known)), keys), "repeated-keys")
    if repeated.isEmpty():
        return rows, None
    winners = one_per_key(rows.join(repeated, list(keys), "left_semi"), keys, prefer)
    return rows.join(repeated, list(keys), "left_anti").unionByName(winners), repeated


def unmatched(rows: DataFrame, other: DataFrame, on: Mapping[str, str], other_unique: bool = False) -> DataFrame:
    """Rows (NULL keys included) whose key does not occur in ``other``.

    Unless the keys of ``other`` are known to be unique they are made so first: an anti join
    can split a hot key on its left side only, so one on the right must not stay large. They are
    staged, since AQE splits a join only if nothing stands between it and its shuffles.
    """
    right = _other_keys(other, on)
    return _anti_join(rows, right if other_unique else stage(right.distinct(), "distinct-keys"), on)


def _other_keys(other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    return other.select(*[F.col(o).alias(f"_other_{o}") for o in on.values()])


def _anti_join(rows: DataFrame, right: DataFrame, on: Mapping[str, str]) -> DataFrame:
    return rows.join(right, [rows[r] == right[f"_other_{o}"] for r, o in on.items()], "left_anti")


def count_unmatched(
    rows: DataFrame, other: DataFrame, on: Mapping[str, str], name: str = "rows", other_unique: bool = False
) -> DataFrame:
    """Number of rows without a match.

    Counts per key first: a key holding a third of the rows crosses the shuffle as one row.
    """
    per_key = rows.groupBy(*on).agg(F.count("*").alias("_n"))
    total = F.coalesce(F.sum("_n"), F.lit(0).cast("bigint"))
    right = _other_keys(other, on)  # neither side has a hot key here, so nothing needs splitting
    return _anti_join(per_key, right if other_unique else right.distinct(), on).agg(total.alias(name))


def latest_per_key(rows: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark prunes to one row per key inside each input partition before the shuffle
    (window group limit), so a hot key does not end up whole in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return rows.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
