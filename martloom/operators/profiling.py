"""Table profiles: grain, missing values, ranges. One aggregation per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.columns import count_where, is_blank, joined_key


def row_counts(tables: Mapping[str, DataFrame], label: str = "table_name", count: str = "rows") -> DataFrame:
    """One labelled row count per table."""
    counts = [df.agg(F.count("*").alias(count)).select(F.lit(name).alias(label), count) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def grain(df: DataFrame, distinct: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """Rows and distinct keys; a key given as several columns counts their joined text."""
    measures = [F.count("*").alias("total")]
    for name, key in distinct.items():
        column = F.col(key) if isinstance(key, str) else joined_key(*[F.col(c) for c in key])
        measures.append(F.count_distinct(column).alias(name))
    return df.agg(*measures)


def nested_grain(df: DataFrame, outer: str, inner: str, outer_name: str, key_name: str) -> DataFrame:
    """Rows, distinct values of ``outer`` and distinct (outer, inner) keys, in two levels of grouping.

    Rows are counted per key, then keys per outer value, each map-side first: no row is multiplied per distinct count,
    as several COUNT(DISTINCT) in one aggregate would, and the key is never built as a text. A NULL part of a key counts as an empty
    text; a NULL ``outer`` is no distinct value of its own."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    known = F.max(F.col(outer).isNotNull().cast("int")).alias("_known")
    keys = df.groupBy(part(outer).alias("_outer"), part(inner).alias("_inner")).agg(F.count("*").alias("_rows"), known)
    values = keys.groupBy("_outer").agg(F.sum("_rows").alias("_rows"), F.count("*").alias("_keys"), F.max("_known").alias("_known"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return values.agg(total("_rows").alias("total"), total("_known").alias(outer_name), total("_keys").alias(key_name))


# Size of a sketch: 2^14 registers, some 16 KB, a relative error of 0.8 % (one standard deviation).
SKETCH_LOG_REGISTERS = 14


def key_sketches(df: DataFrame, keys: Mapping[str, Column], *by: str) -> DataFrame:
    """A mergeable sketch of the distinct values of each key, per value of ``by`` (a batch, a month).

    Stored beside a batch, it answers for any union of batches without reading their rows again."""
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(key, F.lit(SKETCH_LOG_REGISTERS)).alias(name) for name, key in keys.items()])


def sketched_distinct(sketches: DataFrame, *names: str) -> DataFrame:
    """One row of approximate distinct counts over all stored sketches."""
    return sketches.agg(*[F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in names])


def blanks(columns: Mapping[str, str]) -> list[Column]:
    """Number of NULL or blank values of each column."""
    return [count_where(is_blank(F.col(c).cast("string"))).alias(name) for name, c in columns.items()]


def ranges(columns: Mapping[str, str]) -> list[Column]:
    """Smallest and largest value of each column, named ``min_<name>`` and ``max_<name>``."""
    return [f(c).alias(f"{kind}_{name}") for name, c in columns.items() for kind, f in (("min", F.min), ("max", F.max))]


def distribution(df: DataFrame, *columns: str, count: str = "cnt") -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias(count))
