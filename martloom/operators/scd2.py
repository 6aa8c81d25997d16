"""Type-2 versioned dimensions. A version is valid from its effective date up to, not including,
its expiry date: the day a version expires is the day its successor starts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.columns import differs
from martloom.operators.keys import with_surrogate_key
from martloom.operators.lookup import require_unique
from martloom.session import stage

OPEN_END = date(9999, 12, 31)


def expire_changed(dim: DataFrame, feed: DataFrame, key: str, attributes: Sequence[str], as_of: date) -> DataFrame:
    """Close the current version of every key whose attributes differ in the feed."""
    incoming = feed.select(F.col(key).alias("_key"), *[F.col(a).alias(f"_new_{a}") for a in attributes])
    joined = dim.join(incoming, (dim[key] == incoming["_key"]) & (dim["is_current"] == 1), "left")
    changed = F.col("_key").isNotNull() & reduce(or_, [differs(F.col(a), F.col(f"_new_{a}")) for a in attributes])
    replaced = {
        "expiry_date": F.when(changed, F.lit(as_of)).otherwise(F.col("expiry_date")),
        "is_current": F.when(changed, 0).otherwise(F.col("is_current")),
    }
    return joined.select(*[replaced[c].alias(c) if c in replaced else F.col(c) for c in dim.columns])


def keyless(feed: DataFrame, key: str) -> DataFrame:
    """Rows of a delivery that no version can be made of, because their key is NULL."""
    return feed.where(F.col(key).isNull())


def scd2_merge(
    dim: DataFrame,
    feed: DataFrame,
    key: str,
    attributes: Sequence[str],
    surrogate: str,
    as_of: date,
) -> DataFrame:
    """The dimension after a delivery of the source: changed keys get a new version, new keys
    their first one. Keys missing from the delivery stay current, unchanged data changes nothing.
    Rows without a key can't be versioned and are left out; ``keyless`` gives them.
    """
    feed = require_unique(feed.where(F.col(key).isNotNull()), [key], "feed")
    # Needed twice (as the result and to see which keys still have a current version).
    versions = stage(expire_changed(dim, feed, key, attributes, as_of), f"{surrogate}-versions")
    current = versions.where("is_current = 1").select(key)
    inserts = feed.join(current, key, "left_anti").select(
        key,
        *attributes,
        F.lit(as_of).alias("effective_date"),
        F.lit(OPEN_END).alias("expiry_date"),
        F.lit(1).alias("is_current"),
    )
    next_key = (versions.agg(F.max(surrogate)).first()[0] or 0) + 1
    numbered = with_surrogate_key(inserts, [key], surrogate, start=max(next_key, 1))
    return versions.unionByName(numbered)
