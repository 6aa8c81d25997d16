"""Declarative quality checks over one-row tables of measures."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Check outcomes.
PASS, WARN, FAIL = "PASS", "WARN", "FAIL"


@dataclass(frozen=True)
class Check:
    """One check over the columns of a measures row. A NULL ``ok`` does not pass."""

    check_id: int
    category: str
    name: str
    expected: Column
    actual: Column
    ok: Column
    otherwise: str = FAIL

    def as_struct(self) -> Column:
        return F.struct(
            F.lit(self.check_id).alias("check_id"),
            F.lit(self.category).alias("check_category"),
            F.lit(self.name).alias("check_name"),
            self.expected.cast("string").alias("expected"),
            self.actual.cast("string").alias("actual"),
            F.when(self.ok, PASS).otherwise(self.otherwise).alias("status"),
        )


def none_found(check_id: int, category: str, name: str, found: str, otherwise: str = FAIL) -> Check:
    """A check that counts offenders and expects none."""
    count = F.col(found)
    return Check(check_id, category, name, F.lit("0"), count, count == 0, otherwise)


def evaluate(groups: Sequence[tuple[DataFrame, Sequence[Check]]]) -> DataFrame:
    """Results of all checks. Checks that share a measures row share the scan behind it."""
    results = [measures.select(F.inline(F.array(*[c.as_struct() for c in checks]))) for measures, checks in groups]
    return reduce(DataFrame.unionByName, results)


def status_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("checks"))
