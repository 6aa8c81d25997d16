"""Shared pieces: word definition, reading tables, row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import stage

# A word is a run of anything but ASCII white space; bytes.split() cuts UTF-8 text the same way.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, for matching ASCII words: other letters may be folded too or replaced by
    another letter outside ASCII. lower() is many times faster than translate(); the two letters it
    would turn into ASCII ones (Kelvin sign, dotted capital I) are replaced first."""
    for letter in "\u212a\u0130":
        text = F.replace(text, F.lit(letter), F.lit("\u00e9"))
    return F.lower(text)


def staged_with_row(df: DataFrame, name: str, row: str = "_row") -> DataFrame:
    """Write ``df`` down with a number unique to each row, so repeated rows stay apart.

    The numbers are not stable over runs, hence the write: later plans must all see the same ones.
    """
    return stage(df.withColumn(row, F.monotonically_increasing_id()), name)
