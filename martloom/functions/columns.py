"""Column expressions shared by the jobs. Built-in functions only, so every plan stays in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_KEY = -1

MONEY = "decimal(18,2)"
# Room for any decimal(18,2) / decimal(18,2): one tiny price must not overflow and fail a load.
RATIO = "decimal(23,4)"


def try_timestamp(text: Column) -> Column:
    """Text to timestamp without time zone; blank and malformed text become NULL."""
    return text.try_cast("timestamp_ntz")


def try_date(text: Column) -> Column:
    return F.to_date(try_timestamp(text))


def date_key(moment: Column) -> Column:
    """Calendar day as the integer yyyymmdd."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def date_key_or_unknown(moment: Column) -> Column:
    return F.coalesce(date_key(moment), F.lit(UNKNOWN_KEY))


def month_key(day_key: Column) -> Column:
    """yyyymm of a yyyymmdd key; the unknown day stays -1."""
    return F.when(day_key > 0, F.floor(day_key / 100).cast("int")).otherwise(day_key)


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed going from ``start`` to ``end``."""
    return F.datediff(end, start)


def share_of(part: Column, whole: Column) -> Column:
    """``part / whole`` where ``whole`` is positive, else NULL."""
    return F.when(whole > 0, (part / whole).cast(RATIO))


def is_blank(text: Column) -> Column:
    """NULL, empty, or only trailing spaces."""
    return text.isNull() | (F.rtrim(text) == "")


def visible_length(text: Column) -> Column:
    """Length without trailing spaces."""
    return F.length(F.rtrim(text))


def joined_key(*parts: Column, sep: str = "-") -> Column:
    """Composite key as text; a NULL part counts as empty text, so the row is still counted."""
    pieces: list[Column] = []
    for position, part in enumerate(parts):
        if position:
            pieces.append(F.lit(sep))
        pieces.append(F.coalesce(part.cast("string"), F.lit("")))
    return F.concat(*pieces)


def differs(left: Column, right: Column) -> Column:
    """Text change test in which NULL and empty text are the same value."""
    return F.coalesce(left, F.lit("")) != F.coalesce(right, F.lit(""))


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def count_where(condition: Column) -> Column:
    """Rows meeting the condition; NULL over no rows at all."""
    return F.sum(flag(condition))


def whole_average(number: Column) -> Column:
    """Integer average, truncated towards zero."""
    total, rows = F.sum(number.cast("bigint")), F.count(number)
    return F.when(rows > 0, F.call_function("div", total, rows))


def exact_average(number: Column, scale: int) -> Column:
    """Average in decimal arithmetic, rounded half-up to ``scale`` digits."""
    return F.avg(number.cast("decimal(28,6)")).cast(f"decimal(28,{scale})")


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is 0 or NULL."""
    return F.when(whole > 0, part.cast("decimal(20,0)") * 100 / whole.cast("decimal(20,0)"))


def fold_case(text: Column) -> Column:
    """Key normalisation for sources whose keys differ only in case or trailing spaces."""
    return F.lower(F.rtrim(text))


def has_accent(text: Column, letters: tuple[str, ...]) -> Column:
    """True when any of the letters occurs in the text."""
    found = F.lit(False)
    for letter in letters:
        found = found | text.like(f"%{letter}%")
    return found
