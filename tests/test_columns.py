from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.functions import columns as c
from martloom.functions.rules import customer_segment, delay_band


def one(df, expression):
    return df.select(expression.alias("x")).first()["x"]


def test_malformed_and_blank_timestamps_become_null(make):
    df = make("t string", [("2017-05-01 10:30:00",), ("",), ("bad",), (None,), ("2017-13-01 00:00:00",)])
    got = [r[0] for r in df.select(c.try_timestamp(F.col("t"))).collect()]
    assert got == [datetime(2017, 5, 1, 10, 30), None, None, None, None]
    assert [r[0] for r in df.select(c.try_date(F.col("t"))).collect()][0] == date(2017, 5, 1)
    keys = [r[0] for r in df.select(c.date_key_or_unknown(c.try_timestamp(F.col("t")))).collect()]
    assert keys == [20170501, -1, -1, -1, -1]


def test_days_between_counts_midnights(make):
    df = make("a timestamp_ntz, b timestamp_ntz", [(datetime(2020, 1, 1, 23, 59), datetime(2020, 1, 2, 0, 1))])
    assert one(df, c.days_between(F.col("a"), F.col("b"))) == 1
    assert one(df, c.days_between(F.col("b"), F.col("a"))) == -1


@pytest.mark.parametrize(
    "freight, price, share",
    [("5.00", "10.00", "0.5000"), ("5.00", "0.00", None), ("5.00", "-1.00", None), (None, "10.00", None), ("5.00", None, None),
     ("1.00", "3.00", "0.3333"), ("2.00", "3.00", "0.6667"), ("9999999999999999.99", "0.01", "999999999999999999.0000")],
)
def test_share_is_guarded_and_never_overflows(make, freight, price, share):
    values = [None if v is None else Decimal(v) for v in (freight, price)]
    df = make("f decimal(18,2), p decimal(18,2)", [tuple(values)])
    assert one(df, c.share_of(F.col("f"), F.col("p"))) == (None if share is None else Decimal(share))


def test_blank_length_and_change_tests(make):
    df = make("a string, b string", [(None, ""), ("  ", "x"), ("ab  ", "ab"), ("a", None)])
    assert [r[0] for r in df.select(c.is_blank(F.col("a"))).collect()] == [True, True, False, False]
    assert [r[0] for r in df.select(c.visible_length(F.col("a"))).collect()] == [None, 0, 2, 1]
    assert [r[0] for r in df.select(c.differs(F.col("a"), F.col("b"))).collect()] == [False, True, True, True]
    assert [r[0] for r in df.select(c.fold_case(F.concat(F.col("b"), F.lit("Q  ")))).collect()] == ["q", "xq", "abq", None]


def test_joined_key_keeps_rows_with_missing_parts(make):
    df = make("a string, b int", [("x", 1), ("x", None), (None, 1), ("x", 1)])
    assert df.agg(F.count_distinct(c.joined_key(F.col("a"), F.col("b")))).first()[0] == 3


def test_averages(make):
    df = make("n int", [(1,), (2,), (2,), (None,)])
    assert df.agg(c.whole_average(F.col("n"))).first()[0] == 1
    assert df.agg(c.exact_average(F.col("n"), 2)).first()[0] == Decimal("1.67")
    empty = df.where("n > 9")
    assert tuple(empty.agg(c.whole_average(F.col("n")), c.exact_average(F.col("n"), 2)).first()) == (None, None)


def test_percent_of_nothing_is_null(make):
    df = make("n int", [])
    assert df.agg(c.percent(c.count_where(F.col("n") > 0), F.count("*"))).first()[0] is None


def test_accents(make):
    df = make("t string", [("informática",), ("criança",), ("maçã",), ("cafe",), (None,)])
    got = [r[0] for r in df.select(F.coalesce(c.has_accent(F.col("t"), ("á", "ç", "é", "ã")), F.lit(False))).collect()]
    assert got == [True, True, True, False, False]


def test_delay_bands_edges(make):
    days = [-6, -5, -4, -1, 0, 1, 5, 6]
    got = [r[0] for r in make("d int", [(d,) for d in days]).select(delay_band(F.col("d"))).collect()]
    assert got == ["5+ days early"] * 2 + ["Early"] * 2 + ["On time"] + ["1-5 days late"] * 2 + ["5+ days late"]


def test_all_125_segment_cells(make):
    cells = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = make("r int, f int, m int", cells).withColumn("s", customer_segment(F.col("r"), F.col("f"), F.col("m")))
    sizes = {row["s"]: row["count"] for row in df.groupBy("s").count().collect()}
    assert sizes == {
        "Champions": 8,
        "Loyal": 37,
        "New / Promising": 20,
        "Big Spenders": 4,
        "At Risk": 30,
        "Can't Lose Them": 8,
        "Lost": 12,
        "Needs Attention": 6,
    }
    of = {tuple(r)[:3]: r["s"] for r in df.collect()}
    assert of[5, 5, 5] == "Champions" and of[5, 5, 3] == "Loyal" and of[3, 2, 4] == "Big Spenders"
    assert of[2, 3, 5] == "At Risk" and of[1, 1, 5] == "Can't Lose Them" and of[3, 1, 1] == "Needs Attention"
