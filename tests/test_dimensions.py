from datetime import date, datetime
from decimal import Decimal

from martloom.plans import dimensions as d


def test_calendar_and_holidays(spark, collect):
    dim = d.dim_date(d.fixed_bounds(spark, date(2016, 1, 1), date(2018, 12, 31)))
    assert dim.count() == 1097
    by_day = {r["full_date"]: r for r in dim.collect()}
    new_year, carnival, plain = by_day[date(2017, 1, 1)], by_day[date(2017, 2, 28)], by_day[date(2017, 6, 15)]
    assert (new_year["date_sk"], new_year["is_holiday"], new_year["holiday_name"]) == (20170101, 1, "New Year")
    assert (new_year["weekday_name"], new_year["is_weekend"], new_year["quarter"]) == ("Sunday", 1, 1)
    assert (carnival["is_holiday"], carnival["holiday_name"], carnival["month_name"]) == (1, "Carnival", "February")
    assert (plain["is_holiday"], plain["holiday_name"]) == (0, None)
    assert by_day[date(2017, 12, 25)]["holiday_name"] == "Christmas"
    assert dim.where("is_holiday = 1").count() == 8 * 3 + 6


def test_unknown_day_is_not_a_holiday(spark):
    dim = d.dim_date(d.fixed_bounds(spark, date(2016, 1, 1), date(2016, 1, 2)))
    unknown = dim.where("date_sk = -1").first()
    assert (unknown["full_date"], unknown["is_holiday"], unknown["holiday_name"]) == (date(1900, 1, 1), 0, "Unknown")


def test_dated_holiday_wins_over_yearly(spark):
    rules = d.Holidays({(2, 13): "Yearly"}, {date(2018, 2, 13): "Dated"})
    dim = d.dim_date(d.fixed_bounds(spark, date(2017, 2, 13), date(2018, 2, 13)), rules)
    names = {r["full_date"]: r["holiday_name"] for r in dim.where("is_holiday = 1").collect()}
    assert names == {date(2017, 2, 13): "Yearly", date(2018, 2, 13): "Dated"}


def test_calendar_covers_whole_years_of_the_data(make):
    a = make("t timestamp_ntz", [(datetime(2017, 5, 5, 3),), (None,)])
    b = make("t timestamp_ntz", [(datetime(2019, 2, 1),)])
    bounds = d.calendar_bounds([(a, "t"), (b, "t")]).first()
    assert tuple(bounds) == (date(2017, 1, 1), date(2019, 12, 31))


def test_status_dimension(make, collect):
    orders = make("order_status string", [("shipped",), ("delivered",), ("shipped",), (None,)])
    assert collect(d.dim_order_status(orders)) == [(-1, "Unknown", 0), (1, "delivered", 1), (2, "shipped", 0)]


def test_product_dimension_translates(make, collect):
    products = make(
        "product_id string, product_category_name string, product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int",
        [("p2", "casa", 1, 2, 3, 4), ("p1", "pc_gamer", 1, 2, 3, 4), ("p3", None, None, None, None, None)],
    )
    translation = make("product_category_name string, product_category_name_english string", [("casa", "home")])
    got = collect(d.dim_product(products, translation).select("product_sk", "product_id", "category_pt", "category_en"))
    assert got == [
        (-1, "UNKNOWN", "unknown", "unknown"),
        (1, "p1", "pc_gamer", "unknown"),
        (2, "p2", "casa", "home"),
        (3, "p3", None, "unknown"),
    ]


def test_customer_dimension_takes_each_maximum(make, collect):
    customers = make(
        "customer_unique_id string, customer_city string, customer_state string",
        [("u1", "Aracaju", "SE"), ("u1", "Recife", "PE"), ("u2", None, None)],
    )
    got = collect(d.dim_customer(customers))
    # City and state are maximised apart: Recife comes with SE.
    assert got == [(-1, "UNKNOWN", "unknown", "XX", None), (1, "u1", "Recife", "SE", None), (2, "u2", None, None, None)]


def test_latest_customer_record_wins_whole(make, collect):
    customers = make(
        "customer_id string, customer_unique_id string, customer_city string, customer_state string",
        [("c1", "u1", "Aracaju", "SE"), ("c2", "u1", "Recife", "PE"), ("c3", "u1", None, "ZZ"), ("c4", "u2", "x", "B"), ("c5", "u2", "a", "C"), ("c6", "u3", "y", "D")],
    )
    orders = make(
        "customer_id string, order_purchase_timestamp timestamp_ntz",
        [("c1", datetime(2018, 3, 1)), ("c1", datetime(2017, 1, 1)), ("c2", datetime(2018, 2, 1)), ("c3", None), (None, datetime(2019, 1, 1)), ("c4", datetime(2018, 1, 1)), ("c5", datetime(2018, 1, 1))],
    )
    got = collect(d.dim_customer(customers, orders).select("customer_unique_id", "customer_city", "customer_state"))
    assert got == [("UNKNOWN", "unknown", "XX"), ("u1", "Aracaju", "SE"), ("u2", "a", "C"), ("u3", "y", "D")]


def test_geography_centroid_mode_and_ties(make, collect):
    schema = (
        "geolocation_zip_code_prefix string, geolocation_lat decimal(18,10), geolocation_lng decimal(18,10), "
        "geolocation_city string, geolocation_state string"
    )
    rows = [
        ("01", Decimal("1"), Decimal("-1"), "b", "SP"),
        ("01", Decimal("2"), Decimal("-2"), "a", "SP"),
        ("01", Decimal("4"), None, "a", "SP"),
        ("02", Decimal("5"), Decimal("5"), "z", "RJ"),
        ("02", Decimal("6"), Decimal("6"), "y", "RJ"),
        (None, Decimal("9"), Decimal("9"), "n", "XX"),
        ("03", None, None, None, None),
    ]
    got = {r[1]: r for r in collect(d.dim_geography(make(schema, rows)))}
    assert set(got) == {"01", "02", "03", "UNKNOWN"}
    assert got["01"] == (1, "01", "a", "SP", Decimal("2.3333333333"), Decimal("-1.5"))
    assert got["02"][2:4] == ("y", "RJ") and got["02"][4] == Decimal("5.5")
    assert got["03"][2:] == (None, None, None, None)
    assert got["UNKNOWN"] == (-1, "UNKNOWN", "unknown", "XX", None, None)
