"""A small marketplace: the nine feeds with every kind of gap."""

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import types as T

from martloom.schemas import STAGING, TIMESTAMP_COLUMNS

DAY0 = datetime(2018, 1, 10, 12)


def day(n, hour=12):
    return DAY0.replace(hour=hour) + timedelta(days=n)


def money(text):
    return None if text is None else Decimal(text)


CUSTOMERS = [
    ("c1", "u1", "01000", "sao paulo", "SP"),
    ("c2", "u1", "01000", "sao paulo", "SP"),
    ("c3", "u2", "99999", "nowhere", "XX"),
    ("c4", "u3", "20000", "rio", "RJ"),
]
GEOLOCATION = [
    ("01000", Decimal("-23.5"), Decimal("-46.6"), "sao paulo", "SP"),
    ("01000", Decimal("-23.7"), Decimal("-46.8"), "sao paulo", "SP"),
    ("20000", Decimal("-22.9"), Decimal("-43.2"), "rio", "RJ"),
]
# id, customer, status, purchase, approved, carrier, delivered, estimated
ORDERS = [
    ("o1", "c1", "delivered", day(0), day(0), day(1), day(10, 18), day(10, 0)),  # late on the estimated day
    ("o2", "c2", "delivered", day(5), day(5), day(6), day(9), day(20)),
    ("o3", "c3", "shipped", day(20), day(20), day(21), None, day(40)),
    ("o4", "cX", "delivered", day(25), day(25), day(26), day(50), day(30)),
    ("o5", "c4", None, None, None, None, None, day(30)),
    ("o6", "c4", "canceled", day(40), None, None, None, day(60)),
]
ITEMS = [
    ("o1", 1, "p1", "s1", day(3), money("100.00"), money("20.00")),
    ("o1", 2, "p2", "s1", day(3), money("0.00"), money("5.00")),
    ("o2", 1, "p1", "s2", day(7), money("50.00"), money("60.00")),
    ("o3", 1, "pX", "s1", day(22), money("10.00"), None),
    ("o4", 1, "p3", "sX", day(27), money("30.00"), money("3.00")),
    ("o5", 1, "p1", "s1", day(27), money("40.00"), money("4.00")),
    ("o6", 1, "p2", "s2", day(42), money("70.00"), money("7.00")),
    ("oX", 1, "p2", None, day(42), None, money("1.00")),
]
PAYMENTS = [
    ("o1", 1, "credit_card", 3, money("125.00")),
    ("o2", 1, "voucher", 1, money("10.00")),
    ("o2", 2, "credit_card", 2, money("100.00")),
    ("oX", 1, "boleto", 1, money("9.99")),
]
REVIEWS = [
    ("r1", "o1", 2, "title", "slow", day(12), day(13)),
    ("r2", "o1", 4, None, None, day(11), day(13)),
    ("r3", "o2", 5, None, None, day(10), day(13)),
    ("r4", "o2", 1, None, None, day(10), day(13)),
    ("r5", "o4", None, None, None, day(51), day(52)),
]
PRODUCTS = [
    ("p1", "casa", 1, 1, 1, 100, 10, 10, 10),
    ("p2", "pc_gamer", 1, 1, 1, 200, 20, 20, 20),
    ("p3", None, 1, 1, 1, None, None, None, None),
]
SELLERS = [("s1", "01000", "sao paulo", "SP"), ("s2", "20000", None, "RJ")]
TRANSLATION = [("casa", "home")]

ROWS = {
    "customers": CUSTOMERS,
    "geolocation": GEOLOCATION,
    "orders": ORDERS,
    "order_items": ITEMS,
    "order_payments": PAYMENTS,
    "order_reviews": REVIEWS,
    "products": PRODUCTS,
    "sellers": SELLERS,
    "category_translation": TRANSLATION,
}


def typed_schema(feed):
    moments = TIMESTAMP_COLUMNS.get(feed, ())
    return T.StructType(
        [T.StructField(f.name, T.TimestampNTZType() if f.name in moments else f.dataType) for f in STAGING[feed].fields]
    )


def feeds(spark, empty=False):
    return {feed: spark.createDataFrame([] if empty else rows, typed_schema(feed)) for feed, rows in ROWS.items()}
