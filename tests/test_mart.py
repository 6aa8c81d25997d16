from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.operators.lookup import DuplicateKeys
from martloom.plans import quality_suite, reports, rfm
from martloom.plans.mart import Mart
from tests import samples

START = date(2016, 1, 1)


@pytest.fixture(scope="module")
def mart(spark):
    return Mart(spark, samples.feeds(spark), START)


@pytest.fixture(scope="module")
def empty(spark):
    return Mart(spark, samples.feeds(spark, empty=True), START)


def key_of(dim, column, value, key):
    return dim.where(F.col(column) == value).first()[key]


def test_item_fact_keeps_every_item_and_routes_misses(mart):
    got = {(r["order_id"], r["order_item_id"]): r for r in mart.fact_order_items_plan().collect()}
    assert len(got) == len(samples.ITEMS)
    first = got["o1", 1]
    assert first["product_sk"] == key_of(mart.dim_product, "product_id", "p1", "product_sk")
    assert first["customer_sk"] == key_of(mart.dim_customer, "customer_unique_id", "u1", "customer_sk")
    assert first["geography_sk"] == key_of(mart.dim_geography, "zip_code_prefix", "01000", "geography_sk")
    assert first["order_status_sk"] == key_of(mart.dim_order_status, "order_status", "delivered", "order_status_sk")
    assert (first["date_sk"], first["freight_pct"], first["net_contribution"]) == (20180110, Decimal("0.2000"), Decimal("80.00"))
    assert got["o1", 2]["freight_pct"] is None and got["o1", 2]["net_contribution"] == Decimal("-5.00")
    assert got["o3", 1]["product_sk"] == -1 and got["o3", 1]["geography_sk"] == -1 and got["o3", 1]["net_contribution"] is None
    assert got["o4", 1]["seller_sk"] == -1 and got["o4", 1]["customer_sk"] == -1
    assert got["o5", 1]["date_sk"] == -1 and got["o5", 1]["order_status_sk"] == -1
    orphan = got["oX", 1]
    assert [orphan[k] for k in ("date_sk", "customer_sk", "geography_sk", "order_status_sk", "seller_sk")] == [-1] * 5
    assert orphan["freight_pct"] is None


def test_payment_fact(mart, collect):
    got = {(r["order_id"], r["payment_sequential"]): r for r in mart.fact_payments_plan().collect()}
    assert len(got) == 4
    assert got["oX", 1]["date_sk"] == -1 and got["o2", 2]["date_sk"] == 20180115


def test_delivery_fact(mart):
    got = {r["order_id"]: r for r in mart.fact_delivery_reviews_plan().collect()}
    assert len(got) == len(samples.ORDERS)
    late_same_day = got["o1"]
    # Later on the estimated day: late, with a delay of no days. The newer review counts.
    assert (late_same_day["is_late"], late_same_day["delivery_delay_days"], late_same_day["review_score"]) == (1, 0, 2)
    assert (late_same_day["estimated_days"], late_same_day["actual_days"]) == (10, 10)
    # Two reviews at the same time: the larger id.
    assert (got["o2"]["review_score"], got["o2"]["is_late"], got["o2"]["delivery_delay_days"]) == (1, 0, -11)
    assert (got["o3"]["is_late"], got["o3"]["is_delivered"], got["o3"]["actual_days"]) == (0, 0, None)
    assert got["o4"]["delivery_delay_days"] == 20 and got["o4"]["review_score"] is None
    assert got["o5"]["purchase_date_sk"] == -1


def test_duplicate_lookup_key_is_refused(spark):
    feeds = samples.feeds(spark)
    feeds["products"] = feeds["products"].unionByName(feeds["products"].limit(1))
    with pytest.raises(DuplicateKeys):
        Mart(spark, feeds, START).check_feeds()


def test_rfm_base(mart):
    got = {r["customer_unique_id"]: r for r in mart.rfm_base_plan().collect()}
    assert set(got) == {"u1", "u2", "u3"}
    # Reference day is the newest purchase (day 40).
    assert (got["u1"]["recency_days"], got["u1"]["frequency"], got["u1"]["monetary"]) == (35, 2, Decimal("235.00"))
    # A missing freight leaves nothing to add up; an undated order counts as an order.
    assert (got["u2"]["recency_days"], got["u2"]["monetary"]) == (20, None)
    assert (got["u3"]["recency_days"], got["u3"]["frequency"], got["u3"]["monetary"]) == (0, 2, Decimal("121.00"))


def test_repeated_orders_count_once(spark, mart):
    feeds = samples.feeds(spark)
    twice = feeds["orders"].unionByName(feeds["orders"])
    base = rfm.rfm_base(mart.dim_customer, feeds["customers"], twice, feeds["order_items"])
    assert {r["customer_unique_id"]: r["frequency"] for r in base.collect()} == {"u1": 2, "u2": 1, "u3": 2}


def test_customer_without_purchase_day_gets_the_worst_recency(make):
    base = make(
        "customer_sk bigint, customer_unique_id string, recency_days int, frequency bigint, monetary decimal(28,2)",
        [(i, f"u{i}", None if i == 1 else i, 1, Decimal(i)) for i in range(1, 6)],
    )
    scores = {r["customer_sk"]: r["r_score"] for r in rfm.rfm_scores(base).collect()}
    assert scores == {2: 5, 3: 4, 4: 3, 5: 2, 1: 1}


def test_segments_written_back(mart, collect):
    segmented = mart.dim_customer_segmented
    names = {r["customer_unique_id"]: r["rfm_segment"] for r in segmented.collect()}
    assert names["UNKNOWN"] == "Unknown" and set(names) == {"UNKNOWN", "u1", "u2", "u3"}
    assert None not in names.values()


def test_reports(mart):
    routing = reports.unknown_routing(mart.fact_order_items).first().asDict()
    assert routing == {"unk_product": 1, "unk_seller": 2, "unk_customer": 2, "unk_geography": 3, "unk_date": 2, "unk_status": 2}
    total = reports.freight_overall(mart.fact_order_items).first()
    assert (total["revenue"], total["freight"]) == (Decimal("300.00"), Decimal("100.00"))
    by_category = {r["category_en"]: r for r in reports.freight_by_category(mart.fact_order_items, mart.dim_product).collect()}
    assert by_category["home"]["items"] == 3 and by_category["unknown"]["items"] == 5
    heavy = reports.freight_heavy_items(mart.fact_order_items).first()
    assert (heavy["items"], heavy["heavy_items"]) == (6, 1)
    assert reports.freight_over_price_products(mart.fact_order_items).first()[0] == 2
    orders = reports.items_per_order(mart.fact_order_items, mart.feeds["orders"]).first()
    assert (orders["orders_with_items"], orders["items"], orders["multi_item_orders"], orders["all_orders"]) == (7, 8, 1, 6)
    repeat = reports.repeat_customers(mart.feeds["customers"], mart.fact_delivery_reviews).first()
    assert tuple(repeat) == (3, 1, 3, 2)
    assert tuple(reports.delivery_rate(mart.fact_delivery_reviews).first())[:2] == (6, 3)
    late = {r["is_late"]: r for r in reports.score_by_late(mart.fact_delivery_reviews).collect()}
    assert late[1]["avg_review_score"] == Decimal("2.00") and late[0]["avg_delay_days"] == Decimal("-11.0")
    buckets = [r["delivery_bucket"] for r in reports.score_by_delay_bucket(mart.fact_delivery_reviews).collect()]
    assert buckets == ["5+ days early", "On time"]
    trend = reports.monthly_trend(mart.fact_order_items, mart.dim_date, date(2018, 1, 1), date(2018, 1, 31)).collect()
    assert [(r["year"], r["month"], r["items"]) for r in trend] == [(2018, 1, 4)]
    by_type = {r["payment_type"]: r["payments"] for r in reports.payments_by_type(mart.fact_payments).collect()}
    assert by_type == {"credit_card": 2, "voucher": 1, "boleto": 1}


def test_quality_suite_on_sound_data(mart):
    got = {r["check_id"]: r for r in quality_suite.quality_checks(mart).collect()}
    assert sorted(got) == list(range(1, 12))
    assert all(got[i]["status"] == "PASS" for i in range(1, 11))
    assert (got[2]["expected"], got[2]["actual"]) == ("300.00", "300.00")
    assert (got[11]["expected"], got[11]["actual"], got[11]["status"]) == ("<5%", "37.50%", "WARN")


def test_quality_suite_finds_each_fault(spark, make):
    broken = Mart(spark, samples.feeds(spark), START)
    fact = broken.fact_order_items
    broken.fact_order_items = (
        fact.unionByName(fact.limit(1))
        .withColumn("price", F.when(F.col("order_id") == "o6", -1).otherwise(F.col("price")).cast("decimal(18,2)"))
        .withColumn("product_sk", F.when(F.col("order_id") == "o2", 999).otherwise(F.col("product_sk")))
        .withColumn("customer_sk", F.when(F.col("order_id") == "o2", 999).otherwise(F.col("customer_sk")))
        .withColumn("date_sk", F.when(F.col("order_id") == "o2", 19000101).otherwise(F.col("date_sk")))
    )
    broken.fact_payments = broken.fact_payments.limit(3)
    broken.dim_customer = broken.dim_customer.unionByName(broken.dim_customer.where("customer_sk = 1"))
    broken.dim_seller = broken.dim_seller.unionByName(broken.dim_seller.where("seller_sk = 1"))
    reviews = broken.feeds["order_reviews"]
    broken.feeds["order_reviews"] = reviews.withColumn("review_score", F.when(F.col("review_id") == "r1", 6).otherwise(F.col("review_score")))
    got = {r["check_id"]: r["status"] for r in quality_suite.quality_checks(broken).collect()}
    assert got == {**{i: "FAIL" for i in range(1, 11)}, 11: "WARN"}


def test_quality_suite_on_empty_tables(empty):
    got = {r["check_id"]: r for r in quality_suite.quality_checks(empty).collect()}
    # Nothing to reconcile: equal counts pass, an absent revenue and an absent rate do not.
    assert {i for i, r in got.items() if r["status"] != "PASS"} == {2, 11}
    assert got[9]["actual"] == "0" and got[10]["actual"] == "0"


def test_empty_feeds_build_empty_facts(empty):
    assert empty.fact_order_items_plan().count() == 0
    assert empty.fact_delivery_reviews_plan().count() == 0
    assert empty.rfm_segments.count() == 0
    assert reports.unknown_routing(empty.fact_order_items).first()["unk_product"] is None


def test_staging_checks_warn(mart):
    got = {r["check_name"]: (r["check_result"], r["check_status"]) for r in quality_suite.staging_checks(mart.feeds, 6).collect()}
    assert got == {"orders_row_count": ("6", "PASS"), "orphaned_order_items": ("1", "WARN")}


def test_validation(mart):
    got = {(r["section"], r["item"]): r["value"] for r in quality_suite.validate(mart).collect()}
    assert all(v == 1 for (s, _), v in got.items() if s == "unknown_member")
    assert all(v == 0 for (s, _), v in got.items() if s == "dangling_keys")
    assert got["rows", "fact_order_items"] == 8 and got["segments", "null_segments"] == 0
    assert got["check_status", "PASS"] == 10 and got["check_status", "WARN"] == 1
