from datetime import date

import pytest

from martloom.operators.lookup import DuplicateKeys
from martloom.operators.scd2 import keyless, scd2_merge
from martloom.plans.dimensions import dim_seller

START, AS_OF, OPEN = date(2016, 1, 1), date(2018, 6, 1), date(9999, 12, 31)
SCHEMA = "seller_id string, seller_city string, seller_state string"
ATTRIBUTES = ["seller_city", "seller_state"]


@pytest.fixture
def dim(make):
    sellers = [("same", "c", "SP"), ("moved", "c", "SP"), ("blank", None, "SP"), ("gone", "c", "SP")]
    return dim_seller(make(SCHEMA, sellers), START)


@pytest.fixture
def feed(make):
    return make(SCHEMA, [("same", "c", "SP"), ("moved", "c", "RJ"), ("blank", "", "SP"), ("new", "x", "MG")])


def merge(dim, feed, as_of=AS_OF):
    return scd2_merge(dim, feed, "seller_id", ATTRIBUTES, "seller_sk", as_of)


def test_first_load(dim, collect):
    got = collect(dim)
    assert len(got) == 5 and all(r[5] == OPEN and r[6] == 1 for r in got)
    assert (-1, "UNKNOWN", "unknown", "XX", date(1900, 1, 1), OPEN, 1) in got


def test_merge_expires_changed_and_adds_changed_and_new(dim, feed, collect):
    got = {(r["seller_id"], r["is_current"]): r for r in merge(dim, feed).collect()}
    assert len(got) == 7
    assert got["moved", 0]["expiry_date"] == AS_OF
    assert got["moved", 1]["effective_date"] == AS_OF and got["moved", 1]["seller_state"] == "RJ"
    assert got["new", 1]["effective_date"] == AS_OF
    # NULL and blank are the same value; sellers missing from the feed stay current.
    assert got["blank", 1]["seller_city"] is None and got["gone", 1]["expiry_date"] == OPEN
    # New versions get keys after the largest one.
    assert sorted(r["seller_sk"] for r in got.values()) == [-1, 1, 2, 3, 4, 5, 6]


def test_merging_the_same_feed_again_changes_nothing(dim, feed, collect):
    once = merge(dim, feed)
    assert collect(merge(once, feed, date(2019, 1, 1))) == collect(once)


def test_rows_without_a_key_are_left_out(dim, feed, make, collect):
    more = feed.unionByName(make(SCHEMA, [(None, "c", "SP"), (None, "d", "SP")]))
    once = merge(dim, more)
    assert collect(once) == collect(merge(dim, feed)) == collect(merge(once, more))
    assert keyless(more, "seller_id").count() == 2
    assert dim_seller(more, START).where("seller_id is null").count() == 0


def test_history_is_half_open(dim, feed):
    versions = merge(dim, feed).where("seller_id = 'moved'").orderBy("effective_date").collect()
    assert versions[0]["expiry_date"] == versions[1]["effective_date"]


def test_repeated_feed_keys_are_refused(dim, make):
    with pytest.raises(DuplicateKeys):
        merge(dim, make(SCHEMA, [("same", "c", "SP"), ("same", "d", "SP")]))


def test_merge_into_empty_dimension(dim, feed):
    got = merge(dim.where("seller_sk < -1"), feed)
    assert sorted(r["seller_sk"] for r in got.collect()) == [1, 2, 3, 4]
