"""Every query against DuckDB on the given tables."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from catalogue import queries
from catalogue.queries import CATALOGUE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    assert not isinstance(value, decimal.Decimal), "results are presented as doubles"
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    cursor = duck.execute(contract.oracle_sql()[name])
    expected = table([c[0] for c in cursor.description], cursor.fetchall())
    assert table(df.columns, df.collect()) == expected


def test_contract(spark):
    assert set(CATALOGUE) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["category_en", "items", "revenue", "freight", "freight_share"]


def test_csv_feeds_are_written_compressed(spark):
    path = queries._write_csv(spark.range(3), "numbers")
    files = spark.read.text(path).inputFiles()
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert sorted(r[0] for r in spark.read.option("header", True).csv(path).collect()) == ["0", "1", "2"]


def test_item_files_are_not_shuffled_where_the_table_has_parts_enough(spark, tmp_path, monkeypatch):
    """Each line once and the returned ones twice, in the files the scan makes."""
    lines = spark.range(0, 40, 1, 4).selectExpr("id", "if(id % 4 = 0, 'R', 'N') l_returnflag")
    few = []
    monkeypatch.setattr(queries, "driver_reader", lambda *_: lambda table: few[-1])
    monkeypatch.setattr(type(lines), "repartition", lambda *a: few.append("shuffled") or split(*a)) if (split := type(lines).repartition) else None
    for frame, shuffled in ((lines, False), (lines.coalesce(1), True)):
        few.append(frame)
        folder = str(tmp_path / str(shuffled))
        queries._item_files(spark, "", folder)
        assert ("shuffled" in few) == shuffled
        assert sorted(r[0] for r in spark.read.parquet(folder).select("id").collect()) == sorted([*range(40), *range(0, 40, 4)])
