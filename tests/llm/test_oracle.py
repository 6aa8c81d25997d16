"""Queries that SQL can express against DuckDB, on the given tables and on awkward rows."""

import os

import duckdb
import pytest

from martloom.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

KEY = "AKIA" + "Q1" * 8
TEXTS = [
    None, "", "   ", "one",
    f"user=ann\n{KEY} pwd: x1\n \t\r\nlogin = bob\nhttps://h.example/a?b=1", "api_key=" + "z" * 300 + "\nuser=bob", "TOKEN: abc tokEN:'abcdef12' 10.0.0.1:80",
    "é" * 40 + f" a.b@c.de secret=ſix {KEY}\n\npasswd=123456 " + "0a" * 13, "password=abcdef" * 3,
    "Licensed under the Apache License, Version 2.0 (the \"License\")", "MIT License. mit license; GNU General Public License v3.0 or any later version",
    "CC BY 4.0 cc-by-sa 3.0 SPDX-License-Identifier: MIT", "Kernel cc by cc by " * 50,
]


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [sorted(columns)] + sorted((tuple(v[i] for i in order) for v in values), key=repr)


def sides(spark, name, folder):
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{folder}/documents.parquet{'/*.parquet' if os.path.isdir(f'{folder}/documents.parquet') else ''}'")
    cursor = duck.execute(queries.ORACLE_SQL[name])
    df = queries.QUERIES[name](spark, folder)
    return rows(df.columns, df.collect()), rows([c[0] for c in cursor.description], cursor.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    got, expected = sides(spark, name, SF_DIR)
    assert got == expected


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_awkward_rows_match_sql(spark, tmp_path, name):
    sources = ["a", "b", None, "é", "c"]
    docs = [(i, sources[i % 5], text) for i, text in enumerate(TEXTS)] + [(3, "a", "word " * n) for n in (1, 70, 70, 900)] + [(None, "b", "x\ny")]
    full = [(*d, None if i % 3 else "en", None if i % 4 else i) for i, d in enumerate(docs)]
    spark.createDataFrame(full, "doc_id bigint, source string, text string, lang string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    got, expected = sides(spark, name, str(tmp_path))
    assert got == expected
