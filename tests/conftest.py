import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from martloom.session import configure

    return configure(session)


@pytest.fixture
def make(spark):
    """A small frame from a DDL schema and rows."""
    return lambda schema, rows: spark.createDataFrame(rows, schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def collect():
    return rows


@pytest.fixture
def operators():
    """Names of the operators in the executed plan of a frame."""

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return plan
