"""Every registered query against its SQL twin, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__
from checks.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return connection


def text(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return repr(value + 0.0) if isinstance(value, float) else str(value)


def multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry_offers_every_query_and_twin():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, duck, name):
    df = QUERIES[name](spark, SF)
    twin = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(twin.columns)
    assert multiset(df.columns, df.collect()) == multiset(twin.columns, twin.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
