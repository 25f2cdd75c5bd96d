"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as registered
from sonotheca.plans.registry import ORACLE, QUERIES
from tools.compare import NAMES, rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in NAMES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    mine = rows(df.columns, df.collect())
    relation = con.sql(ORACLE[name])
    assert mine == rows(relation.columns, relation.fetchall())


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == ["qid", "rank", "id", "distance", "document"] and df.count() == 120
