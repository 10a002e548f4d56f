"""Every registered query against its oracle SQL, on the smallest test tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from strataflow.queries.landing import TABLES, Landing, fold_orders
from strataflow.queries.registry import ORACLES, QUERIES
from strataflow.session import scratch_root

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, duck, key):
    df = contract.queries()[key](spark, SF_DIR)
    cursor = duck.execute(contract.oracle_sql()[key])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    want = Counter(tuple(row[names.index(c)] for c in df.columns) for row in cursor.fetchall())
    assert Counter(tuple(row) for row in df.collect()) == want


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_scratch_is_the_shared_folder(spark):
    assert scratch_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_documents_hold_each_line_once(spark):
    documents = fold_orders(Landing(spark, SF_DIR)).selectExpr("order_id", "supplier_id", "size(items) AS n").filter("n > 0")
    assert documents.agg({"n": "sum"}).first()[0] == Landing(spark, SF_DIR).table("lineitem").count()
    assert documents.count() == documents.select("order_id", "supplier_id").distinct().count()
