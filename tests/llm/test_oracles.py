"""Queries with oracle SQL against DuckDB, on the smallest test tables."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from strataflow.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query(spark, key):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    df = QUERIES[key](spark, SF_DIR)
    cursor = con.execute(ORACLES[key])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    want = Counter(tuple(row[names.index(c)] for c in df.columns) for row in cursor.fetchall())
    assert Counter(tuple(row) for row in df.collect()) == want


def test_one_query_per_operator():
    assert [k.split("_")[0] for k in QUERIES] == [f"op{n}" for n in range(1, 14)]
