"""Corpus queries against their SQL on the smallest tables."""

import duckdb
import pytest

from barloom.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", ["op7_phrases", "op10_passages"])
def test_same_as_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    got = QUERIES[key](spark, FOLDER)
    want = con.execute(SQL[key])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)
