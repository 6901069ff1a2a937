"""Sinks of trades keep the order's own day as their partition."""

from __future__ import annotations

from datetime import date, datetime

import duckdb
import pytest

import checks  # noqa: F401
from checks.base import CHECKS
from checks.compare import compare

DAYS = [datetime(1995, 3, 1), datetime(1995, 3, 2), datetime(1995, 3, 2), datetime(1996, 7, 9), datetime(1999, 12, 31), None]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("orders"))
    rows = [(k, k % 3, "OFP"[k % 3], 10.0 * k, DAYS[k % len(DAYS)], f"{k % 2}-P") for k in range(1, 31)]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{at}/orders.parquet")
    return at


@pytest.mark.parametrize("key", ["S-24", "S-26", "S-27"])
def test_partition_is_the_day(spark, folder, key):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{folder}/orders.parquet/*.parquet'")
    found = CHECKS[key].run(spark, folder)
    days = {r[0] for r in found.select("dt").distinct().collect()}
    assert days == {d and date(d.year, d.month, d.day) for d in DAYS}
    ok, text = compare(spark, con, key, folder)
    assert ok, text
