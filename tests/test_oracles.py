"""Fast operators against DuckDB on the smallest tables; checks.compare runs all of them."""

from __future__ import annotations

import duckdb
import pytest

import checks  # noqa: F401
from checks.base import CHECKS
from checks.compare import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
KEYS = ["F-01", "F-02", "F-04_continuous", "F-11", "F-14", "F-15_tick_rule", "F-16", "F-28", "F-40", "F-42", "F-46", "F-53", "F-54", "F-62",
        "T-04", "T-12", "T-17", "G-05", "G-07", "W-09", "A-10", "S-09", "S-12", "J-08", "O-03", "O-07", "O-14", "O-16", "F-70"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_same_as_sql(spark, duck, key):
    ok, text = compare(spark, duck, key, FOLDER)
    assert ok, text


def test_every_survey_id_is_registered():
    for prefix, last in (("T", 24), ("G", 9), ("J", 20), ("A", 15), ("W", 15), ("K", 5), ("U", 4), ("X", 15), ("S", 27), ("O", 22), ("R", 4), ("P", 3)):
        for n in range(1, last + 1):
            assert f"{prefix}-{n:02d}" in CHECKS
    families = [*range(1, 33), *range(40, 57), *range(60, 64), 70]
    assert all(f"F-{n:02d}" in CHECKS for n in families)
