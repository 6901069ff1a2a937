"""Event-time phases: order within the watermark doesn't matter, later bars don't count, idle series are forgotten."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barloom.operators.range_phase import range_phases
from barloom.session import shared_folder
from barloom.streaming import live

START = dt.datetime(2025, 1, 2)
SHAPE = "instrument string, anchor_tf string, ts timestamp_ntz, high double, low double, close double"
CFG = {"lookback_bars": 5, "atr_window": 3, "tests_min": 1, "p_inside_min": 0.3, "width_min_atr": 0.1}


@pytest.fixture(autouse=True)
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def bars(name, minutes, seed=1):
    rng, out, price = random.Random(seed), [], 100.0
    for m in minutes:
        price += rng.gauss(0, 0.5)
        out.append((name, "M1", START + dt.timedelta(minutes=m), price + rng.random(), price - rng.random(), price))
    return out


def streamed(spark, batches, **settings):
    """Phases of a stream that gets one file after the other."""
    folder = shared_folder(spark, "live-bars")
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SHAPE).coalesce(1).write.mode("append").parquet(f"{folder}/{k}")
    query = spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)
    out = live.drain(live.live_phases(query, CFG, delay="10 minutes", **settings), spark, "live-phases")
    return {(r.instrument, r.us): (r.fold_phase, r.fold_age, r.fold_reason, r.fold_number) for r in out.collect()}


def batch(spark, rows):
    out = range_phases(spark.createDataFrame(rows, SHAPE).withColumn("dt", F.to_date("ts")), CFG)
    shown = out.select("instrument", F.unix_micros(F.col("anchor_ts").cast("timestamp")).alias("us"), "dr_phase", "dr_age_bars", "dr_reason_code")
    return {(r.instrument, r.us): (r.dr_phase, r.dr_age_bars, r.dr_reason_code) for r in shown.collect()}


def test_order_within_the_watermark(spark):
    rows = bars("A", range(60))
    early, late, end = rows[:30], rows[30:40], bars("A", [60, 90], seed=2)
    too_late = [(*rows[3][:2], START + dt.timedelta(minutes=3, seconds=30), 900.0, 1.0, 5.0)]
    moved = [rows[25], rows[28]]  # arrive a batch later, behind bars that came before them
    first = [r for r in early if r not in moved]
    random.Random(3).shuffle(first)
    got = streamed(spark, [first, [*late, *moved], [*rows[40:], *too_late], end])
    want = batch(spark, [*rows, *end])
    closed = {k: v for k, v in want.items() if k[1] <= (START + dt.timedelta(minutes=80) - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)}
    assert {k: v[:3] for k, v in got.items()} == closed
    assert any(v[0] for v in got.values())


def test_idle_series_are_forgotten(spark):
    rows, again = bars("A", range(40)), bars("A", range(600, 640), seed=4)
    clock = [bars("B", [m], seed=5) for m in (100, 200, 560)]
    for idle, fresh in ((60 * 60_000, True), (7 * 86_400_000, False)):
        got = streamed(spark, [rows, *clock, again, bars("B", [700], seed=6)], idle_ms=idle)
        minute = lambda k: (k[1] // 60_000_000) % 1440
        later = {minute(k): v for k, v in got.items() if k[0] == "A" and minute(k) >= 600}
        assert len(later) == 40
        known = later[600][2] is not None or later[601][0] is not None
        assert known != fresh  # a forgotten series needs a full lookback before it knows a range again
