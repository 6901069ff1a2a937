"""Blocks equal plain windows, results do not depend on partitioning, and the store round-trips."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions.rolling import Rows
from barloom.operators import structure as st
from barloom.operators.bars import resample, to_bars
from barloom.operators.blocks import exponential_means, in_blocks, number_rows
from barloom.operators.conform import RunContext, normalise_evaluation, merge_family_columns
from barloom.operators.decisions import finish_paths
from barloom.operators.quality import content_hash, key_invariants
from barloom.operators.trend import memory_rows
from barloom.sources import importers as imp
from barloom.sources import store

SERIES = ["instrument", "anchor_tf"]


@pytest.fixture(scope="module")
def bars(spark):
    """Two series over five days; one holds most of the rows."""
    start, rows = datetime(2025, 1, 2), []
    for i in range(1500):
        px = 100 + (i * 37 % 101) / 10 - (i * 13 % 47) / 5
        rows.append(("HOT", "M5", start + timedelta(minutes=5 * i), px, px + 1 + i % 3, px - 1 - i % 2, px + (i % 5 - 2) / 2, float(1 + i % 7)))
        if i % 10 == 0:
            rows.append(("COLD", "M5", start + timedelta(minutes=5 * i), px, px + 2, px - 2, px + 1, 1.0))
    df = spark.createDataFrame(rows, "instrument string, anchor_tf string, ts timestamp_ntz, open double, high double, low double, close double, volume double")
    return df.withColumn("dt", F.to_date("ts")).cache()


def test_row_numbers_over_slices(bars):
    out = number_rows(bars, SERIES, ["ts"], F.to_date("ts")).withColumn("plain", Rows(SERIES).row())
    assert out.where("_rn <> plain").count() == 0


@pytest.mark.parametrize("size", [32, 100, 4096])
def test_halo_blocks_equal_one_window(bars, size):
    def add(df, by):
        r = Rows(by)
        return df.withColumns({"m": r.mean(F.col("close"), 20, 5), "a": F.max("high").over(r.next(7))})

    plain = add(bars, SERIES).select("instrument", "ts", "m", "a")
    split = in_blocks(bars, SERIES, ["ts"], add, back=20, ahead=7, block_rows=size).select("instrument", "ts", "m", "a")
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def test_affine_scan_equals_recursion(bars):
    alpha = 2 / 21
    scan = in_blocks(
        bars, SERIES, ["ts"], lambda df, by: exponential_means(df, {"y": (F.col("close"), alpha)}, by), back=memory_rows(alpha), block_rows=600
    )
    got = scan.where("instrument = 'HOT'").orderBy("ts").toPandas()
    want = got["close"].ewm(alpha=alpha, adjust=False).mean()
    assert (got["y"] - want).abs().max() < 1e-9


def test_structure_does_not_depend_on_partitions(spark, bars):
    day = bars.where("dt = date'2025-01-03'").drop("dt").withColumn("dt", F.to_date("ts"))
    one = content_hash(st.structure(day, {"tick_size": 0.01})).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    two = content_hash(st.structure(day.repartition(5, "close"), {"tick_size": 0.01})).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert one == two and one[0]["rows"] > 0


def test_structure_invariants(bars):
    out = st.structure(bars, {"tick_size": 0.01}).cache()
    assert out.count() == bars.count()
    assert key_invariants(out, ["instrument", "anchor_tf", "ts"]).collect()[0]["duplicate_rows"] == 0
    assert out.where("ict_struct_dealing_range_low > ict_struct_dealing_range_high or pd_location_frac < 0 or pd_location_frac > 1").count() == 0
    assert out.where("fvg_direction <> 'none' and fvg_lower >= fvg_upper").count() == 0


CTX = RunContext("research", "backtest", "s", "r1")


def test_store_replaces_only_its_partitions(spark, bars, tmp_path):
    rows = bars.select("instrument", "anchor_tf", "ts", "dt", F.col("close").alias("x"))
    store.write_table(rows, "features", str(tmp_path), CTX)
    day = date(2025, 1, 3)
    store.write_table(rows.where(F.col("dt") == F.lit(day)).withColumn("x", F.lit(0.0)), "features", str(tmp_path), CTX)
    back = store.read_table(spark, str(tmp_path), "features", run_id="r1")
    assert back.count() == rows.count()
    assert back.where(F.col("dt") == F.lit(day)).agg(F.max("x")).collect()[0][0] == 0.0
    assert back.where(F.col("dt") != F.lit(day)).where("x = 0").count() == 0
    one = store.read_table(spark, str(tmp_path), "features", instrument="COLD", dt=day)
    assert "PartitionFilters: [" in one._jdf.queryExecution().toString()


def test_upsert_touches_incoming_days(spark, bars, tmp_path):
    candles = bars.drop("dt").withColumnRenamed("anchor_tf", "tf").withColumns({"mode": F.lit("backtest"), "dt": F.to_date("ts")})
    store.upsert_table(candles, "candles", str(tmp_path))
    fresh = candles.where("dt = date'2025-01-03' and instrument = 'COLD'").withColumn("close", F.lit(-1.0))
    store.upsert_table(fresh, "candles", str(tmp_path))
    back = store.read_table(spark, str(tmp_path), "candles")
    assert back.count() == candles.count()
    assert back.where("close = -1").count() == fresh.count()


def test_missing_paths(spark, tmp_path):
    assert store.scan_ticks(spark, str(tmp_path / "none"), "backtest", ["A"], ["2025-01-02"]).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.scan(spark, str(tmp_path / "none"), {"a": "int"})


def test_day_guard(spark):
    df = spark.createDataFrame([(date(2025, 1, 2), datetime(2025, 1, 3, 1))], "dt date, ts timestamp_ntz")
    with pytest.raises(ValueError, match="outside"):
        imp.guard_days(df, "error")
    assert imp.guard_days(df, "ignore").count() == 1


def test_calendar_csv(spark, tmp_path):
    from barloom.operators.calendar import import_calendar

    path = tmp_path / "c.csv"
    path.write_text("Unnamed: 0,Start,Name,Impact,Currency\n0,01/15/2025 09:00,CPI,high,usd\n1,nonsense,X,low,eur\n")
    out = import_calendar(imp.read_calendar_csv(spark, str(path)), "vendor", zone="America/New_York", by_impact={"HIGH": (30, 60)}).collect()
    assert len(out) == 1
    assert out[0]["event_ts"] == datetime(2025, 1, 15, 14) and out[0]["blackout_end_ts"] == datetime(2025, 1, 15, 15)


def test_resample_counts(spark, bars):
    hourly = resample(bars.where("instrument = 'HOT'").withColumnRenamed("anchor_tf", "tf"), "H1")
    assert hourly.count() == 125
    assert to_bars(hourly).where("dt is null").count() == 0


def test_sentinels(spark):
    df = spark.createDataFrame([(None, datetime(2025, 1, 2)), ("c1", datetime(2025, 1, 2))], "candidate_id string, entry_ts timestamp_ntz")
    out = finish_paths(df.withColumns({"anchor_tf": F.lit("M5"), "tf_entry": F.lit("M1")})).orderBy("candidate_id").collect()
    assert [r["candidate_id"] for r in out] == ["c1", "∅"] and {r["experiment_id"] for r in out} == {"∅"}
    with pytest.raises(ValueError):
        normalise_evaluation(spark.createDataFrame([("p",)], "paradigm_id string"))


def test_family_column_conflicts():
    assert merge_family_columns({"a": {"x": "double"}, "b": {"x": "double"}}) == {"x": "double"}
    with pytest.raises(ValueError):
        merge_family_columns({"a": {"x": "double"}, "b": {"x": "string"}})
    with pytest.raises(ValueError):
        merge_family_columns({"a": {"dt": "date"}})


def test_equal_levels_against_brute_force(spark, bars):
    cfg = {**st.STRUCTURE, "tick_size": 0.01, "eq_level_ticks_max": 60.0, "eq_lookback_bars": 30}
    day = bars.where("instrument = 'HOT' and dt = date'2025-01-03'")
    got = st.equal_levels(st.with_basics(day, cfg), cfg).orderBy("ts").toPandas()
    high = got["high"].tolist()
    for i in range(len(high)):
        found = []
        for j in range(max(0, i - 29) + 1, i):
            if high[j] >= high[j - 1] and high[j] >= high[j + 1]:
                if found and abs(high[j] - sum(found[-1][0]) / len(found[-1][0])) <= 0.6:
                    if j - found[-1][1][-1] >= 3:
                        found[-1][0].append(high[j])
                        found[-1][1].append(j)
                else:
                    found.append(([high[j]], [j]))
        good = [f for f in found if len(f[0]) >= 2]
        best = max(good, key=lambda f: (len(f[0]), f[1][-1])) if good else None
        want = sum(best[0]) / len(best[0]) if best else None
        have = got["eqh_level_px"].iloc[i]
        assert (want is None and pd.isna(have)) or abs(want - have) < 1e-9
