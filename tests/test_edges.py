"""Inputs that the supplied tables don't hold: nulls in recursive means, bars off the grid, long integers."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators.blocks import exponential_means
from barloom.operators.calendar import blackout_flags
from barloom.operators.conform import union_widened, wider_type
from barloom.sources.tables import TABLES


@pytest.mark.parametrize("alpha", [0.02, 0.5, 0.999, 1 - 1e-13])
def test_null_inputs_leave_the_mean(spark, alpha):
    values = [None, 100.0, 110.0, None, None, 90.0, None, 95.0, 100.0, None, None, 100.0]
    rows = [("a", k, v) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "s string, ts int, x double")
    out = exponential_means(df, {"m": (F.col("x"), alpha), "one": (F.col("x"), 1.0)}, ["s"]).orderBy("ts").collect()
    mean = None
    for r, v in zip(out, values):
        mean = mean if v is None else v if mean is None else alpha * v + (1 - alpha) * mean
        assert r.m == (None if mean is None else pytest.approx(mean))


def test_a_day_of_seconds_without_lists(spark):
    import random

    rng, n = random.Random(2), 86_400
    values = [None if rng.random() < 0.1 else 100 + rng.gauss(0, 5) for _ in range(n)]
    df = spark.createDataFrame([("a", k, v) for k, v in enumerate(values)], "s string, ts int, x double")
    alphas = {"slow": 0.0004, "mid": 0.02, "fast": 0.3, "last": 0.97}
    out = exponential_means(df, {k: (F.col("x"), a) for k, a in alphas.items()}, ["s"], ["ts"])
    assert "collect_list" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.orderBy("ts").select(*alphas).collect()
    for name, a in alphas.items():
        mean, worst = None, 0.0
        for r, v in zip(rows, values):
            mean = mean if v is None else v if mean is None else a * v + (1 - a) * mean
            worst = max(worst, 0.0 if mean is None else abs(r[name] - mean))
        assert worst < 1e-9


def test_bars_off_the_grid(spark):
    at = lambda h, m, s=0: dt.datetime(2024, 1, 2, h, m, s)
    spans = [(at(9, 0), at(10, 0), 2), (at(12, 1), at(12, 3), 1), (at(12, 2), at(12, 9), 3), (at(13, 0), at(13, 0), 3)]
    calendar = spark.createDataFrame(spans, "blackout_start_ts timestamp_ntz, blackout_end_ts timestamp_ntz, impact int")
    times = [at(8, 59, 59), at(9, 0), at(9, 16), at(9, 59, 59), at(10, 0), at(12, 0), at(12, 1), at(12, 2, 30), at(12, 5), at(12, 8, 59), at(12, 9), at(13, 0)]
    grid = spark.createDataFrame([("M5", t) for t in times], "anchor_tf string, ts timestamp_ntz")
    got = {r.ts: (r.macro_is_blackout, r.macro_blackout_max_impact) for r in blackout_flags(grid, calendar, ["M5"]).collect()}
    for t in times:
        impact = max([i for a, b, i in spans if a <= t < b], default=0)
        assert got[t] == (impact > 0, impact)


def test_widening_keeps_digits(spark):
    a = spark.createDataFrame([(9007199254740993,)], "x long")
    b = spark.createDataFrame([(1,)], "x int")
    assert sorted(r.x for r in union_widened(a, b).collect()) == [1, 9007199254740993]
    assert wider_type("decimal(10,2)", "int") == "decimal(12,2)" and wider_type("float", "bigint") == "double"
    with pytest.raises(ValueError):
        wider_type("string", "int")


def test_declared_columns():
    assert len(TABLES["trade_paths"].columns) == len(set(TABLES["trade_paths"].columns)) > 40
    assert all(kind in {"string", "date", "timestamp", "double", "int", "boolean"} for t in TABLES.values() for kind in t.columns.values())


def test_longer_windows_than_default_reach_back_far_enough(spark):
    from barloom.plans.features import family_frame

    rows = [("a", "M1", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k), 100 + (k * 7919 % 101) / 10.0) for k in range(4000)]
    bars = spark.createDataFrame(rows, "instrument string, anchor_tf string, ts timestamp_ntz, close double")
    bars = bars.withColumns({"open": F.col("close"), "high": F.col("close") + 1, "low": F.col("close") - 1, "volume": F.lit(1.0), "dt": F.to_date("ts")})
    cfg = {"jump_window_bars": 400}
    one = family_frame("jump_variation", bars, cfg, by=("instrument", "anchor_tf"))
    many = family_frame("jump_variation", bars, cfg, continuous=True)
    key = lambda df: sorted((r.ts, *[None if v is None or v != v else round(v, 9) if isinstance(v, float) else v for v in r[3:]]) for r in df.select(*one.columns).collect())
    assert key(one) == key(many)


def test_copies_of_a_candle_don_t_multiply(spark):
    from barloom.plans.features import feature_table

    rows = [("a", "M5", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=5 * k), 100.0 + k) for k in [0, 1, 2, 3, 3, 4, 5]]
    bars = spark.createDataFrame(rows, "instrument string, anchor_tf string, ts timestamp_ntz, close double")
    bars = bars.withColumns({"open": F.col("close"), "high": F.col("close") + 1, "low": F.col("close") - 1, "volume": F.lit(1.0), "dt": F.to_date("ts")})
    assert feature_table(bars, families=("ta_trend", "ta_vol", "jump_variation")).count() == 6


def test_barriers_in_cells(spark):
    """Outcomes don't depend on the cell width, follow a bar-by-bar search, and orders keep their own dt."""
    import datetime as dt
    import random

    from barloom.operators.decisions import barrier_outcomes, fill_entry_price

    rng, day = random.Random(5), dt.datetime(2025, 1, 2)
    bars = {}
    for k in range(0, 400):
        if rng.random() < 0.7:
            o, c = (100 + rng.gauss(0, 1) for _ in range(2))
            bars[day + dt.timedelta(minutes=k)] = (o, max(o, c) + 0.2, min(o, c) - 0.2, c)
    candles = spark.createDataFrame([("A", "M1", t, *v) for t, v in bars.items()], "instrument string, tf string, ts timestamp_ntz, open double, high double, low double, close double")
    orders, want = [], {}
    for n in range(80):
        at = day + dt.timedelta(minutes=rng.randrange(-5, 420), seconds=rng.choice([0, 30]))
        side, wide = rng.choice(["long", "short"]), rng.choice([0.5, 1.5, 3.0, 9.0])
        up, down = 100 + wide, 100 - wide
        tp, sl = (up, down) if side == "long" else (down, up)
        orders.append((f"t{n}", "A", "M1", day.date() - dt.timedelta(days=1), at, None, side, tp, sl))
        after = sorted(t for t in bars if t >= at and t.date() == at.date())
        if after:
            result = (after[0], after[-1], bars[after[-1]][3], "last_close")
            for t in after:
                _, high, low, _ = bars[t]
                hit_tp, hit_sl = (high >= tp, low <= sl) if side == "long" else (low <= tp, high >= sl)
                if hit_tp or hit_sl:
                    result = (after[0], t, tp if hit_tp else sl, "target" if hit_tp else "stop")
                    break
            want[f"t{n}"] = (*result, bars[after[0]][0])
    asked = spark.createDataFrame(orders, "trade_id string, instrument string, tf_entry string, dt date, entry_ts timestamp_ntz, entry_px double, side string, tp_px double, sl_px double")
    for us in (60_000_000, 600_000_000, 86_400_000_000):
        got = barrier_outcomes(asked, candles, us).collect()
        assert {r.trade_id: (r.entry_fill_ts, r.exit_fill_ts, r.exit_fill_px, r.exit_reason, r.entry_fill_px) for r in got} == want
    filled = fill_entry_price(asked, candles).collect()
    assert len(filled) == len(orders) and {r.dt for r in filled} == {day.date() - dt.timedelta(days=1)}
    assert {r.trade_id: r.entry_px for r in filled if r.entry_px is not None} == {k: v[4] for k, v in want.items()}


def test_negative_offsets_reach_ahead_far_enough(spark):
    from barloom.plans.features import family_frame

    rows = [("a", "M1", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k), float(k * 7919 % 101), float(k * 6101 % 103)) for k in range(4200)]
    bars = spark.createDataFrame(rows, "instrument string, anchor_tf string, ts timestamp_ntz, open double, close double")
    bars = bars.withColumns({"high": F.greatest("open", "close") + 1, "low": F.least("open", "close") - 1, "volume": F.lit(1.0), "dt": F.to_date("ts")})
    for cfg in ({"start_offset_bars": -10, "mid_offset_bars": -5}, {"start_offset_bars": -40, "mid_offset_bars": 30, "end_offset_bars": 25}):
        one = family_frame("pac_bar", bars, cfg, by=("instrument", "anchor_tf"))
        many = family_frame("pac_bar", bars, cfg, continuous=True)
        assert sorted(map(str, one.collect())) == sorted(map(str, many.select(*one.columns).collect()))
