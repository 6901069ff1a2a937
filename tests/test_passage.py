"""First passages against a walk over all later bars."""

from __future__ import annotations

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from barloom.operators.decisions import excursions

DAY = dt.datetime(2025, 1, 2)
BARS = "instrument string, tf string, ts timestamp_ntz, open double, high double, low double, close double"
ORDERS = "trade_id string, instrument string, tf_entry string, entry_ts timestamp_ntz, side string, entry_px double, sl_px double, note string"


def walk(rng, name, seconds, step, gaps):
    """Bars of one day, some missing, some without a high."""
    price, out = 100.0, []
    for s in range(0, seconds, step):
        price += rng.gauss(0, 0.4)
        if rng.random() > gaps:
            high = None if rng.random() < 0.02 else price + rng.random()
            out.append((name, "S1", DAY + dt.timedelta(seconds=s), price, high, price - rng.random(), price))
    return out


def brute(order, bars):
    _, name, tf, at, side, entry, stop, _ = order
    later = [b for b in bars if b[0] == name and b[1] == tf and at is not None and b[2] >= at and b[2].date() == at.date()]
    t1 = t2 = mae = mfe = None
    for n, (_, _, _, _, high, low, _) in enumerate(later):
        good, bad = (high, low) if side == "long" else (low, high)
        risk = abs(entry - stop) if stop is not None else 0
        sign = 1 if side == "long" else -1
        gain = sign * (good - entry) / risk if risk and good is not None else None
        loss = sign * (entry - bad) / risk if risk and bad is not None else None
        if gain is not None:
            mfe = max(mfe if mfe is not None else 0.0, gain)
            t1 = n if t1 is None and gain >= 1 else t1
            t2 = n if t2 is None and gain >= 2 else t2
        if loss is not None:
            mae = max(mae if mae is not None else 0.0, loss)
    return t1, t2, (0.0 if mae is None else mae) if mfe is not None else None, mfe


def test_excursions_as_a_walk(spark):
    rng = random.Random(8)
    bars = walk(rng, "A", 7200, 7, 0.1) + walk(rng, "B", 80_000, 900, 0.3)
    bars += [(n, "S1", t + dt.timedelta(days=1), o, h, low, c) for n, _, t, o, h, low, c in bars[:50]]
    orders = []
    for k in range(300):
        b = rng.choice(bars)
        at = b[2] + dt.timedelta(seconds=rng.choice([0, 1, -1, 800, 4000]))
        entry = b[3] + rng.gauss(0, 1)
        orders.append((f"t{k}", b[0], "S1", at, rng.choice(["long", "short"]), entry, entry - rng.choice([0.0, 0.5, 2.0, 8.0]), "x"))
    orders += [("null", "A", "S1", None, "long", 1.0, 2.0, "x"), ("stop", "A", "S1", DAY, "long", 100.0, None, "x"), ("tf", "A", "M1", DAY, "long", 1.0, 2.0, "x"), ("none", "Z", "S1", DAY, "short", 1.0, 2.0, "x")]
    got = excursions(spark.createDataFrame(orders, ORDERS).repartition(3), spark.createDataFrame(bars, BARS).repartition(4))
    assert got.columns == [f.split()[0] for f in ORDERS.split(", ")] + ["time_to_1R_bars", "time_to_2R_bars", "mae_R", "mfe_R"]
    rows = {r.trade_id: tuple(r)[-4:] for r in got.collect()}
    assert len(rows) == len(orders)
    for o in orders:
        want = brute(o, bars)
        assert rows[o[0]][:2] == want[:2], o
        assert [x is None for x in rows[o[0]]] == [x is None for x in want]
        assert [x for x in rows[o[0]][2:] if x is not None] == pytest.approx([x for x in want[2:] if x is not None]), o


def test_rows_stay_in_proportion(spark):
    """20 000 trades before 20 000 bars of one day: one row a trade and join, not 200 million pairs."""
    bars = spark.range(20_000).select(
        F.lit("A").alias("instrument"), F.lit("S1").alias("tf"), F.timestamp_seconds(F.lit(1735776000) + F.col("id") * 4).cast("timestamp_ntz").alias("ts"),
        *[(F.lit(100.0) + F.col("id") / 1000 + x).alias(n) for n, x in (("open", 0.0), ("high", 0.1), ("low", -0.1), ("close", 0.0))],
    )
    orders = spark.range(20_000).select(
        F.col("id").cast("string").alias("trade_id"), F.lit("A").alias("instrument"), F.lit("S1").alias("tf_entry"),
        F.timestamp_seconds(F.lit(1735776000) + F.col("id") % 100).cast("timestamp_ntz").alias("entry_ts"), F.lit("long").alias("side"),
        (F.lit(100.0) + F.col("id") / 2000).alias("entry_px"), F.lit(99.0).alias("sl_px"),
    )
    start = time.time()
    got = excursions(orders, bars)
    r = got.agg(F.count(F.lit(1)), F.count("time_to_1R_bars"), F.max("time_to_1R_bars"), F.min("mfe_R")).first()
    assert r[0] == 20_000 and r[1] > 15_000 and r[2] > 10_000 and time.time() - start < 60
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_block_measures_as_a_walk(spark):
    """Packs of bars against every later bar, with gaps over pack borders, null closes and a reach of several packs."""
    from barloom.operators.structure import block_measures

    rng = random.Random(9)
    by = ("instrument", "anchor_tf", "dt")
    for confirm, reach in ((2, 300), (1, 70), (3, 64), (0, 20)):
        price, bars = 100.0, []
        for i in range(500):
            price += rng.gauss(0, 0.3)
            close = None if rng.random() < 0.03 else price
            bars.append([i, price + rng.random(), price - rng.random(), close, 0.5])
        blocks = {}
        for i in range(0, 480, 3):
            blocks[i + rng.randrange(1, 4)] = (i, rng.choice(["bullish", "bearish"]), bars[i][1], bars[i][2])
        rows = []
        for i, h, low, c, a in bars:
            o, kind, top, bottom = blocks.get(i, (None, "none", None, None))
            rows.append(("A", "M1", "d", DAY + dt.timedelta(minutes=i), i, h, low, c, a, o, kind, top, bottom))
        df = spark.createDataFrame(rows, "instrument string, anchor_tf string, dt string, ts timestamp_ntz, _row long, high double, low double, close double, atr_anchor double, _ob_row long, ob_type string, ob_high double, ob_low double")
        cfg = {"ob_max_origin_age_bars": reach, "ob_breaker_confirm_bars": confirm}
        measured = block_measures(df.repartition(3), cfg)
        plan = measured._jdf.queryExecution().executedPlan().toString()
        assert not any("Window" in line and "_ob_row" in line.split("windowspec")[0] for line in plan.splitlines() if "Window [" in line and "_ob_row" in line)
        got = {(r["_ob_row"], r["ob_type"]): (r["_ob_touch"], r["_ob_reacted"], r["_ob_break"], r["_ob_break_ts"]) for r in measured.collect()}
        n = max(1, confirm)
        for o, kind, top, bottom in blocks.values():
            bull = kind == "bullish"
            later = bars[o + 1 : o + reach + 1]
            touch = next((b for b in later if b[2] <= top and b[1] >= bottom), None)
            out = [b[3] is not None and (b[3] < bottom if bull else b[3] > top) for b in later]
            broken = next((k for k in range(n - 1, len(out)) if all(out[k - n + 1 : k + 1])), None)
            reacted = None
            if touch:
                ahead = bars[touch[0] : touch[0] + 3]
                move = max(b[1] for b in ahead) - min(touch[1], top) if bull else max(touch[2], bottom) - min(b[2] for b in ahead)
                reacted = int(move >= 0.3 * 0.5)
            want = (touch and touch[0], reacted, None if broken is None else later[broken][0], None if broken is None else DAY + dt.timedelta(minutes=later[broken - n + 1][0]))
            assert got.get((o, kind), (None,) * 4) == want, (o, kind, confirm)
