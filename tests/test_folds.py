"""State machines as column scans against a walk over the bars."""

from __future__ import annotations

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from barloom.functions import fold
from barloom.operators import structure as st
from barloom.operators.range_phase import FOLD_INPUT, PHASE_TYPE, STATE_FIELDS, STATE_TYPE, PhaseState, phase_step, range_settings, step

EPS = st.EPS


def walk_boxes(bars, c):
    """Accumulation → manipulation → distribution over the bars of one group."""
    need = c["mms_phase_persist_bars_min"]
    phase, side, direction, box, age, streak = "none", "none", "none", None, 0, 0
    rows = []
    for b in bars:
        streak = streak + 1 if b.compressed else max(0, streak - 1)
        if phase == "none" and b.compressed and streak >= need:
            phase, side, direction, box, age = "accumulation", "none", "none", (b.box_high, b.box_low), 0
        if phase != "none" and box:
            age += 1
        trigger = b.sweep != "none" or (not c["mms_manipulation_requires_sweep"] and b.grab)
        if phase == "accumulation" and trigger and streak >= need:
            up = b.sweep == "eqh" or (b.sweep == "none" and b.close < b.open)
            phase, side, direction, streak = "manipulation", "buyside" if up else "sellside", "none", 0
        if phase == "manipulation" and streak >= need:
            wanted = "down" if side == "buyside" else "up"
            if b.displaced and b.direction == wanted and box:
                beyond = box[1] - b.low if wanted == "down" else b.high - box[0]
                if b.atr > EPS and beyond >= c["mms_distribution_range_atr_min"] * b.atr:
                    phase, direction, streak = "distribution", wanted, 0
        if phase != "none" and box and b.box_high == b.box_high:
            shift = abs((b.box_high + b.box_low) / 2.0 - (box[0] + box[1]) / 2.0)
            shared = max(0.0, min(box[0], b.box_high) - max(box[1], b.box_low)) / max(box[0] - box[1], EPS)
            if b.atr > EPS and (shift > b.atr or shared < 0.5):
                phase, side, direction, box, age, streak = "none", "none", "none", None, 0, 0
        high, low = box if box else (None, None)
        rows.append((phase, high, low, age if box else 0, side, direction))
    return rows


def walk_swings(rows_in, gap):
    """Accept a candidate that is at least ``gap`` bars after the opposite swing."""
    last_high = last_low = None
    rows = []
    for row, is_high, is_low in rows_in:
        high = low = False
        strength = None
        if is_high and (last_low is None or row - last_low >= gap):
            high, last_high = True, row
            strength = None if last_low is None else float(row - last_low)
        if is_low and (last_high is None or row - last_high >= gap):
            low, last_low = True, row
            strength = None if last_high is None else float(row - last_high)
        rows.append((high, low, strength))
    return rows


BOX = "g string, dt string, _row long, open double, high double, low double, close double, atr_anchor double, _compressed boolean, _box_high double, _box_low double, liq_sweep_side string, liq_grab_flag boolean, displacement_flag boolean, displacement_dir string"
NAMES = "open high low close atr compressed box_high box_low sweep grab displaced direction".split()


def boxes(spark, bars, c):
    """phase_fold over bars given by NAMES, as rows in order."""
    rows = [("g", "d", k, *[b[n] for n in NAMES]) for k, b in enumerate(bars)]
    found = st.phase_fold(spark.createDataFrame(rows, BOX).repartition(3), c, ["g", "dt"])
    assert "InPandas" not in found._jdf.queryExecution().executedPlan().toString()
    return [tuple(r)[3:] for r in found.orderBy("_row").collect()]


def test_distribution_phase_is_reached(spark):
    c = {"mms_phase_persist_bars_min": 1}
    calm = dict(open=100.0, high=101.0, low=99.0, close=100.0, atr=2.0, compressed=True, box_high=102.0, box_low=98.0, sweep="none", grab=False, displaced=False, direction="none")
    path = [calm, {**calm, "sweep": "eqh"}, {**calm, "low": 90.0, "displaced": True, "direction": "down"}]
    out = boxes(spark, path, c)
    assert [r[0] for r in out] == ["accumulation", "manipulation", "distribution"]
    assert out[-1][5] == "down"
    moved = {**calm, "box_high": 120.0, "box_low": 116.0}
    assert boxes(spark, [*path, moved], c)[-1][0] == "none"


@pytest.mark.parametrize("seed", range(4))
def test_boxes_as_a_walk(spark, seed):
    rng = random.Random(seed)
    c = {**st.STRUCTURE, "mms_phase_persist_bars_min": 1 + seed % 3, "mms_distribution_range_atr_min": 0.5, "mms_manipulation_requires_sweep": seed % 2}
    bars, level = [], 100.0
    for _ in range(300):
        level += rng.choice([0, 0, 0, rng.gauss(0, 2)])
        box = rng.random() < 0.9
        bars.append(dict(
            open=level, high=level + rng.choice([2, 7]), low=level - rng.choice([2, 7]), close=level + rng.choice([-1, 1]), atr=rng.choice([1.0, 3.0, 0.0]), compressed=box and rng.random() < 0.7,
            box_high=level + 3 if box else None, box_low=level - 3 if box else None, sweep=rng.choice(["none", "none", "eqh", "eql"]), grab=rng.random() < 0.3,
            displaced=rng.random() < 0.4, direction=rng.choice(["up", "down", "none"]),
        ))
    nan = float("nan")
    walked = walk_boxes([SimpleNamespace(**{k: nan if v is None else v for k, v in b.items()}) for b in bars], c)
    got = boxes(spark, bars, c)
    assert got == [tuple(r) for r in walked]
    assert len({r[0] for r in got}) == 4


def test_swings_as_a_walk(spark):
    rng = random.Random(3)
    rows = [(r, *rng.choice([(True, False), (False, True), (True, True)])) for r in sorted(rng.sample(range(900), 250))]
    for gap in (1, 5, 9):
        df = spark.createDataFrame([("g", *r) for r in rows], "g string, _row long, _cand_high boolean, _cand_low boolean").repartition(3)
        got = st.accepted_swings(df, {"swing_strength_min_bars": gap}, ["g"]).orderBy("_row").collect()
        assert [(r["_is_high"], r["_is_low"], r["_strength"]) for r in got] == walk_swings(rows, gap)
    rows = [(3, True, False), (7, False, True), (12, False, True), (13, True, False)]
    df = spark.createDataFrame([("g", *r) for r in rows], "g string, _row long, _cand_high boolean, _cand_low boolean")
    got = st.accepted_swings(df, {"swing_strength_min_bars": 5}, ["g"]).orderBy("_row").collect()
    assert [r["_is_high"] for r in got] == [True, False, False, False]
    assert [r["_is_low"] for r in got] == [False, False, True, False] and got[2]["_strength"] == 9.0


@pytest.mark.parametrize("seed", range(3))
def test_range_phases_as_the_streaming_step(spark, seed):
    rng = random.Random(seed)
    c = range_settings({"accept_bars_min": 2, "trend_bars_min": 2, "reclaim_bars_max": 2})
    flags = [n for n in FOLD_INPUT if n not in ("dr_high", "dr_width_atr", "inside_ratio", "tests_count")]
    bars = []
    for k in range(500):
        b = {n: rng.choice([True, False, False, None]) for n in flags}
        b |= {"us": k, "dr_high": None if rng.random() < 0.1 else 1.0, "dr_width_atr": rng.choice([0.5, 3.0, 3.0, 3.0, None]), "inside_ratio": rng.choice([0.9, 0.9, 0.1, None]), "tests_count": rng.choice([5, 5, 1, None])}
        bars.append(b)
    state = PhaseState()
    want = [step(state, b, c) for b in bars]
    shape = ", ".join(["us long", *[f"{n} {'boolean' if n in flags else 'long' if n == 'tests_count' else 'double'}" for n in FOLD_INPUT]])
    df = spark.createDataFrame([tuple(b[n] for n in ("us", *FOLD_INPUT)) for b in bars], shape).withColumn("g", F.lit("g")).repartition(3)
    start = F.struct(*[F.lit(getattr(PhaseState(), n)).alias(n) for n in STATE_FIELDS]).cast(STATE_TYPE)
    got = fold.scanned(df, ["g"], "us", start, STATE_TYPE, PHASE_TYPE, phase_step(c)).orderBy("us").collect()
    assert [tuple(r)[-9:] for r in got] == [tuple(w) for w in want]
    assert len({w[5] for w in want}) >= 13


def test_scan_over_chunks(spark):
    """A running sum over one row, a chunk, and many chunks."""
    for n in (1, 63, 64, 65, 1000):
        df = spark.range(n).select(F.lit("g").alias("g"), "id", (F.col("id") % 7).alias("x")).repartition(4)

        def bar(s, b):
            total = s["total"] + b["x"]
            return F.struct(F.struct(total.alias("total")).alias("state"), F.struct(total.alias("total"), b["id"].alias("at")).alias("result"))

        start = F.struct(F.lit(0).cast("long").alias("total"))
        rows = fold.scanned(df, ["g"], "id", start, "struct<total:bigint>", "struct<total:bigint,at:bigint>", bar).orderBy("id").collect()
        totals, s = [], 0
        for k in range(n):
            s += k % 7
            totals.append((k, s, k))
        assert [(r["id"], r["total"], r["at"]) for r in rows] == totals
