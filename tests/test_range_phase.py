"""Closed-form paths that force each reason code of the range fold."""

from __future__ import annotations

from datetime import datetime, timedelta

from barloom.operators.range_phase import PhaseState, phases_for_windows, range_settings, step

CFG = range_settings({})
CALM = {
    "us": 0, "dr_high": 110.0, "dr_width_atr": 3.0, "inside": True, "inside_ratio": 1.0, "tests_count": 5, "probe_low": False, "probe_high": False,
    "reclaim_from_low": False, "reclaim_from_high": False, "outside_up": False, "outside_dn": False, "trend_far": False,
}


def reasons(*bars):
    state = PhaseState()
    return [step(state, {**CALM, **b}, CFG)[5] for b in bars], state


OUT = {"outside_up": True, "inside": False}


def test_all_reason_codes():
    seen = set()
    paths = [
        [{}, {}, {"probe_low": True}, {}, {"reclaim_from_low": True}],
        [{}, {"probe_high": True}, {}, {}, {}, {}],
        [{}, OUT, OUT, OUT, {**OUT}, {"inside": True}],
        [{}, {"probe_low": True}, OUT, OUT, OUT],
        [{}, OUT, OUT, OUT, *[{**OUT, "trend_far": True}] * 6, {"inside": True}],
        [{}, {"dr_width_atr": 0.5}],
    ]
    for p in paths:
        seen |= set(reasons(*p)[0])
    assert seen == {
        "ENTER_B_RANGE_VALID", "RESET_RANGE_INVALID", "EXIT_B_ACCEPTED_BREAK", "ENTER_C_PROBE", "STAY_B_AUCTION_IN_RANGE", "EXIT_C_ACCEPTED_BREAK", "EXIT_C_RECLAIMED",
        "EXIT_C_TIMEOUT", "STAY_C_PROBE", "EXIT_D_TREND_ESTABLISHED", "REENTER_B_FROM_D", "STAY_D_ACCEPTED", "REENTER_B_FROM_E", "STAY_E_TREND",
    }


def test_timeout_comes_after_the_allowed_bars():
    codes, state = reasons({}, {"probe_low": True}, {}, {}, {}, {})
    assert codes[2:] == ["STAY_C_PROBE"] * 3 + ["EXIT_C_TIMEOUT"]
    assert state.phase == "B"


def test_bars_without_range_leave_the_state():
    codes, state = reasons({}, {"dr_high": None}, {})
    assert codes == ["ENTER_B_RANGE_VALID", None, "STAY_B_AUCTION_IN_RANGE"]
    assert state.age == 2


def windows(spark):
    start = datetime(2025, 1, 2, 12)
    rows = [("XAUUSD", "H1", start), ("XAUUSD", "H1", start + timedelta(hours=1))]
    return spark.createDataFrame(rows, "instrument string, anchor_tf string, anchor_ts timestamp_ntz")


def test_null_rows_without_candles(spark):
    out = phases_for_windows(windows(spark), None)
    assert out.count() == 2
    assert out.where("dr_phase is null and dr_reason_code is null").count() == 2


def test_null_rows_with_missing_columns(spark):
    candles = spark.createDataFrame([("XAUUSD", datetime(2025, 1, 2, 12), 2000.0)], "instrument string, ts timestamp_ntz, high double")
    out = phases_for_windows(windows(spark), candles)
    assert out.count() == 2
    assert out.where("dr_phase is null and dr_reason_code is null").count() == 2
