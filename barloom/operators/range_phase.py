"""Dealing-range phases: descriptors, evidence flags and the phase fold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import policy_ids, safe_div, settings
from ..functions.fold import let, scanned
from ..functions.rolling import DAY, Rows

RANGE_PHASE = {
    "lookback_bars": 50,
    "atr_window": 14,
    "width_min_atr": 1.0,
    "p_inside_min": 0.7,
    "tests_min": 3,
    "test_atr_mult": 0.2,
    "probe_atr_mult": 0.5,
    "reclaim_atr_mult": 0.2,
    "accept_atr_mult": 0.5,
    "accept_bars_min": 3,
    "reclaim_bars_max": 3,
    "trend_atr_mult": 1.5,
    "trend_width_mult": 1.0,
    "trend_bars_min": 5,
}

# Other names under which settings may arrive.
SETTING_ALIASES = {
    "dealing_range_lookback_bars": "lookback_bars",
    "width_min_atr_mult": "width_min_atr",
    "test_band_atr_mult": "test_atr_mult",
    "spring_penetration_atr_mult": "probe_atr_mult",
    "trend_distance_atr": "trend_atr_mult",
}


def range_settings(cfg: Mapping | None) -> dict:
    return settings(RANGE_PHASE, {SETTING_ALIASES.get(k, k): v for k, v in (cfg or {}).items()})


def range_descriptors(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """atr, dr_low, dr_high, dr_mid, dr_width, dr_width_atr, range_position."""
    c = range_settings(cfg)
    w, aw = max(2, c["lookback_bars"]), max(2, c["atr_window"])
    rows = Rows(by)
    out = bars.withColumn("_tr", rows.true_range())
    out = out.withColumns(
        {
            "atr": rows.mean(F.col("_tr"), aw),
            "dr_high": rows.max(F.col("high"), w),
            "dr_low": rows.min(F.col("low"), w),
        }
    ).drop("_tr")
    width = F.col("dr_high") - F.col("dr_low")
    return out.withColumns(
        {
            "dr_width": width,
            "dr_mid": (F.col("dr_high") + F.col("dr_low")) / 2.0,
            "dr_width_atr": safe_div(width, F.col("atr"), None),
            "range_position": safe_div(F.col("close") - F.col("dr_low"), width, None),
        }
    )


EVIDENCE = (
    "inside",
    "inside_ratio",
    "test_high_count",
    "test_low_count",
    "tests_count",
    "pierce_low",
    "pierce_high",
    "probe_low",
    "probe_high",
    "reclaim_from_low",
    "reclaim_from_high",
    "outside_up",
    "outside_dn",
    "trend_far",
    "reclaim_band",
    "accept_dist",
    "trend_dist",
)


def range_evidence(described: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """Flags and distances the transition reads; null ATR leaves them null."""
    c = range_settings(cfg)
    w = max(2, c["lookback_bars"])
    rows = Rows(by)
    atr, lo, hi = F.col("atr"), F.col("dr_low"), F.col("dr_high")
    high, low, close = F.col("high"), F.col("low"), F.col("close")
    pierce_low, pierce_high = F.greatest(lo - low, F.lit(0.0)), F.greatest(high - hi, F.lit(0.0))
    known = hi.isNotNull()
    probe = atr * c["probe_atr_mult"]
    trend = F.greatest(atr * c["trend_atr_mult"], F.col("dr_width") * c["trend_width_mult"])
    out = described.withColumns(
        {
            "inside": (close >= lo) & (close <= hi),
            "_test_high": (high >= hi - atr * c["test_atr_mult"]).cast("long"),
            "_test_low": (low <= lo + atr * c["test_atr_mult"]).cast("long"),
            "pierce_low": F.when(known, pierce_low),
            "pierce_high": F.when(known, pierce_high),
            "probe_low": F.when(known, pierce_low >= probe),
            "probe_high": F.when(known, pierce_high >= probe),
            "reclaim_band": atr * c["reclaim_atr_mult"],
            "accept_dist": atr * c["accept_atr_mult"],
            "trend_dist": trend,
            "reclaim_from_low": close >= lo + atr * c["reclaim_atr_mult"],
            "reclaim_from_high": close <= hi - atr * c["reclaim_atr_mult"],
            "outside_up": close >= hi + atr * c["accept_atr_mult"],
            "outside_dn": close <= lo - atr * c["accept_atr_mult"],
            "trend_far": F.abs(close - F.col("dr_mid")) >= trend,
        }
    )
    test_high, test_low = F.col("_test_high"), F.col("_test_low")
    return out.withColumns(
        {
            "inside_ratio": rows.mean(F.col("inside").cast("double"), w),
            "test_high_count": rows.sum(test_high, w),
            "test_low_count": rows.sum(test_low, w),
            "tests_count": rows.sum(test_high + test_low, w),
        }
    ).drop("_test_high", "_test_low")


@dataclass
class PhaseState:
    """What the fold carries from bar to bar; also the streaming state row."""

    phase: str | None = None
    number: int = 0
    start: int | None = None
    age: int = 0
    probe_side: str | None = None
    probe_age: int = 0
    up_run: int = 0
    down_run: int = 0
    trend_run: int = 0

    def as_row(self) -> tuple:
        return tuple(getattr(self, f.name) for f in fields(self))


STATE_SCHEMA = (
    "phase string, number bigint, start bigint, age bigint, probe_side string, probe_age bigint, "
    "up_run bigint, down_run bigint, trend_run bigint"
)


def _transition(s: PhaseState, b: Mapping, c: Mapping) -> str | None:
    """Move the phase by one bar of evidence; gives the reason code."""
    accepted = max(s.up_run, s.down_run) >= c["accept_bars_min"]
    probe_low, probe_high = b["probe_low"] is True, b["probe_high"] is True
    inside = b["inside"] is True
    width = b["dr_width_atr"]
    if s.phase is None:
        ready = width is not None and width >= c["width_min_atr"]
        ready = ready and b["inside_ratio"] is not None and b["inside_ratio"] >= c["p_inside_min"]
        ready = ready and b["tests_count"] is not None and b["tests_count"] >= c["tests_min"]
        if not ready:
            return None
        s.phase, s.number, s.start, s.age = "B", s.number + 1, b["us"], 0
        return "ENTER_B_RANGE_VALID"
    if s.phase == "B":
        if width is not None and width < c["width_min_atr"]:
            s.phase, s.start, s.age, s.probe_side, s.probe_age = None, None, 0, None, 0
            return "RESET_RANGE_INVALID"
        if accepted:
            s.phase = "D"
            return "EXIT_B_ACCEPTED_BREAK"
        if probe_low or probe_high:
            s.phase, s.probe_side, s.probe_age = "C", "LOW" if probe_low else "HIGH", 0
            return "ENTER_C_PROBE"
        return "STAY_B_AUCTION_IN_RANGE"
    if s.phase == "C":
        s.probe_age += 1
        back = b["reclaim_from_low"] if s.probe_side == "LOW" else b["reclaim_from_high"]
        if accepted:
            s.phase, s.probe_side = "D", None
            return "EXIT_C_ACCEPTED_BREAK"
        if back is True:
            s.phase, s.probe_side = "B", None
            return "EXIT_C_RECLAIMED"
        if s.probe_age > c["reclaim_bars_max"]:
            s.phase, s.probe_side = "B", None
            return "EXIT_C_TIMEOUT"
        return "STAY_C_PROBE"
    if s.phase == "D":
        if s.trend_run >= c["trend_bars_min"]:
            s.phase = "E"
            return "EXIT_D_TREND_ESTABLISHED"
        if inside:
            s.phase = "B"
            return "REENTER_B_FROM_D"
        return "STAY_D_ACCEPTED"
    if inside:
        s.phase = "B"
        return "REENTER_B_FROM_E"
    return "STAY_E_TREND"


PHASE_COLUMNS = ("fold_phase", "fold_number", "fold_start_us", "fold_age", "fold_probe_side", "fold_reason", "up_run", "down_run", "trend_run")
PHASE_SCHEMA = (
    "fold_phase string, fold_number bigint, fold_start_us bigint, fold_age bigint, fold_probe_side string, "
    "fold_reason string, up_run bigint, down_run bigint, trend_run bigint"
)


def step(s: PhaseState, b: Mapping, c: Mapping) -> tuple:
    """One bar through the fold; bars without a full range leave the state alone."""
    if b["dr_high"] is None:
        return (None,) * 9
    s.up_run = s.up_run + 1 if b["outside_up"] is True else 0
    s.down_run = s.down_run + 1 if b["outside_dn"] is True else 0
    s.trend_run = s.trend_run + 1 if b["trend_far"] is True else 0
    reason = _transition(s, b, c)
    if s.phase is None:
        return (None, None, None, None, None, reason, s.up_run, s.down_run, s.trend_run)
    s.age += 1
    side = s.probe_side if s.phase == "C" else None
    return (s.phase, s.number, s.start, s.age, side, reason, s.up_run, s.down_run, s.trend_run)


FOLD_INPUT = (
    "dr_high",
    "dr_width_atr",
    "inside",
    "inside_ratio",
    "tests_count",
    "probe_low",
    "probe_high",
    "reclaim_from_low",
    "reclaim_from_high",
    "outside_up",
    "outside_dn",
    "trend_far",
)


def phase_step(c: Mapping):
    """``step`` as a column expression over (state, bar)."""

    def move(s, b):
        flag = {n: F.coalesce(b[n], F.lit(False)) for n in ("inside", "probe_low", "probe_high", "reclaim_from_low", "reclaim_from_high")}
        width, phase = b["dr_width_atr"], s["phase"]
        accepted = F.greatest(s["up_run"], s["down_run"]) >= c["accept_bars_min"]
        ready = (width >= c["width_min_atr"]) & (b["inside_ratio"] >= c["p_inside_min"]) & (b["tests_count"] >= c["tests_min"])
        back = F.when(s["probe_side"] == "LOW", flag["reclaim_from_low"]).otherwise(flag["reclaim_from_high"])
        reason = (
            F.when(phase.isNull(), F.when(ready, "ENTER_B_RANGE_VALID"))
            .when(
                phase == "B",
                F.when(width < c["width_min_atr"], "RESET_RANGE_INVALID")
                .when(accepted, "EXIT_B_ACCEPTED_BREAK")
                .when(flag["probe_low"] | flag["probe_high"], "ENTER_C_PROBE")
                .otherwise("STAY_B_AUCTION_IN_RANGE"),
            )
            .when(
                phase == "C",
                F.when(accepted, "EXIT_C_ACCEPTED_BREAK")
                .when(back, "EXIT_C_RECLAIMED")
                .when(s["probe_age"] + 1 > c["reclaim_bars_max"], "EXIT_C_TIMEOUT")
                .otherwise("STAY_C_PROBE"),
            )
            .when(
                phase == "D",
                F.when(s["trend_run"] >= c["trend_bars_min"], "EXIT_D_TREND_ESTABLISHED").when(flag["inside"], "REENTER_B_FROM_D").otherwise("STAY_D_ACCEPTED"),
            )
            .otherwise(F.when(flag["inside"], "REENTER_B_FROM_E").otherwise("STAY_E_TREND"))
        )
        return let(reason, lambda why: moved(s, b, why, flag))

    def moved(s, b, why, flag):
        none, enter, reset, probe = F.lit(None), why == "ENTER_B_RANGE_VALID", why == "RESET_RANGE_INVALID", why == "ENTER_C_PROBE"
        leave_c = why.isin("EXIT_C_ACCEPTED_BREAK", "EXIT_C_RECLAIMED", "EXIT_C_TIMEOUT")
        phase = (
            F.when(reset, none.cast("string"))
            .when(enter | why.isin("EXIT_C_RECLAIMED", "EXIT_C_TIMEOUT", "REENTER_B_FROM_D", "REENTER_B_FROM_E"), "B")
            .when(probe, "C")
            .when(why.isin("EXIT_B_ACCEPTED_BREAK", "EXIT_C_ACCEPTED_BREAK"), "D")
            .when(why == "EXIT_D_TREND_ESTABLISHED", "E")
            .otherwise(s["phase"])
        )
        side = F.when(probe, F.when(flag["probe_low"], "LOW").otherwise("HIGH")).when(~(reset | leave_c) | why.isNull(), s["probe_side"])
        probe_age = F.when(reset | probe, 0).when(s["phase"] == "C", s["probe_age"] + 1).otherwise(s["probe_age"])
        fields = {
            "phase": phase,
            "number": s["number"] + F.when(enter, 1).otherwise(0),
            "start": F.when(enter, b["us"]).when(reset, none.cast("long")).otherwise(s["start"]),
            "age": F.when(enter | reset, 0).otherwise(s["age"]),
            "probe_side": side,
            "probe_age": probe_age,
            **{n: s[n] for n in ("up_run", "down_run", "trend_run")},
        }
        return let(F.struct(*[v.alias(k) for k, v in fields.items()]).cast(STATE_TYPE), lambda t: shown(t, why))

    def shown(t, why):
        live = t["phase"].isNotNull()
        aged = F.struct(*[(t[n] + live.cast("int") if n == "age" else t[n]).alias(n) for n in STATE_FIELDS]).cast(STATE_TYPE)
        out = {
            "fold_phase": t["phase"], "fold_number": F.when(live, t["number"]), "fold_start_us": t["start"], "fold_age": F.when(live, t["age"] + 1),
            "fold_probe_side": F.when(t["phase"] == "C", t["probe_side"]), "fold_reason": why, **{n: t[n] for n in ("up_run", "down_run", "trend_run")},
        }
        return F.struct(aged.alias("state"), F.struct(*[v.alias(k) for k, v in out.items()]).cast(PHASE_TYPE).alias("result"))

    def bar(s, b):
        def run(n, flag):
            return F.when(b[flag], s[n] + 1).otherwise(0)

        counted = {**{n: s[n] for n in STATE_FIELDS}, "up_run": run("up_run", "outside_up"), "down_run": run("down_run", "outside_dn"), "trend_run": run("trend_run", "trend_far")}
        after = let(F.struct(*[v.alias(k) for k, v in counted.items()]).cast(STATE_TYPE), lambda t: move(t, b))
        idle = F.struct(s.alias("state"), F.lit(None).cast(PHASE_TYPE).alias("result"))
        return F.when(b["dr_high"].isNull(), idle).otherwise(after)

    return bar


def _struct(schema: str) -> str:
    return "struct<" + ",".join(part.replace(" ", ":") for part in schema.split(", ")) + ">"


STATE_FIELDS = tuple(f.name for f in fields(PhaseState))
STATE_TYPE, PHASE_TYPE = _struct(STATE_SCHEMA), _struct(PHASE_SCHEMA)


def bar_dicts(pdf: pd.DataFrame) -> list[dict]:
    """Rows as plain dicts with None for null."""
    return pdf.astype(object).where(pdf.notna(), None).to_dict("records")


def finish_phases(folded: DataFrame, cfg: Mapping | None = None) -> DataFrame:
    """Fold columns to the published dr_* and evidence columns."""
    phase, reason = F.col("fold_phase"), F.col("fold_reason")
    live, seen = phase.isNotNull(), reason.isNotNull()
    probing = F.when(F.col("probe_low"), F.col("pierce_low")).when(F.col("probe_high"), F.col("pierce_high"))
    runs = F.when(F.col("outside_up"), F.col("up_run")).when(F.col("outside_dn"), F.col("down_run")).otherwise(F.lit(0))
    null = F.lit(None)
    out = {
        "dr_id": F.when(
            live, F.format_string("%s:%s-%04d", F.col("instrument"), F.col("anchor_tf"), F.col("fold_number"))
        ),
        "dr_phase": phase,
        **{n: F.when(live, F.col(n)) for n in ("dr_low", "dr_high", "dr_mid", "dr_width", "dr_width_atr")},
        "dr_age_bars": F.col("fold_age"),
        "dr_start_ts": F.when(live, F.timestamp_micros("fold_start_us").cast("timestamp_ntz")),
        "dr_last_update_ts": F.when(live, F.col("ts")),
        "dr_reason_code": reason,
        "inside_ratio_L": F.when(seen, F.col("inside_ratio")),
        "tests_L": F.when(seen, F.col("tests_count")),
        "test_high_count_L": F.when(seen, F.col("test_high_count")),
        "test_low_count_L": F.when(seen, F.col("test_low_count")),
        "probe_side": F.col("fold_probe_side"),
        "pierce_dist": F.when(live, probing),
        "reclaim_margin": F.when(seen, F.col("reclaim_band")),
        "accept_dist": F.when(seen, F.col("accept_dist")),
        "accept_bars": F.when(seen, runs),
        "retest_pass": null.cast("boolean"),
        "trend_dist": F.when(seen, F.col("trend_dist")),
        "trend_bars": F.when(seen, F.col("trend_run")),
        "range_position": F.when(seen, F.col("range_position")),
        "pd_index": null.cast("double"),
        "liq_eqh_count": null.cast("long"),
        "liq_eql_count": null.cast("long"),
    }
    keys = ["instrument", "anchor_tf", F.col("ts").alias("anchor_ts")] + (["dt"] if "dt" in folded.columns else [])
    ids = policy_ids("dr_phase_v1", "dr_thresholds_v1", cfg)
    return folded.select(*keys, *[v.alias(k) for k, v in {**out, **ids}.items()])


def range_phases(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """dr_* per bar: evidence in columns, the transition as a scan over the array of a group's bars, which carries the evidence along.

    Groups are bounded (a day of one series). Range numbers restart per group.
    """
    c = range_settings(cfg)
    by = list(by)
    bars = bars.select(*dict.fromkeys([*by, "instrument", "anchor_tf", "ts"]), "high", "low", "close")
    evidence = range_evidence(range_descriptors(bars, c, by), c, by)
    evidence = evidence.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    state = PhaseState()
    start = F.struct(*[F.lit(getattr(state, n)).alias(n) for n in STATE_FIELDS]).cast(STATE_TYPE)
    return finish_phases(scanned(evidence, by, "us", start, STATE_TYPE, PHASE_TYPE, phase_step(c)), cfg)


def attach_phases(windows: DataFrame, phases: DataFrame, cfg: Mapping | None = None) -> DataFrame:
    """Phases on the distinct window keys; windows without a bar get nulls and policy ids."""
    keys = ["instrument", "anchor_tf", "anchor_ts"]
    ids = policy_ids("dr_phase_v1", "dr_thresholds_v1", cfg)
    base = windows.select(*keys).dropna().distinct()
    return base.join(phases.drop(*ids, "dt"), keys, "left").withColumns(ids)


def empty_phases(windows: DataFrame, cfg: Mapping | None = None) -> DataFrame:
    """The same columns, all null, for windows without usable candles."""
    bars = windows.select(
        "instrument",
        "anchor_tf",
        F.col("anchor_ts").alias("ts"),
        F.to_date("anchor_ts").alias("dt"),
        *[F.lit(None).cast("double").alias(n) for n in ("high", "low", "close")],
    )
    return attach_phases(windows, range_phases(bars.limit(0), cfg), cfg)


def phases_for_windows(windows: DataFrame, candles: DataFrame | None, cfg: Mapping | None = None) -> DataFrame:
    """Phases by candles (instrument, tf, ts, high, low, close); tolerant of none."""
    needed = {"instrument", "tf", "ts", "high", "low", "close"}
    if candles is None or not needed <= set(candles.columns):
        return empty_phases(windows, cfg)
    bars = candles.dropna(subset=["instrument", "tf", "ts"]).withColumnsRenamed({"tf": "anchor_tf"})
    return attach_phases(windows, range_phases(bars.withColumn("dt", F.to_date("ts")), cfg), cfg)
