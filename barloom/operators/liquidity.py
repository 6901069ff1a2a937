"""Liquidity levels inside the range, their overlaps and microstructure confirmation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import column_or, safe_div, settings, sign, zscore
from ..functions.rolling import DAY, Rows

LEVELS = {
    "lookback_bars": 50,
    "range_method": "donchian",
    "range_min_atr": 0.0,
    "range_max_atr": 1.0e9,
    "interior_buffer_mode": "atr",
    "interior_buffer_ticks": 0.0,
    "atr_window": 14,
    "edge_atr_mult": 0.25,
    "min_count": 2,
    "pivot_left_bars": 2,
    "pivot_right_bars": 2,
    "pivot_prominence_atr_min": 0.0,
    "level_merge_mode": "atr",
    "level_merge_ticks": 0.0,
    "level_merge_atr_mult": 0.0,
    "level_rank_method": "count",
    "touch_mode": "wick",
    "touch_tolerance_mode": "atr",
    "touch_tolerance_ticks": 0.0,
    "touch_tolerance_atr_mult": 0.0,
    "min_bars_between_touches": 0,
    "nearest_dist_atr_max": 1.0e9,
    "require_both_sides": False,
    "source": "range_interior",
    "micro_event_band_ticks": 0.0,
}


def _tolerance(mode: str, ticks: float, mult: float) -> Column:
    return F.lit(ticks) if mode == "ticks" else F.col("_atr") * mult


def interior_levels(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """internal_liq levels, touch counts, nearest side and distance, flag, reason.

    Keeps internal_liq_atr, which the overlap test needs. Pivots read
    pivot_right_bars later bars (look-ahead).
    """
    c = settings(LEVELS, cfg)
    w, aw = max(5, c["lookback_bars"]), max(5, c["atr_window"])
    left, right = max(1, c["pivot_left_bars"]), max(1, c["pivot_right_bars"])
    rows = Rows(by)
    high, low, close = F.col("high"), F.col("low"), F.col("close")
    donchian = c["range_method"] == "donchian"
    null = F.lit(None).cast("double")
    around = rows.around(left, right)
    full = F.count(F.lit(1)).over(around) == left + right + 1

    out = bars.withColumn("_tr", rows.true_range())
    out = out.withColumns(
        {
            "_atr": rows.mean(F.col("_tr"), aw),
            "_top": rows.max(high, w) if donchian else null,
            "_bottom": rows.min(low, w) if donchian else null,
            "_pivot_top": F.when(full, F.max("high").over(around)),
            "_pivot_bottom": F.when(full, F.min("low").over(around)),
        }
    )
    atr = F.col("_atr")
    edge = _tolerance(c["interior_buffer_mode"], c["interior_buffer_ticks"], c["edge_atr_mult"])
    out = out.withColumns({"_inner_top": F.col("_top") - edge, "_inner_bottom": F.col("_bottom") + edge})
    prominence = c["pivot_prominence_atr_min"]

    def pivot(price: Column, extreme: str, reach: Column) -> Column:
        inside = (price <= F.col("_inner_top")) & (price >= F.col("_inner_bottom"))
        return F.when((price == F.col(extreme)) & (safe_div(reach, atr) >= prominence) & inside, price)

    out = out.withColumns(
        {
            "_pivot_high": pivot(high, "_pivot_top", high - F.col("_pivot_bottom")),
            "_pivot_low": pivot(low, "_pivot_bottom", F.col("_pivot_top") - low),
        }
    )
    if c["level_rank_method"] == "recency_weighted":
        levels = {
            "internal_liq_level_high": rows.forward_fill(F.col("_pivot_high")),
            "internal_liq_level_low": rows.forward_fill(F.col("_pivot_low")),
        }
    else:
        # A full frame of non-null pivots is asked for, as declared.
        levels = {
            "internal_liq_level_high": rows.max(F.col("_pivot_high"), w, c.get("level_min_periods", w)),
            "internal_liq_level_low": rows.min(F.col("_pivot_low"), w, c.get("level_min_periods", w)),
        }
    out = out.withColumns(levels)
    level_high, level_low = F.col("internal_liq_level_high"), F.col("internal_liq_level_low")
    reach = _tolerance(
        c["touch_tolerance_mode"], c["touch_tolerance_ticks"], c["touch_tolerance_atr_mult"]
    ) + _tolerance(c["level_merge_mode"], c["level_merge_ticks"], c["level_merge_atr_mult"])
    if c["touch_mode"] == "close":
        at_high = at_low = close
    elif c["touch_mode"] == "hlc3":
        at_high = at_low = (high + low + close) / 3.0
    else:
        at_high, at_low = high, low
    touch = {
        "_touch_high": F.coalesce(F.abs(at_high - level_high) <= reach, F.lit(False)),
        "_touch_low": F.coalesce(F.abs(at_low - level_low) <= reach, F.lit(False)),
    }
    out = out.withColumns(touch)
    gap = c["min_bars_between_touches"]
    if gap > 0:
        recent = rows.last(gap, skip=1)
        out = out.withColumns(
            {t: F.col(t) & ~F.coalesce(F.bool_or(t).over(recent), F.lit(False)) for t in touch}
        )
    out = out.withColumns(
        {
            "internal_liq_high_count_L": rows.sum(F.col("_touch_high").cast("long"), w),
            "internal_liq_low_count_L": rows.sum(F.col("_touch_low").cast("long"), w),
            "_dist_high": safe_div(F.abs(level_high - close), atr),
            "_dist_low": safe_div(F.abs(close - level_low), atr),
            "_width": safe_div(F.col("_top") - F.col("_bottom"), atr),
        }
    )
    side = (
        F.when(level_high.isNull() & level_low.isNull(), "none")
        .when(level_high.isNull(), "low")
        .when(level_low.isNull(), "high")
        .when(F.col("_dist_high") <= F.col("_dist_low"), "high")
        .otherwise("low")
    )
    enough_high = F.col("internal_liq_high_count_L") >= c["min_count"]
    enough_low = F.col("internal_liq_low_count_L") >= c["min_count"]
    flag = (enough_high & enough_low) if c["require_both_sides"] else (enough_high | enough_low)
    out = out.withColumns(
        {
            "internal_liq_nearest_side": side,
            "internal_liq_nearest_dist_atr": F.when(side == "high", F.col("_dist_high")).otherwise(
                F.col("_dist_low")
            ),
        }
    )
    if c["nearest_dist_atr_max"] < 1.0e9:
        flag = flag & (F.col("internal_liq_nearest_dist_atr") <= c["nearest_dist_atr_max"])
    band = c["micro_event_band_ticks"]
    nearest_px = F.when(F.col("internal_liq_nearest_side") == "high", level_high).when(
        F.col("internal_liq_nearest_side") == "low", level_low
    )
    near = (
        F.lit(None).cast("boolean")
        if band <= 0
        else F.when(nearest_px.isNull(), F.lit(False)).otherwise(
            F.abs(close - nearest_px) <= column_or(bars, "tick_size", "double", 1.0) * band
        )
    )
    reason = (
        F.when(F.lit(not donchian), "UNSUPPORTED_RANGE_METHOD")
        .when(atr.isNull() | F.col("_top").isNull() | F.col("_bottom").isNull(), "INSUFFICIENT_LOOKBACK")
        .when((F.col("_width") < c["range_min_atr"]) | (F.col("_width") > c["range_max_atr"]), "RANGE_OUT_OF_BOUNDS")
        .when(flag, "INTERNAL_LIQ_PRESENT")
        .otherwise("INTERNAL_LIQ_ABSENT")
    )
    out = out.withColumns(
        {
            "internal_liq_flag": flag,
            "internal_liq_reason_code": reason,
            "internal_liq_source_used": F.lit(c["source"]),
            "internal_liq_micro_near_level_flag": near,
        }
    )
    scratch = [n for n in out.columns if n.startswith("_") and n not in bars.columns and n != "_atr"]
    return out.withColumnRenamed("_atr", "internal_liq_atr").drop(*scratch)


# Zone family → its lower and upper price columns.
ZONES = {"fvg": ("fvg_lower", "fvg_upper"), "ob": ("ob_low", "ob_high"), "zmf_zone": ("zmf_zone_lo", "zmf_zone_hi")}


def level_overlap(levels: DataFrame, zones: DataFrame, family: str = "none", max_dist_atr: float = 0.0) -> DataFrame:
    """Whether a level lies within a band around a gap, block or zone of the same bar.

    zones: instrument, anchor_tf, ts and any of the price columns; family picks
    the flag: fvg, ob, zmf_zone, any, or none.
    """
    keys = ["instrument", "anchor_tf", "ts"]
    prices = [p for pair in ZONES.values() for p in pair if p in zones.columns]
    out = levels.join(zones.select(*keys, *prices), keys, "left")
    band = F.col("internal_liq_atr") * max_dist_atr

    def touches(level: str, lo: str, hi: str) -> Column:
        inside = (F.col(level) >= F.col(lo) - band) & (F.col(level) <= F.col(hi) + band)
        return F.coalesce(inside, F.lit(False))

    flags = {
        name: touches("internal_liq_level_high", lo, hi) | touches("internal_liq_level_low", lo, hi)
        for name, (lo, hi) in ZONES.items()
        if lo in prices and hi in prices
    }
    null = F.lit(None).cast("boolean")
    if family == "any":
        chosen = null
        for f in flags.values():
            chosen = f if chosen is null else chosen | f
    else:
        chosen = flags.get(family, null)
    return out.withColumns(
        {
            "internal_liq_fvg_overlap_flag": flags.get("fvg", null),
            "internal_liq_overlap_flag": chosen,
            "internal_liq_overlap_family_used": F.lit(family),
        }
    ).drop(*prices)


MICRO = {
    "micro_window_bars": 50,
    "micro_intensity_z_cut": 2.0,
    "micro_confirm_mode": "hybrid",
    "ofi_flip_min_events": 1,
    "agg_flip_min_events": 1,
    "spread_spike_z_cut": 0.0,
}


def micro_confirmation(flow: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """Sign flips of flow and imbalance, intensity and spread z-scores, confirmation flag.

    flow: bars with micro_ofi_value, micro_agg_imbalance, micro_intensity_events
    and optionally micro_spread.
    """
    c = settings(MICRO, cfg)
    w = max(5, c["micro_window_bars"])
    rows = Rows(by)
    sides = {"_ofi": sign(F.col("micro_ofi_value")), "_agg": sign(F.col("micro_agg_imbalance"))}
    out = flow.withColumns(sides)

    def flip(side: str) -> Column:
        now, before = F.col(side), rows.shift(F.col(side))
        # Null (no earlier bar) is not counted, as a null in a sum.
        return ((now != before) & (now != 0) & (before != 0)).cast("long")

    out = out.withColumns({"_ofi_flip": flip("_ofi"), "_agg_flip": flip("_agg")})
    events = F.col("micro_intensity_events")
    out = out.withColumns(
        {
            "internal_liq_ofi_flip_count_L": rows.sum(F.col("_ofi_flip"), w, 1),
            "internal_liq_agg_flip_count_L": rows.sum(F.col("_agg_flip"), w, 1),
            "internal_liq_intensity_z": zscore(events, rows.mean(events, w), rows.std(events, w)),
        }
    )
    if "micro_spread" in flow.columns:
        gap, cut = F.col("micro_spread"), c["spread_spike_z_cut"]
        out = out.withColumn("internal_liq_spread_z", zscore(gap, rows.mean(gap, w), rows.std(gap, w)))
        spike = F.abs("internal_liq_spread_z") >= cut if cut > 0 else F.lit(None).cast("boolean")
        out = out.withColumn("internal_liq_spread_spike_flag", spike)
    else:
        out = out.withColumns(
            {
                "internal_liq_spread_z": F.lit(None).cast("double"),
                "internal_liq_spread_spike_flag": F.lit(None).cast("boolean"),
            }
        )
    out = out.withColumns(
        {
            "internal_liq_ofi_flip_flag": F.col("internal_liq_ofi_flip_count_L") >= max(1, c["ofi_flip_min_events"]),
            "internal_liq_agg_flip_flag": F.col("internal_liq_agg_flip_count_L") >= max(1, c["agg_flip_min_events"]),
            "internal_liq_intensity_spike_flag": F.abs("internal_liq_intensity_z") >= c["micro_intensity_z_cut"],
        }
    )
    single = {
        "intensity_only": "internal_liq_intensity_spike_flag",
        "ofi_flip": "internal_liq_ofi_flip_flag",
        "agg_flip": "internal_liq_agg_flip_flag",
    }.get(c["micro_confirm_mode"].lower())
    confirm = (
        F.col(single)
        if single
        else F.col("internal_liq_ofi_flip_flag")
        | F.col("internal_liq_agg_flip_flag")
        | F.col("internal_liq_intensity_spike_flag")
    )
    return out.withColumns(
        {
            "internal_liq_micro_confirm_flag": confirm,
            "internal_liq_micro_source_used": F.lit("microstructure_flow"),
        }
    ).drop("_ofi", "_agg", "_ofi_flip", "_agg_flip")


MICRO_COLUMNS = (
    "internal_liq_micro_confirm_flag",
    "internal_liq_ofi_flip_flag",
    "internal_liq_ofi_flip_count_L",
    "internal_liq_agg_flip_flag",
    "internal_liq_agg_flip_count_L",
    "internal_liq_intensity_spike_flag",
    "internal_liq_intensity_z",
    "internal_liq_spread_z",
    "internal_liq_spread_spike_flag",
    "internal_liq_micro_source_used",
)


def attach_confirmation(levels: DataFrame, micro: DataFrame) -> DataFrame:
    """Confirmation columns on the level bars, gated by nearness where that is asked for."""
    keys = ["instrument", "anchor_tf", "ts"]
    out = levels.join(micro.select(*keys, *MICRO_COLUMNS), keys, "left")
    near, confirm = F.col("internal_liq_micro_near_level_flag"), F.col("internal_liq_micro_confirm_flag")
    return out.withColumn(
        "internal_liq_micro_confirm_flag", F.when(near.isNotNull(), confirm & near).otherwise(confirm)
    )
