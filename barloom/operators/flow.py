"""Order-flow, bar-shape and zone families from ticks and bars."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import bucket_by_edges, clamp01, column_or, map_values, policy_ids, safe_div, settings, zscore
from ..functions.rolling import DAY, Rows
from ..functions.sliding import sliding_quantiles
from ..functions.timegrid import anchor_grid, snap
from .bars import order_key
from .blocks import in_blocks

# Side texts of a trade.
BUY_SIDES = ("buy", "bid", "long")
SELL_SIDES = ("sell", "ask", "short")


def options_context(bars: DataFrame, cfg: Mapping | None = None) -> DataFrame:
    """Anchor keys with policy ids, as a carrier for option data."""
    keys = bars.select("instrument", "anchor_tf", "ts").distinct()
    return keys.withColumns(policy_ids("options_context_v1", "options_context_thresholds_v1", cfg))


BAR_FLOW = {
    "vol_z_window": 100,
    "vol_z_medium_high_cut": 1.0,
    "vol_z_low_high_cut": 2.0,
    "ofi_strong_cut": 0.5,
    "range_bucket_window": 250,
    "range_q_low": 0.33,
    "range_q_high": 0.66,
}


def bar_flow(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """pcr_*: signed volume relative to its mean, volume z-score, range and close location."""
    c = settings(BAR_FLOW, cfg)
    w, qw = c["vol_z_window"], c["range_bucket_window"]
    rows = Rows(by)
    volume, rng = F.col("volume"), F.col("high") - F.col("low")
    mean, std = rows.mean(volume, w), rows.std(volume, w)
    signed = F.when(F.col("close") >= F.col("open"), volume).otherwise(-volume)
    out = bars.withColumns(
        {
            "pcr_ofi_value": safe_div(signed, mean),
            "pcr_micro_vol_value": zscore(volume, mean, std),
            "pcr_range_value": rng,
        }
    )
    out = sliding_quantiles(out, {"_q_lo": (rng, c["range_q_low"], qw, None), "_q_hi": (rng, c["range_q_high"], qw, None)}, by)
    location = clamp01(safe_div(F.col("close") - F.col("low"), rng, 0.5))
    strong = c["ofi_strong_cut"]
    return out.withColumns(
        {
            "pcr_micro_vol_bucket": bucket_by_edges(
                F.col("pcr_micro_vol_value"),
                [c["vol_z_medium_high_cut"], c["vol_z_low_high_cut"]],
                ["low", "medium", "high"],
            ),
            "pcr_ofi_bucket": bucket_by_edges(
                F.col("pcr_ofi_value"), [-strong, strong], ["strong_sell", "balanced", "strong_buy"]
            ),
            "pcr_range_bucket": bucket_by_edges(
                F.col("pcr_range_value"), [F.col("_q_lo"), F.col("_q_hi")], ["narrow", "normal", "wide"]
            ),
            "pcr_clv_bucket": bucket_by_edges(location, [0.33, 0.66], ["lower", "mid", "upper"]),
        }
    ).drop("_q_lo", "_q_hi")


TICK_PRESSURE = {
    "tick_window": 50,
    "tick_imbalance_ratio_threshold": 0.6,
    "tick_concentration_ratio_at_threshold": 2.0,
    "tick_sweep_range_ticks_threshold": 3.0,
    "tick_absorption_volume_threshold": 2.0,
    "tick_absorption_range_ticks_threshold": 1.0,
    "tick_delta_z_strong": 2.0,
}


def with_trade_fields(ticks: DataFrame) -> DataFrame:
    """size defaults to 1, side to null; rows without instrument or ts go."""
    return ticks.withColumns(
        {"size": column_or(ticks, "size", "double", 1.0), "side": column_or(ticks, "side", "string")}
    ).dropna(subset=["instrument", "ts"])


def direction(rows: Rows) -> Column:
    """+1 / -1 from the side text, else from the tick rule (no lower price → +1)."""
    uptick = F.col("price") >= rows.shift(F.col("price"))
    return (
        F.when(F.col("side").isin(*BUY_SIDES), 1.0)
        .when(F.col("side").isin(*SELL_SIDES), -1.0)
        .otherwise(F.when(uptick, 1.0).otherwise(-1.0))
    )


def _pressure(ticks: DataFrame, c: Mapping, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    w = c["tick_window"]
    rows = Rows(by, order)
    out = ticks.withColumns(
        {"_delta": F.col("size") * direction(rows), "_move": F.abs(rows.diff(F.col("price")))}
    )
    size, delta = F.col("size"), F.col("_delta")
    total, net = rows.sum(size, w), rows.sum(delta, w)
    out = out.withColumns(
        {
            "pcr_tick_total_volume_units": total,
            "pcr_tick_delta_units": net,
            "pcr_tick_delta_z": zscore(delta, rows.mean(delta, w), rows.std(delta, w)),
            "pcr_tick_imbalance_ratio": safe_div(F.abs(net), total),
            "pcr_tick_concentration_ratio_at": safe_div(size, rows.mean(size, w)),
        }
    )
    strong, move = c["tick_delta_z_strong"], F.col("_move")
    return out.withColumns(
        {
            "pcr_tick_imbalance_flag": F.col("pcr_tick_imbalance_ratio") >= c["tick_imbalance_ratio_threshold"],
            "pcr_tick_concentration_flag_at": F.col("pcr_tick_concentration_ratio_at")
            >= c["tick_concentration_ratio_at_threshold"],
            "pcr_tick_sweep_flag": move >= c["tick_sweep_range_ticks_threshold"],
            "pcr_tick_absorption_flag": (size >= c["tick_absorption_volume_threshold"])
            & (move <= c["tick_absorption_range_ticks_threshold"]),
            "pcr_footprint_pattern": F.when(F.col("pcr_tick_delta_z") >= strong, "aggressive_buy")
            .when(F.col("pcr_tick_delta_z") <= -strong, "aggressive_sell")
            .otherwise("balanced"),
        }
    ).drop("_delta", "_move")


def tick_pressure(
    ticks: DataFrame,
    anchor_tf: str = "tick",
    tie: str | None = None,
    cfg: Mapping | None = None,
    slice_unit: str = "minute",
    block_rows: int = 100_000,
) -> DataFrame:
    """pcr_tick_*: pressure over the last ticks of an instrument's day.

    A day of ticks has no size bound, so rows are numbered per time slice and
    the frames run over blocks with a halo of one window.
    """
    c = settings(TICK_PRESSURE, cfg)
    order = ["ts", tie] if tie else ["ts"]
    prepared = with_trade_fields(ticks).withColumn("dt", F.to_date("ts"))
    out = in_blocks(
        prepared,
        ["instrument", "dt"],
        order,
        lambda df, by: _pressure(df, c, by, order),
        back=c["tick_window"] + 1,
        block_rows=block_rows,
        slice_by=F.date_trunc(slice_unit, F.col("ts")),
    )
    return out.withColumns({"anchor_tf": F.lit(anchor_tf), "pcr_window_ts": F.col("ts")})


FLOW = {"micro_agg_imbalance_abs_cut": 0.2, "micro_intensity_low_cut": 25, "micro_intensity_high_cut": 250}


def signed_ticks(ticks: DataFrame, tie: str | None = None, slice_unit: str = "minute") -> DataFrame:
    """Ticks with signed_size.

    Ticks with a known side need no neighbour. The tick rule of the others needs
    the previous price of the instrument's day: lag inside a time slice, and the
    last price of the nearest earlier slice for the first tick of a slice.
    """
    order = ["ts", tie] if tie else ["ts"]
    key = ["instrument", "dt", "_slice"]
    base = with_trade_fields(ticks).withColumns(
        {"dt": F.to_date("ts"), "_slice": F.date_trunc(slice_unit, F.col("ts"))}
    )
    ends = base.groupBy(*key).agg(F.max_by("price", order_key(F.col("ts"), F.col(tie) if tie else None)).alias("_end"))
    earlier = Rows(["instrument", "dt"], ["_slice"])
    ends = ends.select(*key, earlier.shift(F.col("_end")).alias("_before"))
    rows = Rows(key, order)
    previous = F.coalesce(rows.shift(F.col("price")), F.col("_before"))
    side = (
        F.when(F.col("side").isin(*BUY_SIDES), 1.0)
        .when(F.col("side").isin(*SELL_SIDES), -1.0)
        .otherwise(F.when(F.col("price") >= previous, 1.0).otherwise(-1.0))
    )
    return base.join(ends, key).withColumn("signed_size", F.col("size") * side).drop("_slice", "_before")


def side_signed(ticks: DataFrame) -> DataFrame:
    """signed_size for ticks that all carry a side: no shuffle at all."""
    side = F.when(F.col("side").isin(*BUY_SIDES), 1.0).when(F.col("side").isin(*SELL_SIDES), -1.0)
    return with_trade_fields(ticks).withColumn("signed_size", F.col("size") * side)


def flow_sums(signed: DataFrame, tf: str) -> DataFrame:
    """Total size, signed size and tick count per bar."""
    return (
        signed.groupBy("instrument", snap(F.col("ts"), tf).alias("ts"))
        .agg(
            F.sum("size").alias("total_size"),
            F.sum("signed_size").alias("delta_size"),
            F.count("signed_size").alias("ticks"),
        )
        .withColumn("anchor_tf", F.lit(tf))
    )


def label_flow(sums: DataFrame, cfg: Mapping | None = None) -> DataFrame:
    """micro_* values and buckets from the sums of a bar."""
    c = settings(FLOW, cfg)
    cut = float(c["micro_agg_imbalance_abs_cut"])
    imbalance = safe_div(F.col("delta_size"), F.col("total_size"), None)
    events = F.col("ticks").cast("double")
    return sums.withColumns(
        {
            "micro_ofi_value": F.col("delta_size"),
            "micro_agg_imbalance": imbalance,
            "micro_agg_imbalance_bucket": F.when(imbalance >= cut, "buy_dominant")
            .when(imbalance <= -cut, "sell_dominant")
            .otherwise("balanced"),
            "micro_intensity_events": events,
            "micro_intensity_bucket": F.when(events >= c["micro_intensity_high_cut"], "high")
            .when(events <= c["micro_intensity_low_cut"], "low")
            .otherwise("normal"),
        }
    ).drop("total_size", "delta_size", "ticks")


def bucketed_flow(bars: DataFrame, signed: DataFrame, tf: str, cfg: Mapping | None = None) -> DataFrame:
    """micro_* on every bar of one timeframe; bars without ticks stay null."""
    grid = anchor_grid(bars.where(F.col("anchor_tf") == tf), tf)
    flow = label_flow(flow_sums(signed, tf), cfg)
    ids = policy_ids("micro_flow_v1", "micro_flow_thresholds_v1", cfg)
    return grid.join(flow, ["instrument", "anchor_tf", "ts"], "left").withColumns(ids)


BAR_PATH = {
    "impulse_threshold": 0.65,
    "rejection_body_ratio_max": 0.25,
    "start_offset_bars": -2,
    "mid_offset_bars": -1,
    "end_offset_bars": 1,
    "regime_half_window_bars": 5,
    "regime_flat_body_ratio_max": 0.10,
    "regime_impulsive_body_ratio_min": 0.25,
    "regime_trend_body_ratio_min": 0.35,
    "regime_trend_wick_ratio_max": 0.35,
}


def bar_path(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """pac_*: bar colours around the anchor, rejection, follow-through, path regime.

    Offsets are shifts: the negative start and mid offsets read later bars
    (look-ahead), the positive end offset an earlier one.
    """
    c = settings(BAR_PATH, cfg)
    half = max(1, c["regime_half_window_bars"])
    w, m = 2 * half + 1, max(3, half)
    rows = Rows(by)
    o, h, l, x = (F.col(n) for n in ("open", "high", "low", "close"))
    span = F.when(h - l == 0, 1.0).otherwise(h - l)
    colour = F.when(x - o > 0, "bull").when(x - o < 0, "bear").otherwise("doji")
    out = bars.withColumns(
        {
            "pac_micro_state_anchor": colour,
            "_body": F.abs(x - o) / span,
            "_wick": F.greatest(h - F.greatest(o, x), F.least(o, x) - l) / span,
        }
    )
    state, impulse = F.col("pac_micro_state_anchor"), c["impulse_threshold"]
    shifts = {
        "pac_micro_state_pre_entry": 1,
        "pac_micro_state_post_entry": -1,
        "pac_micro_state_start": c["start_offset_bars"],
        "pac_micro_state_mid": c["mid_offset_bars"],
        "pac_micro_state_end": c["end_offset_bars"],
    }
    out = out.withColumns(
        {
            **{n: F.coalesce(rows.shift(state, k), F.lit("na")) for n, k in shifts.items()},
            "_body_w": rows.mean(F.col("_body"), w, m),
            "_wick_w": rows.mean(F.col("_wick"), w, m),
        }
    )
    body, wick = F.col("_body_w"), F.col("_wick_w")
    return out.withColumns(
        {
            "pac_path_regime": F.when(body.isNull() | wick.isNull(), "unknown")
            .when(body <= c["regime_flat_body_ratio_max"], "flat")
            .when((wick >= impulse) & (body >= c["regime_impulsive_body_ratio_min"]), "impulsive")
            .when(
                (body >= c["regime_trend_body_ratio_min"]) & (wick <= c["regime_trend_wick_ratio_max"]), "trend"
            )
            .otherwise("chop"),
            "pac_entry_immediate_rejection_flag": (F.col("_wick") >= impulse)
            & (F.col("_body") <= c["rejection_body_ratio_max"]),
            "pac_entry_immediate_followthrough_flag": state.isin("bull", "bear")
            & (state == F.col("pac_micro_state_post_entry")),
        }
    ).drop("_body", "_wick", "_body_w", "_wick_w")


PROFILE = {
    "vp_hvn_lvn_ratio_cut": 1.5,
    "vp_thin_total_volume_cut_units": 0.0,
    "vp_skew_abs_strong_cut": 0.35,
    "vp_mean_volume_window_bars": 50,
    "vp_mean_volume_min_periods": 10,
}

# Profile type → bucket.
PROFILE_BUCKETS = {
    "balanced_hvn": "hvn",
    "rejection_lvn": "lvn",
    "skewed_high": "skew_high",
    "skewed_low": "skew_low",
    "thin": "thin",
}


def volume_profile(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """zone_vp_*: a one-bar volume profile stand-in with its type."""
    c = settings(PROFILE, cfg)
    w = max(1, c["vp_mean_volume_window_bars"])
    m = max(1, min(w, c["vp_mean_volume_min_periods"]))
    ratio, strong = c["vp_hvn_lvn_ratio_cut"], c["vp_skew_abs_strong_cut"]
    rows = Rows(by)
    volume = column_or(bars, "volume", "double", 0.0)
    mid, span = (F.col("high") + F.col("low")) / 2.0, F.col("high") - F.col("low")
    wide = F.greatest(span, F.lit(1e-12))
    mean = rows.mean(volume, w, m)
    out = bars.withColumns(
        {
            "zone_id": F.concat_ws("::", F.lit("vp_core"), F.col("instrument"), F.col("anchor_tf")),
            "zone_vp_total_volume_units": volume,
            "zone_vp_poc_price": mid,
            "zone_vp_poc_relative_position": F.when(span == 0, 0.5).otherwise(
                clamp01((mid - F.col("low")) / wide)
            ),
            "zone_vp_volume_lower_units": volume * 0.5,
            "zone_vp_volume_upper_units": volume * 0.5,
            "zone_vp_skew": F.when(span == 0, 0.0).otherwise((F.col("close") - mid) / wide),
            "zone_vp_hvn_flag": F.coalesce(volume >= mean * ratio, F.lit(False)),
            "zone_vp_lvn_flag": F.coalesce(volume <= mean / ratio, F.lit(False)),
        }
    )
    out = out.withColumn(
        "zone_vp_type",
        F.when(F.col("zone_vp_total_volume_units") <= c["vp_thin_total_volume_cut_units"], "thin")
        .when(F.col("zone_vp_skew") >= strong, "skewed_high")
        .when(F.col("zone_vp_skew") <= -strong, "skewed_low")
        .when(F.col("zone_vp_hvn_flag"), "balanced_hvn")
        .when(F.col("zone_vp_lvn_flag"), "rejection_lvn")
        .otherwise("balanced_hvn"),
    )
    return out.withColumn("zone_vp_type_bucket", map_values(F.col("zone_vp_type"), PROFILE_BUCKETS, "unknown"))


def day_range_zone(bars: DataFrame) -> DataFrame:
    """zmf_zone_*: the high, low, middle and width of the day on each of its bars."""
    keys = ["instrument", "anchor_tf", "dt"]
    day = bars.groupBy(*keys).agg(
        F.max("high").cast("double").alias("zmf_zone_hi"), F.min("low").cast("double").alias("zmf_zone_lo")
    )
    grid = bars.select(*keys, "ts").distinct()
    out = grid.join(day, keys).withColumns(
        {
            "zone_id": F.concat_ws("::", F.lit("DAY_RANGE"), F.col("dt").cast("string"), F.col("anchor_tf")),
            "zmf_zone_kind": F.lit("DAY_RANGE"),
            "zmf_zone_mid": (F.col("zmf_zone_hi") + F.col("zmf_zone_lo")) / 2.0,
            "zmf_zone_width": F.col("zmf_zone_hi") - F.col("zmf_zone_lo"),
        }
    )
    # Context buckets of the day zone.
    return out.withColumns(
        {
            "zmf_zone_behaviour_type_bucket": F.lit("mixed"),
            "zmf_zone_freshness_bucket": F.lit("fresh"),
            "zmf_zone_stack_depth_bucket": F.lit("single"),
            "zmf_zone_htf_confluence_bucket": F.lit("single"),
        }
    )
