"""Volatility, return and regime families over bars."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import clip, policy_ids, safe_div, settings
from ..functions.rolling import DAY, Rows, scaled_rank
from .blocks import exponential_means

VOL = {
    "atr_period": 14,
    "atr_smoothing": "wilder",
    "ret_window": 20,
    "ret_type": "pct",
    "min_periods_atr": 1,
    "min_periods_ret_std": 2,
    "min_periods_range_mean": 1,
}


def atr(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """atr_value and its alias ta_vol__atr: Wilder mean or simple mean of the true range."""
    c = settings(VOL, cfg)
    period = max(1, c["atr_period"])
    rows = Rows(by)
    out = bars.withColumn("_tr", rows.true_range())
    if c["atr_smoothing"] == "sma":
        out = out.withColumn("atr_value", rows.mean(F.col("_tr"), period, c["min_periods_atr"]))
    else:
        out = exponential_means(out, {"atr_value": (F.col("_tr"), 1.0 / period)}, by)
    return out.withColumn("ta_vol__atr", F.col("atr_value")).drop("_tr")


def return_range(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """ta_vol__ret1_std and ta_vol__range_mean."""
    c = settings(VOL, cfg)
    w = max(2, c["ret_window"])
    rows = Rows(by)
    out = bars.withColumn("_r", one_bar_return(rows, c["ret_type"]))
    return out.withColumns(
        {
            "ta_vol__ret1_std": rows.std(F.col("_r"), w, c["min_periods_ret_std"]),
            "ta_vol__range_mean": rows.mean(F.col("high") - F.col("low"), w, c["min_periods_range_mean"]),
        }
    ).drop("_r")


def one_bar_return(rows: Rows, kind: str = "pct"):
    close = F.col("close")
    return F.ln(close) - F.ln(rows.shift(close)) if kind == "log" else rows.pct_change(close)


def return_zscores(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """Return, absolute return and range with z-scores over the whole group.

    A zero deviation gives null. The group is a bounded one (a day of bars).
    """
    rows = Rows(by)
    out = bars.withColumns(
        {"stat_ts_return": rows.pct_change(F.col("close")), "stat_ts_range": F.col("high") - F.col("low")}
    )
    out = out.withColumn("stat_ts_vol", F.abs("stat_ts_return"))
    names = ("stat_ts_return", "stat_ts_vol", "stat_ts_range")
    moments = {}
    for n in names:
        # F.stddev_samp over a single row divides by zero under ANSI; it is null here.
        enough = F.count(n).over(rows.whole) >= 2
        moments[f"_m_{n}"] = F.avg(n).over(rows.whole)
        moments[f"_s_{n}"] = F.when(enough, F.stddev_samp(n).over(rows.whole))
    out = out.withColumns(moments)
    return out.withColumns(
        {f"{n}_zscore": safe_div(F.col(n) - F.col(f"_m_{n}"), F.col(f"_s_{n}"), None) for n in names}
    ).drop(*moments)


RANGE_REGIME = {
    "vol_range_lookback_bars": 200,
    "vol_range_zscore_window_bars": 200,
    "vol_range_compress_z_cut": -1.0,
    "vol_range_expand_z_cut": 1.0,
    "vol_range_regime_conf_cut": 0.55,
}


def range_regime(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """vol_range_*: mean range, its z-score, compress / expand / neutral, confidence."""
    c = settings(RANGE_REGIME, cfg)
    w = max(2, c["vol_range_lookback_bars"])
    zw = max(2, c["vol_range_zscore_window_bars"])
    lo, hi = c["vol_range_compress_z_cut"], c["vol_range_expand_z_cut"]
    rows = Rows(by)
    rng = F.col("high") - F.col("low")
    out = bars.withColumns(
        {
            "vol_range_lookback_bars": F.lit(w).cast("long"),
            "vol_range_realised_range": rows.mean(rng, w),
            "vol_range_range_z": safe_div(rng - rows.mean(rng, zw), rows.std(rng, zw)),
        }
    )
    z = F.col("vol_range_range_z")
    state = F.when(z <= lo, "compress").when(z >= hi, "expand").otherwise("neutral")
    full = max(abs(lo), abs(hi), 1e-9)
    return out.withColumns(
        {
            "vol_range_compress_flag": z <= lo,
            "vol_range_expand_flag": z >= hi,
            "vol_range_state": state,
            "vol_range_regime_id": state,
            "vol_range_regime_confidence": F.when(F.abs(z) < c["vol_range_regime_conf_cut"], 0.0).otherwise(
                clip(F.abs(z) / full, 0.0, 1.0)
            ),
        }
    )


CONSOLIDATION = {"lookback_bars": 20, "vol_z_window_bars": 200, "range_pct_max": 0.003, "vol_z_abs_max": 0.5}


def consolidation(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """consolidation_*: relative range and volatility z-score both within limits."""
    c = settings(CONSOLIDATION, cfg)
    w, zw = max(2, c["lookback_bars"]), max(5, c["vol_z_window_bars"])
    rows = Rows(by)
    out = bars.withColumns(
        {
            "consolidation_range_pct": safe_div(
                rows.max(F.col("high"), w) - rows.min(F.col("low"), w), F.col("close")
            ),
            "_r": rows.pct_change(F.col("close")),
        }
    )
    out = out.withColumn("_vol", rows.std(F.col("_r"), w))
    vol = F.col("_vol")
    out = out.withColumn("consolidation_vol_z", safe_div(vol - rows.mean(vol, zw), rows.std(vol, zw)))
    pct, z = F.col("consolidation_range_pct"), F.col("consolidation_vol_z")
    range_score = clip(1.0 - pct / c["range_pct_max"], 0.0, 1.0)
    vol_score = clip(1.0 - F.abs(z) / c["vol_z_abs_max"], 0.0, 1.0)
    both = F.least(F.coalesce(range_score, F.lit(0.0)), F.coalesce(vol_score, F.lit(0.0)))
    return out.withColumns(
        {
            "consolidation_score": F.when(pct.isNotNull() | z.isNotNull(), both),
            "consolidation_flag": F.coalesce(
                (pct <= c["range_pct_max"]) & (F.abs(z) <= c["vol_z_abs_max"]), F.lit(False)
            ),
            "consolidation_method": F.lit("range_vol_squeeze"),
        }
    ).drop("_r", "_vol")


VOL_BUCKET = {
    "unsup_n_clusters": 8,
    "unsup_min_confidence": 0.55,
    "unsup_clip_abs": 8.0,
    "unsup_conf_softmax_temp": 1.0,
    "unsup_entropy_high_cut": 1.5,
    "unsup_method": "kmeans",
    "unsup_feature_set_id": "windows_core_v1",
    "vol_window": 20,
    "z_window": 200,
}


def vol_bucket_regime(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """unsup_*: volatility percentile bucket within the group, with confidence.

    The rank needs the whole group, so ``by`` has to be a bounded one.
    """
    c = settings(VOL_BUCKET, cfg)
    n, w, zw = max(2, c["unsup_n_clusters"]), c["vol_window"], c["z_window"]
    rows = Rows(by)
    out = bars.withColumn("_r", rows.pct_change(F.col("close")))
    out = out.withColumn("_vol", rows.std(F.col("_r"), w))
    vol = F.col("_vol")
    z = clip(safe_div(vol - rows.mean(vol, zw), rows.std(vol, zw)), -c["unsup_clip_abs"], c["unsup_clip_abs"])
    out = out.withColumns({"_z": z, "_pct": scaled_rank(vol, by)})
    confidence = clip(F.abs("_z") / max(c["unsup_conf_softmax_temp"], 1e-6), 0.0, 1.0)
    bucket = F.least(F.floor(F.col("_pct") * n), F.lit(n - 1))
    out = out.withColumns(
        {
            "unsup_regime_id": F.when(F.col("_pct").isNotNull(), bucket.cast("string")),
            "unsup_regime_confidence": confidence,
            "unsup_method_used": F.lit(c["unsup_method"]),
            "unsup_feature_set_used": F.lit(c["unsup_feature_set_id"]),
            "unsup_model_id": F.lit(None).cast("string"),
            "unsup_fit_ts": F.lit(None).cast("timestamp_ntz"),
            "unsup_distance_to_centroid": F.lit(None).cast("double"),
            "unsup_logprob": F.lit(None).cast("double"),
        }
    )
    entropy = 1.0 - F.col("unsup_regime_confidence")
    return out.withColumns(
        {
            "unsup_entropy": entropy,
            "unsup_outlier_flag": (F.col("unsup_regime_confidence") < c["unsup_min_confidence"])
            | (entropy >= c["unsup_entropy_high_cut"]),
        }
    ).drop("_r", "_vol", "_z", "_pct")


CARRY = {
    "carry_slope_window_bars": 60,
    "carry_score_window_bars": 252,
    "carry_regime_flat_cut": 0.10,
    "carry_regime_strong_cut": 1.00,
    "carry_min_periods": 10,
    "carry_source": "external",
    "carry_proxy_method": "none",
}


def carry(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """carry_ts_*: mean return as carry, price slope, regime from the z-score of the mean."""
    c = settings(CARRY, cfg)
    slope_w = max(5, c["carry_slope_window_bars"])
    w, m = max(10, c["carry_score_window_bars"]), max(5, c["carry_min_periods"])
    flat, strong = c["carry_regime_flat_cut"], c["carry_regime_strong_cut"]
    rows = Rows(by)
    close = F.col("close")
    out = bars.withColumn("_r", rows.pct_change(close))
    out = out.withColumns(
        {
            "carry_ts_carry_score": rows.mean(F.col("_r"), w, m),
            "carry_ts_ts_slope": (close - rows.shift(close, slope_w)) / float(slope_w),
        }
    )
    score = F.col("carry_ts_carry_score")
    out = out.withColumn("_z", safe_div(score - rows.mean(score, w, m), rows.std(score, w, m)))
    z = F.col("_z")
    out = out.withColumn(
        "carry_ts_ts_regime",
        F.when(F.abs(z) < flat, "flat")
        .when(z >= strong, "contango")
        .when(z <= -strong, "backwardated")
        .otherwise("unknown"),
    )
    regime = F.col("carry_ts_ts_regime")
    return out.withColumns(
        {
            "carry_ts_level": F.lit(None).cast("double"),
            "carry_ts_level_z": F.lit(None).cast("double"),
            "carry_ts_slope_z": F.lit(None).cast("double"),
            "carry_ts_sign_bucket": F.when(regime == "contango", "positive")
            .when(regime == "backwardated", "negative")
            .when(regime == "flat", "flat")
            .otherwise("unknown"),
            "carry_ts_confidence": F.lit(None).cast("double"),
            "carry_ts_source_used": F.lit(c["carry_source"]),
            "carry_ts_proxy_method_used": F.lit(c["carry_proxy_method"]),
            "carry_ts_missing_flag": F.lit(False),
            "carry_ts_data_age_bars": F.lit(0).cast("long"),
        }
    ).drop("_r", "_z")


JUMP = {"jump_window_bars": 50, "jump_min_periods": 10, "jump_ret_type": "pct", "jump_bv_mu1": 2.0 / math.pi}


def jump_variation(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """jump_*: realised and bipower variation, their gap, and signed semivariances.

    The first bar has no return: it does not enter the realised variation, but
    counts as a zero in both semivariances.
    """
    c = settings(JUMP, cfg)
    w, m = max(2, c["jump_window_bars"]), max(1, c["jump_min_periods"])
    rows = Rows(by)
    out = bars.withColumn("_r", one_bar_return(rows, c["jump_ret_type"]))
    r = F.col("_r")
    pair = F.abs(r) * F.abs(rows.shift(r))
    out = out.withColumn("_bp", pair)
    out = out.withColumns(
        {
            "jump_rv": rows.sum(r * r, w, m),
            "jump_bv": rows.sum(F.col("_bp"), w, m) * c["jump_bv_mu1"],
            "jump_rs_plus": rows.sum(F.when(r > 0, r * r).otherwise(0.0), w, m),
            "jump_rs_minus": rows.sum(F.when(r < 0, r * r).otherwise(0.0), w, m),
        }
    )
    gap = F.col("jump_rv") - F.col("jump_bv")
    jv = F.when(gap.isNotNull(), F.greatest(gap, F.lit(0.0)))
    ids = policy_ids("jump_variation_v1", "jump_variation_thresholds_v1", cfg)
    return out.withColumns({"jump_jv": jv, **ids}).drop("_r", "_bp")


IMPACT = {
    "impact_window_bars": 50,
    "impact_min_periods": 10,
    "impact_lambda_low_cut": 1e-6,
    "impact_lambda_high_cut": 1e-4,
}


def price_impact(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """impact_*: slope of price change on signed volume, cost of a mean trade, regime."""
    c = settings(IMPACT, cfg)
    w, m = max(2, c["impact_window_bars"]), max(1, c["impact_min_periods"])
    rows = Rows(by)
    out = bars.withColumn("_dp", rows.diff(F.col("close")))
    dp = F.col("_dp")
    side = F.when(dp > 0, 1.0).when(dp < 0, -1.0).otherwise(0.0)
    out = out.withColumn("_q", F.col("volume") * side)
    q = F.col("_q")
    out = out.withColumn("impact_kyle_lambda", safe_div(rows.sum(dp * q, w, m), rows.sum(q * q, w, m), None))
    lam = F.col("impact_kyle_lambda")
    return out.withColumns(
        {
            "impact_cost_unit": lam * rows.mean(F.abs(q), w, m),
            "impact_lambda_regime": F.when(lam.isNull(), "unknown")
            .when(lam <= c["impact_lambda_low_cut"], "low")
            .when(lam >= c["impact_lambda_high_cut"], "high")
            .otherwise("medium"),
            **policy_ids("impact_lambda_v1", "impact_lambda_thresholds_v1", cfg),
        }
    ).drop("_dp", "_q")
