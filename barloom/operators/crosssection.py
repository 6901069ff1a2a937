"""Correlation and relative-value families over the instruments of a cluster.

Series windows run per (instrument, anchor_tf, dt); market means per
(cluster_id, anchor_tf, ts), whose size is the instrument count of a cluster.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expr import clip, safe_div, settings
from ..functions.rolling import DAY, Rows, long_frames, scaled_rank
from .peers import neighbours_json, primary_peer, top_peers

STAMP = ("cluster_id", "anchor_tf", "ts")

CORR = {
    "corr_window_bars": 50,
    "corr_min_periods": None,
    "corr_strong_cut": 0.5,
    "corr_clip_abs": 0.999,
    "corr_stability_window_bars": 200,
    "corr_flip_abs_delta_cut": 0.5,
    "corr_unstable_std_cut": 0.25,
    "corr_lag_max_bars": 5,
    "corr_vol_window_bars": 20,
    "corr_topk_neighbors": 5,
    "corr_topk_min_abs_corr": 0.5,
}


def with_cluster(bars: DataFrame, universe: DataFrame) -> DataFrame:
    """cluster_id by instrument; a cluster bounds which instruments meet each other."""
    return bars.join(universe.select("instrument", "cluster_id"), "instrument")


def with_returns(bars: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """ret, the one-bar return of each series."""
    return bars.withColumn("ret", Rows(by).pct_change(F.col("close")))


def with_market(bars: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """ret and the mean return of the cluster at the same time.

    The mean is a window, not a group and join back: one exchange on the time.
    """
    out = with_returns(bars, by)
    return out.withColumn("market_ret", F.avg("ret").over(W.partitionBy(*STAMP)))


def _mixed_corr(rows: Rows, x: Column, y: Column, w: int) -> Column:
    """(mean(xy) - mean(x)·mean(y)) / (std(x)·std(y)) with sample deviations.

    That is the correlation times (n-1)/n, and each mean skips its own nulls.
    """
    cov = rows.mean(x * y, w) - rows.mean(x, w) * rows.mean(y, w)
    return safe_div(cov, rows.std(x, w) * rows.std(y, w), None)


def market_correlation(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """corr_index_major and its copies from bars that carry ret and market_ret."""
    c = settings(CORR, cfg)
    w, cut = max(5, c["corr_window_bars"]), c["corr_clip_abs"]
    raw = _mixed_corr(Rows(by), F.col("ret"), F.col("market_ret"), w)
    out = bars.withColumn("corr_index_major", clip(raw, -cut, cut))
    same = F.col("corr_index_major")
    return out.withColumns(
        {"corr_dxy": same, "corr_oil": same, "corr_ref1": same, "corr_ref1_id": F.lit("MARKET")}
    )


def peer_correlation(
    bars: DataFrame, cfg: Mapping | None = None, panel: Sequence[str] | None = None, tiles: int = 1
) -> DataFrame:
    """corr_ref2/3 with ids and the JSON list of neighbours, joined to the bars."""
    c = settings(CORR, cfg)
    w = max(5, c["corr_window_bars"])
    m = c["corr_min_periods"] or max(10, w // 2)
    chosen = {
        "window": w,
        "min_periods": m,
        "topk": c["corr_topk_neighbors"],
        "min_abs": c["corr_topk_min_abs_corr"],
    }
    found = top_peers(bars, chosen, panel or ("cluster_id", "anchor_tf", "dt"), tiles)
    refs = {}
    for slot, k in (("ref2", 0), ("ref3", 1)):
        refs[f"corr_{slot}_id"] = F.get("peers", F.lit(k))
        refs[f"corr_{slot}"] = F.get("corrs", F.lit(k))
    refs["corr_topk_neighbors_json"] = neighbours_json(F.col("peers"), F.col("corrs"))
    found = found.withColumns(refs).drop("peers", "corrs")
    return bars.join(found, ["cluster_id", "anchor_tf", "instrument", "ts"], "left")


def correlation_state(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """micro_corr_*: sign and strength of the strongest reference, stability, flips, regime."""
    c = settings(CORR, cfg)
    w = max(5, c["corr_window_bars"])
    m = c["corr_min_periods"] or max(10, w // 2)
    strong = c["corr_strong_cut"]
    rows = Rows(by)
    refs = [F.col(f"corr_ref{i}") for i in (1, 2, 3)]
    sizes = [F.coalesce(F.abs(r), F.lit(0.0)) for r in refs]
    largest = F.greatest(*sizes)
    best = F.when(sizes[0] == largest, refs[0]).when(sizes[1] == largest, refs[1]).otherwise(refs[2])
    ref1, before = refs[0], rows.shift(refs[0])
    out = bars.withColumns(
        {
            "_best": best,
            "micro_corr_confidence": F.when(rows.count(F.col("ret"), w) >= m, 1.0).otherwise(0.0),
            "micro_corr_std": rows.std(ref1, max(5, c["corr_stability_window_bars"]), m),
            "micro_corr_flip_flag": (ref1 * before < 0) | (F.abs(ref1 - before) >= c["corr_flip_abs_delta_cut"]),
            "micro_corr_regime": F.when(ref1 >= strong, "aligned")
            .when(ref1 <= -strong, "divergent")
            .otherwise("unstable"),
        }
    )
    return out.withColumns(
        {
            "micro_corr_sign": F.when(F.col("_best").isNotNull(), F.when(F.col("_best") >= 0, "pos").otherwise("neg")),
            "micro_corr_strength": clip(F.abs("_best"), 0.0, 1.0),
            "micro_corr_unstable_flag": F.col("micro_corr_std") >= c["corr_unstable_std_cut"],
            "corr_cluster_id": _cluster_label(F.col("micro_corr_regime")),
        }
    ).drop("_best")


def _cluster_label(regime: Column) -> Column:
    return (
        F.when(regime == "aligned", "cluster_pos").when(regime == "divergent", "cluster_neg").otherwise("cluster_neutral")
    )


def lagged_correlation(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """Largest |correlation| with the shifted market, and its lag (the last lag wins ties).

    Negative lags read later market returns.
    """
    c = settings(CORR, cfg)
    w, most = max(5, c["corr_window_bars"]), max(0, c["corr_lag_max_bars"])
    rows = Rows(by)
    lags = range(-most, most + 1)
    ret, mkt = F.col("ret"), F.col("market_ret")
    out = bars.withColumns(
        {
            "_m_ret": rows.mean(ret, w),
            "_s_ret": rows.std(ret, w),
            "_m_mkt": rows.mean(mkt, w),
            "_s_mkt": rows.std(mkt, w),
            **{f"_xy_{i}": ret * rows.shift(mkt, lag) for i, lag in enumerate(lags)},
        }
    )
    # The rolling moments of a shifted series are the shifted rolling moments, so
    # only the products need a frame of their own per lag.
    out = out.withColumns(
        {
            **{f"_xy_{i}": rows.mean(F.col(f"_xy_{i}"), w) for i in range(len(lags))},
            **{f"_my_{i}": rows.shift(F.col("_m_mkt"), lag) for i, lag in enumerate(lags)},
            **{f"_sy_{i}": rows.shift(F.col("_s_mkt"), lag) for i, lag in enumerate(lags)},
        }
    )
    out = out.withColumns(
        {
            f"_xc_{i}": F.abs(
                safe_div(
                    F.col(f"_xy_{i}") - F.col("_m_ret") * F.col(f"_my_{i}"), F.col("_s_ret") * F.col(f"_sy_{i}"), None
                )
            )
            for i in range(len(lags))
        }
    )
    sizes = [F.col(f"_xc_{i}") for i in range(len(lags))]
    largest = F.greatest(*sizes) if len(sizes) > 1 else sizes[0]
    out = out.withColumn("corr_ref1_xcorr_max", largest)
    lag_at = F.lit(None).cast("long")
    for lag, size in zip(lags, sizes):
        lag_at = F.when(size == F.col("corr_ref1_xcorr_max"), F.lit(lag).cast("long")).otherwise(lag_at)
    return out.withColumn("corr_ref1_xcorr_lag_bars", lag_at).drop(
        "_m_ret",
        "_s_ret",
        "_m_mkt",
        "_s_mkt",
        *[f"_{part}_{i}" for part in ("xy", "my", "sy", "xc") for i in range(len(lags))],
    )


def volatility_correlation(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """corr_vol_ref1..3: volatility against the market's and the two peers'."""
    c = settings(CORR, cfg)
    w = max(3, c["corr_vol_window_bars"])
    rows = Rows(by)
    out = bars.withColumn("_vol", rows.std(F.col("ret"), w, max(3, w // 2)))
    out = out.withColumn("_market_vol", F.avg("_vol").over(W.partitionBy(*STAMP)))
    own = out.select(
        *STAMP[:2], "ts", F.col("instrument").alias("_peer"), F.col("_vol").alias("_peer_vol")
    )
    for slot in (2, 3):
        right = own.withColumnsRenamed({"_peer": f"corr_ref{slot}_id", "_peer_vol": f"_vol_{slot}"})
        out = out.join(right, [*STAMP, f"corr_ref{slot}_id"], "left")
    vol = F.col("_vol")
    return out.withColumns(
        {
            "corr_vol_ref1": _mixed_corr(rows, vol, F.col("_market_vol"), w),
            "corr_vol_ref2": _mixed_corr(rows, vol, F.col("_vol_2"), w),
            "corr_vol_ref3": _mixed_corr(rows, vol, F.col("_vol_3"), w),
        }
    ).drop("_vol", "_market_vol", "_vol_2", "_vol_3")


SLOW_CORR = {
    "corr_htf_window_bars": 500,
    "corr_htf_min_periods": 100,
    "corr_htf_clip_abs": 0.999,
    "corr_htf_cluster_stability_cut": 0.70,
    "peer_min_abs": 0.5,
}


def slow_correlation(
    bars: DataFrame,
    cfg: Mapping | None = None,
    by: Sequence[str] = DAY,
    panel: Sequence[str] | None = None,
    tiles: int = 1,
) -> DataFrame:
    """corr_htf_* and htf_*: as the fast families, one long window, two peers."""
    c = settings(SLOW_CORR, cfg)
    w, m, cut = max(5, c["corr_htf_window_bars"]), c["corr_htf_min_periods"], c["corr_htf_clip_abs"]
    x, y = F.col("ret"), F.col("market_ret")
    out = long_frames(
        bars,
        {"_xy": ("mean", x * y, w, None), "_x": ("mean", x, w, None), "_y": ("mean", y, w, None), "_sx": ("std", x, w, None), "_sy": ("std", y, w, None)},
        by,
    )
    raw = safe_div(F.col("_xy") - F.col("_x") * F.col("_y"), F.col("_sx") * F.col("_sy"), None)
    out = out.withColumns({"corr_htf_ref1": clip(raw, -cut, cut), "corr_htf_ref1_id": F.lit("MARKET")}).drop("_xy", "_x", "_y", "_sx", "_sy")
    found = top_peers(
        bars,
        {"window": w, "min_periods": m, "topk": 2, "min_abs": c["peer_min_abs"]},
        panel or ("cluster_id", "anchor_tf", "dt"),
        tiles,
    )
    refs = {}
    for slot, k in (("ref2", 0), ("ref3", 1)):
        refs[f"corr_htf_{slot}_id"] = F.get("peers", F.lit(k))
        refs[f"corr_htf_{slot}"] = F.get("corrs", F.lit(k))
    found = found.withColumns(refs).drop("peers", "corrs")
    ref1 = F.col("corr_htf_ref1")
    regime = F.when(
        ref1.isNotNull(),
        F.when(F.abs(ref1) < 0.2, "unstable").when(ref1 >= 0, "aligned").otherwise("divergent"),
    )
    out = long_frames(out, {"_std": ("std", ref1, w, m)}, by).withColumns(
        {
            "htf_corr_regime": regime,
            "htf_corr_confidence": F.abs(ref1),
            "corr_cluster_confidence_htf": F.abs(ref1),
        }
    )
    stable = c["corr_htf_cluster_stability_cut"]
    out = out.withColumns(
        {
            "corr_cluster_id_htf": _cluster_label(F.col("htf_corr_regime")),
            "corr_cluster_stability_htf": (
                clip(1 - F.col("_std") / stable, 0.0, 1.0) if stable > 0 else F.lit(None).cast("double")
            ),
        }
    ).drop("_std")
    return out.join(found, ["cluster_id", "anchor_tf", "instrument", "ts"], "left")


RELVAL = {
    "xs_relval_spread_type": "log_ratio",
    "xs_relval_spread_z_window": 60,
    "xs_relval_z_clip_abs": 8.0,
    "xs_relval_bucket_mild_cut": 1.5,
    "xs_relval_bucket_strong_cut": 2.5,
    "xs_relval_peer_set_id": "cluster_peers",
    "xs_relval_primary_peer_method": "max_abs_corr",
    "xs_relval_primary_peer_min_corr": 0.50,
    "xs_relval_coint_window_bars": 500,
    "beta_ddof": 1,
}


def spread(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """xs_relval_spread_*: level against the cluster, clipped z-score, bucket, signal, role.

    bars carry ret; for hedged_residual they also carry xs_relval_residual.
    """
    c = settings(RELVAL, cfg)
    w, cap = max(5, c["xs_relval_spread_z_window"]), c["xs_relval_z_clip_abs"]
    m = max(3, w // 3)
    mild, strong = c["xs_relval_bucket_mild_cut"], c["xs_relval_bucket_strong_cut"]
    stamp = W.partitionBy(*STAMP)
    close, kind = F.col("close"), c["xs_relval_spread_type"]
    if kind == "log_ratio":
        level = F.ln(close) - F.avg(F.ln(close)).over(stamp)
    elif kind == "price_ratio":
        level = safe_div(close, F.avg(close).over(stamp), None) - 1.0
    elif kind == "hedged_residual":
        level = F.col("xs_relval_residual")
    else:
        level = F.col("ret") - F.avg("ret").over(stamp)
    rows = Rows(by)
    out = bars.withColumn("xs_relval_spread_level", level)
    x = F.col("xs_relval_spread_level")
    z = safe_div(x - rows.mean(x, w, m), rows.std(x, w, m), None)
    out = out.withColumn("xs_relval_spread_zscore", clip(z, -cap, cap))
    z = F.col("xs_relval_spread_zscore")
    strength = clip(F.abs(z) / strong, 0.0, 1.0) if strong > 0 else F.lit(0.0)

    def tri(low: str, high: str) -> Column:
        return F.when(z <= -mild, low).when(z >= mild, high).otherwise("neutral")

    return out.withColumns(
        {
            "xs_relval_spread_bucket": F.when(z <= -strong, "far_undervalued")
            .when(z <= -mild, "undervalued")
            .when(z >= strong, "far_overvalued")
            .when(z >= mild, "overvalued")
            .otherwise("fair"),
            "xs_relval_signal": tri("long", "short"),
            "xs_relval_signal_strength": strength,
            "xs_relval_primary_peer_role": tri("buy_this", "sell_this"),
            "xs_relval_peer_set_used": F.lit(c["xs_relval_peer_set_id"]),
        }
    )


def cross_ranks(bars: DataFrame, by: Sequence[str] = DAY) -> DataFrame:
    """Ranks of return and short mean return among the cluster, and the peer count."""
    rows = Rows(by)
    out = bars.withColumn("_momo", rows.mean(F.col("ret"), 5, 2))
    return out.withColumns(
        {
            "xs_relval_carry_rank": scaled_rank(F.col("ret"), STAMP),
            "xs_relval_momo_rank": scaled_rank(F.col("_momo"), STAMP),
            "xs_relval_peer_count": F.count(F.lit(1)).over(W.partitionBy(*STAMP)),
        }
    ).drop("_momo")


def primary_hedge(
    bars: DataFrame, cfg: Mapping | None = None, panel: Sequence[str] | None = None, tiles: int = 1
) -> DataFrame:
    """xs_relval_primary_peer* and residual columns, joined to the bars.

    The p-value column is 1 - |correlation|, a stand-in and not a test result.
    """
    c = settings(RELVAL, cfg)
    w = max(10, c["xs_relval_coint_window_bars"])
    chosen = {
        "window": w,
        "min_periods": max(5, w // 3),
        "method": c["xs_relval_primary_peer_method"],
        "min_corr": c["xs_relval_primary_peer_min_corr"],
        "beta_ddof": c["beta_ddof"],
    }
    found = primary_peer(bars, chosen, panel or ("cluster_id", "anchor_tf", "dt"), tiles)
    named = found.select(
        "cluster_id",
        "anchor_tf",
        "instrument",
        "ts",
        F.col("peer").alias("xs_relval_primary_peer"),
        F.col("corr").alias("xs_relval_primary_peer_corr"),
        F.col("beta").alias("xs_relval_primary_peer_beta"),
        (1.0 - F.least(F.lit(1.0), F.abs("corr"))).alias("_p"),
        F.col("half_life").alias("xs_relval_half_life_bars"),
        F.col("residual").alias("xs_relval_residual"),
        F.col("residual_z").alias("xs_relval_residual_z"),
    )
    named = named.withColumn(
        "xs_relval_coint_pvalue", F.when(F.col("xs_relval_primary_peer").isNotNull(), F.col("_p"))
    ).drop("_p")
    return bars.join(named, ["cluster_id", "anchor_tf", "instrument", "ts"], "left")
