"""Trend, volatility, flow, cross-section and calendar families (F-01 … F-29, F-70)."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import crosssection as cs
from barloom.operators import flow, trend, volatility
from barloom.operators.blocks import in_blocks
from barloom.operators.calendar import blackout_flags, macro_regime
from barloom.operators.peers import in_panel_blocks, top_peers
from barloom.plans.features import POLICY, family_frame

from .base import (
    BY_ALL, BY_DAY, BY_YEAR, CALENDAR, D1, M15, TICKS, YEAR,
    check, div, lag, mean, over, query, std, total, true_range,
)

KEYS = ("instrument", "anchor_tf", "ts")
K = "instrument, anchor_tf, ts"


def ewm(x: str, alpha: float, by: str) -> str:
    """Recursive mean by folding the list of all values so far."""
    return (
        f"list_reduce(list(CAST({x} AS DOUBLE)) OVER (PARTITION BY {by} ORDER BY ts), "
        f"lambda a, v: a * {1 - alpha!r}::DOUBLE + v * {alpha!r}::DOUBLE)"
    )


# --- trend ------------------------------------------------------------------------------


@check(
    "F-01",
    query(M15, f"""SELECT {K}, {ewm('close', 2 / 21, BY_DAY)} AS ema_fast, {ewm('close', 2 / 51, BY_DAY)} AS ema_slow
    FROM bars""", "ema_fast ema_slow"),
)
def _(d):
    return trend.ema(d.bars()).select(*KEYS, "ema_fast", "ema_slow")


@check(
    "F-01_continuous",
    query(M15, f"""SELECT {K}, {ewm('close', 2 / 21, BY_ALL)} AS ema_fast, {ewm('close', 2 / 51, BY_ALL)} AS ema_slow
    FROM bars""", "ema_fast ema_slow"),
)
def _(d):
    back = trend.memory_rows(2 / 51)
    out = in_blocks(d.bars(), ["instrument", "anchor_tf"], ["ts"], lambda df, by: trend.ema(df, None, by), back=back)
    return out.select(*KEYS, "ema_fast", "ema_slow")


RSI_SQL = f"""SELECT {K}, CASE WHEN i >= 28 THEN v END AS rsi_value,
  CASE WHEN i < 28 THEN 'na' WHEN v <= 30 THEN 'oversold' WHEN v >= 70 THEN 'overbought' ELSE 'neutral' END AS rsi_bucket
FROM (SELECT *, CASE WHEN l <= 1e-12 THEN CASE WHEN g <= 1e-12 THEN 50.0 ELSE 100.0 END
                     ELSE 100.0 - 100.0 / (1.0 + g / l) END AS v
  FROM (SELECT *, {ewm('gain', 1 / 14, BY_DAY)} AS g, {ewm('loss', 1 / 14, BY_DAY)} AS l
    FROM (SELECT *, CASE WHEN m > 0 THEN m ELSE 0.0 END AS gain, CASE WHEN m < 0 THEN -m ELSE 0.0 END AS loss,
                 row_number() OVER (PARTITION BY {BY_DAY} ORDER BY ts) - 1 AS i
      FROM (SELECT *, close - {lag('close', BY_DAY)} AS m FROM bars))))"""


@check("F-02", query(M15, RSI_SQL, "rsi_value"))
def _(d):
    return trend.rsi(d.bars()).select(*KEYS, "rsi_value", "rsi_bucket")


@check(
    "F-03",
    query(M15, f"""SELECT {K}, {ewm('tr', 1 / 14, BY_DAY)} AS atr_value, {mean('tr', 14, BY_DAY, 1)} AS atr_sma
    FROM (SELECT *, {true_range(BY_DAY)} AS tr FROM bars)""", "atr_value atr_sma"),
)
def _(d):
    out = volatility.atr(d.bars()).withColumnRenamed("atr_value", "wilder").drop("ta_vol__atr")
    out = volatility.atr(out, {"atr_smoothing": "sma"})
    return out.select(*KEYS, F.col("wilder").alias("atr_value"), F.col("atr_value").alias("atr_sma"))


# --- volatility and regimes ---------------------------------------------------------------


def ret(by):
    return f"close / nullif({lag('close', by)}, 0) - 1"


@check(
    "F-04",
    query(M15, f"""SELECT {K}, {std('r', 20, BY_DAY, 2)} AS ta_vol__ret1_std,
      {mean('high - low', 20, BY_DAY, 1)} AS ta_vol__range_mean
    FROM (SELECT *, {ret(BY_DAY)} AS r FROM bars)""", "ta_vol__ret1_std ta_vol__range_mean"),
)
def _(d):
    return volatility.return_range(d.bars()).select(*KEYS, "ta_vol__ret1_std", "ta_vol__range_mean")


@check(
    "F-04_continuous",
    query(M15, f"""SELECT {K}, {std('r', 20, BY_ALL, 2)} AS ta_vol__ret1_std,
      {mean('high - low', 20, BY_ALL, 1)} AS ta_vol__range_mean
    FROM (SELECT *, ln(close) - ln({lag('close', BY_ALL)}) AS r FROM bars)""", "ta_vol__ret1_std ta_vol__range_mean"),
)
def _(d):
    out = in_blocks(
        d.bars(), ["instrument", "anchor_tf"], ["ts"],
        lambda df, by: volatility.return_range(df, {"ret_type": "log"}, by), back=21, block_rows=256,
    )
    return out.select(*KEYS, "ta_vol__ret1_std", "ta_vol__range_mean")


STAT = ("stat_ts_return", "stat_ts_vol", "stat_ts_range")
P_DAY = f"(PARTITION BY {BY_DAY})"


@check(
    "F-05",
    query(M15, f"""SELECT {K}, r AS stat_ts_return, abs(r) AS stat_ts_vol, high - low AS stat_ts_range,
      (r - avg(r) OVER {P_DAY}) / nullif(stddev_samp(r) OVER {P_DAY}, 0) AS stat_ts_return_zscore,
      (abs(r) - avg(abs(r)) OVER {P_DAY}) / nullif(stddev_samp(abs(r)) OVER {P_DAY}, 0) AS stat_ts_vol_zscore,
      (high - low - avg(high - low) OVER {P_DAY}) / nullif(stddev_samp(high - low) OVER {P_DAY}, 0) AS stat_ts_range_zscore
    FROM (SELECT *, {ret(BY_DAY)} AS r FROM bars)""", " ".join(STAT) + " " + " ".join(f"{s}_zscore" for s in STAT)),
)
def _(d):
    return volatility.return_zscores(d.bars()).select(*KEYS, *STAT, *[f"{s}_zscore" for s in STAT])


@check(
    "F-06",
    query(D1, f"""SELECT instrument, anchor_tf, ts AS anchor_ts, CAST(200 AS BIGINT) AS vol_range_lookback_bars, m AS vol_range_realised_range,
      z AS vol_range_range_z,
      CASE WHEN z <= -1 THEN 'compress' WHEN z >= 1 THEN 'expand' ELSE 'neutral' END AS vol_range_state,
      z <= -1 AS vol_range_compress_flag, z >= 1 AS vol_range_expand_flag,
      CASE WHEN z <= -1 THEN 'compress' WHEN z >= 1 THEN 'expand' ELSE 'neutral' END AS vol_range_regime_id,
      CASE WHEN abs(z) < 0.55 THEN 0.0 ELSE least(abs(z), 1.0) END AS vol_range_regime_confidence
    FROM (SELECT *, {mean('high - low', 200, BY_YEAR)} AS m,
      {div('high - low - ' + mean('high - low', 200, BY_YEAR), std('high - low', 200, BY_YEAR))} AS z FROM bars)""",
      "vol_range_realised_range vol_range_range_z vol_range_regime_confidence"),
)
def _(d):
    return family_frame("vol_range", d.daily(), by=YEAR)


@check(
    "F-07",
    query(D1, f"""SELECT instrument, anchor_tf, ts AS anchor_ts, pct AS consolidation_range_pct, z AS consolidation_vol_z,
      CASE WHEN pct IS NOT NULL OR z IS NOT NULL THEN least(
        coalesce(CASE WHEN 1 - pct / 30.0 < 0 THEN 0.0 WHEN 1 - pct / 30.0 > 1 THEN 1.0 ELSE 1 - pct / 30.0 END, 0.0),
        coalesce(CASE WHEN 1 - abs(z) / 0.5 < 0 THEN 0.0 ELSE 1 - abs(z) / 0.5 END, 0.0)) END AS consolidation_score,
      coalesce(pct <= 30.0 AND abs(z) <= 0.5, false) AS consolidation_flag, 'range_vol_squeeze' AS consolidation_method
    FROM (SELECT *, {div('v - ' + mean('v', 200, BY_YEAR), std('v', 200, BY_YEAR))} AS z
      FROM (SELECT *, {std('r', 20, BY_YEAR)} AS v,
          {div(f"(CASE WHEN count(high) OVER {over(20, BY_YEAR)} >= 20 THEN max(high) OVER {over(20, BY_YEAR)} - min(low) OVER {over(20, BY_YEAR)} END)", 'close')} AS pct
        FROM (SELECT *, {ret(BY_YEAR)} AS r FROM bars)))""",
      "consolidation_range_pct consolidation_vol_z consolidation_score"),
)
def _(d):
    # The brand prices jump by whole multiples, so the range limit is wider than the default.
    return family_frame("consolidation_bar", d.daily(), {"range_pct_max": 30.0}, YEAR)


@check(
    "F-08",
    query(D1, f"""SELECT instrument, anchor_tf, ts AS anchor_ts,
      CASE WHEN pct IS NOT NULL THEN CAST(CAST(least(floor(pct * 8), 7) AS BIGINT) AS VARCHAR) END AS unsup_regime_id, conf AS unsup_regime_confidence,
      'kmeans' AS unsup_method_used, 'windows_core_v1' AS unsup_feature_set_used,
      CAST(NULL AS VARCHAR) AS unsup_model_id, CAST(NULL AS TIMESTAMP) AS unsup_fit_ts,
      CAST(NULL AS DOUBLE) AS unsup_distance_to_centroid, CAST(NULL AS DOUBLE) AS unsup_logprob,
      1 - conf AS unsup_entropy, conf < 0.55 OR 1 - conf >= 1.5 AS unsup_outlier_flag
    FROM (SELECT *, least(abs(greatest(least(z, 8.0), -8.0)), 1.0) AS conf,
        CASE WHEN n = 1 THEN 0.0 WHEN v IS NULL THEN NULL ELSE (rk + (ties - 1) / 2.0 - 1) / (n - 1) END AS pct
      FROM (SELECT *, {div('v - ' + mean('v', 60, BY_YEAR), std('v', 60, BY_YEAR))} AS z,
          count(*) OVER (PARTITION BY {BY_YEAR}) AS n,
          rank() OVER (PARTITION BY {BY_YEAR} ORDER BY v NULLS LAST) AS rk,
          count(v) OVER (PARTITION BY {BY_YEAR}, v) AS ties
        FROM (SELECT *, {std('r', 20, BY_YEAR)} AS v FROM (SELECT *, {ret(BY_YEAR)} AS r FROM bars))))""",
      "unsup_regime_confidence unsup_entropy"),
)
def _(d):
    return family_frame("unsup_regime", d.daily(), {"z_window": 60}, YEAR)


@check(
    "F-09",
    query(D1, f"""SELECT instrument, anchor_tf, ts AS anchor_ts, score AS carry_ts_carry_score, slope AS carry_ts_ts_slope,
      reg AS carry_ts_ts_regime, CAST(NULL AS DOUBLE) AS carry_ts_level, CAST(NULL AS DOUBLE) AS carry_ts_level_z,
      CAST(NULL AS DOUBLE) AS carry_ts_slope_z,
      CASE reg WHEN 'contango' THEN 'positive' WHEN 'backwardated' THEN 'negative' WHEN 'flat' THEN 'flat' ELSE 'unknown' END AS carry_ts_sign_bucket,
      CAST(NULL AS DOUBLE) AS carry_ts_confidence, 'external' AS carry_ts_source_used, 'none' AS carry_ts_proxy_method_used,
      false AS carry_ts_missing_flag, CAST(0 AS BIGINT) AS carry_ts_data_age_bars
    FROM (SELECT *, CASE WHEN abs(z) < 0.1 THEN 'flat' WHEN z >= 1 THEN 'contango' WHEN z <= -1 THEN 'backwardated' ELSE 'unknown' END AS reg
      FROM (SELECT *, {div('score - ' + mean('score', 252, BY_YEAR, 10), std('score', 252, BY_YEAR, 10))} AS z
        FROM (SELECT *, {mean('r', 252, BY_YEAR, 10)} AS score, (close - {lag('close', BY_YEAR, 60)}) / 60.0 AS slope
          FROM (SELECT *, {ret(BY_YEAR)} AS r FROM bars))))""", "carry_ts_carry_score carry_ts_ts_slope"),
)
def _(d):
    return family_frame("carry_ts", d.daily(), by=YEAR)


@check(
    "F-10",
    query(D1, f"""SELECT {K}, rv AS jump_rv, bv AS jump_bv, greatest(rv - bv, CASE WHEN rv - bv IS NOT NULL THEN 0.0 END) AS jump_jv,
      rp AS jump_rs_plus, rm AS jump_rs_minus
    FROM (SELECT *, {total('r * r', 50, BY_YEAR, 10)} AS rv, {total('bp', 50, BY_YEAR, 10)} * 0.6366197723675814::DOUBLE AS bv,
        {total('(CASE WHEN r > 0 THEN r * r ELSE 0.0 END)', 50, BY_YEAR, 10)} AS rp,
        {total('(CASE WHEN r < 0 THEN r * r ELSE 0.0 END)', 50, BY_YEAR, 10)} AS rm
      FROM (SELECT *, abs(r) * abs({lag('r', BY_YEAR)}) AS bp FROM (SELECT *, {ret(BY_YEAR)} AS r FROM bars)))""",
      "jump_rv jump_bv jump_jv jump_rs_plus jump_rs_minus", 4),
    digits=4,
)
def _(d):
    return family_frame("jump_variation", d.daily(), by=YEAR, drop_policy=True)


@check(
    "F-11",
    query(M15, f"""SELECT {K}, lam AS impact_kyle_lambda, lam * {mean('abs(q)', 50, BY_DAY, 10)} AS impact_cost_unit,
      CASE WHEN lam IS NULL THEN 'unknown' WHEN lam <= 1e-6 THEN 'low' WHEN lam >= 1e-4 THEN 'high' ELSE 'medium' END AS impact_lambda_regime
    FROM (SELECT *, {div(total('dp * q', 50, BY_DAY, 10), total('q * q', 50, BY_DAY, 10), 'NULL')} AS lam
      FROM (SELECT *, volume * CASE WHEN dp > 0 THEN 1.0 WHEN dp < 0 THEN -1.0 ELSE 0.0 END AS q
        FROM (SELECT *, close - {lag('close', BY_DAY)} AS dp FROM bars)))""", "impact_kyle_lambda impact_cost_unit"),
)
def _(d):
    return family_frame("impact_lambda", d.bars(), drop_policy=True)


@check(
    "F-12",
    query(M15, f"""SELECT DISTINCT {K}, 'options_context_v1' AS phase_version, 'options_context_thresholds_v1' AS threshold_bundle_id,
      'micro_policy_v1' AS micro_policy_id, 'jump_policy_v1' AS jump_policy_id, 'impact_policy_v1' AS impact_policy_id,
      'options_policy_v1' AS options_policy_id FROM bars"""),
)
def _(d):
    return flow.options_context(d.bars())


# --- flow -------------------------------------------------------------------------------


def bucket(x: str, a, b, names: str, default="'unknown'") -> str:
    lo, mid, hi = (f"'{n}'" for n in names.split())
    return f"CASE WHEN {x} > {b} THEN {hi} WHEN {x} > {a} AND {x} <= {b} THEN {mid} WHEN {x} <= {a} THEN {lo} ELSE {default} END"


def nearest(q: float, n: int, by: str) -> str:
    """list_sort element nearest to rank q·(n-1)."""
    return (
        f"(CASE WHEN count(rng) OVER {over(n, by)} >= {n} THEN "
        f"list_sort(list(rng) OVER {over(n, by)})[CAST(floor({q} * (count(rng) OVER {over(n, by)} - 1) + 0.5) AS INTEGER) + 1] END)"
    )


@check(
    "F-13",
    query(D1, f"""SELECT instrument, anchor_tf, ts AS pcr_window_ts, ofi AS pcr_ofi_value, vz AS pcr_micro_vol_value, rng AS pcr_range_value,
      {bucket('vz', '1.0', '2.0', 'low medium high')} AS pcr_micro_vol_bucket,
      {bucket('ofi', '-0.5', '0.5', 'strong_sell balanced strong_buy')} AS pcr_ofi_bucket,
      {bucket('rng', 'qlo', 'qhi', 'narrow normal wide')} AS pcr_range_bucket,
      {bucket('clv', '0.33', '0.66', 'lower mid upper')} AS pcr_clv_bucket
    FROM (SELECT *, {div('CASE WHEN close >= open THEN volume ELSE -volume END', mean('volume', 100, BY_YEAR))} AS ofi,
        {div('volume - ' + mean('volume', 100, BY_YEAR), std('volume', 100, BY_YEAR))} AS vz,
        {nearest(0.33, 250, BY_YEAR)} AS qlo, {nearest(0.66, 250, BY_YEAR)} AS qhi,
        greatest(0.0, least(1.0, {div('close - low', 'high - low', '0.5')})) AS clv
      FROM (SELECT *, high - low AS rng FROM bars))""", "pcr_ofi_value pcr_micro_vol_value pcr_range_value"),
)
def _(d):
    return family_frame("pcra_bar", d.daily(), by=YEAR)


TICK_BY = "instrument, CAST(ts AS DATE)"


def tick(agg: str, x: str, n: int = 50) -> str:
    w = over(n, TICK_BY, "ts, event_id")
    return f"(CASE WHEN count({x}) OVER {w} >= {n} THEN {agg}({x}) OVER {w} END)"


@check(
    "F-14",
    query(TICKS, f"""SELECT instrument, 'M15' AS anchor_tf, ts AS pcr_window_ts, event_id, tv AS pcr_tick_total_volume_units,
      ds AS pcr_tick_delta_units, z AS pcr_tick_delta_z, imb AS pcr_tick_imbalance_ratio, conc AS pcr_tick_concentration_ratio_at,
      imb >= 0.6 AS pcr_tick_imbalance_flag, conc >= 2.0 AS pcr_tick_concentration_flag_at, mv >= 3.0 AS pcr_tick_sweep_flag,
      size >= 2.0 AND mv <= 1.0 AS pcr_tick_absorption_flag,
      CASE WHEN z >= 2 THEN 'aggressive_buy' WHEN z <= -2 THEN 'aggressive_sell' ELSE 'balanced' END AS pcr_footprint_pattern
    FROM (SELECT *, {tick('sum', 'size')} AS tv, {tick('sum', 'delta')} AS ds,
        {div('delta - ' + tick('avg', 'delta'), tick('stddev_samp', 'delta'))} AS z,
        {div('abs(' + tick('sum', 'delta') + ')', tick('sum', 'size'))} AS imb, {div('size', tick('avg', 'size'))} AS conc
      FROM (SELECT *, size * CASE WHEN side = 'buy' THEN 1.0 ELSE -1.0 END AS delta,
            abs(price - lag(price) OVER (PARTITION BY {TICK_BY} ORDER BY ts, event_id)) AS mv FROM ticks))""",
      "pcr_tick_total_volume_units pcr_tick_delta_units pcr_tick_delta_z pcr_tick_imbalance_ratio pcr_tick_concentration_ratio_at"),
)
def _(d):
    out = flow.tick_pressure(d.ticks(), "M15", "event_id")
    fresh = [c for c in out.columns if c.startswith("pcr_") and c != "pcr_window_ts"]
    return out.select("instrument", "anchor_tf", "pcr_window_ts", "event_id", *fresh)


FLOW_SQL = """SELECT b.instrument, b.anchor_tf, b.ts, f.delta AS micro_ofi_value, f.imb AS micro_agg_imbalance,
  CASE WHEN f.n IS NULL THEN NULL WHEN f.imb >= 0.2 THEN 'buy_dominant' WHEN f.imb <= -0.2 THEN 'sell_dominant' ELSE 'balanced' END AS micro_agg_imbalance_bucket,
  CAST(f.n AS DOUBLE) AS micro_intensity_events,
  CASE WHEN f.n IS NULL THEN NULL WHEN f.n >= 4 THEN 'high' WHEN f.n <= 1 THEN 'low' ELSE 'normal' END AS micro_intensity_bucket
FROM bars b LEFT JOIN (
  SELECT instrument, time_bucket(INTERVAL 15 MINUTE, ts) AS ts, sum(signed) AS delta, sum(signed) / nullif(sum(size), 0) AS imb, count(*) AS n
  FROM ({signed}) GROUP BY 1, 2) f USING (instrument, ts)"""
SIDE_SIGNED = "SELECT *, size * CASE WHEN side = 'buy' THEN 1.0 ELSE -1.0 END AS signed FROM ticks"
TICK_SIGNED = """SELECT *, size * CASE WHEN side = 'buy' THEN 1.0 WHEN price >= lag(price) OVER
  (PARTITION BY instrument, CAST(ts AS DATE) ORDER BY ts, event_id) THEN 1.0 ELSE -1.0 END AS signed FROM ticks"""
FLOW_CFG = {"micro_intensity_low_cut": 1, "micro_intensity_high_cut": 4}


@check("F-15", query(M15, FLOW_SQL.replace("{signed}", SIDE_SIGNED), "micro_ofi_value micro_agg_imbalance"))
def _(d):
    return flow.bucketed_flow(d.bars(), flow.side_signed(d.ticks()), "M15", FLOW_CFG).drop(*POLICY)


@check("F-15_tick_rule", query(M15, FLOW_SQL.replace("{signed}", TICK_SIGNED), "micro_ofi_value micro_agg_imbalance"))
def _(d):
    # Only buys keep their side; the others are signed by the price before them.
    ticks = d.ticks().withColumn("side", F.when(F.col("side") == "buy", "buy"))
    return flow.bucketed_flow(d.bars(), flow.signed_ticks(ticks, "event_id"), "M15", FLOW_CFG).drop(*POLICY)


def coloured(n):
    return f"coalesce({lag('c', BY_DAY, n)}, 'na')"


@check(
    "F-16",
    query(M15, f"""SELECT instrument, anchor_tf, ts AS anchor_ts, c AS pac_micro_state_anchor, {coloured(1)} AS pac_micro_state_pre_entry,
      {coloured(-1)} AS pac_micro_state_post_entry, {coloured(-2)} AS pac_micro_state_start, {coloured(-1)} AS pac_micro_state_mid,
      {coloured(1)} AS pac_micro_state_end,
      CASE WHEN bw IS NULL OR ww IS NULL THEN 'unknown' WHEN bw <= 0.1 THEN 'flat' WHEN ww >= 0.65 AND bw >= 0.25 THEN 'impulsive'
           WHEN bw >= 0.35 AND ww <= 0.35 THEN 'trend' ELSE 'chop' END AS pac_path_regime,
      wick >= 0.65 AND body <= 0.25 AS pac_entry_immediate_rejection_flag,
      c IN ('bull', 'bear') AND c = {coloured(-1)} AS pac_entry_immediate_followthrough_flag
    FROM (SELECT *, {mean('body', 11, BY_DAY, 5)} AS bw, {mean('wick', 11, BY_DAY, 5)} AS ww
      FROM (SELECT *, CASE WHEN close > open THEN 'bull' WHEN close < open THEN 'bear' ELSE 'doji' END AS c,
          abs(close - open) / CASE WHEN high = low THEN 1.0 ELSE high - low END AS body,
          greatest(high - greatest(open, close), least(open, close) - low) / CASE WHEN high = low THEN 1.0 ELSE high - low END AS wick
        FROM bars))"""),
)
def _(d):
    return family_frame("pac_bar", d.bars())


@check(
    "F-17",
    query(M15, f"""SELECT {K}, concat_ws('::', 'vp_core', instrument, anchor_tf) AS zone_id, volume AS zone_vp_total_volume_units,
      mid AS zone_vp_poc_price, CASE WHEN high = low THEN 0.5 ELSE (mid - low) / (high - low) END AS zone_vp_poc_relative_position,
      volume / 2 AS zone_vp_volume_lower_units, volume / 2 AS zone_vp_volume_upper_units, skew AS zone_vp_skew,
      hvn AS zone_vp_hvn_flag, lvn AS zone_vp_lvn_flag, t AS zone_vp_type,
      CASE t WHEN 'balanced_hvn' THEN 'hvn' WHEN 'rejection_lvn' THEN 'lvn' WHEN 'skewed_high' THEN 'skew_high'
             WHEN 'skewed_low' THEN 'skew_low' ELSE t END AS zone_vp_type_bucket
    FROM (SELECT *, CASE WHEN volume <= 0 THEN 'thin' WHEN skew >= 0.35 THEN 'skewed_high' WHEN skew <= -0.35 THEN 'skewed_low'
          WHEN hvn THEN 'balanced_hvn' WHEN lvn THEN 'rejection_lvn' ELSE 'balanced_hvn' END AS t
      FROM (SELECT *, (high + low) / 2 AS mid, CASE WHEN high = low THEN 0.0 ELSE (close - (high + low) / 2) / (high - low) END AS skew,
          coalesce(volume >= {mean('volume', 50, BY_DAY, 10)} * 1.5, false) AS hvn,
          coalesce(volume <= {mean('volume', 50, BY_DAY, 10)} / 1.5, false) AS lvn FROM bars))""",
      "zone_vp_total_volume_units zone_vp_poc_price zone_vp_poc_relative_position zone_vp_volume_lower_units zone_vp_volume_upper_units zone_vp_skew"),
)
def _(d):
    return family_frame("vp_core", d.bars())


@check(
    "F-18",
    query(M15, f"""SELECT {K}, hi AS zmf_zone_hi, lo AS zmf_zone_lo, concat_ws('::', 'DAY_RANGE', CAST(dt AS VARCHAR), anchor_tf) AS zone_id,
      'DAY_RANGE' AS zmf_zone_kind, (hi + lo) / 2 AS zmf_zone_mid, hi - lo AS zmf_zone_width, 'mixed' AS zmf_zone_behaviour_type_bucket,
      'fresh' AS zmf_zone_freshness_bucket, 'single' AS zmf_zone_stack_depth_bucket, 'single' AS zmf_zone_htf_confluence_bucket
    FROM bars JOIN (SELECT instrument, anchor_tf, dt, max(high) AS hi, min(low) AS lo FROM bars GROUP BY ALL) USING (instrument, anchor_tf, dt)""",
      "zmf_zone_hi zmf_zone_lo zmf_zone_mid zmf_zone_width"),
)
def _(d):
    return family_frame("zmf_core", d.bars())


# --- cross-section -----------------------------------------------------------------------

MARKET = f"""{D1}, rets AS (SELECT *, {ret(BY_YEAR)} AS ret FROM bars),
market AS (SELECT *, avg(ret) OVER (PARTITION BY ts) AS market_ret FROM rets)"""


def corr_sql(x: str, y: str, n: int, by: str = BY_YEAR) -> str:
    cov = f"{mean(f'({x}) * ({y})', n, by)} - {mean(x, n, by)} * {mean(y, n, by)}"
    return div(cov, f"{std(x, n, by)} * {std(y, n, by)}", "NULL")


def clipped(x: str, cut: str) -> str:
    return f"(CASE WHEN {x} > {cut} THEN {cut} WHEN {x} < -{cut} THEN -{cut} ELSE {x} END)"


def market(d):
    bars = d.daily()
    return cs.with_market(cs.with_cluster(bars, d.universe(bars)), YEAR)


PANEL = ("cluster_id", "anchor_tf", "yr")
# Correlations of this data are weak, so the strength cuts are lower than the defaults.
CORR = {"corr_min_periods": 12, "corr_topk_min_abs_corr": 0.4, "corr_strong_cut": 0.2, "corr_unstable_std_cut": 0.05, "corr_flip_abs_delta_cut": 0.1}
REFS = "corr_index_major corr_dxy corr_oil corr_ref1"


@check(
    "F-19",
    query(MARKET, f"""SELECT {K}, c AS corr_index_major, c AS corr_dxy, c AS corr_oil, c AS corr_ref1, 'MARKET' AS corr_ref1_id
    FROM (SELECT *, {clipped('c0', '0.999')} AS c FROM (SELECT *, {corr_sql('ret', 'market_ret', 50)} AS c0 FROM market))""", REFS),
)
def _(d):
    return cs.market_correlation(market(d), None, YEAR).select(*KEYS, *REFS.split(), "corr_ref1_id")


def pair_sql(window: int, min_periods: int, scope: str = "yr", source: str = "rets") -> str:
    """Pair moments over the last bar times of the panel, both directions."""
    w = f"(PARTITION BY {scope}, a, b ORDER BY i RANGE BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"
    return f"""stamps AS (SELECT *, row_number() OVER (PARTITION BY {scope} ORDER BY ts) - 1 AS i
      FROM (SELECT DISTINCT {scope}, ts FROM {source})),
    names AS (SELECT DISTINCT {scope}, instrument FROM {source}),
    grid AS (SELECT s.{scope}, s.ts, s.i, x.instrument AS a, y.instrument AS b FROM stamps s
      JOIN names x ON x.{scope} = s.{scope} JOIN names y ON y.{scope} = s.{scope} AND x.instrument <> y.instrument),
    joint AS (SELECT g.*, CASE WHEN q.ret IS NOT NULL THEN p.ret END AS x, CASE WHEN p.ret IS NOT NULL THEN q.ret END AS y
      FROM grid g LEFT JOIN {source} p ON p.ts = g.ts AND p.instrument = g.a LEFT JOIN {source} q ON q.ts = g.ts AND q.instrument = g.b),
    moments AS (SELECT *, count(x) OVER {w} AS n, avg(x) OVER {w} AS mx, avg(y) OVER {w} AS my, avg(x * y) OVER {w} AS mxy,
      var_pop(x) OVER {w} AS vx, var_pop(y) OVER {w} AS vy FROM joint),
    pairs AS (SELECT *, CASE WHEN n >= greatest(2, {min_periods}) AND i + 1 >= {min_periods} AND vx > 0 AND vy > 0
      THEN (mxy - mx * my) / sqrt(vx * vy) END AS rho FROM moments)"""


TOP_SQL = f"""{MARKET}, {pair_sql(50, 12)},
ranked AS (SELECT *, row_number() OVER (PARTITION BY ts, a ORDER BY abs(rho) DESC, b) AS k FROM pairs WHERE abs(rho) >= 0.4),
tops AS (SELECT a AS instrument, ts, max(CASE WHEN k = 1 THEN b END) AS id2, max(CASE WHEN k = 1 THEN rho END) AS r2,
  max(CASE WHEN k = 2 THEN b END) AS id3, max(CASE WHEN k = 2 THEN rho END) AS r3,
  string_agg(b, ',' ORDER BY k) AS peers, count(*) AS n FROM ranked WHERE k <= 5 GROUP BY 1, 2)"""
TOP_BODY = f"""SELECT instrument, 'D1' AS anchor_tf, ts, id2 AS corr_ref2_id, r2 AS corr_ref2, id3 AS corr_ref3_id, r3 AS corr_ref3,
  peers, coalesce(n, 0) AS n_peers FROM bars LEFT JOIN tops USING (instrument, ts)"""


def top_columns(df):
    parsed = F.from_json("corr_topk_neighbors_json", "array<struct<peer:string,corr:double,lag:int>>")
    names = F.transform(parsed, lambda p: p["peer"])
    return df.select(
        *KEYS, "corr_ref2_id", "corr_ref2", "corr_ref3_id", "corr_ref3",
        F.when(parsed.isNotNull(), F.concat_ws(",", names)).alias("peers"),
        F.coalesce(F.size(parsed), F.lit(0)).cast("long").alias("n_peers"),
    )


@check("F-20", query(TOP_SQL, TOP_BODY, "corr_ref2 corr_ref3"))
def _(d):
    return top_columns(cs.peer_correlation(market(d), CORR, PANEL, tiles=4))


CONT_SQL = f"""{D1}, rets AS (SELECT *, 0 AS z, {ret(BY_ALL)} AS ret FROM bars), {pair_sql(60, 15, 'z')},
ranked AS (SELECT *, row_number() OVER (PARTITION BY ts, a ORDER BY abs(rho) DESC, b) AS k FROM pairs WHERE abs(rho) >= 0.25)"""


@check(
    "F-20_continuous",
    query(CONT_SQL, "SELECT a AS instrument, ts, b AS peer, rho AS corr FROM ranked WHERE k = 1", "corr"),
)
def _(d):
    bars = d.daily()
    by_day = in_blocks(
        bars, ["instrument", "anchor_tf"], ["ts"], lambda df, by: cs.with_returns(df, by), back=2, slice_by=F.col("yr")
    )
    panel = cs.with_cluster(by_day, d.universe(bars))
    cfg = {"window": 60, "min_periods": 15, "topk": 1, "min_abs": 0.25}
    found = in_panel_blocks(panel, lambda df, by: top_peers(df, cfg, by), window=60, block_bars=256)
    return found.where(F.size("peers") > 0).select(
        "instrument", "ts", F.get("peers", F.lit(0)).alias("peer"), F.get("corrs", F.lit(0)).alias("corr")
    )


STATE_SQL = f"""{TOP_SQL}, refs AS (SELECT m.*, {clipped('c0', '0.999')} AS r1, r2, r3
  FROM (SELECT *, {corr_sql('ret', 'market_ret', 50)} AS c0 FROM market) m LEFT JOIN tops USING (instrument, ts)),
sized AS (SELECT *, coalesce(abs(r1), 0) AS s1, coalesce(abs(r2), 0) AS s2, coalesce(abs(r3), 0) AS s3 FROM refs),
best AS (SELECT *, CASE WHEN s1 = greatest(s1, s2, s3) THEN r1 WHEN s2 = greatest(s1, s2, s3) THEN r2 ELSE r3 END AS bst,
  {lag('r1', BY_YEAR)} AS prev, {std('r1', 200, BY_YEAR, 12)} AS sd,
  CASE WHEN r1 >= 0.2 THEN 'aligned' WHEN r1 <= -0.2 THEN 'divergent' ELSE 'unstable' END AS regime FROM sized)"""


@check(
    "F-21",
    query(STATE_SQL, f"""SELECT {K}, CASE WHEN bst >= 0 THEN 'pos' WHEN bst < 0 THEN 'neg' END AS micro_corr_sign,
      least(abs(bst), CASE WHEN bst IS NOT NULL THEN 1.0 END) AS micro_corr_strength,
      CASE WHEN count(ret) OVER {over(50, BY_YEAR)} >= 12 THEN 1.0 ELSE 0.0 END AS micro_corr_confidence, sd AS micro_corr_std,
      sd >= 0.05 AS micro_corr_unstable_flag, (r1 * prev < 0) OR (abs(r1 - prev) >= 0.1) AS micro_corr_flip_flag, regime AS micro_corr_regime,
      CASE regime WHEN 'aligned' THEN 'cluster_pos' WHEN 'divergent' THEN 'cluster_neg' ELSE 'cluster_neutral' END AS corr_cluster_id
    FROM best""", "micro_corr_strength micro_corr_confidence micro_corr_std"),
)
def _(d):
    out = cs.peer_correlation(cs.market_correlation(market(d), CORR, YEAR), CORR, PANEL)
    out = cs.correlation_state(out, CORR, YEAR)
    names = ("sign", "strength", "confidence", "std", "unstable_flag", "flip_flag", "regime")
    return out.select(*KEYS, *[f"micro_corr_{n}" for n in names], "corr_cluster_id")


LAGS = list(range(-5, 6))


@check(
    "F-22",
    query(MARKET, f"""SELECT {K}, greatest({', '.join(f'x{i}' for i in range(11))}) AS corr_ref1_xcorr_max,
      CAST(CASE {' '.join(f"WHEN x{i} = greatest({', '.join(f'x{j}' for j in range(11))}) THEN {LAGS[i]}" for i in reversed(range(11)))} END AS BIGINT) AS corr_ref1_xcorr_lag_bars
    FROM (SELECT *, {', '.join(f"abs({corr_sql('ret', f'm{i}', 20)}) AS x{i}" for i in range(11))}
      FROM (SELECT *, {', '.join(f"{lag('market_ret', BY_YEAR, n) if n else 'market_ret'} AS m{i}" for i, n in enumerate(LAGS))} FROM market))""",
      "corr_ref1_xcorr_max"),
)
def _(d):
    out = cs.lagged_correlation(market(d), {"corr_window_bars": 20}, YEAR)
    return out.select(*KEYS, "corr_ref1_xcorr_max", "corr_ref1_xcorr_lag_bars")


VOL_SQL = f"""{TOP_SQL}, vols AS (SELECT m.*, id2, id3, {std('ret', 20, BY_YEAR, 10)} AS vol FROM market m LEFT JOIN tops USING (instrument, ts)),
peer AS (SELECT v.*, avg(v.vol) OVER (PARTITION BY v.ts) AS mv, p.vol AS v2, q.vol AS v3 FROM vols v
  LEFT JOIN vols p ON p.instrument = v.id2 AND p.ts = v.ts LEFT JOIN vols q ON q.instrument = v.id3 AND q.ts = v.ts)"""


@check(
    "F-23",
    query(VOL_SQL, f"""SELECT {K}, {corr_sql('vol', 'mv', 20)} AS corr_vol_ref1, {corr_sql('vol', 'v2', 20)} AS corr_vol_ref2,
      {corr_sql('vol', 'v3', 20)} AS corr_vol_ref3 FROM peer""", "corr_vol_ref1 corr_vol_ref2 corr_vol_ref3"),
)
def _(d):
    out = cs.volatility_correlation(cs.peer_correlation(market(d), CORR, PANEL), CORR, YEAR)
    return out.select(*KEYS, "corr_vol_ref1", "corr_vol_ref2", "corr_vol_ref3")


SLOW_SQL = f"""{MARKET}, {pair_sql(150, 40)},
ranked AS (SELECT *, row_number() OVER (PARTITION BY ts, a ORDER BY abs(rho) DESC, b) AS k FROM pairs WHERE abs(rho) >= 0.2),
tops AS (SELECT a AS instrument, ts, max(CASE WHEN k = 1 THEN b END) AS id2, max(CASE WHEN k = 1 THEN rho END) AS r2,
  max(CASE WHEN k = 2 THEN b END) AS id3, max(CASE WHEN k = 2 THEN rho END) AS r3 FROM ranked WHERE k <= 2 GROUP BY 1, 2),
slow AS (SELECT *, {clipped('c0', '0.999')} AS r1 FROM (SELECT *, {corr_sql('ret', 'market_ret', 150)} AS c0 FROM market)),
named AS (SELECT *, CASE WHEN abs(r1) < 0.2 THEN 'unstable' WHEN r1 >= 0 THEN 'aligned' WHEN r1 < 0 THEN 'divergent' END AS regime,
  {std('r1', 150, BY_YEAR, 40)} AS sd FROM slow)"""


@check(
    "F-24",
    query(SLOW_SQL, f"""SELECT {K}, r1 AS corr_htf_ref1, 'MARKET' AS corr_htf_ref1_id, id2 AS corr_htf_ref2_id, r2 AS corr_htf_ref2,
      id3 AS corr_htf_ref3_id, r3 AS corr_htf_ref3, regime AS htf_corr_regime, abs(r1) AS htf_corr_confidence,
      CASE regime WHEN 'aligned' THEN 'cluster_pos' WHEN 'divergent' THEN 'cluster_neg' ELSE 'cluster_neutral' END AS corr_cluster_id_htf,
      abs(r1) AS corr_cluster_confidence_htf, CASE WHEN 1 - sd / 0.7 < 0 THEN 0.0 ELSE 1 - sd / 0.7 END AS corr_cluster_stability_htf
    FROM named LEFT JOIN tops USING (instrument, ts)""",
      "corr_htf_ref1 corr_htf_ref2 corr_htf_ref3 htf_corr_confidence corr_cluster_confidence_htf corr_cluster_stability_htf"),
)
def _(d):
    cfg = {"corr_htf_window_bars": 150, "corr_htf_min_periods": 40, "peer_min_abs": 0.2}
    out = cs.slow_correlation(market(d), cfg, YEAR, PANEL)
    names = [c for c in out.columns if "htf" in c]
    return out.select(*KEYS, *names)


@check(
    "F-25",
    query(MARKET, f"""SELECT {K}, x AS xs_relval_spread_level, z AS xs_relval_spread_zscore,
      CASE WHEN z <= -2.5 THEN 'far_undervalued' WHEN z <= -1.5 THEN 'undervalued' WHEN z >= 2.5 THEN 'far_overvalued' WHEN z >= 1.5 THEN 'overvalued' ELSE 'fair' END AS xs_relval_spread_bucket,
      CASE WHEN z <= -1.5 THEN 'long' WHEN z >= 1.5 THEN 'short' ELSE 'neutral' END AS xs_relval_signal,
      CASE WHEN abs(z) / 2.5 > 1 THEN 1.0 ELSE abs(z) / 2.5 END AS xs_relval_signal_strength,
      CASE WHEN z <= -1.5 THEN 'buy_this' WHEN z >= 1.5 THEN 'sell_this' ELSE 'neutral' END AS xs_relval_primary_peer_role,
      'cluster_peers' AS xs_relval_peer_set_used
    FROM (SELECT *, {clipped(div('x - ' + mean('x', 60, BY_YEAR, 20), std('x', 60, BY_YEAR, 20), 'NULL'), '8.0')} AS z
      FROM (SELECT *, ln(close) - avg(ln(close)) OVER (PARTITION BY ts) AS x FROM market))""",
      "xs_relval_spread_level xs_relval_spread_zscore xs_relval_signal_strength"),
)
def _(d):
    out = cs.spread(market(d), None, YEAR)
    return out.select(*KEYS, *[c for c in out.columns if c.startswith("xs_relval")])


def ranked_sql(x: str) -> str:
    return (
        f"CASE WHEN count(*) OVER (PARTITION BY ts) = 1 THEN 0.0 WHEN {x} IS NULL THEN NULL ELSE "
        f"(rank() OVER (PARTITION BY ts ORDER BY {x} NULLS LAST) + (count({x}) OVER (PARTITION BY ts, {x}) - 1) / 2.0 - 1) "
        f"/ (count(*) OVER (PARTITION BY ts) - 1) END"
    )


@check(
    "F-26",
    query(MARKET, f"""SELECT {K}, {ranked_sql('ret')} AS xs_relval_carry_rank, {ranked_sql('momo')} AS xs_relval_momo_rank,
      count(*) OVER (PARTITION BY ts) AS xs_relval_peer_count
    FROM (SELECT *, {mean('ret', 5, BY_YEAR, 2)} AS momo FROM market)""", "xs_relval_carry_rank xs_relval_momo_rank"),
)
def _(d):
    out = cs.cross_ranks(market(d), YEAR)
    return out.select(*KEYS, "xs_relval_carry_rank", "xs_relval_momo_rank", "xs_relval_peer_count")


HEDGE_W = "(PARTITION BY yr, a, b ORDER BY i RANGE BETWEEN 119 PRECEDING AND CURRENT ROW)"
HEDGE_SQL = f"""{MARKET}, {pair_sql(120, 40)},
best AS (SELECT *, row_number() OVER (PARTITION BY ts, a ORDER BY abs(rho) DESC, b) AS k FROM pairs WHERE rho IS NOT NULL),
chosen AS (SELECT *, (mxy - mx * my) * n / (n - 1) / vy AS beta FROM best WHERE k = 1 AND abs(rho) >= 0.2),
joined AS (SELECT c.yr, c.ts, c.a, c.b, c.i, c.rho, c.beta, j.i AS ji, j.x - c.beta * j.y AS e FROM chosen c
  JOIN joint j ON j.yr = c.yr AND j.a = c.a AND j.b = c.b AND j.i BETWEEN c.i - 119 AND c.i AND j.x IS NOT NULL),
lagged AS (SELECT *, lag(e) OVER (PARTITION BY ts, a ORDER BY ji) AS e1 FROM joined),
stats AS (SELECT ts, a, any_value(b) AS b, any_value(i) AS i, any_value(rho) AS rho, any_value(beta) AS beta, count(*) AS n, avg(e) AS em, stddev_pop(e) AS es,
  arg_max(e, ji) AS last_e, max(ji) AS last_i,
  corr(e1, e) AS phi FROM lagged GROUP BY ts, a)"""


@check(
    "F-27",
    query(HEDGE_SQL, f"""SELECT m.instrument, m.anchor_tf, m.ts, s.b AS xs_relval_primary_peer, s.rho AS xs_relval_primary_peer_corr,
      s.beta AS xs_relval_primary_peer_beta, CASE WHEN s.rho IS NOT NULL THEN 1 - least(1.0, abs(s.rho)) END AS xs_relval_coint_pvalue,
      CASE WHEN s.n >= 3 AND phi > 0 AND phi < 1 THEN CAST(round_even(-ln(2) / ln(phi), 0) AS BIGINT) END AS xs_relval_half_life_bars,
      s.last_e AS xs_relval_residual,
      CASE WHEN s.n >= 3 AND s.es > 0 AND m.ret IS NOT NULL THEN (s.last_e - s.em) / s.es END AS xs_relval_residual_z
    FROM market m LEFT JOIN stats s ON s.a = m.instrument AND s.ts = m.ts""",
      "xs_relval_primary_peer_corr xs_relval_primary_peer_beta xs_relval_coint_pvalue xs_relval_residual xs_relval_residual_z"),
)
def _(d):
    cfg = {"xs_relval_coint_window_bars": 120, "xs_relval_primary_peer_min_corr": 0.2}
    out = cs.primary_hedge(market(d), cfg, PANEL, tiles=4)
    return out.select(*KEYS, *[c for c in out.columns if c.startswith("xs_relval")])


# --- calendar ------------------------------------------------------------------------------


@check(
    "F-28",
    query(f"{M15}, {CALENDAR}", f"""SELECT b.instrument, b.anchor_tf, b.ts, count(impact) > 0 AS macro_is_blackout,
      CAST(coalesce(max(impact), 0) AS INTEGER) AS macro_blackout_max_impact
    FROM (SELECT instrument, anchor_tf, ts FROM bars UNION SELECT instrument, anchor_tf, ts + to_seconds(7 * 60 + 13) FROM bars) b LEFT JOIN calendar c ON b.ts >= c.blackout_start_ts AND b.ts < c.blackout_end_ts GROUP BY ALL"""),
)
def _(d):
    grid = d.bars().select(*KEYS)
    between = grid.withColumn("ts", F.col("ts") + F.make_dt_interval(mins=F.lit(7), secs=F.lit(13)))  # bars off the grid
    return blackout_flags(grid.unionByName(between).distinct(), d.calendar(), ["M15"]).select(*KEYS, "macro_is_blackout", "macro_blackout_max_impact")


@check(
    "F-29",
    """SELECT ts, label AS macro_regime_id, label AS macro_regime_label, floor(CAST(conf AS DOUBLE) * 1e6::DOUBLE + 0.50013::DOUBLE) / 1e6::DOUBLE AS macro_regime_confidence
    FROM (SELECT ts, CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'event_risk' WHEN event_type = 'purchase' THEN 'unknown' ELSE 'risk_on' END AS label,
      CASE WHEN value < 1 THEN 0.0 ELSE greatest(0.0, least(1.0, floor(value / 30) / 3.0)) END AS conf FROM events)""",
)
def _(d):
    words = {"click": "red_window", "view": "pre_event", "signup": "post_event", "purchase": "unknown"}
    state = F.lit("quiet")
    for event, word in words.items():
        state = F.when(F.col("event_type") == event, word).otherwise(state)
    level = F.when(F.col("value") >= 1, F.floor(F.col("value") / 30))
    macro = d.table("events").select("ts", state.alias("macro_state"), level.alias("impact_level"))
    return macro_regime(macro)
