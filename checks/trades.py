"""Joins, the decision chain, callables and streaming twins (J, O, P, R, F-70)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from barloom.functions.rolling import Rows
from barloom.operators import calendar as cal
from barloom.operators import crosssection as cs
from barloom.operators import decisions as dc
from barloom.operators import quality as qa
from barloom.operators.flow import bucketed_flow, day_range_zone, side_signed
from barloom.operators.paths import path_classes
from barloom.operators.range_phase import range_phases
from barloom.operators.structure import fair_value_gap, with_basics
from barloom.operators.volatility import return_zscores
from barloom.operators.windows import context_windows, expand_entries, full_join, reduce_features, zone_context
from barloom.plans.features import feature_table, family_frame, zones_table
from barloom.plans.run import run
from barloom.session import cut_lineage, shared_folder
from barloom.streaming import live

from .base import BY_DAY, CALENDAR, M15, TICKS, YEAR, bars_cte, check, div, lag, mean, query, rounded, std, total
from .families import CORR, FLOW_CFG, FLOW_SQL, MARKET, PANEL, SIDE_SIGNED, TOP_SQL, VOL_SQL, corr_sql, market
from .scans import trades
from .structures import CFG, EVENT_BODY, EVENT_CTES, FOLD, FOLD_SELECT, GAP, RANGE
from .tables import CTX
from .windowing import scored

KEYS = ("instrument", "anchor_tf", "ts")
K = "instrument, anchor_tf, ts"
WKEYS = ("instrument", "anchor_tf", "anchor_ts")

ZS = f"""{M15}, rr AS (SELECT *, close / nullif({lag('close', BY_DAY)}, 0) - 1 AS r FROM bars),
zs AS (SELECT *, (abs(r) - avg(abs(r)) OVER (PARTITION BY {BY_DAY})) / nullif(stddev_samp(abs(r)) OVER (PARTITION BY {BY_DAY}), 0) AS z FROM rr)"""


# --- joins -----------------------------------------------------------------------------------------


@check("J-01", query(ZS, f"""SELECT * FROM (SELECT {K}, z AS stat_ts_vol_zscore FROM zs WHERE volume > 3) FULL JOIN (SELECT {K}, high - low AS rng FROM bars WHERE volume < 6) USING (instrument, anchor_tf, ts)
  FULL JOIN (SELECT {K}, open FROM bars WHERE close > open) USING (instrument, anchor_tf, ts)""", "stat_ts_vol_zscore rng open"))
def _(d):
    b = return_zscores(d.bars())
    return full_join(
        [
            b.where("volume > 3").select(*KEYS, "stat_ts_vol_zscore"),
            b.where("volume < 6").select(*KEYS, (F.col("high") - F.col("low")).alias("rng")),
            b.where("close > open").select(*KEYS, "open"),
        ],
        KEYS,
    )


def windows_of(d, entries=("M1", "M5")):
    base = d.bars().select("instrument", "anchor_tf", F.col("ts").alias("anchor_ts"))
    return expand_entries(base, entries)


ENTRIES = "(VALUES ('M1'), ('M5')) v(e)"


@check("J-02", query(ZS, f"SELECT instrument, anchor_tf, ts AS anchor_ts, e AS tf_entry, CASE WHEN volume > 3 THEN z END AS stat_ts_vol_zscore FROM zs, {ENTRIES}", "stat_ts_vol_zscore"))
def _(d):
    features = return_zscores(d.bars()).where("volume > 3").select(*KEYS, "stat_ts_vol_zscore")
    return windows_of(d).join(reduce_features(features), list(WKEYS), "left")


@check("J-03", query(M15, f"""SELECT instrument, anchor_tf, ts AS anchor_ts, e AS tf_entry, 'mixed' AS zone_behaviour_type_bucket, 'fresh' AS zone_freshness_bucket, 'single' AS zone_stack_depth_bucket, 'single' AS zone_htf_confluence_bucket FROM bars, {ENTRIES}"""))
def _(d):
    return windows_of(d).join(zone_context(day_range_zone(d.bars())), list(WKEYS), "left")


@check("J-04", query(FOLD, f"SELECT p.instrument, p.anchor_tf, p.anchor_ts, e AS tf_entry, dr_id, dr_phase FROM ({FOLD_SELECT}) p, {ENTRIES}"))
def _(d):
    phases = range_phases(d.bars(), RANGE).select(*WKEYS, "dr_id", "dr_phase")
    return windows_of(d).join(phases, list(WKEYS), "left")


@check("J-05", query(M15, f"""SELECT w.instrument, w.anchor_tf, w.ts AS anchor_ts, b.c AS pac_micro_state_anchor FROM (SELECT DISTINCT instrument, 'M15' AS anchor_tf, ts + INTERVAL 30 MINUTE AS ts FROM bars) w
  LEFT JOIN (SELECT *, CASE WHEN close > open THEN 'bull' WHEN close < open THEN 'bear' ELSE 'doji' END AS c FROM bars) b USING (instrument, ts)"""))
def _(d):
    base = d.bars().select("instrument", "anchor_tf", (F.col("ts") + F.make_dt_interval(mins=F.lit(30))).alias("anchor_ts"))
    return base.join(family_frame("pac_bar", d.bars()).select(*WKEYS, "pac_micro_state_anchor"), list(WKEYS), "left")


@check("J-06", query(MARKET, f"SELECT {K}, ret, market_ret FROM market", "ret market_ret"))
def _(d):
    return market(d).select(*KEYS, "ret", "market_ret")


@check("J-07", query(f"{M15}, {CALENDAR}", """SELECT b.instrument, b.ts, CAST(max(c.impact) AS INTEGER) AS impact FROM bars b JOIN calendar c ON b.ts >= c.blackout_start_ts AND b.ts < c.blackout_end_ts GROUP BY 1, 2"""))
def _(d):
    slots = cal.blackout_slots(d.calendar(), "M15")
    return d.bars().join(slots, ["anchor_tf", "ts"]).select("instrument", "ts", F.col("macro_blackout_max_impact").alias("impact"))


ASKS = """asks AS (SELECT event_id, instrument, time_bucket(INTERVAL 1 MINUTE, ts) AS entry_ts, CASE WHEN event_id % 4 = 0 THEN price END AS entry_px FROM ticks)"""


def asks(d):
    from barloom.functions.timegrid import snap

    return d.ticks().select(
        "event_id", "instrument", F.lit("M15").alias("tf_entry"), snap(F.col("ts"), "M1").alias("entry_ts"),
        F.when(F.col("event_id") % 4 == 0, F.col("price")).alias("entry_px"),
    )


@check("J-08", query(f"{M15}, {ASKS}", """SELECT a.event_id, a.instrument, 'M15' AS tf_entry, a.entry_ts, coalesce(a.entry_px, CASE WHEN b.dt = CAST(a.entry_ts AS DATE) THEN b.open END) AS entry_px
  FROM asks a ASOF LEFT JOIN bars b ON a.instrument = b.instrument AND a.entry_ts <= b.ts""", "entry_px"))
def _(d):
    return dc.fill_entry_price(asks(d), d.candles())


BR = f"""{M15}, br AS (SELECT instrument || '-' || strftime(ts, '%Y%m%d%H%M') AS trade_id, instrument, ts AS entry_ts, dt, CASE WHEN close >= open THEN 'long' ELSE 'short' END AS side,
  CASE WHEN volume > 2 THEN close END AS entry_px, CASE WHEN close >= open THEN close + 40 ELSE close - 40 END AS tp_px, CASE WHEN volume < 9 THEN CASE WHEN close >= open THEN close - 30 ELSE close + 30 END END AS sl_px FROM bars),
pr AS (SELECT o.*, b.ts, b.open, b.close, b.high, b.low, CASE WHEN side = 'long' THEN b.high >= tp_px ELSE b.low <= tp_px END AS t, coalesce(CASE WHEN side = 'long' THEN b.low <= sl_px ELSE b.high >= sl_px END, false) AS s
  FROM br o JOIN bars b ON b.instrument = o.instrument AND b.dt = o.dt AND b.ts >= o.entry_ts),
oc AS (SELECT trade_id, instrument, any_value(side) AS side, any_value(dt) AS dt, min(ts) AS entry_fill_ts, coalesce(any_value(entry_px), first(open ORDER BY ts)) AS entry_fill_px,
  coalesce(min(CASE WHEN t OR s THEN ts END), max(ts)) AS exit_fill_ts, CASE WHEN bool_or(t OR s) THEN arg_min(CASE WHEN t THEN tp_px ELSE sl_px END, CASE WHEN t OR s THEN ts END) ELSE last(close ORDER BY ts) END AS exit_fill_px,
  CASE WHEN bool_or(t OR s) THEN arg_min(CASE WHEN t THEN 'target' ELSE 'stop' END, CASE WHEN t OR s THEN ts END) ELSE 'last_close' END AS exit_reason FROM pr GROUP BY trade_id, instrument)"""


def order_book(d):
    up = F.col("close") >= F.col("open")
    c = F.col("close")
    return d.bars().select(
        F.concat_ws("-", "instrument", F.date_format("ts", "yyyyMMddHHmm")).alias("trade_id"), "instrument", F.lit("M15").alias("tf_entry"),
        F.col("ts").alias("entry_ts"), "dt", F.when(up, "long").otherwise("short").alias("side"), F.when(F.col("volume") > 2, c).alias("entry_px"),
        F.when(up, c + 40).otherwise(c - 40).alias("tp_px"), F.when(F.col("volume") < 9, F.when(up, c - 30).otherwise(c + 30)).alias("sl_px"),
        *[F.lit(v).alias(k) for k, v in (("snapshot_id", "snap1"), ("run_id", "run1"), ("mode", "backtest"))],
    )


@check("J-09", query(BR, "SELECT trade_id, instrument, exit_fill_ts, exit_fill_px, exit_reason FROM oc", "exit_fill_px"))
def _(d):
    return dc.barrier_outcomes(order_book(d), d.candles()).select("trade_id", "instrument", "exit_fill_ts", "exit_fill_px", "exit_reason")


@check("J-10", query(VOL_SQL, f"SELECT {K}, id2 AS corr_ref2_id, {corr_sql('vol', 'v2', 20)} AS corr_vol_ref2 FROM peer", "corr_vol_ref2"))
def _(d):
    out = cs.volatility_correlation(cs.peer_correlation(market(d), CORR, PANEL, tiles=3), CORR, YEAR)
    return out.select(*KEYS, "corr_ref2_id", "corr_vol_ref2")


@check("J-11", query(TOP_SQL, "SELECT a AS instrument, ts, count(*) AS n, sum(rho) AS total FROM ranked WHERE k <= 24 GROUP BY 1, 2", "total"))
def _(d):
    from barloom.operators.peers import top_peers

    # Every pair of the panel is looked at; what leaves a task is the list per instrument.
    out = top_peers(market(d), {"window": 50, "min_periods": 12, "topk": 24, "min_abs": 0.4}, PANEL, tiles=5)
    total_corr = F.aggregate("corrs", F.lit(0.0), lambda s, x: s + x)
    return out.where(F.size("peers") > 0).select("instrument", "ts", F.size("peers").cast("long").alias("n"), total_corr.alias("total"))


@check("J-12", query("", f"SELECT CAST(o_orderkey AS VARCHAR) AS trade_id, CAST(o_custkey % 5 AS VARCHAR) AS instrument, CASE WHEN o_custkey % 2 = 0 THEN o_orderdate END AS entry_ts FROM orders"))
def _(d):
    t = trades(d).drop("entry_ts", "anchor_ts")
    paths = d.table("orders").where("o_custkey % 2 = 0").select(F.col("o_orderkey").cast("string").alias("trade_id"), (F.col("o_custkey") % 5).cast("string").alias("instrument"), F.col("o_orderdate").alias("entry_ts"))
    return t.join(paths, dc.shared_keys(t, paths), "left").select("trade_id", "instrument", "entry_ts")


@check("J-13", query("", f"SELECT CAST(o_orderkey AS VARCHAR) AS trade_id, {rounded('CASE WHEN o_custkey % 2 = 0 THEN o_totalprice / 100000 END')} AS critic_score_at_entry FROM orders"))
def _(d):
    s = scored(d).withColumns({"critic_reason_tags_at_entry": F.lit("[]"), "critic_reason_cluster_id": F.lit("x")})
    paths = s.drop(*dc.CRITIC_FIELDS)
    return dc.write_back_scores(paths, s.where(F.col("side") == "long")).select("trade_id", "critic_score_at_entry")


MACRO = f"""{M15}, {CALENDAR}, fl AS (SELECT b.*, count(impact) > 0 AS hit, coalesce(max(impact), 0) AS imp FROM bars b LEFT JOIN calendar c ON b.ts >= c.blackout_start_ts AND b.ts < c.blackout_end_ts GROUP BY ALL)"""


def flagged(d):
    return cal.blackout_flags(d.bars().select(*KEYS), d.calendar(), ["M15"])


@check("J-14", query(MACRO, """SELECT t.event_id, f.hit AS macro_is_blackout, CAST(f.imp AS BIGINT) AS macro_blackout_max_impact, CAST(NULL AS VARCHAR) AS macro_state
  FROM ticks t LEFT JOIN fl f ON f.instrument = t.instrument AND f.ts = time_bucket(INTERVAL 15 MINUTE, t.ts)"""))
def _(d):
    wins = flagged(d).withColumnRenamed("ts", "anchor_ts")
    decisions = d.ticks().select("event_id", "instrument", F.lit("M15").alias("anchor_tf"), F.col("ts").alias("entry_ts"))
    return dc.enrich_macro(decisions, wins.unionByName(wins)).drop("instrument", "anchor_tf", "entry_ts")


@check("J-15", "SELECT CAST(o_orderkey AS VARCHAR) AS trade_id, 'ict' AS paradigm_id, o_orderpriority AS principle_id, CASE WHEN o_custkey % 2 = 0 THEN 'own' ELSE o_orderstatus END AS candidate_id, '∅' AS experiment_id FROM orders")
def _(d):
    s = scored(d)
    own = F.when(F.col("side") == "long", "own").otherwise("∅")
    left = s.select("instrument", "trade_id", own.alias("candidate_id"))
    return dc.attach_evaluation(left, s).drop("instrument")


@check("J-16", "SELECT o_orderkey, o_orderdate AS event_ts, o_orderdate - to_minutes(CASE o_orderstatus WHEN 'O' THEN 10 WHEN 'F' THEN 30 ELSE 15 END) AS blackout_start_ts, o_orderdate + to_minutes(CASE o_orderstatus WHEN 'O' THEN 20 WHEN 'F' THEN 40 ELSE 5 END) AS blackout_end_ts FROM orders")
def _(d):
    rows = d.table("orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("event_ts"), F.col("o_orderstatus").alias("impact"))
    return cal.blackout_bounds(rows, (15, 5), {"O": (10, 20), "F": (30, 40)}).drop("impact")


@check("J-17", query(M15, "SELECT instrument, ts AS anchor_ts, e AS tf_entry FROM bars, (VALUES ('S1'), ('M1'), ('M5'), ('M15')) v(e)"))
def _(d):
    return windows_of(d, ("S1", "M1", "M5", "M15")).drop("anchor_tf")


@check("J-18", query(GAP, f"SELECT {K}, close, CASE WHEN g THEN glo END AS fvg_lower, CASE WHEN g THEN ghi END AS fvg_upper FROM gap", "close fvg_lower fvg_upper"))
def _(d):
    gaps = fair_value_gap(with_basics(d.bars(), CFG), CFG).where("fvg_direction <> 'none'").select(*KEYS, "fvg_lower", "fvg_upper")
    return d.bars().select(*KEYS, "close").join(gaps, list(KEYS), "left")


@check("J-19", query(M15, FLOW_SQL.replace("{signed}", SIDE_SIGNED), "micro_ofi_value micro_agg_imbalance"))
def _(d):
    out = bucketed_flow(d.bars(), side_signed(d.ticks()), "M15", FLOW_CFG)
    return out.select(*KEYS, *[c for c in out.columns if c.startswith("micro_") and c != "micro_policy_id"])


@check("J-20", query(MACRO, "SELECT t.event_id, coalesce(f.hit, false) AS macro_is_blackout, CAST(coalesce(f.imp, 0) AS INTEGER) AS macro_blackout_max_impact FROM ticks t LEFT JOIN fl f ON f.instrument = t.instrument AND f.ts = t.ts - (t.ts - time_bucket(INTERVAL 1 MINUTE, t.ts))"))
def _(d):
    from barloom.functions.timegrid import snap

    t = d.ticks().select("event_id", "instrument", F.lit("M15").alias("anchor_tf"), snap(F.col("ts"), "M1").alias("entry_ts"))
    return cal.trades_in_blackout(t, flagged(d)).drop("instrument", "anchor_tf", "entry_ts")


# --- decision chain ------------------------------------------------------------------------------------

CW = f"""{ZS}, cw AS (SELECT *, ts AS anchor_ts, CASE WHEN close > open THEN 'bullish' WHEN close < open THEN 'bearish' ELSE 'none' END AS bos_dir, CASE WHEN volume > 8 THEN low END AS swl, CASE WHEN volume > 9 THEN high END AS swh,
  close AS lvl, close + 15 AS drh, close - 12 AS drl, {mean('high - low', 5, BY_DAY, 1)} AS atr FROM zs),
cd AS (SELECT *, swl IS NOT NULL OR swh IS NOT NULL OR abs(coalesce(z, 0)) > 1.0 AS hit FROM cw),
ce AS (SELECT *, bool_or(hit) OVER (PARTITION BY dt) AS hit_any, CASE WHEN bos_dir = 'bearish' THEN 'short' ELSE 'long' END AS side FROM cd),
ct AS (SELECT *, CASE WHEN side = 'long' THEN coalesce(swl, lvl) ELSE coalesce(swh, lvl) END AS entry, CASE WHEN side = 'long' THEN drh ELSE drl END AS target, e AS tf_entry,
  concat_ws('-', 'run1', instrument, anchor_tf, strftime(ts, '%Y%m%dT%H%M%S'), e) AS trade_id FROM ce, (VALUES ('M5'), ('M15')) v(e) WHERE hit OR NOT hit_any)"""


def candidate_windows(d):
    b = return_zscores(d.bars())
    c, r = F.col("close"), Rows()
    out = b.select(
        "instrument", "anchor_tf", F.col("ts").alias("anchor_ts"), "dt", "stat_ts_vol_zscore",
        F.when(c > F.col("open"), "bullish").when(c < F.col("open"), "bearish").otherwise("none").alias("bos_dir"),
        F.when(F.col("volume") > 8, F.col("low")).alias("ict_struct_swing_low"), F.when(F.col("volume") > 9, F.col("high")).alias("ict_struct_swing_high"),
        c.alias("bos_level_px"), (c + 15).alias("ict_struct_dealing_range_high"), (c - 12).alias("ict_struct_dealing_range_low"),
        r.mean(F.col("high") - F.col("low"), 5, 1).alias("atr_anchor"),
    )
    return expand_entries(out, ("M1", "M5", "M15"))


CAND_CFG = {"tf_entry_allowlist": ["M5", "M15"]}
TRADE = "trade_id, instrument, anchor_tf, anchor_ts, tf_entry, side"


@check("O-01", query(f"{ZS}", f"""SELECT {K}, r AS stat_ts_return, z AS stat_ts_vol_zscore, {div(total('dp * q', 50, BY_DAY, 10), total('q * q', 50, BY_DAY, 10), 'NULL')} AS impact_kyle_lambda, {std('r', 20, BY_DAY, 2)} AS ta_vol__ret1_std
  FROM (SELECT *, volume * CASE WHEN dp > 0 THEN 1.0 WHEN dp < 0 THEN -1.0 ELSE 0.0 END AS q FROM (SELECT *, close - {lag('close', BY_DAY)} AS dp FROM zs))""", "stat_ts_return stat_ts_vol_zscore impact_kyle_lambda ta_vol__ret1_std"))
def _(d):
    table = feature_table(d.bars(), d.calendar(), side_signed(d.ticks()), {"ict_struct": CFG}, ["M15"], materialise=cut_lineage)
    return table.select(*KEYS, "stat_ts_return", "stat_ts_vol_zscore", "impact_kyle_lambda", "ta_vol__ret1_std")


@check("O-02", query(f"{FOLD}, {ZS.split(M15 + ',', 1)[1]}", f"""SELECT b.instrument, b.anchor_tf, b.ts AS anchor_ts, e AS tf_entry, b.dt, b.z AS stat_ts_vol_zscore, 'mixed' AS zone_behaviour_type_bucket, p.dr_id, p.dr_reason_code
  FROM zs b JOIN ({FOLD_SELECT}) p ON p.instrument = b.instrument AND p.anchor_ts = b.ts, {ENTRIES}""", "stat_ts_vol_zscore"))
def _(d):
    bars = d.bars()
    features = family_frame("stat_ts", bars)
    zones = zones_table(bars)
    out = context_windows(d.candles(), features, zones, range_phases(bars, RANGE), ["M15"], ["M1", "M5"])
    return out.select(*WKEYS, "tf_entry", "dt", "stat_ts_vol_zscore", "zone_behaviour_type_bucket", "dr_id", "dr_reason_code")


@check("O-03", query(CW, f"SELECT {TRADE}, entry AS entry_px, target AS exit_px, target AS tp_px, CASE WHEN side = 'long' THEN entry - atr ELSE entry + atr END AS sl_px FROM ct", "entry_px exit_px tp_px sl_px"))
def _(d):
    out = dc.candidate_trades(candidate_windows(d), CTX, CAND_CFG)
    return out.select(*TRADE.split(", "), "entry_px", "exit_px", "tp_px", "sl_px")


@check("O-04", query(CW, """SELECT 'ict' AS paradigm_id, 'p' || CAST(n AS VARCHAR) AS principle_id, CASE n WHEN 1 THEN '∅' ELSE 'c2' END AS candidate_id, '∅' AS experiment_id, count(*) AS n_trades FROM ce, (VALUES (1, 1.0), (2, 2.5)) v(n, cut), (VALUES ('M5'), ('M15')) w(e)
  WHERE swl IS NOT NULL OR swh IS NOT NULL OR abs(coalesce(z, 0)) > cut GROUP BY n"""))
def _(d):
    plan = [dc.Evaluation("ict", "p1"), dc.Evaluation("ict", "p2", "c2", " ", {"vol_z_abs_min": 2.5})]
    out = dc.evaluate_all(candidate_windows(d), CTX, plan, {**CAND_CFG, "fallback_all": False})
    return out.groupBy("paradigm_id", "principle_id", "candidate_id", "experiment_id").agg(F.count(F.lit(1)).alias("n_trades"))


@check("O-05", query(TICKS, """SELECT event_id, coalesce(a, ts) AS anchor_ts, CASE WHEN src IS NOT NULL AND trim(src) <> '' THEN src WHEN coalesce(a, ts) = ts THEN 'anchor_close' ELSE 'signal_ts' END AS entry_ts_source,
  (epoch_us(ts) - epoch_us(coalesce(a, ts))) // 1000 AS entry_ts_offset_ms, epoch_us(ts) % 900000000 = 0 AS entry_ts_is_aligned_anchor_tf, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) % 1000000 = 0 END AS entry_ts_is_aligned_entry_tf
  FROM (SELECT event_id, ts, CASE WHEN event_id % 3 > 0 THEN time_bucket(INTERVAL 15 MINUTE, ts) END AS a, CASE event_id % 4 WHEN 0 THEN 'feed' WHEN 1 THEN ' ' END AS src FROM ticks)"""))
def _(d):
    from barloom.functions.timegrid import snap

    e = F.col("event_id")
    paths = d.ticks().select(
        "event_id", F.col("ts").alias("entry_ts"), F.when(e % 3 > 0, snap(F.col("ts"), "M15")).alias("anchor_ts"), F.when(e % 4 == 0, "feed").when(e % 4 == 1, " ").alias("entry_ts_source"),
        F.lit("M15").alias("anchor_tf"), F.when(e % 2 == 0, "S1").otherwise("??").alias("tf_entry"),
    )
    return dc.finish_paths(paths).select("event_id", "anchor_ts", "entry_ts_source", "entry_ts_offset_ms", "entry_ts_is_aligned_anchor_tf", "entry_ts_is_aligned_entry_tf")


@check("O-06", query(TICKS, "SELECT event_id, 'M15' AS anchor_tf, time_bucket(INTERVAL 15 MINUTE, CASE WHEN event_id % 2 = 0 THEN ts ELSE ts + INTERVAL 1 HOUR END) AS anchor_ts FROM ticks"))
def _(d):
    e = F.col("event_id")
    base = d.ticks().select(e.cast("string").alias("trade_id"), "instrument", "event_id", "ts")
    decisions = base.select("trade_id", "instrument", "event_id", F.when(e % 3 > 0, "M15").alias("anchor_tf"), F.when(e % 2 == 0, F.col("ts")).alias("anchor_ts"))
    paths = base.select("trade_id", "instrument", F.lit("M15").alias("anchor_tf"), (F.col("ts") + F.make_dt_interval(hours=F.lit(1))).alias("entry_ts"))
    return dc.enrich_anchor(decisions, paths).select("event_id", "anchor_tf", "anchor_ts")


VR = "CASE user_id % 4 WHEN 0 THEN 'Low_vol' WHEN 1 THEN 'high' WHEN 2 THEN 'mid' END"
TR = "CASE user_id % 3 WHEN 0 THEN 'strong_up' WHEN 1 THEN 'Range' ELSE 'weak' END"
CRIT = f"""(SELECT event_id, event_type AS instrument, event_id % 6 = 0 AS blk, CASE WHEN event_id % 5 > 0 THEN event_id % 5 - 1 END AS imp, CASE WHEN event_id % 7 > 0 THEN (value - 50) / 30 END AS vz, value > 120 AS sw,
  coalesce({VR}, '') AS vr, {TR} AS tr, event_id % 11 = 0 AS st FROM events)"""
TAG_SQL = """list_filter([CASE WHEN blk THEN 'macro_blackout' END, CASE WHEN imp >= 3 THEN 'macro_blackout_impact_high' END,
  CASE WHEN vz IS NULL THEN 'volatility_missing' WHEN least(abs(vz), 3) >= 1 THEN 'volatility_confluence' ELSE 'volatility_below_threshold' END, CASE WHEN sw THEN 'structural_confluence' END,
  CASE WHEN vr LIKE '%low%' AND tr LIKE '%strong%' THEN 'regime_mismatch_vol_low_trend_strong' END, CASE WHEN vr LIKE '%high%' AND tr LIKE '%range%' THEN 'regime_mismatch_vol_high_range' END,
  CASE WHEN vr = '' THEN 'regime_context_missing' END, CASE WHEN st THEN 'corr_regime_high' END, 'anchor_tf:M15', 'instrument:' || instrument], lambda t: t IS NOT NULL)"""
SCORE = """CASE WHEN blk THEN -1.0 ELSE 0 END - CASE WHEN imp >= 3 THEN 0.4 ELSE 0 END + CASE WHEN vz IS NULL THEN 0 WHEN least(abs(vz), 3) >= 1 THEN 0.5 ELSE -0.2 END + CASE WHEN sw THEN 0.3 ELSE 0 END
  - CASE WHEN vr LIKE '%low%' AND tr LIKE '%strong%' THEN 0.15 ELSE 0 END - CASE WHEN vr LIKE '%high%' AND tr LIKE '%range%' THEN 0.15 ELSE 0 END - CASE WHEN st THEN 0.1 ELSE 0 END"""
CRITIC_SQL = f"""SELECT event_id, {rounded(SCORE)} AS critic_score_at_entry, '["' || array_to_string({TAG_SQL}, '","') || '"]' AS critic_reason_tags_at_entry, ({TAG_SQL})[1] AS critic_reason_cluster_id
  FROM (SELECT * REPLACE (lower(vr) AS vr, lower(tr) AS tr) FROM {CRIT})"""


def critic_input(d):
    e, u = F.col("event_id"), F.col("user_id")
    vz = F.when(e % 7 > 0, (F.col("value") - 50) / 30)
    # Odd events carry their z-score only in the JSON, some JSON is broken where it does not matter.
    js = F.when(e % 2 == 1, F.to_json(F.struct(vz.alias("stat_ts_vol_zscore")))).otherwise("{oops")
    return d.table("events").select(
        "event_id", e.cast("string").alias("trade_id"), F.col("event_type").alias("instrument"), F.lit("M15").alias("anchor_tf"), F.lit("ict").alias("paradigm_id"), F.lit("p").alias("principle_id"),
        (e % 6 == 0).alias("macro_is_blackout"), F.when(e % 5 > 0, e % 5 - 1).alias("macro_blackout_max_impact"), F.when(e % 2 == 0, vz).alias("stat_ts_vol_zscore"), js.alias("hypothesis_features_json"),
        F.when(F.col("value") > 120, F.col("value")).alias("ict_struct_swing_high"), F.when(u % 4 == 0, "Low_vol").when(u % 4 == 1, "high").when(u % 4 == 2, "mid").alias("vol_regime"),
        F.when(u % 3 == 0, "strong_up").when(u % 3 == 1, "Range").otherwise("weak").alias("trend_regime"), F.when(e % 11 == 0, "Stress").alias("micro_corr_regime"),
    )


@check("O-07", CRITIC_SQL)
def _(d):
    return dc.context_critic(critic_input(d)).select("event_id", *dc.CRITIC_FIELDS)


@check("O-08", "SELECT CAST(event_id AS VARCHAR) AS trade_id, event_type AS instrument, 'ict' AS paradigm_id, 'p' AS principle_id, '∅' AS candidate_id, '∅' AS experiment_id, 0.0::DOUBLE AS critic_score_at_entry, 'dev_noop' AS critic_reason_tags_at_entry, 'dev_noop' AS critic_reason_cluster_id FROM events")
def _(d):
    rows = critic_input(d)
    return dc.neutral_critic(rows.unionByName(rows))


def two_paradigms(d):
    return critic_input(d).withColumn("paradigm_id", F.when(F.col("event_id") % 3 == 0, "plain").otherwise("ict"))


@check("O-09", f"SELECT c.event_id, CASE WHEN c.event_id % 3 = 0 THEN 0.0::DOUBLE ELSE critic_score_at_entry END AS critic_score_at_entry, CASE WHEN c.event_id % 3 = 0 THEN 'dev_noop' ELSE critic_reason_cluster_id END AS critic_reason_cluster_id FROM ({CRITIC_SQL}) c")
def _(d):
    t = two_paradigms(d)
    paths = t.select("event_id", "trade_id", "instrument", "paradigm_id", "principle_id")
    _scored, _summary, updated = dc.apply_critics(paths, t, {"ict": dc.context_critic})
    return updated.select("event_id", "critic_score_at_entry", "critic_reason_cluster_id")


@check("O-10", "SELECT event_id, event_id % 6 = 0 AS macro_is_blackout, CASE WHEN event_id % 6 = 0 THEN 'macro_blackout' ELSE '' END AS macro_blackout_tag, event_id % 6 <> 0 AS kept FROM events")
def _(d):
    rows = critic_input(d)
    tagged = dc.blackout_policy(rows, "tag_only").select("event_id", "macro_is_blackout", "macro_blackout_tag")
    kept = dc.blackout_policy(rows, "drop").select("event_id", F.lit(True).alias("kept"))
    return tagged.join(kept, "event_id", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))


@check("O-11", f"SELECT o_orderpriority AS principle_id, 'allowed_dev_stub' AS gatekeeper_status, count(*) AS n FROM orders GROUP BY o_orderpriority")
def _(d):
    return dc.gatekeep(scored(d)).groupBy("principle_id", "gatekeeper_status").agg(F.count(F.lit(1)).alias("n"))


@check("O-12", f"SELECT CAST(o_custkey % 7 AS VARCHAR) AS instrument_cluster_id, 0.0::DOUBLE AS portfolio_risk_bps_at_entry, CAST(sum(1) AS BIGINT) AS n FROM orders GROUP BY o_custkey % 7")
def _(d):
    sized = dc.size_positions(scored(d))
    return sized.groupBy("instrument_cluster_id", "portfolio_risk_bps_at_entry").agg(F.count(F.lit(1)).alias("n"))


@check("O-13", query(f"{CW}, {bars_cte('five', 'M5', 5)}", """SELECT trade_id, instrument, side, tf_entry, anchor_ts AS entry_ts, coalesce(px, CASE WHEN tf_entry = 'M15' THEN open ELSE (SELECT arg_min(f.open, f.ts) FROM five f WHERE f.instrument = q.instrument AND f.dt = q.dt AND f.ts >= q.ts) END) AS entry_px, target AS tp_px, 'dev_stub' AS order_type
  FROM (SELECT *, CASE WHEN volume > 4 THEN entry END AS px FROM ct) q""", "entry_px tp_px"))
def _(d):
    t = dc.candidate_trades(candidate_windows(d), CTX, CAND_CFG)
    volumes = d.bars().select("instrument", F.col("ts").alias("anchor_ts"), "volume")
    paths = dc.paths_of(t).join(volumes, ["instrument", "anchor_ts"]).withColumn("entry_px", F.when(F.col("volume") > 4, F.col("entry_px")))
    candles = d.candles("M15").unionByName(d.candles("M5"))
    out = dc.fill_entry_price(dc.brackets(paths, CTX), candles)
    return out.select("trade_id", "instrument", "side", "tf_entry", "entry_ts", "entry_px", "tp_px", "order_type")


@check("O-14", query(BR, """SELECT trade_id, instrument, side, dt, entry_fill_ts AS fill_ts, entry_fill_px AS fill_px, 'entry' AS fill_type FROM oc UNION ALL SELECT trade_id, instrument, side, dt, exit_fill_ts, exit_fill_px, 'exit' FROM oc""", "fill_px"))
def _(d):
    fills = dc.fill_rows(dc.barrier_outcomes(order_book(d), d.candles()))
    return fills.drop("snapshot_id", "run_id", "mode")


@check("O-15", f"""SELECT CAST(o_orderdate AS DATE) AS dt, CASE WHEN grouping(o_orderstatus) = 1 THEN 'run_total' ELSE 'evaluation' END AS report_level, CASE WHEN grouping(o_orderstatus) = 1 THEN '∅' ELSE o_orderpriority END AS principle_id,
  CASE WHEN grouping(o_orderstatus) = 1 THEN '∅' ELSE o_orderstatus END AS candidate_id, count(*) AS n_trades, count(*) FILTER (o_custkey % 3 > 0) AS n_decisions_pretrade, 0::BIGINT AS n_brackets
  FROM orders GROUP BY GROUPING SETS ((CAST(o_orderdate AS DATE), o_orderpriority, o_orderstatus), (CAST(o_orderdate AS DATE)))""")
def _(d):
    s = scored(d)
    keep = ("instrument", "trade_id", "dt", "paradigm_id", "principle_id", "candidate_id", "experiment_id")
    tables = {"trade_paths": s.select(*keep), "decisions_pretrade": dc.blackout_policy(s).select("instrument", "trade_id", "dt")}
    report = dc.run_report(tables, s, CTX, unit=["dt"])
    return report.select("dt", "report_level", "principle_id", "candidate_id", "n_trades", "n_decisions_pretrade", "n_brackets")


@check("O-16", query(ZS, "SELECT cut::DOUBLE AS threshold, dt, count(*) FILTER (abs(coalesce(z, 0)) > cut) AS candidates FROM zs, (VALUES (0.5), (1.0), (1.5), (2.0)) v(cut) GROUP BY 1, 2"))
def _(d):
    return dc.threshold_sweep(return_zscores(d.bars()).select("dt", "stat_ts_vol_zscore"), [0.5, 1.0, 1.5, 2.0])


CELLS_SQL = " || ".join(
    f"CASE WHEN {x} IS NULL THEN 'n' ELSE length({x}) || ':' || {x} END"
    for x in ("CAST(event_id AS VARCHAR)", "event_type", "props", "CAST(epoch_us(ts) AS VARCHAR)", "CAST(user_id AS VARCHAR)", "CAST(CAST(floor(value * 1e6 + 0.50013) AS BIGINT) AS VARCHAR)")
)


@check("O-17", f"""WITH h AS (SELECT md5({CELLS_SQL}) AS h FROM events),
  n AS (SELECT CAST('0x' || h[1:8] AS BIGINT) AS a, CAST('0x' || h[9:23] AS BIGINT) AS b FROM h)
  SELECT count(*) AS rows, CAST(sum(a) AS VARCHAR) AS sum_32, CAST(sum(b) AS VARCHAR) AS sum_60, bit_xor(b) AS xor_60, true AS same_when_shuffled, true AS differs_when_changed FROM n""")
def _(d):
    e = d.table("events")
    mixed = e.repartition(7, "user_id").select(*reversed(e.columns))
    other = e.withColumn("value", F.when(F.col("event_id") == 0, F.col("value") + 1).otherwise(F.col("value")))
    parts = [qa.portable_digest(x).withColumn("which", F.lit(n)) for n, x in (("a", e), ("b", mixed), ("c", other))]
    names = ("rows", "sum_32", "sum_60", "xor_60")
    row = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy().pivot("which", ["a", "b", "c"]).agg(*[F.max(n).alias(n) for n in names])
    same = [F.col(f"a_{n}") == F.col(f"b_{n}") for n in names]
    return row.select(
        *[F.col(f"a_{n}").alias(n) for n in names], (same[0] & same[1] & same[2] & same[3]).alias("same_when_shuffled"),
        ((F.col("a_sum_32") != F.col("c_sum_32")) & (F.col("a_sum_60") != F.col("c_sum_60")) & (F.col("a_xor_60") != F.col("c_xor_60"))).alias("differs_when_changed"),
    )


@check("O-18", "SELECT count(*) AS rows, count(*) FILTER (event_id % 50 = 0) AS null_key_rows, count(*) - count(DISTINCT coalesce(CASE WHEN event_id % 50 > 0 THEN user_id END, -1)) AS duplicate_rows FROM events")
def _(d):
    rows = d.table("events").select(F.when(F.col("event_id") % 50 > 0, F.col("user_id")).alias("k"))
    return qa.key_invariants(rows, ["k"]).select(*[F.col(c).cast("long").alias(c) for c in ("rows", "null_key_rows", "duplicate_rows")])


@check("O-19", """SELECT 'events' AS "table", sha256('event_id:bigint|ts:timestamp_ntz') AS schema_fingerprint, 'event_id' AS key_columns, count(*) AS rows FROM events
  UNION ALL SELECT 'none', sha256('event_id:bigint|ts:timestamp_ntz'), '', 0""")
def _(d):
    e = d.table("events").select("event_id", "ts")
    return qa.manifest({"events": e, "none": e.where("event_id < 0")}, {"events": ["event_id"]})


@check("O-20", """SELECT 'events' AS "table", count(*) AS rows FROM events UNION ALL SELECT 'orders', count(*) FROM orders""")
def _(d):
    return qa.column_check({"events": d.table("events"), "orders": d.table("orders")}, {"events": ["event_id", "ts"], "orders": ["o_orderkey"]})


@check("O-21", query(MACRO, "SELECT f.instrument, count(*) AS trades, count(*) FILTER (f.hit) AS in_blackout, 100.0 * count(*) FILTER (f.hit) / count(*) AS pct FROM ticks t JOIN fl f ON f.instrument = t.instrument AND f.ts = time_bucket(INTERVAL 15 MINUTE, t.ts) GROUP BY 1", "pct"))
def _(d):
    from barloom.functions.timegrid import snap

    t = d.ticks().select("instrument", F.lit("M15").alias("anchor_tf"), snap(F.col("ts"), "M15").alias("entry_ts"))
    seen = cal.trades_in_blackout(t, flagged(d))
    hit = F.sum(F.col("macro_is_blackout").cast("long"))
    return seen.groupBy("instrument").agg(F.count(F.lit(1)).alias("trades"), hit.alias("in_blackout"), (100.0 * hit / F.count(F.lit(1))).alias("pct"))


@check("O-22", """SELECT 'ticks' AS "table", CAST(ts AS DATE) AS dt, count(*) AS rows FROM events GROUP BY 2 UNION ALL SELECT 'errors', CAST(ts AS DATE), count(*) FROM events WHERE event_type = 'error' GROUP BY 2""")
def _(d):
    e = d.table("events").withColumn("dt", F.to_date("ts"))
    return qa.table_counts({"ticks": e, "errors": e.where("event_type = 'error'")}, ["dt"])


@check("O-chain", f"""WITH RECURSIVE {EVENT_CTES}, told_all AS ({EVENT_BODY}), counted AS (SELECT count(*) AS n FROM bars)
  SELECT 'features' AS "table", n AS rows FROM counted UNION ALL SELECT 'windows', n FROM counted UNION ALL SELECT 'zones_state', 2 * n FROM counted
  UNION ALL SELECT 'features_corr', n FROM counted UNION ALL SELECT 'market_events', count(*) FROM told_all UNION ALL SELECT 'fills without a partner', 0""")
def _(d):
    """The whole chain, candles given twice: a feature row and a window a bar, two zones, the structure's events; each trade has an entry and an exit fill."""
    candles = d.candles()
    tables = run(CTX, candles.unionByName(candles), ["M15"], ["M15"], d.ticks(), d.calendar(), cfg={"ict_struct": CFG, "dealing_range_state": RANGE}, ticks_have_sides=True, materialise=cut_lineage, universe=d.universe(d.bars()))
    fills = tables["fills"].groupBy("trade_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("fill_type").alias("k"))
    alone = fills.where(~((F.col("n") == 2) & (F.col("k") == 2)))
    found = [(n, tables[n]) for n in ("features", "windows", "zones_state", "features_corr", "market_events")] + [("fills without a partner", alone)]
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in found]
    return reduce(lambda x, y: x.unionByName(y), parts)


# --- trade paths --------------------------------------------------------------------------------------------

EXC = f"""{BR}, ex AS (SELECT trade_id, instrument, row_number() OVER (PARTITION BY trade_id ORDER BY ts) - 1 AS n, CASE WHEN side = 'long' THEN high - entry_px ELSE entry_px - low END / nullif(abs(entry_px - sl_px), 0) AS gain,
  CASE WHEN side = 'long' THEN entry_px - low ELSE high - entry_px END / nullif(abs(entry_px - sl_px), 0) AS loss FROM pr),
me AS (SELECT trade_id, min(CASE WHEN gain >= 1 THEN n END) AS t1, min(CASE WHEN gain >= 2 THEN n END) AS t2, CASE WHEN count(gain) > 0 THEN greatest(max(loss), 0) END AS mae, CASE WHEN count(gain) > 0 THEN greatest(max(gain), 0) END AS mfe FROM ex GROUP BY trade_id),
sh AS (SELECT *, CASE WHEN t1 <= 6 AND mfe >= 2 AND mae <= 0.5 THEN 'straight_runner' WHEN mfe >= 2 AND mae > 0.5 THEN 'dip_then_go' WHEN t1 > 6 AND mfe >= 1.5 THEN 'grind_then_go' WHEN mfe < 1 AND mae >= 1 THEN 'straight_fail' WHEN t1 > 6 AND mfe < 1 THEN 'chop_and_die' ELSE 'unknown' END AS shape FROM me)"""
FIRST = "CASE shape WHEN 'straight_runner' THEN 'fast_winner' WHEN 'dip_then_go' THEN 'drawdown_then_win' WHEN 'grind_then_go' THEN 'slow_winner' WHEN 'straight_fail' THEN 'fast_loser' WHEN 'chop_and_die' THEN 'chop_loser' END"
PTAGS = f"list_filter([{FIRST}, CASE WHEN mae >= 1 THEN 'deep_mae' END, CASE WHEN mfe >= 2 THEN 'high_mfe' END], lambda t: t IS NOT NULL)"


@check("F-70", query(EXC, f"""SELECT trade_id, t1 AS time_to_1R_bars, t2 AS time_to_2R_bars, mae AS mae_R, mfe AS mfe_R, shape AS path_shape,
  CASE WHEN mae <= 0.25 THEN '<= 0.25' WHEN mae <= 0.5 THEN '(0.25,0.5]' WHEN mae <= 0.75 THEN '(0.5,0.75]' WHEN mae <= 1 THEN '(0.75,1]' WHEN mae <= 1.5 THEN '(1,1.5]' WHEN mae <= 2 THEN '(1.5,2]' WHEN mae > 2 THEN '> 2' END AS mae_R_bucket,
  CASE WHEN shape IN ('straight_runner', 'dip_then_go', 'grind_then_go') THEN 'winners' WHEN shape = 'unknown' THEN 'unknown' ELSE 'losers' END AS path_family_id, {FIRST} AS path_filter_primary,
  CASE WHEN len({PTAGS}) = 0 THEN '[]' ELSE '["' || array_to_string({PTAGS}, '","') || '"]' END AS path_filter_tags_json FROM sh""", "mae_R mfe_R"))
def _(d):
    measured = dc.excursions(order_book(d), d.candles())
    out = path_classes(measured, {"path_shape_time_to_1R_bars_max": 6})
    return out.drop("path_cluster_id", "exit_reason")


# --- callables ------------------------------------------------------------------------------------------------


@check("P-01", "SELECT event_id, sha1(strftime(ts, '%Y-%m-%dT%H:%M:%S') || '|USD|' || event_type || '|' || props || '|src') AS id FROM events")
def _(d):
    from barloom.functions.expr import sha1_id

    return d.table("events").select("event_id", sha1_id(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("USD"), F.col("event_type"), F.col("props"), F.lit("src")).alias("id"))


@check("P-02", query(CW, "SELECT 'mine' AS paradigm_id, instrument, count(*) AS n FROM cw, (VALUES ('M1'), ('M5'), ('M15')) v(e) WHERE volume > 6 GROUP BY instrument"))
def _(d):
    volumes = d.bars().select("instrument", F.col("ts").alias("anchor_ts"), "volume")

    def builder(windows, ctx, cfg):
        busy = windows.join(volumes, ["instrument", "anchor_ts"]).where("volume > 6")
        return dc.candidate_trades(busy, ctx, {**cfg, "vol_z_abs_min": -1.0})

    out = dc.evaluate_all(candidate_windows(d), CTX, [dc.Evaluation("mine", "p")], builders={("mine", "*"): builder})
    return out.groupBy("paradigm_id", "instrument").agg(F.count(F.lit(1)).alias("n"))


@check("P-03", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0.0::DOUBLE ELSE 7.5::DOUBLE END AS critic_score_at_entry FROM events")
def _(d):
    def critic(rows):
        return rows.withColumns({"critic_score_at_entry": F.lit(7.5), "critic_reason_tags_at_entry": F.lit("[]"), "critic_reason_cluster_id": F.lit("flat")})

    t = two_paradigms(d)
    _s, _c, updated = dc.apply_critics(t.select("event_id", "trade_id", "instrument", "paradigm_id", "principle_id"), t, {"ict": critic})
    return updated.select("event_id", "critic_score_at_entry")


# --- streaming ---------------------------------------------------------------------------------------------------


def tick_stream(d):
    schema = d.table("events").schema
    raw = d.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d.folder)
    k = F.get_json_object("props", "$.k").cast("int")
    return raw.select(
        F.col("event_type").alias("instrument"), "ts", F.col("value").alias("price"), (1 + k % 5).cast("double").alias("size"),
        F.when(k < 50, "buy").otherwise("sell").alias("side"), "event_id",
    )


CLOSED = "ts + INTERVAL 15 MINUTE <= date_trunc('milliseconds', (SELECT max(ts) FROM ticks)) - INTERVAL 10 MINUTE"


@check("R-01", query(M15, f"SELECT instrument, anchor_tf AS tf, ts, open, high, low, close, volume FROM bars WHERE {CLOSED}", "open high low close volume"))
def _(d):
    return live.drain(live.live_bars(tick_stream(d), "M15", tie="event_id"), d.spark, "r01")


@check("R-02", query(M15, f"SELECT * FROM ({FLOW_SQL.replace('{signed}', SIDE_SIGNED)}) WHERE {CLOSED}", "micro_ofi_value micro_agg_imbalance micro_intensity_events"))
def _(d):
    return live.drain(live.live_flow(side_signed(tick_stream(d)), "M15", cfg=FLOW_CFG), d.spark, "r02")


def stored_bars(d):
    """Bars written out once, to be read back as a stream."""
    folder = shared_folder(d.spark, "bars")
    d.bars().write.parquet(folder)
    return folder


@check("R-03", query(FOLD, """SELECT e.instrument, e.ts, q.phase AS dr_phase, q.why AS dr_reason_code, CAST(CASE WHEN q.phase IS NOT NULL THEN q.age END AS BIGINT) AS dr_age_bars FROM ev e JOIN q USING (instrument, dt, i)
  WHERE e.ts <= (SELECT max(ts) FROM ev) - INTERVAL 10 MINUTE"""))  # the rest still waits for the watermark
def _(d):
    d.spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    folder = stored_bars(d)
    stream = d.spark.readStream.schema(d.bars().schema).parquet(folder)
    out = live.drain(live.live_phases(stream, RANGE), d.spark, "r03")
    ts = F.timestamp_micros("us").cast("timestamp_ntz").alias("ts")
    return out.select("instrument", ts, F.col("fold_phase").alias("dr_phase"), F.col("fold_reason").alias("dr_reason_code"), F.col("fold_age").alias("dr_age_bars"))


@check("R-04", query(f"{M15}, {CALENDAR}", """SELECT b.instrument, b.anchor_tf, b.ts, count(impact) > 0 AS macro_is_blackout, CAST(coalesce(max(impact), 0) AS INTEGER) AS macro_blackout_max_impact
  FROM (SELECT instrument, anchor_tf, ts FROM bars UNION ALL SELECT instrument, anchor_tf, ts + to_seconds(7 * 60 + 13) FROM bars) b
  LEFT JOIN calendar c ON b.ts >= c.blackout_start_ts AND b.ts < c.blackout_end_ts GROUP BY ALL"""))
def _(d):
    stream = d.spark.readStream.schema(d.bars().schema).parquet(stored_bars(d)).select(*KEYS)
    between = stream.withColumn("ts", F.col("ts") + F.make_dt_interval(mins=F.lit(7), secs=F.lit(13)))  # bars off the grid
    return live.drain(live.live_blackout(stream.unionByName(between), d.calendar(), "M15"), d.spark, "r04").select(*KEYS, "macro_is_blackout", "macro_blackout_max_impact")
