"""Liquidity, market structure and range phases (F-30 … F-63)."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import flow, liquidity
from barloom.operators import structure as st
from barloom.operators.range_phase import attach_phases, range_descriptors, range_evidence, range_phases
from barloom.plans.features import POLICY
from barloom.session import cut_lineage

from .base import BY_DAY, M15, check, div, lag, mean, query, std, total, true_range

KEYS = ("instrument", "anchor_tf", "ts")
K = "instrument, anchor_tf, ts"
TICK = 0.01
CFG = {
    "tick_size": TICK,
    "eq_level_ticks_max": 150.0,
    "eq_lookback_bars": 30,
    "mms_compression_window_bars": 8,
    "mms_compression_atr_z_max": 0.8,
    "mms_distribution_range_atr_min": 3.5,
    "dealing_range_lookback_bars": 20,
    "choch_z_cut": 0.2,
    "fvg_max_origin_age_bars": 20,
    "ob_max_origin_age_bars": 25,
}

def w(start: str, end: str) -> str:
    return f"OVER (PARTITION BY {BY_DAY} ORDER BY ts ROWS BETWEEN {start} AND {end})"


def head(n: str) -> str:
    """Frame of the bar and the n - 1 before it."""
    return w(f"{n} PRECEDING", "CURRENT ROW")


BASE = f"""{M15},
trs AS (SELECT *, coalesce({true_range(BY_DAY)}, 0.0) AS tr, row_number() OVER (PARTITION BY {BY_DAY} ORDER BY ts) - 1 AS i FROM bars),
atrs AS (SELECT *, {mean('tr', 14, BY_DAY, 1)} AS atr FROM trs),
s AS (SELECT *, {div('atr - ' + mean('atr', 50, BY_DAY, 10), std('atr', 50, BY_DAY, 10))} AS z FROM atrs)"""


def basics(d):
    return st.with_basics(d.bars(), CFG)


# --- displacement, gaps ---------------------------------------------------------------------

RNG = "greatest(high - low, 1e-9::DOUBLE)"
DISP = f"""{BASE},
d0 AS (SELECT *, CASE WHEN atr > 1e-9 THEN (high - low) / atr ELSE 0.0 END AS ra, abs(close - open) / {RNG} AS br, (close - low) / {RNG} AS cl,
  CASE WHEN close > open THEN 'up' WHEN close < open THEN 'down' ELSE 'none' END AS dir FROM s),
d1 AS (SELECT *, ra >= 1.2 AND br >= 0.6 AND ((dir = 'up' AND cl >= 0.7) OR (dir = 'down' AND 1 - cl >= 0.7)) AS disp,
  greatest(0.0, least(1.0, (ra / 1.2 + br / 0.6 + CASE WHEN dir = 'up' THEN cl ELSE 1 - cl END / 0.7) / 3)) AS base,
  CASE dir WHEN 'up' THEN max(high) {w('1 FOLLOWING', '2 FOLLOWING')} - high WHEN 'down' THEN low - min(low) {w('1 FOLLOWING', '2 FOLLOWING')} END AS follow FROM d0),
disp AS (SELECT *, CASE WHEN NOT disp THEN base WHEN follow >= 0.25 * atr THEN base ELSE base * 0.25 END AS dq FROM d1)"""


@check(
    "F-40",
    query(DISP, f"""SELECT {K}, atr AS atr_anchor, z AS atr_z, disp AS displacement_flag, dir AS displacement_dir, ra AS displacement_range_atr,
      br AS displacement_body_ratio, cl AS displacement_close_loc, dq AS displacement_quality FROM disp""",
      "atr_anchor atr_z displacement_range_atr displacement_body_ratio displacement_close_loc displacement_quality"),
)
def _(d):
    out = st.displacement(basics(d), CFG)
    return out.select(*KEYS, "atr_anchor", "atr_z", *[c for c in out.columns if c.startswith("displacement_")])


GAP = f"""{DISP},
g0 AS (SELECT *, {lag('high', BY_DAY, 2)} AS h2, {lag('low', BY_DAY, 2)} AS l2, {lag('ra', BY_DAY)} AS ra1, {lag('br', BY_DAY)} AS br1 FROM disp),
g1 AS (SELECT *, low > h2 AS bull, CASE WHEN low > h2 THEN h2 WHEN high < l2 THEN high END AS glo, CASE WHEN low > h2 THEN low WHEN high < l2 THEN l2 END AS ghi FROM g0),
gap AS (SELECT *, coalesce(ghi - glo > 0 AND (ghi - glo) / 0.01::DOUBLE >= 8 AND ra1 >= 1 AND br1 >= 0.55, false) AS g FROM g1)"""
GAP_COLUMNS = """CASE WHEN g THEN CASE WHEN bull THEN 'bull' ELSE 'bear' END ELSE 'none' END AS fvg_direction,
  CASE WHEN g THEN (ghi - glo) / 0.01::DOUBLE ELSE 0.0 END AS fvg_gap_ticks, CASE WHEN g THEN ghi END AS fvg_upper, CASE WHEN g THEN glo END AS fvg_lower,
  CASE WHEN g THEN (ghi + glo) / 2 END AS fvg_mid"""


@check(
    "F-41",
    query(GAP, f"""SELECT {K}, {GAP_COLUMNS}, CASE WHEN g THEN ts END AS fvg_origin_ts, anchor_tf AS fvg_origin_tf, CASE WHEN g THEN 0 END AS fvg_age_bars,
      CASE WHEN g THEN ra1 END AS fvg_origin_impulse_atr, CASE WHEN g THEN br1 END AS fvg_origin_body_ratio FROM gap""",
      "fvg_gap_ticks fvg_upper fvg_lower fvg_mid fvg_origin_impulse_atr fvg_origin_body_ratio"),
)
def _(d):
    out = st.fair_value_gap(basics(d), CFG)
    return out.select(*KEYS, *[c for c in out.columns if c.startswith("fvg_")])


FILL = f"""{GAP}, reach AS (SELECT *, max(high) {w('CURRENT ROW', '2 FOLLOWING')} AS mx, min(low) {w('CURRENT ROW', '2 FOLLOWING')} AS mn FROM gap),
pairs AS (SELECT g.instrument, g.dt, g.i, b.i AS j, b.atr AS a, g.bull, g.ghi, g.glo, b.mx, b.mn,
    greatest(0.0, least(b.high, g.ghi) - greatest(b.low, g.glo)) / (g.ghi - g.glo) AS part,
    CASE WHEN g.bull THEN least(b.high, g.ghi) ELSE greatest(b.low, g.glo) END AS px
  FROM gap g JOIN reach b ON b.instrument = g.instrument AND b.dt = g.dt AND b.i > g.i AND b.i <= g.i + 20 WHERE g.g),
touch AS (SELECT *, row_number() OVER (PARTITION BY instrument, dt, i ORDER BY j) AS k FROM pairs WHERE part > 0),
fills AS (SELECT instrument, dt, i, max(part) AS fill FROM pairs GROUP BY ALL),
done AS (SELECT p.*, least(1.0, coalesce(f.fill, 0.0)) AS fill, t.j - p.i AS dur,
    t.a > 1e-9 AND CASE WHEN t.bull THEN t.mx - t.px ELSE t.px - t.mn END >= 0.3 * t.a AS reacted
  FROM gap p LEFT JOIN fills f USING (instrument, dt, i) LEFT JOIN touch t ON t.instrument = p.instrument AND t.dt = p.dt AND t.i = p.i AND t.k = 1)"""


@check(
    "F-42",
    query(FILL, f"""SELECT {K}, fill AS fvg_fill_frac, CASE WHEN NOT g THEN 'none' WHEN fill >= 1 THEN 'filled' WHEN fill >= 0.5 THEN 'partially_filled' ELSE 'unfilled' END AS fvg_fill_state,
      CAST(dur AS INTEGER) AS fvg_fill_duration_bars, dur IS NOT NULL AS fvg_was_mitigated_flag,
      CASE WHEN NOT g THEN 0.0 WHEN dur IS NULL THEN 1.0 WHEN dur <= 6 AND reacted THEN 1.0 ELSE 0.0 END AS fvg_quality FROM done""", "fvg_fill_frac fvg_quality"),
)
def _(d):
    out = st.gap_fills(st.fair_value_gap(basics(d), CFG), CFG)
    return out.select(*KEYS, "fvg_fill_frac", "fvg_fill_state", "fvg_fill_duration_bars", "fvg_was_mitigated_flag", "fvg_quality")


# --- order blocks ------------------------------------------------------------------------------

OB = f"""{DISP},
o0 AS (SELECT *, max(CASE WHEN close < open THEN i END) {w('UNBOUNDED PRECEDING', '1 PRECEDING')} AS dn,
  max(CASE WHEN close > open THEN i END) {w('UNBOUNDED PRECEDING', '1 PRECEDING')} AS upi, max(CASE WHEN disp THEN i END) {head('50')} AS di FROM disp),
ob AS (SELECT b.*, CASE WHEN x.i IS NOT NULL THEN v.dir END AS vdir, CASE WHEN x.i IS NOT NULL THEN x.i END AS oi, x.high AS oh, x.low AS ol, x.ts AS ots
  FROM o0 b LEFT JOIN o0 v ON v.instrument = b.instrument AND v.dt = b.dt AND v.i = b.di
    LEFT JOIN o0 x ON x.instrument = b.instrument AND x.dt = b.dt AND x.i = CASE WHEN v.dir = 'up' THEN v.dn ELSE v.upi END
      AND v.ra >= 1 AND v.br >= 0.55 AND (x.high - x.low) / 0.01::DOUBLE >= 8 AND b.i - x.i <= 25)"""
OB_COLUMNS = """CASE WHEN oi IS NULL THEN 'none' WHEN vdir = 'up' THEN 'bullish' ELSE 'bearish' END AS ob_type"""


@check(
    "F-43",
    query(OB, f"""SELECT {K}, {OB_COLUMNS}, oh AS ob_high, ol AS ob_low, (oh + ol) / 2 AS ob_mid, (oh - ol) / 0.01::DOUBLE AS ob_height_ticks, ots AS ob_origin_ts,
      CAST(i - oi AS INTEGER) AS ob_age_bars, abs(close - (oh + ol) / 2) / 0.01::DOUBLE AS ob_distance_ticks FROM ob""",
      "ob_high ob_low ob_mid ob_height_ticks ob_distance_ticks"),
)
def _(d):
    out = st.order_block(st.displacement(basics(d), CFG), CFG)
    return out.select(*KEYS, *[c for c in out.columns if c.startswith("ob_")])


HISTORY = f"""{OB}, reach AS (SELECT *, max(high) {w('CURRENT ROW', '2 FOLLOWING')} AS mx, min(low) {w('CURRENT ROW', '2 FOLLOWING')} AS mn FROM ob),
seen AS (SELECT o.instrument, o.dt, o.i, o.vdir, o.oh, o.ol, b.i AS j, b.ts AS jts, b.atr AS a, b.mx, b.mn, b.low <= o.oh AND b.high >= o.ol AS hit,
    CASE WHEN o.vdir = 'up' THEN b.close < o.ol ELSE b.close > o.oh END AS beyond,
    CASE WHEN o.vdir = 'up' THEN least(b.high, o.oh) ELSE greatest(b.low, o.ol) END AS px
  FROM ob o JOIN reach b ON b.instrument = o.instrument AND b.dt = o.dt AND b.i > o.oi AND b.i <= o.i WHERE o.oi IS NOT NULL),
runs AS (SELECT *, beyond AND lag(beyond) OVER (PARTITION BY instrument, dt, i ORDER BY j) AS broken,
    lag(jts) OVER (PARTITION BY instrument, dt, i ORDER BY j) AS start FROM seen),
told AS (SELECT instrument, dt, i, min(CASE WHEN hit THEN j END) AS tj,
    arg_min(a > 1e-9 AND CASE WHEN vdir = 'up' THEN mx - px ELSE px - mn END >= 0.3 * a, CASE WHEN hit THEN j END) AS reacted,
    min(CASE WHEN broken THEN j END) AS bj, arg_min(start, CASE WHEN broken THEN j END) AS bts FROM runs GROUP BY instrument, dt, i)"""


@check(
    "F-44",
    query(HISTORY, f"""SELECT {K}, {OB_COLUMNS}, CASE WHEN oi IS NULL THEN 'none' WHEN tj IS NOT NULL THEN 'mitigated' WHEN i - oi > 15 THEN 'old' ELSE 'fresh' END AS ob_freshness_bucket,
      CASE WHEN oi IS NULL THEN 0.0 WHEN tj IS NOT NULL AND NOT reacted THEN 0.0 ELSE 1.0 END AS ob_quality FROM ob LEFT JOIN told USING (instrument, dt, i)""", "ob_quality"),
)
def _(d):
    cfg = {**CFG, "ob_mitigation_bars_max": 15}
    out = st.block_history(st.order_block(st.displacement(basics(d), cfg), cfg), cfg)
    return out.select(*KEYS, "ob_type", "ob_freshness_bucket", "ob_quality")


@check(
    "F-45",
    query(HISTORY, f"""SELECT {K}, bj IS NOT NULL AS ob_breaker_flag, CASE WHEN bj IS NOT NULL THEN CASE WHEN vdir = 'up' THEN 'down' ELSE 'up' END END AS ob_breaker_dir,
      bts AS ob_breaker_ts FROM ob LEFT JOIN told USING (instrument, dt, i)"""),
)
def _(d):
    out = st.block_history(st.order_block(st.displacement(basics(d), CFG), CFG), CFG)
    return out.select(*KEYS, "ob_breaker_flag", "ob_breaker_dir", "ob_breaker_ts")


# --- equal levels, sweeps, grabs ---------------------------------------------------------------


def hits(px: str, cmp: str) -> str:
    one = f"CASE WHEN {px} {cmp} {lag(px, BY_DAY)} AND {px} {cmp} {lag(px, BY_DAY, -1)} THEN [{{'s': {px}, 'n': 1, 'f': i, 'l': i}}] END"
    return one


def clusters(hit: str) -> str:
    """Greedy clusters as a fold: each element is a one-cluster list, merged into the list so far."""
    return f"""list_reduce(list_filter({hit}, lambda h: h IS NOT NULL), lambda a, h:
      CASE WHEN abs(h[1].s - a[-1].s / a[-1].n) <= 1.5::DOUBLE THEN
        CASE WHEN h[1].l - a[-1].l >= 3 THEN list_concat(a[:-2], [{{'s': a[-1].s + h[1].s, 'n': a[-1].n + 1, 'f': a[-1].f, 'l': h[1].l}}]) ELSE a END
      ELSE list_concat(a, h) END)"""


EQ = f"""{DISP},
e0 AS (SELECT *, {hits('high', '>=')} AS hh, {hits('low', '<=')} AS hl FROM disp),
e1 AS (SELECT *, list(hh) {w('28 PRECEDING', '1 PRECEDING')} AS lh, list(hl) {w('28 PRECEDING', '1 PRECEDING')} AS ll FROM e0),
e2 AS (SELECT *, CASE WHEN len(list_filter(lh, lambda h: h IS NOT NULL)) > 0 THEN {clusters('lh')} END AS ch,
  CASE WHEN len(list_filter(ll, lambda h: h IS NOT NULL)) > 0 THEN {clusters('ll')} END AS cl2 FROM e1),
e3 AS (SELECT *, list_sort(list_transform(list_filter(ch, lambda c: c.n >= 2), lambda c: {{'n': c.n, 'l': c.l, 'f': -c.f, 'px': c.s / c.n}}), 'DESC')[1] AS bh,
  list_sort(list_transform(list_filter(cl2, lambda c: c.n >= 2), lambda c: {{'n': c.n, 'l': c.l, 'f': -c.f, 'px': c.s / c.n}}), 'DESC')[1] AS bl FROM e2),
eq AS (SELECT *, bh.px AS hpx, bl.px AS lpx, bl IS NOT NULL AND (bh IS NULL OR bl.n > bh.n) AS lowwins FROM e3)"""
EQ_COLUMNS = """hpx IS NOT NULL AS eqh_flag, lpx IS NOT NULL AS eql_flag, hpx AS eqh_level_px, lpx AS eql_level_px"""


@check(
    "F-46",
    query(EQ, f"""SELECT {K}, {EQ_COLUMNS}, CAST(CASE WHEN lowwins THEN bl.n ELSE bh.n END AS INTEGER) AS eq_level_hit_count,
      CAST(CASE WHEN lowwins THEN bl.l + bl.f ELSE bh.l + bh.f END AS INTEGER) AS eq_level_span_bars FROM eq""", "eqh_level_px eql_level_px"),
)
def _(d):
    out = st.equal_levels(basics(d), CFG)
    return out.select(*KEYS, *[c for c in out.columns if c.startswith("eq")])


def first_close(cmp: str, px: str) -> str:
    return "CASE " + " ".join(f"WHEN {lag('close', BY_DAY, -k)} {cmp} {px} THEN {k}" for k in (1, 2, 3)) + " END"


SWEEP = f"""{EQ},
w0 AS (SELECT *, {first_close('<', 'hpx')} AS kh, {first_close('>', 'lpx')} AS kl FROM eq),
w1 AS (SELECT *, CASE WHEN high - hpx >= 6 * 0.01::DOUBLE THEN kh END AS u, CASE WHEN lpx - low >= 6 * 0.01::DOUBLE THEN kl END AS v FROM w0),
sweep AS (SELECT *, coalesce(u, v) AS kk, CASE WHEN u IS NOT NULL THEN 'eqh' WHEN v IS NOT NULL THEN 'eql' ELSE 'none' END AS side,
  CASE WHEN u IS NOT NULL THEN (high - hpx) / 0.01::DOUBLE WHEN v IS NOT NULL THEN (lpx - low) / 0.01::DOUBLE END AS depth FROM w1),
swept AS (SELECT *, CASE WHEN kk IS NULL THEN 0.0 ELSE greatest(0.0, least(1.0, (least(1.0, depth / 6) + 1 - kk / 4.0) / 2)) END AS sq FROM sweep)"""


@check(
    "F-47",
    query(SWEEP, f"""SELECT {K}, kk IS NOT NULL AS liq_sweep_flag, side AS liq_sweep_side, CASE side WHEN 'eqh' THEN hpx WHEN 'eql' THEN lpx END AS liq_sweep_level_px,
      depth AS liq_sweep_depth_ticks, CAST(kk AS INTEGER) AS liq_sweep_reclaim_bars, sq AS liq_sweep_quality FROM swept""",
      "liq_sweep_level_px liq_sweep_depth_ticks liq_sweep_quality"),
)
def _(d):
    out = st.liquidity_sweep(st.equal_levels(basics(d), CFG), CFG)
    return out.select(*KEYS, *[c for c in out.columns if c.startswith("liq_sweep")])


GRAB = f"""{SWEEP}, grab AS (SELECT *, (high - greatest(open, close) + least(open, close) - low) / {RNG} >= 0.6 AND br <= 0.3 AND
  coalesce(CASE WHEN side = 'eqh' OR (side = 'none' AND close < open) THEN min(close) {w('1 FOLLOWING', '3 FOLLOWING')} < close
                ELSE max(close) {w('1 FOLLOWING', '3 FOLLOWING')} > close END, false) AS grab FROM swept)"""


@check("F-48", query(GRAB, f"SELECT {K}, grab AS liq_grab_flag FROM grab"))
def _(d):
    out = st.liquidity_grab(st.liquidity_sweep(st.equal_levels(basics(d), CFG), CFG), CFG)
    return out.select(*KEYS, "liq_grab_flag")


LOC = f"""{BASE}, l0 AS (SELECT *, max(high) {head('19')} AS hi, min(low) {head('19')} AS lo FROM s),
l1 AS (SELECT *, CASE WHEN atr > 1e-9 AND hi - lo >= atr THEN greatest(0.0, least(1.0, (close - lo) / greatest(hi - lo, 1e-9::DOUBLE))) ELSE 0.5 END AS loc,
  coalesce(hi <> {lag('hi', BY_DAY)} OR lo <> {lag('lo', BY_DAY)}, true) AS moved FROM l0),
loc AS (SELECT *, i - max(CASE WHEN moved THEN i END) {w('UNBOUNDED PRECEDING', 'CURRENT ROW')} AS age,
  CASE WHEN loc <= 0.3 THEN 'discount' WHEN loc >= 0.7 THEN 'premium' ELSE 'equilibrium' END AS bucket FROM l1)"""
LOC_COLUMNS = """hi AS ict_struct_dealing_range_high, lo AS ict_struct_dealing_range_low, (hi + lo) / 2 AS ict_struct_dealing_range_mid, loc AS pd_location_frac,
  bucket AS pd_location_bucket, bucket AS fvg_location_bucket"""


@check(
    "F-49",
    query(LOC, f"""SELECT {K}, {LOC_COLUMNS}, CAST(least(floor(loc * 10), 9) AS INTEGER) AS ict_struct_pd_index, CAST(age AS INTEGER) AS dealing_range_age_bars FROM loc""",
      "ict_struct_dealing_range_high ict_struct_dealing_range_low ict_struct_dealing_range_mid pd_location_frac"),
)
def _(d):
    out = st.dealing_location(basics(d), CFG)
    names = ("high", "low", "mid")
    return out.select(
        *KEYS, *[f"ict_struct_dealing_range_{n}" for n in names], "pd_location_frac", "pd_location_bucket",
        "fvg_location_bucket", "ict_struct_pd_index", "dealing_range_age_bars",
    )


# --- phases -------------------------------------------------------------------------------------

N = 8
PHASE = f"""{GRAB},
c0 AS (SELECT *, CASE WHEN count(high) {head(str(N - 1))} >= {N} THEN max(high) {head(str(N - 1))} END AS wh,
  CASE WHEN count(low) {head(str(N - 1))} >= {N} THEN min(low) {head(str(N - 1))} END AS wl, {mean('atr', N, BY_DAY)} AS wa, {mean('z', N, BY_DAY)} AS wz FROM grab),
c1 AS (SELECT *, wh IS NOT NULL AND coalesce(wz <= 0.8 AND CASE WHEN wa > 1e-9 THEN (wh - wl) / wa ELSE 0.0 END < 3.5, false) AS comp FROM c0),
f(instrument, dt, i, phase, rh, rl, age, ms, dd, cnt) AS (
  SELECT DISTINCT instrument, dt, CAST(-1 AS BIGINT), 'none', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), 0, 'none', 'none', 0 FROM c1
  UNION ALL
  SELECT instrument, dt, i, CASE WHEN rst THEN 'none' ELSE phase END, CASE WHEN NOT rst THEN rh END, CASE WHEN NOT rst THEN rl END, CASE WHEN rst OR rh IS NULL THEN 0 ELSE age END,
    CASE WHEN rst THEN 'none' ELSE ms END, CASE WHEN rst THEN 'none' ELSE dd END, CASE WHEN rst THEN 0 ELSE cnt END
  FROM (SELECT *, coalesce(phase <> 'none' AND rh IS NOT NULL AND wh IS NOT NULL AND atr > 1e-9 AND
      (abs((wh + wl) / 2 - (rh + rl) / 2) > atr OR greatest(0.0, least(rh, wh) - greatest(rl, wl)) / greatest(rh - rl, 1e-9::DOUBLE) < 0.5), false) AS rst
  FROM (SELECT * REPLACE (CASE WHEN dis THEN 'distribution' ELSE phase END AS phase, CASE WHEN dis THEN want ELSE dd END AS dd, CASE WHEN dis THEN 0 ELSE cnt END AS cnt)
  FROM (SELECT *, coalesce(phase = 'manipulation' AND cnt >= 3 AND disp AND dir = want AND rh IS NOT NULL AND atr > 1e-9
        AND CASE WHEN want = 'down' THEN rl - low ELSE high - rh END >= 3.5 * atr, false) AS dis
  FROM (SELECT *, CASE WHEN ms = 'buyside' THEN 'down' ELSE 'up' END AS want
  FROM (SELECT * REPLACE (CASE WHEN man THEN 'manipulation' ELSE phase END AS phase, CASE WHEN man THEN CASE WHEN side = 'eqh' THEN 'buyside' ELSE 'sellside' END ELSE ms END AS ms,
        CASE WHEN man THEN 'none' ELSE dd END AS dd, CASE WHEN man THEN 0 ELSE cnt END AS cnt)
  FROM (SELECT *, phase = 'accumulation' AND side <> 'none' AND cnt >= 3 AS man
  FROM (SELECT * REPLACE (CASE WHEN phase <> 'none' AND rh IS NOT NULL THEN age + 1 ELSE age END AS age)
  FROM (SELECT * REPLACE (CASE WHEN acc THEN 'accumulation' ELSE phase END AS phase, CASE WHEN acc THEN wh ELSE rh END AS rh, CASE WHEN acc THEN wl ELSE rl END AS rl,
        CASE WHEN acc THEN 0 ELSE age END AS age, CASE WHEN acc THEN 'none' ELSE ms END AS ms, CASE WHEN acc THEN 'none' ELSE dd END AS dd)
  FROM (SELECT *, phase = 'none' AND comp AND cnt >= 3 AS acc
  FROM (SELECT b.*, f.phase, f.rh, f.rl, f.age, f.ms, f.dd, CASE WHEN b.comp THEN f.cnt + 1 ELSE greatest(0, f.cnt - 1) END AS cnt
        FROM f JOIN c1 b ON b.instrument = f.instrument AND b.dt = f.dt AND b.i = f.i + 1)))))))))))"""


@check(
    "F-50",
    query(PHASE, f"""SELECT {K}, phase AS mms_phase, rh AS mms_range_high, rl AS mms_range_low, CAST(age AS INTEGER) AS mms_range_age_bars, ms AS mms_manipulation_side,
      dd AS mms_distribution_dir, greatest(0.0, least(1.0, (CASE WHEN comp THEN 1.0 ELSE 0.0 END + sq + dq + CASE WHEN phase = 'distribution' THEN 1.0 ELSE 0.0 END) / 4)) AS mms_confidence
    FROM c1 JOIN f USING (instrument, dt, i)""", "mms_range_high mms_range_low mms_confidence"),
)
def _(d):
    out = st.displacement(basics(d), CFG)
    out = st.liquidity_grab(st.liquidity_sweep(st.equal_levels(out, CFG), CFG), CFG)
    out = st.market_phases(st.compression(out, CFG), CFG)
    return out.select(*KEYS, *[c for c in out.columns if c.startswith("mms_")])


# --- swings and breaks -----------------------------------------------------------------------------

SWING = f"""{BASE},
v0 AS (SELECT *, count(*) {w('3 PRECEDING', '3 FOLLOWING')} = 7 AS inner7, high = max(high) {w('3 PRECEDING', '3 FOLLOWING')} AS ch, low = min(low) {w('3 PRECEDING', '3 FOLLOWING')} AS cl FROM s),
cand AS (SELECT *, row_number() OVER (PARTITION BY instrument, dt ORDER BY i) AS k FROM v0 WHERE inner7 AND (ch OR cl)),
sw(instrument, dt, k, i, hi, lo, strength, lh, ll) AS (
  SELECT DISTINCT instrument, dt, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), false, false, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM cand
  UNION ALL
  SELECT instrument, dt, k, i, hi, lo2, CASE WHEN lo2 THEN i - lh2 WHEN hi THEN i - ll END, lh2, CASE WHEN lo2 THEN i ELSE ll END
  FROM (SELECT *, cl AND (lh2 IS NULL OR i - lh2 >= 5) AS lo2
  FROM (SELECT *, CASE WHEN hi THEN i ELSE lh END AS lh2
  FROM (SELECT c.instrument, c.dt, c.k, c.i, c.cl, c.ch AND (sw.ll IS NULL OR c.i - sw.ll >= 5) AS hi, sw.lh, sw.ll
        FROM sw JOIN cand c ON c.instrument = sw.instrument AND c.dt = sw.dt AND c.k = sw.k + 1)))),
swing AS (SELECT v.*, CASE WHEN q.hi THEN v.high END AS sh, CASE WHEN q.lo THEN v.low END AS sl, q.strength FROM v0 v LEFT JOIN sw q ON q.instrument = v.instrument AND q.dt = v.dt AND q.i = v.i)"""


@check(
    "F-51",
    query(SWING, f"""SELECT {K}, sh AS ict_struct_swing_high, sl AS ict_struct_swing_low, CAST(strength AS DOUBLE) AS ict_struct_swing_strength FROM swing""",
      "ict_struct_swing_high ict_struct_swing_low ict_struct_swing_strength"),
)
def _(d):
    out = st.swings(basics(d), CFG)
    return out.select(*KEYS, "ict_struct_swing_high", "ict_struct_swing_low", "ict_struct_swing_strength")


TREND = f"""{SWING},
pts AS (SELECT instrument, dt, i, 0 AS o, sh AS y, 'h' AS kind FROM swing WHERE sh IS NOT NULL UNION ALL SELECT instrument, dt, i, 1, sl, 'l' FROM swing WHERE sl IS NOT NULL),
near AS (SELECT b.instrument, b.dt, b.i, p.i AS x, p.y, p.kind, p.o, row_number() OVER (PARTITION BY b.instrument, b.dt, b.i ORDER BY p.i DESC, p.o DESC) AS k
  FROM swing b JOIN pts p ON p.instrument = b.instrument AND p.dt = b.dt AND p.i <= b.i),
six AS (SELECT *, y > lag(y) OVER (PARTITION BY instrument, dt, i, kind ORDER BY x, o) AS up FROM near WHERE k <= 6),
fit AS (SELECT instrument, dt, i, count(*) FILTER (kind = 'h') AS nh, count(*) FILTER (kind = 'l') AS nl,
    sum(CASE WHEN up IS NULL THEN 0 WHEN up THEN 1 ELSE -1 END) FILTER (kind = 'h') AS uh, sum(CASE WHEN up IS NULL THEN 0 WHEN up THEN 1 ELSE -1 END) FILTER (kind = 'l') AS ul,
    CASE WHEN count(*) * var_pop(x) > 1e-9 THEN covar_pop(x, y) / var_pop(x) ELSE 0.0 END / (stddev_pop(y) + 1e-9::DOUBLE) AS strength FROM six GROUP BY instrument, dt, i)"""


@check(
    "F-52",
    query(TREND, f"""SELECT {K}, CASE WHEN inner7 AND nh >= 2 AND nl >= 2 AND uh > 0 AND ul > 0 THEN 'up' WHEN inner7 AND nh >= 2 AND nl >= 2 AND uh < 0 AND ul < 0 THEN 'down' ELSE 'range' END AS ict_struct_swing_trend_dir,
      CASE WHEN inner7 AND nh >= 2 AND nl >= 2 THEN fit.strength ELSE 0.0 END AS struct_trend_strength FROM swing LEFT JOIN fit USING (instrument, dt, i)""", "struct_trend_strength"),
)
def _(d):
    out = st.swing_trend(st.swings(basics(d), CFG), CFG)
    return out.select(*KEYS, "ict_struct_swing_trend_dir", "struct_trend_strength")


RUN = w("UNBOUNDED PRECEDING", "CURRENT ROW")
BOS = f"""{SWING},
b0 AS (SELECT *, max(CASE WHEN sh IS NOT NULL THEN i END) {RUN} AS hi_i, max(CASE WHEN sl IS NOT NULL THEN i END) {RUN} AS lo_i,
  last_value(sh IGNORE NULLS) {RUN} AS hp, last_value(sl IGNORE NULLS) {RUN} AS lp FROM swing),
b1 AS (SELECT *, coalesce(inner7 AND i - hi_i BETWEEN 2 AND 20 AND close > hp + 4 * 0.01::DOUBLE, false) AS up, coalesce(inner7 AND i - lo_i BETWEEN 2 AND 20 AND close < lp - 4 * 0.01::DOUBLE, false) AS down FROM b0),
bos AS (SELECT *, up OR down AS bos, CASE WHEN down THEN 'bearish' WHEN up THEN 'bullish' ELSE 'none' END AS bdir, i - max(CASE WHEN up OR down THEN i END) {RUN} AS bage FROM b1)"""


@check(
    "F-53",
    query(BOS, f"""SELECT {K}, bos AS bos_flag, bdir AS bos_dir, CASE WHEN down THEN lp WHEN up THEN hp END AS bos_level_px,
      CASE WHEN down THEN lp - close WHEN up THEN close - hp END / 0.01::DOUBLE AS bos_distance_ticks, CASE WHEN down THEN 'bos_down' WHEN up THEN 'bos_up' ELSE 'none' END AS bos_type,
      CAST(bage AS INTEGER) AS bos_age_bars FROM bos""", "bos_level_px bos_distance_ticks"),
)
def _(d):
    out = st.structure_break(st.swings(basics(d), CFG), CFG)
    return out.select(*KEYS, *[c for c in out.columns if c.startswith("bos_")])


CHOCH = f"""{BOS},
m(instrument, dt, i, state, choch, cdir, px) AS (
  SELECT DISTINCT instrument, dt, CAST(-1 AS BIGINT), 'range', false, 'none', CAST(NULL AS DOUBLE) FROM bos
  UNION ALL
  SELECT instrument, dt, i, CASE WHEN a OR b THEN 'transition' ELSE st END, a OR b, CASE WHEN a THEN 'bearish' WHEN b THEN 'bullish' ELSE 'none' END, CASE WHEN a THEN lp WHEN b THEN hp END
  FROM (SELECT *, coalesce(inner7 AND st = 'bullish' AND close < lp - 4 * 0.01::DOUBLE AND z >= 0.2, false) AS a, coalesce(inner7 AND st = 'bearish' AND close > hp + 4 * 0.01::DOUBLE AND z >= 0.2, false) AS b
  FROM (SELECT x.*, CASE WHEN x.bos THEN x.bdir ELSE m.state END AS st FROM m JOIN bos x ON x.instrument = m.instrument AND x.dt = m.dt AND x.i = m.i + 1)))"""


@check(
    "F-54",
    query(CHOCH, f"""SELECT {K}, choch AS choch_flag, cdir AS choch_dir, px AS choch_level_px, CASE WHEN choch THEN abs(close - px) / 0.01::DOUBLE END AS choch_distance_ticks,
      CAST(i - max(CASE WHEN choch THEN i END) {RUN} AS INTEGER) AS choch_age_bars, state AS struct_state FROM bos JOIN m USING (instrument, dt, i)""", "choch_level_px choch_distance_ticks"),
)
def _(d):
    out = st.character_change(st.structure_break(st.swings(basics(d), CFG), CFG), CFG)
    return out.select(*KEYS, *[c for c in out.columns if c.startswith("choch_")], "struct_state")


def full(d):
    return st.structure(d.bars(), CFG, materialise=cut_lineage)


EVENT_CTES = f"{SWEEP}, {FILL.split(DISP + ',', 1)[1]}, {HISTORY.split(DISP + ',', 1)[1].replace('reach', 'reach2').replace('seen', 'seen2')}, {CHOCH.split(BASE + ',', 1)[1]}"
EVENT_BODY = f"""SELECT * REPLACE (floor(CAST(ref_level AS DOUBLE) * 1e6::DOUBLE + 0.50013::DOUBLE) / 1e6::DOUBLE AS ref_level, floor(CAST(event_strength AS DOUBLE) * 1e6::DOUBLE + 0.50013::DOUBLE) / 1e6::DOUBLE AS event_strength), 'ict_struct' AS event_source FROM (
      SELECT {K}, 'FVG' AS event_type, CASE WHEN bull THEN 'bull' ELSE 'bear' END AS event_side, (ghi + glo) / 2 AS ref_level, CASE WHEN dur IS NULL OR (dur <= 6 AND reacted) THEN 1.0 ELSE 0.0 END AS event_strength FROM done WHERE g
      UNION ALL SELECT {K}, 'OB', CASE WHEN vdir = 'up' THEN 'bullish' ELSE 'bearish' END, (oh + ol) / 2, CASE WHEN tj IS NOT NULL AND NOT reacted THEN 0.0 ELSE 1.0 END FROM ob LEFT JOIN told USING (instrument, dt, i) WHERE oi IS NOT NULL
      UNION ALL SELECT {K}, 'LIQ_SWEEP', side, CASE side WHEN 'eqh' THEN hpx ELSE lpx END, sq FROM swept WHERE kk IS NOT NULL
      UNION ALL SELECT {K}, 'EQ_HIGH', 'high', hpx, CASE WHEN lowwins THEN bl.n ELSE bh.n END FROM eq WHERE hpx IS NOT NULL
      UNION ALL SELECT {K}, 'EQ_LOW', 'low', lpx, CASE WHEN lowwins THEN bl.n ELSE bh.n END FROM eq WHERE lpx IS NOT NULL
      UNION ALL SELECT {K}, 'BOS', bdir, CASE WHEN down THEN lp ELSE hp END, CASE WHEN down THEN lp - close ELSE close - hp END / 0.01::DOUBLE FROM bos WHERE bos
      UNION ALL SELECT {K}, 'CHOCH', cdir, px, abs(close - px) / 0.01::DOUBLE FROM bos JOIN m USING (instrument, dt, i) WHERE choch
      UNION ALL SELECT {K}, 'DISPLACEMENT', dir, NULL, dq FROM disp WHERE disp)"""


@check("F-55", query(EVENT_CTES, EVENT_BODY))
def _(d):
    return st.structure_events(full(d)).select(*KEYS, "event_type", "event_side", "ref_level", "event_strength", "event_source")


@check(
    "F-56",
    query(SWEEP, f"""SELECT {K}, CASE WHEN kk IS NOT NULL THEN 'sweep_' || side WHEN hpx IS NOT NULL AND lpx IS NOT NULL THEN 'pool_both' WHEN hpx IS NOT NULL THEN 'pool_eqh'
      WHEN lpx IS NOT NULL THEN 'pool_eql' ELSE 'none' END AS ict_struct_liquidity_tag FROM swept"""),
)
def _(d):
    out = st.liquidity_sweep(st.equal_levels(basics(d), CFG), CFG)
    return out.select(*KEYS, "ict_struct_liquidity_tag")


# --- liquidity levels ---------------------------------------------------------------------------------

LIQ = {"lookback_bars": 20, "level_rank_method": "recency_weighted", "touch_tolerance_atr_mult": 0.3, "min_bars_between_touches": 2, "micro_event_band_ticks": 2000.0}
LV = f"""{M15}, x0 AS (SELECT *, {true_range(BY_DAY)} AS tr FROM bars),
x1 AS (SELECT *, {mean('tr', 14, BY_DAY)} AS a, CASE WHEN count(high) {head('19')} >= 20 THEN max(high) {head('19')} END AS top, CASE WHEN count(low) {head('19')} >= 20 THEN min(low) {head('19')} END AS bot,
  CASE WHEN count(*) {w('2 PRECEDING', '2 FOLLOWING')} = 5 THEN max(high) {w('2 PRECEDING', '2 FOLLOWING')} END AS pt, CASE WHEN count(*) {w('2 PRECEDING', '2 FOLLOWING')} = 5 THEN min(low) {w('2 PRECEDING', '2 FOLLOWING')} END AS pb FROM x0),
x2 AS (SELECT *, CASE WHEN high = pt AND high <= top - a * 0.25 AND high >= bot + a * 0.25 AND {div('high - pb', 'a')} >= 0 THEN high END AS ph,
  CASE WHEN low = pb AND low <= top - a * 0.25 AND low >= bot + a * 0.25 AND {div('pt - low', 'a')} >= 0 THEN low END AS pl FROM x1),
x3 AS (SELECT *, last_value(ph IGNORE NULLS) {RUN} AS lh, last_value(pl IGNORE NULLS) {RUN} AS ll FROM x2),
x4 AS (SELECT *, coalesce(abs(high - lh) <= a * 0.3, false) AS th, coalesce(abs(low - ll) <= a * 0.3, false) AS tl FROM x3),
x5 AS (SELECT *, th AND NOT coalesce(bool_or(th) {w('2 PRECEDING', '1 PRECEDING')}, false) AS th2, tl AND NOT coalesce(bool_or(tl) {w('2 PRECEDING', '1 PRECEDING')}, false) AS tl2 FROM x4),
x6 AS (SELECT *, CASE WHEN count(*) {head('19')} >= 20 THEN sum(CAST(th2 AS INT)) {head('19')} END AS nh, CASE WHEN count(*) {head('19')} >= 20 THEN sum(CAST(tl2 AS INT)) {head('19')} END AS nl,
  {div('abs(lh - close)', 'a')} AS dh, {div('abs(close - ll)', 'a')} AS dl FROM x5),
lv AS (SELECT *, CASE WHEN lh IS NULL AND ll IS NULL THEN 'none' WHEN lh IS NULL THEN 'low' WHEN ll IS NULL THEN 'high' WHEN dh <= dl THEN 'high' ELSE 'low' END AS side, nh >= 2 OR nl >= 2 AS flag FROM x6)"""


@check(
    "F-30",
    query(LV, f"""SELECT instrument, anchor_tf, ts AS anchor_ts, lh AS internal_liq_level_high, ll AS internal_liq_level_low, CAST(nh AS BIGINT) AS internal_liq_high_count_L, CAST(nl AS BIGINT) AS internal_liq_low_count_L,
      side AS internal_liq_nearest_side, CASE WHEN side = 'high' THEN dh ELSE dl END AS internal_liq_nearest_dist_atr, flag AS internal_liq_flag,
      CASE WHEN a IS NULL OR top IS NULL THEN 'INSUFFICIENT_LOOKBACK' WHEN flag THEN 'INTERNAL_LIQ_PRESENT' ELSE 'INTERNAL_LIQ_ABSENT' END AS internal_liq_reason_code, 'range_interior' AS internal_liq_source_used,
      CASE WHEN side = 'none' THEN false ELSE abs(close - CASE WHEN side = 'high' THEN lh ELSE ll END) <= 20.0 END AS internal_liq_micro_near_level_flag
    FROM lv""", "internal_liq_level_high internal_liq_level_low internal_liq_nearest_dist_atr"),
)
def _(d):
    bars = d.bars().withColumn("tick_size", F.lit(TICK))
    out = liquidity.interior_levels(bars, LIQ)
    fresh = [c for c in out.columns if c.startswith("internal_liq") and c != "internal_liq_atr"]
    return out.select("instrument", "anchor_tf", F.col("ts").alias("anchor_ts"), *fresh)


def near(level: str, lo: str, hi: str) -> str:
    return f"coalesce({level} >= {lo} - a * 0.5 AND {level} <= {hi} + a * 0.5, false)"


@check(
    "F-31",
    query(f"{LV}, {GAP.split(M15 + ',', 1)[1]}", f"""SELECT lv.instrument, lv.anchor_tf, lv.ts, {near('lh', 'g.glo', 'g.ghi')} OR {near('ll', 'g.glo', 'g.ghi')} AS internal_liq_fvg_overlap_flag,
      {near('lh', 'g.glo', 'g.ghi')} OR {near('ll', 'g.glo', 'g.ghi')} OR {near('lh', 'z.lo', 'z.hi')} OR {near('ll', 'z.lo', 'z.hi')} AS internal_liq_overlap_flag, 'any' AS internal_liq_overlap_family_used
    FROM lv LEFT JOIN (SELECT * FROM gap WHERE g) g ON g.instrument = lv.instrument AND g.ts = lv.ts
      JOIN (SELECT instrument, dt, max(high) AS hi, (max(high) + min(low)) / 2 AS lo FROM bars GROUP BY ALL) z ON z.instrument = lv.instrument AND z.dt = lv.dt"""),
)
def _(d):
    bars = d.bars()
    levels = liquidity.interior_levels(bars, LIQ)
    gaps = st.fair_value_gap(st.with_basics(bars, CFG), CFG).select(*KEYS, "fvg_lower", "fvg_upper")
    # The upper half of the day range stands in for a zone.
    zones = flow.day_range_zone(bars).select(*KEYS, F.col("zmf_zone_mid").alias("zmf_zone_lo"), "zmf_zone_hi")
    out = liquidity.level_overlap(levels, gaps.join(zones, list(KEYS)), "any", 0.5)
    return out.select(*KEYS, "internal_liq_fvg_overlap_flag", "internal_liq_overlap_flag", "internal_liq_overlap_family_used")


MICRO_CFG = {"micro_window_bars": 10, "micro_intensity_z_cut": 1.5, "ofi_flip_min_events": 4, "agg_flip_min_events": 5, "spread_spike_z_cut": 1.2}
MICRO = f"""{M15}, fl AS (SELECT instrument, time_bucket(INTERVAL 15 MINUTE, ts) AS ts, sum(size * CASE WHEN side = 'buy' THEN 1 ELSE -1 END) AS ofi, sum(size) AS tot, CAST(count(*) AS DOUBLE) AS n, max(price) - min(price) AS sp FROM ticks GROUP BY 1, 2),
m0 AS (SELECT b.*, ofi, ofi / tot AS agg, n, sp, sign(ofi) AS so FROM bars b JOIN fl USING (instrument, ts)),
m1 AS (SELECT *, CAST(so <> {lag('so', BY_DAY)} AND so <> 0 AND {lag('so', BY_DAY)} <> 0 AS INT) AS flip FROM m0),
m2 AS (SELECT *, {total('flip', 10, BY_DAY, 1)} AS c, {div('n - ' + mean('n', 10, BY_DAY), std('n', 10, BY_DAY))} AS nz, {div('sp - ' + mean('sp', 10, BY_DAY), std('sp', 10, BY_DAY))} AS sz FROM m1)"""


@check(
    "F-32",
    query(f"{MICRO}, {LV.split(M15 + ',', 1)[1]}", f"""SELECT m2.instrument, m2.anchor_tf, m2.ts, CAST(c AS BIGINT) AS internal_liq_ofi_flip_count_L, CAST(c AS BIGINT) AS internal_liq_agg_flip_count_L, nz AS internal_liq_intensity_z, sz AS internal_liq_spread_z,
      abs(sz) >= 1.2 AS internal_liq_spread_spike_flag, c >= 4 AS internal_liq_ofi_flip_flag, c >= 5 AS internal_liq_agg_flip_flag, abs(nz) >= 1.5 AS internal_liq_intensity_spike_flag,
      (c >= 4 OR c >= 5 OR abs(nz) >= 1.5) AND CASE WHEN side = 'none' THEN false ELSE abs(lv.close - CASE WHEN side = 'high' THEN lh ELSE ll END) <= 20.0 END AS internal_liq_micro_confirm_flag, 'microstructure_flow' AS internal_liq_micro_source_used
    FROM m2 JOIN lv USING (instrument, ts)""", "internal_liq_intensity_z internal_liq_spread_z"),
)
def _(d):
    bars = d.bars().withColumn("tick_size", F.lit(TICK))
    moves = flow.bucketed_flow(bars, flow.side_signed(d.ticks()), "M15").drop(*POLICY)
    moves = moves.join(bars.select(*KEYS, "dt", (F.col("high") - F.col("low")).alias("micro_spread")), list(KEYS))
    micro = liquidity.micro_confirmation(moves, MICRO_CFG)
    out = liquidity.attach_confirmation(liquidity.interior_levels(bars, LIQ), micro)
    return out.select(*KEYS, *liquidity.MICRO_COLUMNS)


# --- range phases -------------------------------------------------------------------------------------

RANGE = {"lookback_bars": 10, "atr_window": 5, "tests_min": 2, "accept_bars_min": 1, "trend_bars_min": 2, "reclaim_bars_max": 1,
         "accept_atr_mult": -0.6, "probe_atr_mult": 0.0, "width_min_atr": 1.5, "trend_atr_mult": 0.5, "trend_width_mult": 0.35, "reclaim_atr_mult": 0.8}
DESC = f"""{M15}, r0 AS (SELECT *, {true_range(BY_DAY)} AS trg, row_number() OVER (PARTITION BY {BY_DAY} ORDER BY ts) - 1 AS i FROM bars),
r1 AS (SELECT *, {mean('trg', 5, BY_DAY)} AS atr, CASE WHEN count(high) {head('9')} >= 10 THEN max(high) {head('9')} END AS hi, CASE WHEN count(low) {head('9')} >= 10 THEN min(low) {head('9')} END AS lo FROM r0),
r2 AS (SELECT *, hi - lo AS wd, (hi + lo) / 2 AS mid, {div('hi - lo', 'atr', 'NULL')} AS wa, {div('close - lo', 'hi - lo', 'NULL')} AS pos FROM r1)"""


@check(
    "F-60",
    query(DESC, f"SELECT {K}, atr, hi AS dr_high, lo AS dr_low, wd AS dr_width, mid AS dr_mid, wa AS dr_width_atr, pos AS range_position FROM r2",
          "atr dr_high dr_low dr_width dr_mid dr_width_atr range_position"),
)
def _(d):
    out = range_descriptors(d.bars(), RANGE)
    return out.select(*KEYS, "atr", "dr_high", "dr_low", "dr_width", "dr_mid", "dr_width_atr", "range_position")


EV = f"""{DESC}, v1 AS (SELECT *, close >= lo AND close <= hi AS ins, CAST(high >= hi - atr * 0.2 AS INT) AS t_h, CAST(low <= lo + atr * 0.2 AS INT) AS t_l,
  CASE WHEN hi IS NOT NULL THEN greatest(lo - low, 0.0) END AS p_l, CASE WHEN hi IS NOT NULL THEN greatest(high - hi, 0.0) END AS p_h,
  greatest(atr * 0.5, wd * 0.35) AS td FROM r2),
ev AS (SELECT *, {mean('CAST(ins AS INT)', 10, BY_DAY)} AS ratio, {total('t_h', 10, BY_DAY)} AS n_h, {total('t_l', 10, BY_DAY)} AS n_l, {total('t_h + t_l', 10, BY_DAY)} AS n_t,
  p_l >= atr * 0.0 AS b_l, p_h >= atr * 0.0 AS b_h, close >= lo + atr * 0.8 AS rc_l, close <= hi - atr * 0.8 AS rc_h,
  close >= hi + atr * -0.6 AS o_u, close <= lo - atr * -0.6 AS o_d, abs(close - mid) >= td AS far FROM v1)"""


@check(
    "F-61",
    query(EV, f"""SELECT {K}, ins AS inside, ratio AS inside_ratio, CAST(n_h AS BIGINT) AS test_high_count, CAST(n_l AS BIGINT) AS test_low_count, CAST(n_t AS BIGINT) AS tests_count, p_l AS pierce_low, p_h AS pierce_high,
      b_l AS probe_low, b_h AS probe_high, rc_l AS reclaim_from_low, rc_h AS reclaim_from_high, o_u AS outside_up, o_d AS outside_dn, far AS trend_far, atr * 0.8 AS reclaim_band, atr * -0.6 AS accept_dist, td AS trend_dist FROM ev""",
      "inside_ratio pierce_low pierce_high reclaim_band accept_dist trend_dist"),
)
def _(d):
    from barloom.operators.range_phase import EVIDENCE

    return range_evidence(range_descriptors(d.bars(), RANGE), RANGE).select(*KEYS, *EVIDENCE)


FOLD = f"""{EV},
q(instrument, dt, i, phase, num, start, age, ps, pa, ur, dr, tr, why) AS (
  SELECT DISTINCT instrument, dt, CAST(-1 AS BIGINT), CAST(NULL AS VARCHAR), 0, CAST(NULL AS TIMESTAMP), 0, CAST(NULL AS VARCHAR), 0, 0, 0, 0, CAST(NULL AS VARCHAR) FROM ev
  UNION ALL
  SELECT instrument, dt, i, np, num + CASE WHEN why = 'ENTER_B_RANGE_VALID' THEN 1 ELSE 0 END,
    CASE WHEN why = 'ENTER_B_RANGE_VALID' THEN ts WHEN why = 'RESET_RANGE_INVALID' THEN NULL ELSE start END,
    CASE WHEN skip THEN age WHEN np IS NULL THEN 0 WHEN why = 'ENTER_B_RANGE_VALID' THEN 1 ELSE age + 1 END,
    CASE WHEN why = 'ENTER_C_PROBE' THEN CASE WHEN b_l THEN 'LOW' ELSE 'HIGH' END WHEN why = 'STAY_C_PROBE' OR skip THEN ps END,
    CASE WHEN why = 'ENTER_C_PROBE' THEN 0 ELSE pa END, ur, dr, tr, why
  FROM (SELECT *, CASE WHEN skip OR why IS NULL THEN phase WHEN why = 'ENTER_B_RANGE_VALID' THEN 'B' WHEN why = 'RESET_RANGE_INVALID' THEN NULL
      WHEN why IN ('EXIT_B_ACCEPTED_BREAK', 'EXIT_C_ACCEPTED_BREAK', 'STAY_D_ACCEPTED') THEN 'D' WHEN why IN ('ENTER_C_PROBE', 'STAY_C_PROBE') THEN 'C'
      WHEN why IN ('EXIT_D_TREND_ESTABLISHED', 'STAY_E_TREND') THEN 'E' ELSE 'B' END AS np
  FROM (SELECT *, CASE WHEN skip THEN NULL
      WHEN phase IS NULL THEN CASE WHEN wa >= 1.5 AND ratio >= 0.7 AND n_t >= 2 THEN 'ENTER_B_RANGE_VALID' END
      WHEN phase = 'B' THEN CASE WHEN wa < 1.5 THEN 'RESET_RANGE_INVALID' WHEN ok THEN 'EXIT_B_ACCEPTED_BREAK' WHEN b_l OR b_h THEN 'ENTER_C_PROBE' ELSE 'STAY_B_AUCTION_IN_RANGE' END
      WHEN phase = 'C' THEN CASE WHEN ok THEN 'EXIT_C_ACCEPTED_BREAK' WHEN (ps = 'LOW' AND rc_l) OR (ps = 'HIGH' AND rc_h) THEN 'EXIT_C_RECLAIMED' WHEN pa > 1 THEN 'EXIT_C_TIMEOUT' ELSE 'STAY_C_PROBE' END
      WHEN phase = 'D' THEN CASE WHEN tr >= 2 THEN 'EXIT_D_TREND_ESTABLISHED' WHEN ins THEN 'REENTER_B_FROM_D' ELSE 'STAY_D_ACCEPTED' END
      ELSE CASE WHEN ins THEN 'REENTER_B_FROM_E' ELSE 'STAY_E_TREND' END END AS why
  FROM (SELECT *, greatest(ur, dr) >= 1 AS ok FROM (
    SELECT e.*, e.hi IS NULL AS skip, q.phase, q.num, q.start, q.age, q.ps, CASE WHEN e.hi IS NOT NULL AND q.phase = 'C' THEN q.pa + 1 ELSE q.pa END AS pa,
      CASE WHEN e.hi IS NULL THEN q.ur WHEN e.o_u THEN q.ur + 1 ELSE 0 END AS ur, CASE WHEN e.hi IS NULL THEN q.dr WHEN e.o_d THEN q.dr + 1 ELSE 0 END AS dr,
      CASE WHEN e.hi IS NULL THEN q.tr WHEN e.far THEN q.tr + 1 ELSE 0 END AS tr
    FROM q JOIN ev e ON e.instrument = q.instrument AND e.dt = q.dt AND e.i = q.i + 1)))))"""
FOLD_SELECT = """SELECT e.instrument, e.anchor_tf, e.ts AS anchor_ts, CASE WHEN phase IS NOT NULL THEN format('{}:{}-{:04d}', e.instrument, e.anchor_tf, num) END AS dr_id, phase AS dr_phase,
  CASE WHEN phase IS NOT NULL THEN lo END AS dr_low, CASE WHEN phase IS NOT NULL THEN hi END AS dr_high, CASE WHEN phase IS NOT NULL THEN wa END AS dr_width_atr,
  CAST(CASE WHEN phase IS NOT NULL THEN age END AS BIGINT) AS dr_age_bars, CASE WHEN phase IS NOT NULL THEN start END AS dr_start_ts, CASE WHEN phase IS NOT NULL THEN e.ts END AS dr_last_update_ts, why AS dr_reason_code,
  CASE WHEN why IS NOT NULL THEN ratio END AS inside_ratio_L, CAST(CASE WHEN why IS NOT NULL THEN n_t END AS BIGINT) AS tests_L, CASE WHEN phase = 'C' THEN ps END AS probe_side,
  CASE WHEN phase IS NOT NULL THEN CASE WHEN b_l THEN p_l WHEN b_h THEN p_h END END AS pierce_dist,
  CAST(CASE WHEN why IS NOT NULL THEN CASE WHEN o_u THEN q.ur WHEN o_d THEN q.dr ELSE 0 END END AS BIGINT) AS accept_bars, CAST(CASE WHEN why IS NOT NULL THEN q.tr END AS BIGINT) AS trend_bars
FROM ev e JOIN q USING (instrument, dt, i)"""
FOLD_COLUMNS = ("dr_id", "dr_phase", "dr_low", "dr_high", "dr_width_atr", "dr_age_bars", "dr_start_ts", "dr_last_update_ts", "dr_reason_code",
                "inside_ratio_L", "tests_L", "probe_side", "pierce_dist", "accept_bars", "trend_bars")


@check("F-62", query(FOLD, FOLD_SELECT, "dr_low dr_high dr_width_atr inside_ratio_L pierce_dist"))
def _(d):
    return range_phases(d.bars(), RANGE).select("instrument", "anchor_tf", "anchor_ts", *FOLD_COLUMNS)


@check(
    "F-63",
    query(FOLD, f"""SELECT w.instrument, 'M15' AS anchor_tf, w.ts AS anchor_ts, dr_id, dr_phase, dr_reason_code, 'dr_phase_v1' AS phase_version, 'dr_thresholds_v1' AS threshold_bundle_id
      FROM (SELECT DISTINCT instrument, CASE WHEN event_id % 2 = 0 THEN time_bucket(INTERVAL 15 MINUTE, ts) ELSE time_bucket(INTERVAL 15 MINUTE, ts + INTERVAL 30 MINUTE) END AS ts FROM ticks) w
      LEFT JOIN ({FOLD_SELECT}) p ON p.instrument = w.instrument AND p.anchor_ts = w.ts"""),
)
def _(d):
    from barloom.functions.timegrid import snap

    # Windows partly without a bar of their own: odd ticks ask half an hour later.
    late = F.when(F.col("event_id") % 2 == 0, F.col("ts")).otherwise(F.col("ts") + F.expr("INTERVAL 30 MINUTES"))
    windows = d.ticks().select("instrument", F.lit("M15").alias("anchor_tf"), snap(late, "M15").alias("anchor_ts"))
    out = attach_phases(windows, range_phases(d.bars(), RANGE))
    return out.select("instrument", "anchor_tf", "anchor_ts", "dr_id", "dr_phase", "dr_reason_code", "phase_version", "threshold_bundle_id")
