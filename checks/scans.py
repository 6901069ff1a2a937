"""Scans, importers, upserts, the calendar, and rows as the sinks store them (S)."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions.timegrid import snap
from barloom.operators import calendar as cal
from barloom.operators import decisions as dc
from barloom.operators.conform import union_all
from barloom.operators.structure import structure_events
from barloom.plans.features import family_frame, zones_table
from barloom.session import shared_folder
from barloom.sources import importers as imp
from barloom.sources import store

from .base import BY_DAY, M15, TICKS, bars_cte, check, lag, query, rounded, std
from .structures import EVENT_BODY, EVENT_CTES, full
from .tables import CTX, PARSED, RAW, raw_start

KEYS = ("instrument", "anchor_tf", "ts")
K = "instrument, anchor_tf, ts"
STAMP = "'snap1' AS snapshot_id, 'run1' AS run_id, 'backtest' AS mode"
EVENT_COLUMNS = {"event_id": "int", "ts": "timestamp", "user_id": "int", "event_type": "string", "value": "double", "props": "string"}


def stored(d, rows, table, ctx=CTX, **identity):
    """rows written to a table and read again: first with stale rows in half of its days, which the whole write replaces, and in a day it no longer has."""
    root = shared_folder(d.spark, "tables")
    day = F.to_date(F.lit("1899-12-31"))
    half = rows.where(F.pmod(F.xxhash64("dt"), F.lit(2)) == 0)
    stale = half.unionByName(half.limit(1).withColumn("dt", day))
    store.write_table(stale, table, root, ctx, **identity)
    store.write_table(rows, table, root, ctx, covers=[{"dt": "1899-12-31"}], **identity)
    return store.read_table(d.spark, root, table, **({"run_id": ctx.run_id} if ctx else {}))


def listed(df, column):
    """Distinct values of a column of few: the instruments and days of a scan."""
    return [r[0] for r in df.select(column).distinct().collect()]


@check("S-01", query(M15, "SELECT instrument, anchor_tf AS tf, ts, open, high, low, close, volume, 'backtest' AS mode, dt FROM bars WHERE dt >= (SELECT min(dt) + 2 FROM bars)", "open high low close volume"))
def _(d):
    rows = d.candles().withColumns({"mode": F.lit("backtest"), "dt": F.to_date("ts")})
    root = shared_folder(d.spark, "tables")
    store.write_table(rows, "candles", root)
    days = sorted(listed(rows, "dt"))[2:]
    found = store.scan_candles(d.spark, root, "backtest", listed(rows, "instrument"), days)
    return found.select(*rows.columns)


@check("S-02", f"SELECT event_id, ts, user_id, event_type, {rounded('value')} AS value, props FROM events")
def _(d):
    found = store.scan_optional(d.spark, f"{d.folder}/events.parquet", EVENT_COLUMNS)
    absent = store.scan_optional(d.spark, f"{d.folder}/no_such_ticks.parquet", EVENT_COLUMNS)
    return found.unionByName(absent)


@check("S-03", """SELECT ts, CAST(ts AS DATE) AS dt, 'quiet' AS macro_state, CAST(max(floor(value / 60)) AS INTEGER) AS impact_level, max(value) > 150 AS blackout
  FROM events WHERE CAST(ts AS DATE) > (SELECT min(CAST(ts AS DATE)) FROM events) GROUP BY ts""")
def _(d):
    macro = d.table("events").groupBy("ts").agg(F.floor(F.max("value") / 60).cast("int").alias("impact_level"), (F.max("value") > 150).alias("blackout"))
    macro = macro.withColumns({"dt": F.to_date("ts"), "macro_state": F.lit("quiet")})
    root = shared_folder(d.spark, "tables")
    absent = store.scan_macro(d.spark, root, ["2024-01-02"])  # nothing is stored yet
    store.write_table(macro, "macro", root)
    found = store.scan_macro(d.spark, root, sorted(listed(macro, "dt"))[1:])
    return absent.unionByName(found).select("ts", "dt", "macro_state", "impact_level", "blackout")


@check("S-04", f"SELECT l_orderkey, l_linenumber, l_shipdate, {rounded('l_quantity')} AS l_quantity FROM lineitem")
def _(d):
    columns = {"l_orderkey": "int", "l_shipdate": "timestamp", "l_quantity": "double"}
    df = store.scan(d.spark, f"{d.folder}/lineitem.parquet", columns)
    lines = d.table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    # The declared scan must hold the same rows as the inferred one, pair by pair.
    pairs = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return lines.join(pairs, list(columns), "left_semi")


@check("S-05", """SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_ts, ts - INTERVAL 15 MINUTE AS blackout_start_ts, ts + INTERVAL 15 MINUTE AS blackout_end_ts, 'USD' AS currency,
  CAST(CASE event_type WHEN 'error' THEN 3 WHEN 'click' THEN 2 WHEN 'view' THEN 1 WHEN 'signup' THEN 2 ELSE 0 END AS INTEGER) AS impact FROM events""")
def _(d):
    words = {"error": " high ", "click": "Med", "view": "L", "signup": "2"}
    label = F.lit("holiday")
    for event, word in words.items():
        label = F.when(F.col("event_type") == event, word).otherwise(label)
    gap = F.make_dt_interval(mins=F.lit(15))
    rows = d.table("events").select(
        "event_id", F.col("ts").alias("event_ts"), (F.col("ts") - gap).alias("blackout_start_ts"),
        (F.col("ts") + gap).alias("blackout_end_ts"), F.lit(" usd").alias("currency"), label.alias("impact"),
    )
    return cal.stored_calendar(rows)


def vendor_candles(d):
    return d.candles().withColumnRenamed("ts", "timestamp").drop("tf").withColumn("volume", F.col("volume").cast("string"))


@check("S-06", query(M15, "SELECT instrument, 'M15' AS tf, ts, open, high, low, close, volume FROM bars", "open high low close volume"))
def _(d):
    return imp.import_candles(vendor_candles(d), tf="M15")


@check("S-07", query(M15, "SELECT instrument, 'M15' AS tf, ts, open, high, low, CASE WHEN hour(ts) >= 12 THEN close + 1 ELSE close END AS close, volume FROM bars", "open high low close volume"))
def _(d):
    old = d.candles()
    new = old.where(F.hour("ts") >= 12).withColumn("close", F.col("close") + 1)
    return store.upsert(old, new, ["instrument", "tf", "ts"])


def vendor_ticks(d):
    return d.table("events").select(
        F.col("event_type").alias("instrument"), F.col("ts").cast("timestamp").alias("time"), F.col("value").alias("bidPrice"),
        (F.col("value") + 0.5).alias("askPrice"), F.col("user_id").alias("bidVolume"), "event_id",
    )


@check("S-08", f"SELECT event_type AS instrument, ts, {rounded('value')} AS bid, {rounded('value + 0.5')} AS ask, {rounded('user_id')} AS bid_size, CAST(NULL AS DOUBLE) AS ask_size FROM events")
def _(d):
    return imp.import_ticks(vendor_ticks(d))


@check("S-09", f"""SELECT event_type AS instrument, date_trunc('minute', ts) AS ts, {rounded('value')} AS bid, event_id FROM events
  QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('minute', ts) ORDER BY event_id % 2, event_id * (event_id % 2) DESC, event_id DESC) = 1""".replace("ORDER BY event_id % 2, event_id * (event_id % 2) DESC, event_id DESC", "ORDER BY event_id % 2 DESC, event_id DESC"))
def _(d):
    rows = d.table("events").select(
        F.col("event_type").alias("instrument"), snap(F.col("ts"), "M1").alias("ts"), F.col("value").alias("bid"), "event_id"
    )
    # Odd events arrive in the second batch; among even ones of one minute the existing file holds one row.
    from barloom.operators.bars import keep_last

    old = keep_last(rows.where("event_id % 2 = 0"), ["instrument", "ts"], F.col("event_id"))
    return store.upsert(old, rows.where("event_id % 2 = 1"), ["instrument", "ts"], tie="event_id")


@check("S-10", "SELECT event_id, CAST(ts AS DATE) AS utc_day, CAST(ts - INTERVAL 5 HOUR AS DATE) AS market_day FROM events")
def _(d):
    return d.table("events").select(
        "event_id", imp.market_day(F.col("ts")).alias("utc_day"), imp.market_day(F.col("ts"), "America/New_York").alias("market_day")
    )


@check("S-11", """SELECT * FROM (SELECT CAST(ts - INTERVAL 5 HOUR AS DATE) AS dt, min(ts) AS ts_min, max(ts) AS ts_max, count(*) AS rows FROM events GROUP BY 1)
  WHERE ts_min < CAST(dt AS TIMESTAMP) OR ts_max >= CAST(dt AS TIMESTAMP) + INTERVAL 1 DAY""")
def _(d):
    days = d.table("events").withColumn("dt", imp.market_day(F.col("ts"), "America/New_York"))
    return imp.day_violations(days)


VENDOR = f"""(SELECT event_id, {RAW} AS raw_start, {PARSED} AS event_ts, upper(event_type) AS impact, 'CCY' || CAST(user_id % 3 AS VARCHAR) AS currency, props AS name FROM events)"""
IMPACT = "CASE impact WHEN 'ERROR' THEN 'HIGH' WHEN 'CLICK' THEN 'MEDIUM' ELSE impact END"
ISO = "strftime(event_ts, '%Y-%m-%dT%H:%M:%S')"


def vendor_calendar(d):
    return d.table("events").select(
        raw_start().alias("Start"), F.concat(F.lit(" "), F.col("event_type")).alias("Impact"),
        F.concat(F.lit("ccy"), (F.col("user_id") % 3).cast("string")).alias("Currency"), F.col("props").alias("Name"), F.col("event_id").alias("Unnamed: 0"),
    )


MAPS = {"impact_map": {"ERROR": "HIGH", "CLICK": "MEDIUM"}, "currency_map": {"CCY0": "USD"}}
RULES = {"HIGH": (60, 60), "MEDIUM": (30, 45)}


@check("S-12", f"""SELECT sha1({ISO} || '|' || ccy || '|' || imp || '|' || name || '|vendor') AS event_id, event_ts, event_ts - INTERVAL 15 MINUTE AS blackout_start_ts, event_ts + INTERVAL 15 MINUTE AS blackout_end_ts,
  ccy AS currency, imp AS impact, name, 'vendor' AS source, raw_start FROM (SELECT *, {IMPACT} AS imp, CASE currency WHEN 'CCY0' THEN 'USD' ELSE currency END AS ccy FROM {VENDOR}) WHERE event_ts IS NOT NULL""")
def _(d):
    return cal.import_calendar(vendor_calendar(d), "vendor", **MAPS)


PRE = "to_minutes(CASE impact WHEN 'HIGH' THEN 60 WHEN 'MEDIUM' THEN 30 ELSE 10 END)"
POST = "to_minutes(CASE impact WHEN 'HIGH' THEN 60 WHEN 'MEDIUM' THEN 45 ELSE 20 END)"


@check("S-13", f"SELECT event_id, impact, ts - {PRE} AS blackout_start_ts, ts + {POST} AS blackout_end_ts FROM (SELECT event_id, ts, CASE event_type WHEN 'error' THEN 'HIGH' WHEN 'click' THEN 'MEDIUM' ELSE 'LOW' END AS impact FROM events)")
def _(d):
    label = F.when(F.col("event_type") == "error", "HIGH").when(F.col("event_type") == "click", "MEDIUM").otherwise("LOW")
    rows = d.table("events").select("event_id", F.col("ts").alias("event_ts"), label.alias("impact"))
    return cal.blackout_bounds(rows, (10, 20), RULES).drop("event_ts")


@check("S-14", """SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_ts, CASE WHEN event_id % 2 = 0 THEN 'new' ELSE 'old' END AS source, CASE WHEN event_id % 2 = 0 THEN 'HIGH' END AS impact FROM events""")
def _(d):
    e = d.table("events")
    old = e.select(F.col("event_id").cast("string").alias("event_id"), "ts", F.lit("old").alias("source"))
    new = e.where("event_id % 2 = 0").select(F.col("event_id").cast("string").alias("event_id"), F.col("ts").alias("event_ts"), F.lit("new").alias("source"), F.lit("HIGH").alias("impact"))
    out = cal.upsert_calendar(old, cal.canonical_calendar(new))
    return out.select("event_id", "event_ts", "source", "impact")


@check("S-15", query(f"{TICKS}, {bars_cte('a', 'M15', 15)}, {bars_cte('b', 'H1', 60)}", "SELECT instrument, anchor_tf AS tf, ts, open, high, low, close, CAST(volume AS BIGINT) AS volume FROM (SELECT * FROM a UNION ALL SELECT * FROM b)", "open high low close"))
def _(d):
    both = union_all([d.candles("M15"), d.candles("H1"), d.candles("H1"), d.candles("H4")])
    return imp.project_timeframes(both, ["M15", "H1"])


@check("S-16", query(M15, f"SELECT {STAMP}, dt, {K}, {std('r', 20, BY_DAY, 2)} AS ta_vol__ret1_std FROM (SELECT *, close / nullif({lag('close', BY_DAY)}, 0) - 1 AS r FROM bars)", "ta_vol__ret1_std"))
def _(d):
    rows = family_frame("ta_vol", d.bars()).select(*KEYS, "ta_vol__ret1_std").withColumn("dt", F.to_date("ts"))
    return stored(d, rows, "features", CTX)


@check("S-17", query(EVENT_CTES, f"SELECT {STAMP}, CAST(ts AS DATE) AS dt, * EXCLUDE (event_source) FROM ({EVENT_BODY})"))
def _(d):
    return stored(d, structure_events(full(d)), "market_events", CTX).select(
        "snapshot_id", "run_id", "mode", "dt", *KEYS, "event_type", "event_side", "ref_level", "event_strength"
    )


@check("S-18", query(M15, f"""SELECT {STAMP}, dt, {K}, zone_id FROM (
  SELECT dt, {K}, concat_ws('::', 'DAY_RANGE', CAST(dt AS VARCHAR), anchor_tf) AS zone_id FROM bars UNION ALL SELECT dt, {K}, concat_ws('::', 'vp_core', instrument, anchor_tf) FROM bars)"""))
def _(d):
    zones = zones_table(d.bars()).withColumn("dt", F.to_date("ts"))
    rows = stored(d, zones.unionByName(zones), "zones_state", CTX)
    return rows.select("snapshot_id", "run_id", "mode", "dt", *KEYS, "zone_id")


@check("S-19", query(M15, f"SELECT {STAMP}, dt, instrument, anchor_tf, ts AS pcr_window_ts, high - low AS pcr_range_value FROM bars", "pcr_range_value"))
def _(d):
    rows = family_frame("pcra_bar", d.bars(), {"range_bucket_window": 10, "vol_z_window": 10}).withColumn("dt", F.to_date("pcr_window_ts"))
    out = stored(d, rows, "pcr_a", CTX)
    return out.select("snapshot_id", "run_id", "mode", "dt", "instrument", "anchor_tf", "pcr_window_ts", "pcr_range_value")


@check("S-20", query(M15, f"SELECT {STAMP}, dt, instrument, anchor_tf, ts AS anchor_ts, e AS tf_entry FROM bars, (VALUES ('M1'), ('M5')) v(e)"))
def _(d):
    from barloom.operators.windows import base_windows, expand_entries

    base = expand_entries(base_windows(d.candles(), None, ["M15"]), ["M1", "M5", "M5"])
    return stored(d, base.withColumn("dt", F.to_date("anchor_ts")), "windows", CTX)


EVAL_SQL = "'ict' AS paradigm_id, o_orderpriority AS principle_id, CASE WHEN o_orderstatus = 'O' THEN '∅' ELSE o_orderstatus END AS candidate_id, '∅' AS experiment_id"
ORDER_AT = "o_orderdate + to_seconds(o_orderkey % 86400)"


def trades(d, dt=None):
    """Trades from orders; dt is their partition, a year's first day if not given."""
    at = (F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") % 86400)).cast("timestamp_ntz")
    return d.table("orders").select(
        F.lit("ict").alias("paradigm_id"), F.col("o_orderpriority").alias("principle_id"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("candidate_id"),
        (F.col("o_custkey") % 5).cast("string").alias("instrument"), F.col("o_orderkey").cast("string").alias("trade_id"),
        F.lit("H1").alias("anchor_tf"), at.alias("entry_ts"), at.alias("anchor_ts"), (F.trunc("o_orderdate", "year") if dt is None else dt).alias("dt"),
        F.lit("long").alias("side"), F.lit("M5").alias("tf_entry"), F.col("o_totalprice").alias("entry_px"),
    )


def daily(d):
    return trades(d, F.to_date("o_orderdate"))


COMMON = f"{STAMP}, CAST(date_trunc('year', o_orderdate) AS DATE) AS dt, {EVAL_SQL}, CAST(o_custkey % 5 AS VARCHAR) AS instrument, CAST(o_orderkey AS VARCHAR) AS trade_id"
DAILY = COMMON.replace("date_trunc('year', o_orderdate)", "o_orderdate")
SHOWN = ("snapshot_id", "run_id", "mode", "dt", "paradigm_id", "principle_id", "candidate_id", "experiment_id", "instrument", "trade_id")


@check("S-21", f"SELECT {COMMON}, 'pretrade' AS stage, {ORDER_AT} AS decision_ts, time_bucket(INTERVAL 1 HOUR, {ORDER_AT}) AS anchor_ts, CAST(NULL AS BOOLEAN) AS blocked_by_macro FROM orders")
def _(d):
    return stored(d, trades(d), "decisions_pretrade", CTX).select(*SHOWN, "stage", "decision_ts", "anchor_ts", "blocked_by_macro")


@check("S-22", f"SELECT {COMMON}, 'long' AS side, CAST(NULL AS DOUBLE) AS mae_R, {rounded('o_totalprice')} AS entry_px FROM orders")
def _(d):
    return stored(d, trades(d), "trade_paths", CTX).select(*SHOWN, "side", "mae_R", "entry_px")


@check("S-23", f"SELECT {COMMON}, {rounded('o_totalprice')} AS entry_px, 'dev_stub' AS order_type FROM orders")
def _(d):
    rows = stored(d, dc.brackets(trades(d), CTX), "brackets", CTX)
    return rows.select(*SHOWN, "entry_px", "order_type")


@check("S-24", f"SELECT {DAILY}, {rounded('o_totalprice')} AS limit_px, 'submitted' AS status FROM orders")
def _(d):
    rows = dc.order_rows(dc.brackets(daily(d), CTX))
    return store.prepare_rows(rows, "orders", CTX).select(*SHOWN, "limit_px", "status")


@check("S-25", f"SELECT {COMMON}, f AS fill_type, {ORDER_AT} AS fill_ts FROM orders, (VALUES ('entry'), ('exit')) v(f)")
def _(d):
    done = dc.brackets(trades(d), CTX).withColumns(
        {"entry_fill_ts": F.col("entry_ts"), "exit_fill_ts": F.col("entry_ts"), "entry_fill_px": F.col("entry_px"), "exit_fill_px": F.col("entry_px")}
    )
    return stored(d, dc.fill_rows(done), "fills", CTX).select(*SHOWN, "fill_type", "fill_ts")


@check("S-26", f"""SELECT {STAMP}, CAST(o_orderdate AS DATE) AS dt, 'all' AS cluster_id, CASE WHEN grouping(o_orderstatus) = 1 THEN 'run_total' ELSE 'evaluation' END AS report_level,
  CASE WHEN grouping(o_orderstatus) = 1 THEN '∅' ELSE o_orderpriority END AS principle_id, CASE WHEN grouping(o_orderstatus) = 1 OR o_orderstatus = 'O' THEN '∅' ELSE o_orderstatus END AS candidate_id, count(*) AS n_trades
  FROM orders GROUP BY GROUPING SETS ((CAST(o_orderdate AS DATE), o_orderpriority, o_orderstatus), (CAST(o_orderdate AS DATE)))""")
def _(d):
    t = daily(d)
    report = dc.run_report({"trade_paths": t}, t, CTX, unit=["dt"])
    rows = stored(d, report, "reports", CTX, cluster_id="all")
    return rows.select("snapshot_id", "run_id", "mode", "dt", "cluster_id", "report_level", "principle_id", "candidate_id", "n_trades")


@check("S-27", f"SELECT {STAMP}, CAST(o_orderdate AS DATE) AS dt, 'all' AS cluster_id, {EVAL_SQL}, CAST(o_custkey % 5 AS VARCHAR) AS instrument, count(*) AS trade_count FROM orders GROUP BY CAST(o_orderdate AS DATE), o_orderpriority, o_orderstatus, o_custkey % 5")
def _(d):
    rows = stored(d, dc.context_counts(daily(d)), "principles_context", CTX, cluster_id="all")
    return rows.select("snapshot_id", "run_id", "mode", "dt", "cluster_id", "paradigm_id", "principle_id", "candidate_id", "experiment_id", "instrument", "trade_count")
