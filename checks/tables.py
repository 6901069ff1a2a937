"""Conformance, filters, expressions, time grid, set operations and scalars (T, G, U, X)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from barloom.functions import expr as ex
from barloom.functions import timegrid as tg
from barloom.functions.rolling import Rows
from barloom.operators import conform as cf
from barloom.operators.bars import keep_first, keep_last, resample, ticks_to_bars
from barloom.operators.decisions import pick_candidates
from barloom.operators.volatility import return_zscores
from barloom.operators.windows import base_windows, expand_entries

from .base import BY_DAY, M15, TICKS, bars_cte, check, div, lag, mean, query, rounded, std

CTX = cf.RunContext("research", "backtest", "snap1", "run1")
K = "instrument, anchor_tf, ts"
KEYS = ("instrument", "anchor_tf", "ts")


def orders(d):
    return d.table("orders")


def events(d):
    return d.table("events")


# --- conformance --------------------------------------------------------------------------------

DECLARED = {"event_id": "int", "absent": "string", "ts": "timestamp", "value": "int", "event_type": "double", "user_id": "string"}


@check("T-01", "SELECT event_id, CAST(NULL AS VARCHAR) AS absent, ts, CAST(trunc(value) AS BIGINT) AS value, CAST(NULL AS DOUBLE) AS event_type, CAST(user_id AS VARCHAR) AS user_id FROM events")
def _(d):
    return cf.enforce_schema(events(d), DECLARED, allow_extra=False, reorder=True)


@check("T-02", "SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def _(d):
    empty = cf.empty_table(d.spark, {"o_orderkey": "int", "o_orderstatus": "string", "o_orderdate": "date"})
    rows = orders(d).select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate"))
    return empty.unionByName(rows)


@check("T-03", """SELECT o_orderkey, 'snap1' AS snapshot_id, 'run1' AS run_id, o_orderstatus AS mode,
  CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) ELSE DATE '2024-01-15' END AS dt FROM orders""")
def _(d):
    rows = orders(d).select(
        "o_orderkey",
        F.col("o_orderstatus").alias("mode"),
        F.when(F.col("o_orderstatus") == "O", F.to_date("o_orderdate")).alias("dt"),
    )
    return cf.stamp_identity(rows, CTX, date(2024, 1, 15))


EVAL_SRC = """(SELECT o_orderkey, 'ict' AS paradigm_id, o_orderpriority AS principle_id, CASE WHEN o_orderstatus = 'O' THEN '  ' WHEN o_orderstatus = 'F' THEN o_orderpriority END AS candidate_id FROM orders)"""


def evaluated(d):
    s = F.col("o_orderstatus")
    return orders(d).select(
        "o_orderkey",
        F.lit("ict").alias("paradigm_id"),
        F.col("o_orderpriority").alias("principle_id"),
        F.when(s == "O", "  ").when(s == "F", F.col("o_orderpriority")).alias("candidate_id"),
    )


@check("T-04", f"SELECT o_orderkey, paradigm_id, principle_id, CASE WHEN candidate_id IS NULL OR trim(candidate_id) = '' THEN '∅' ELSE candidate_id END AS candidate_id, '∅' AS experiment_id FROM {EVAL_SRC}")
def _(d):
    return cf.normalise_evaluation(evaluated(d))


@check("T-05", "SELECT event_id, ts, CAST(NULL AS INTEGER) AS extra_score FROM events")
def _(d):
    out = cf.conform_to_family(events(d), ["event_id", "ts", "extra_score"], ["event_id", "ts"], allow_extra=False)
    return out.withColumn("extra_score", F.col("extra_score").cast("int"))


@check("T-06", "SELECT event_id, event_type FROM events")
def _(d):
    return cf.require_columns(events(d), ["event_id", "event_type"], "events").select("event_id", "event_type")


@check("T-07", "SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def _(d):
    return cf.on_day(events(d), date(2024, 1, 15)).select("event_id", "ts")


TWO_TF = f"{TICKS}, {bars_cte('a', 'M15', 15)}, {bars_cte('b', 'H1', 60)}, both_tf AS (SELECT * FROM a UNION ALL SELECT * FROM b)"


@check("T-08", query(TWO_TF, "SELECT instrument, anchor_tf AS tf, ts, close FROM both_tf WHERE anchor_tf IN ('H1')", "close"))
def _(d):
    both = d.candles("M15").unionByName(d.candles("H1"))
    return both.where(F.col("tf").isin("H1")).select("instrument", "tf", "ts", "close")


@check("T-09", "SELECT event_id, k FROM (SELECT event_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS k FROM events) WHERE k IS NOT NULL")
def _(d):
    return events(d).select("event_id", F.when(F.col("event_id") % 3 > 0, F.col("event_type")).alias("k")).dropna(subset=["k"])


@check("T-10", "SELECT CAST(user_id AS VARCHAR) AS instrument, ts FROM events")
def _(d):
    return cf.cast_keys(events(d).select(F.col("user_id").alias("instrument"), "ts"), ["instrument", "ts"])


HOURS = "SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS h FROM events"


@check("T-11", f"SELECT event_type, h, event_id, {rounded('value')} AS value FROM ({HOURS}) QUALIFY row_number() OVER (PARTITION BY event_type, h ORDER BY event_id) = 1")
def _(d):
    rows = events(d).select("event_type", tg.snap(F.col("ts"), "H1").alias("h"), "event_id", "value")
    return keep_first(rows, ["event_type", "h"], F.col("event_id"))


@check("T-12", f"SELECT event_type, h, event_id, {rounded('value')} AS value FROM ({HOURS}) QUALIFY row_number() OVER (PARTITION BY event_type, h ORDER BY event_id DESC) = 1")
def _(d):
    rows = events(d).select("event_type", tg.snap(F.col("ts"), "H1").alias("h"), "event_id", "value")
    return keep_last(rows, ["event_type", "h"], F.col("event_id"))


PAIR = f"SELECT {K}, high - low AS rng, close - open AS body FROM bars"


@check("T-13", query(M15, PAIR, "rng body"))
def _(d):
    bars = d.bars()
    frames = {
        "a": bars.select(*KEYS, (F.col("high") - F.col("low")).alias("rng")),
        "b": bars.select(*KEYS, (F.col("close") - F.col("open")).alias("body")),
    }
    cf.require_disjoint(frames, KEYS)
    return frames["a"].join(frames["b"], list(KEYS))


@check("T-14", query(M15, f"SELECT {K}, close, high, low, open, volume FROM bars", "close high low open volume"))
def _(d):
    return cf.order_columns(d.bars().drop("dt"), KEYS)


@check("T-15", f"SELECT event_id, {rounded(div('value', 'k'))} AS q FROM (SELECT event_id, value, CASE WHEN event_id % 5 > 0 THEN user_id % 4 END AS k FROM events)")
def _(d):
    k = F.when(F.col("event_id") % 5 > 0, F.col("user_id") % 4)
    return events(d).select("event_id", ex.safe_div(F.col("value"), k).alias("q"))


@check("T-16", query(M15, f"SELECT {K}, {div('close - ' + mean('close', 10, BY_DAY), std('close', 10, BY_DAY))} AS z FROM bars", "z"))
def _(d):
    r, x = Rows(), F.col("close")
    return d.bars().select(*KEYS, ex.zscore(x, r.mean(x, 10), r.std(x, 10)).alias("z"))


@check("T-17", "SELECT event_id, CASE WHEN v > 100 THEN 'high' WHEN v > 20 THEN 'mid' WHEN v <= 20 THEN 'low' ELSE 'unknown' END AS bucket FROM (SELECT event_id, CASE WHEN event_id % 7 > 0 THEN value END AS v FROM events)")
def _(d):
    v = F.when(F.col("event_id") % 7 > 0, F.col("value"))
    return events(d).select("event_id", ex.bucket_by_edges(v, [20.0, 100.0], ["low", "mid", "high"]).alias("bucket"))


@check("T-18", "SELECT event_id, CASE WHEN v <= 0.25 THEN '<= 0.25' WHEN v <= 0.5 THEN '(0.25,0.5]' WHEN v <= 0.75 THEN '(0.5,0.75]' WHEN v <= 1 THEN '(0.75,1]' WHEN v <= 1.5 THEN '(1,1.5]' WHEN v <= 2 THEN '(1.5,2]' ELSE '> 2' END AS label FROM (SELECT event_id, value / 40 AS v FROM events)")
def _(d):
    return events(d).select("event_id", ex.interval_labels(F.col("value") / 40, ex.parse_edges("not json")).alias("label"))


@check("T-19", f"""SELECT event_id, {rounded('CASE WHEN x < 0 THEN 0 WHEN x > 1 THEN 1 ELSE x END')} AS unit, {rounded('CASE WHEN x < -0.8 THEN -0.8 WHEN x > 0.8 THEN 0.8 ELSE x END')} AS clipped,
  CAST(CASE WHEN x > 0 THEN 1 WHEN x < 0 THEN -1 ELSE 0 END AS INTEGER) AS direction FROM (SELECT event_id, CASE WHEN event_id % 9 > 0 THEN (value - 30) / 50 END AS x FROM events)""")
def _(d):
    x = F.when(F.col("event_id") % 9 > 0, (F.col("value") - 30) / 50)
    return events(d).select("event_id", ex.clamp01(x).alias("unit"), ex.clip(x, -0.8, 0.8).alias("clipped"), ex.sign(x).alias("direction"))


@check("T-20", f"SELECT event_id, {rounded('coalesce(CASE WHEN event_id % 2 = 0 THEN value END, user_id)')} AS px FROM events")
def _(d):
    rows = events(d).withColumn("first_px", F.when(F.col("event_id") % 2 == 0, F.col("value")))
    return rows.select("event_id", ex.coalesce_present(rows, ["missing", "first_px", "user_id"], "double").alias("px"))


@check("T-21", f"SELECT event_id, {rounded('value')} AS value, 'n/a' AS venue, CAST(NULL AS BIGINT) AS lots FROM events")
def _(d):
    rows = events(d)
    return rows.select(
        "event_id",
        ex.column_or(rows, "value", "double").alias("value"),
        ex.column_or(rows, "venue", "string", "n/a").alias("venue"),
        ex.column_or(rows, "lots", "int").alias("lots"),
    )


@check("T-22", query(M15, f"SELECT {K}, 'p1' AS phase_version, 't1' AS threshold_bundle_id, 'micro_policy_v1' AS micro_policy_id, 'jump_v2' AS jump_policy_id, 'impact_policy_v1' AS impact_policy_id, 'options_policy_v1' AS options_policy_id FROM bars"))
def _(d):
    return d.bars().select(*KEYS).withColumns(ex.policy_ids("p1", "t1", {"jump_policy_id": "jump_v2"}))


@check("T-23", "SELECT event_id FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'B' END AS phase, CASE WHEN event_id % 3 > 0 THEN value END AS lo FROM events) WHERE phase IS NOT NULL AND lo IS NULL")
def _(d):
    rows = events(d).select(
        "event_id",
        F.when(F.col("event_type") == "error", "B").alias("phase"),
        F.when(F.col("event_id") % 3 > 0, F.col("value")).alias("lo"),
    )
    return cf.rows_missing(rows, "phase", ["lo"]).select("event_id")


CAND = f"""{M15}, r AS (SELECT *, close / nullif({lag('close', BY_DAY)}, 0) - 1 AS r FROM bars),
z AS (SELECT *, (abs(r) - avg(abs(r)) OVER (PARTITION BY {BY_DAY})) / nullif(stddev_samp(abs(r)) OVER (PARTITION BY {BY_DAY}), 0) AS z FROM r),
hit AS (SELECT *, abs(coalesce(z, 0)) > 4.5 AS hit, bool_or(abs(coalesce(z, 0)) > 4.5) OVER (PARTITION BY dt) AS hit_any FROM z)"""


@check("T-24", query(CAND, f"SELECT {K}, z AS stat_ts_vol_zscore FROM hit WHERE hit OR NOT hit_any", "stat_ts_vol_zscore"))
def _(d):
    rows = return_zscores(d.bars()).select(*KEYS, "dt", "stat_ts_vol_zscore")
    return pick_candidates(rows, {"vol_z_abs_min": 4.5}).select(*KEYS, "stat_ts_vol_zscore")


# --- time grid -------------------------------------------------------------------------------------

TF = "CASE l_linenumber % 6 WHEN 0 THEN 'S30' WHEN 1 THEN 'M5' WHEN 2 THEN 'M15' WHEN 3 THEN 'H4' WHEN 4 THEN 'D1' ELSE 'X9' END"
SECONDS = "CASE tf WHEN 'S30' THEN 30 WHEN 'M5' THEN 300 WHEN 'M15' THEN 900 WHEN 'H4' THEN 14400 WHEN 'D1' THEN 86400 END"
STAMP = "l_shipdate + to_seconds(l_orderkey % 86400)"
LINES = f"(SELECT l_orderkey, l_linenumber, {TF} AS tf, {STAMP} AS stamp FROM lineitem)"


def lines(d):
    tf = F.lit("X9")
    for k, code in enumerate(("S30", "M5", "M15", "H4", "D1")):
        tf = F.when(F.col("l_linenumber") % 6 == k, code).otherwise(tf)
    at = F.col("l_shipdate") + F.make_dt_interval(secs=F.col("l_orderkey") % 86400)
    return d.table("lineitem").select("l_orderkey", "l_linenumber", tf.alias("tf"), at.cast("timestamp_ntz").alias("stamp"))


@check("G-01", f"SELECT l_orderkey, l_linenumber, tf, CAST({SECONDS} AS BIGINT) * 1000000 AS us FROM {LINES}")
def _(d):
    return lines(d).select("l_orderkey", "l_linenumber", "tf", tg.tf_micros(F.col("tf")).alias("us"))


@check("G-02", "SELECT DISTINCT event_type AS instrument, 'H4' AS anchor_tf, time_bucket(INTERVAL 4 HOUR, ts, TIMESTAMP '1970-01-01') AS ts FROM events")
def _(d):
    return tg.anchor_grid(events(d), "H4", instrument="event_type")


@check("G-03", f"SELECT l_orderkey, l_linenumber, stamp FROM {LINES} WHERE epoch_us(stamp) % 300000000 <> 0")
def _(d):
    return tg.off_grid(lines(d), F.lit("M5"), "stamp").select("l_orderkey", "l_linenumber", "stamp")


@check("G-04", f"SELECT tf AS anchor_tf, count(*) AS rows, CAST(sum(CASE WHEN epoch(stamp)::BIGINT % {SECONDS} <> 0 THEN 1 WHEN {SECONDS} IS NOT NULL THEN 0 END) AS BIGINT) AS bad_rows FROM {LINES} GROUP BY tf")
def _(d):
    return tg.grid_report(lines(d).withColumnRenamed("tf", "anchor_tf"), "anchor_tf", "stamp")


@check("G-05", f"SELECT l_orderkey, l_linenumber, tf, CASE WHEN {SECONDS} IS NULL THEN stamp ELSE stamp - to_seconds(epoch(stamp)::BIGINT % {SECONDS}) END AS stamp FROM {LINES}")
def _(d):
    return lines(d).withColumn("stamp", tg.snap_by(F.col("stamp"), F.col("tf")))


@check("G-06", f"SELECT l_orderkey, l_linenumber, epoch(stamp)::BIGINT % {SECONDS} = 0 AS aligned FROM {LINES}")
def _(d):
    return lines(d).select("l_orderkey", "l_linenumber", tg.is_aligned(F.col("stamp"), F.col("tf")).alias("aligned"))


@check("G-07", query(M15, """SELECT instrument, 'H1' AS tf, min(ts) AS ts, first(open ORDER BY ts) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY ts) AS close, sum(volume) AS volume
  FROM bars GROUP BY instrument, time_bucket(INTERVAL 1 HOUR, ts)""", "open high low close volume"))
def _(d):
    return resample(d.candles("M15"), "H1")


@check("G-07_ticks", query(TICKS + ", " + bars_cte("bars", "M5", 5), "SELECT instrument, anchor_tf AS tf, ts, open, high, low, close, volume FROM bars", "open high low close volume"))
def _(d):
    return ticks_to_bars(d.ticks(), "M5", "event_id")


@check("G-08", query(M15, "SELECT instrument, anchor_tf, ts AS anchor_ts, e AS tf_entry FROM bars, (VALUES ('M1'), ('M5'), ('M15')) v(e)"))
def _(d):
    base = d.bars().select("instrument", "anchor_tf", F.col("ts").alias("anchor_ts"))
    return expand_entries(base, ["M1", "M5", "M15"])


@check("G-09", query(M15, """SELECT instrument, anchor_tf, ts AS anchor_ts FROM bars
  UNION SELECT instrument, 'H4', time_bucket(INTERVAL 4 HOUR, ts, TIMESTAMP '1970-01-01') FROM ticks"""))
def _(d):
    # H4 has no candles here and comes from the timestamps of features.
    features = d.ticks().select("instrument", F.lit("H4").alias("anchor_tf"), "ts")
    return base_windows(d.candles("M15"), features, ["M15", "H4"])


# --- set operations -----------------------------------------------------------------------------------


@check("U-01", "SELECT event_id, event_type FROM events UNION ALL SELECT o_orderkey, o_orderstatus FROM orders")
def _(d):
    return cf.union_all(
        [events(d).select("event_id", "event_type"), orders(d).select(F.col("o_orderkey").alias("event_id"), F.col("o_orderstatus").alias("event_type"))]
    )


@check("U-02", f"SELECT event_id, event_type, NULL::DOUBLE AS price FROM events UNION ALL SELECT o_orderkey, NULL, {rounded('o_totalprice')} FROM orders")
def _(d):
    return cf.union_all(
        [events(d).select("event_id", "event_type"), orders(d).select(F.col("o_orderkey").alias("event_id"), F.col("o_totalprice").alias("price"))]
    )


@check("U-03", f"SELECT {rounded('value')} AS value FROM events UNION ALL SELECT {rounded('o_custkey')} FROM orders")
def _(d):
    return cf.union_widened(events(d).select("value"), orders(d).select(F.col("o_custkey").alias("value")))


@check("U-04", "SELECT user_id AS id FROM events UNION SELECT o_custkey FROM orders")
def _(d):
    return events(d).select(F.col("user_id").alias("id")).union(orders(d).select("o_custkey")).distinct()


# --- scalar functions ------------------------------------------------------------------------------------


@check("X-01", "SELECT o_orderkey, trim(s) AS t, upper(s) AS u, lower(s) AS l, trim(s) = '' AS blank FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '  ' ELSE ' ' || o_orderpriority END AS s FROM orders)")
def _(d):
    s = F.when(F.col("o_orderkey") % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("o_orderpriority")))
    return orders(d).select("o_orderkey", F.trim(s).alias("t"), F.upper(s).alias("u"), F.lower(s).alias("l"), ex.is_blank(s).alias("blank"))


@check("X-02", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE 'unknown' END AS word FROM orders")
def _(d):
    return orders(d).select("o_orderkey", ex.map_values(F.col("o_orderstatus"), {"O": "open", "F": "filled"}, "unknown").alias("word"))


@check("X-03", "SELECT o_orderkey, concat_ws('::', 'zone', o_orderstatus, CAST(o_custkey AS VARCHAR)) AS id, format('{}-{:04d}', o_orderstatus, o_custkey) AS code FROM orders")
def _(d):
    return orders(d).select(
        "o_orderkey",
        F.concat_ws("::", F.lit("zone"), "o_orderstatus", F.col("o_custkey").cast("string")).alias("id"),
        F.format_string("%s-%04d", "o_orderstatus", "o_custkey").alias("code"),
    )


@check("X-04", "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%S') AS stamp FROM events")
def _(d):
    return events(d).select("event_id", F.date_format("ts", "yyyyMMdd'T'HHmmss").alias("stamp"))


RAW = "CASE event_id % 4 WHEN 0 THEN strftime(ts, '%m/%d/%Y %H:%M') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 2 THEN strftime(ts, '%d/%m/%Y %H:%M') ELSE 'soon' END"
PARSED = f"""CASE WHEN event_id % 4 = 1 THEN date_trunc('second', ts) WHEN event_id % 4 = 0 THEN date_trunc('minute', ts)
  WHEN event_id % 4 = 2 AND day(ts) > 12 THEN date_trunc('minute', ts) WHEN event_id % 4 = 2 THEN make_timestamp(2024, day(ts), month(ts), hour(ts), minute(ts), 0) END"""


def raw_start():
    m = F.col("event_id") % 4
    return (
        F.when(m == 0, F.date_format("ts", "MM/dd/yyyy HH:mm"))
        .when(m == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(m == 2, F.date_format("ts", "dd/MM/yyyy HH:mm"))
        .otherwise("soon")
    )


@check("X-05", f"SELECT event_id, {PARSED} AS at FROM events")
def _(d):
    from barloom.operators.calendar import parse_start

    return events(d).select("event_id", parse_start(raw_start(), "UTC").alias("at"))


@check("X-06", "SELECT event_id, ts + INTERVAL 5 HOUR AS at FROM events")
def _(d):
    # New York is five hours behind UTC throughout January.
    return events(d).select("event_id", F.to_utc_timestamp(F.col("ts").cast("timestamp"), "America/New_York").cast("timestamp_ntz").alias("at"))


@check("X-07", "SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts) AS at, CAST(ts AS DATE) AS day FROM events")
def _(d):
    return events(d).select("event_id", tg.snap(F.col("ts"), "M5").alias("at"), F.to_date("ts").alias("day"))


@check("X-08", "SELECT event_id, ts + INTERVAL 15 MINUTE AS later, (epoch_us(ts) - epoch_us(time_bucket(INTERVAL 1 HOUR, ts))) // 1000 AS ms FROM events")
def _(d):
    gap = tg.micros(F.col("ts")) - tg.micros(tg.snap(F.col("ts"), "H1"))
    return events(d).select(
        "event_id", (F.col("ts") + F.make_dt_interval(mins=F.lit(15))).alias("later"), F.floor(gap / 1000).cast("long").alias("ms")
    )


@check("X-09", f"SELECT event_id, {rounded('ln(value)')} AS ln, {rounded('abs(value - 50)')} AS dist, CAST(floor(value) AS BIGINT) AS whole, {rounded('value * value')} AS square FROM events")
def _(d):
    v = F.col("value")
    return events(d).select("event_id", F.ln(v).alias("ln"), F.abs(v - 50).alias("dist"), F.floor(v).alias("whole"), (v * v).alias("square"))


TAGS = "list_filter([CASE WHEN value > 50 THEN 'big' END, CASE WHEN event_type = 'error' THEN 'bad' END, CASE WHEN event_id % 2 = 0 THEN 'even' END], lambda t: t IS NOT NULL)"


def tags():
    return [
        F.when(F.col("value") > 50, F.lit("big")),
        F.when(F.col("event_type") == "error", F.lit("bad")),
        F.when(F.col("event_id") % 2 == 0, F.lit("even")),
    ]


@check("X-10", f"SELECT event_id, coalesce(array_to_string({TAGS}, ','), '') AS joined FROM events")
def _(d):
    return events(d).select("event_id", F.concat_ws(",", F.array_compact(F.array(*tags()))).alias("joined"))


@check("X-11", f"SELECT event_id, CASE WHEN len({TAGS}) = 0 THEN '[]' ELSE '[\"' || array_to_string({TAGS}, '\",\"') || '\"]' END AS js FROM events")
def _(d):
    return events(d).select("event_id", ex.json_tags(tags()).alias("js"))


@check("X-12", "SELECT event_id, CASE WHEN event_id % 3 > 0 THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) END AS k FROM events")
def _(d):
    text = F.when(F.col("event_id") % 3 > 0, F.col("props")).otherwise("{broken")
    return events(d).select("event_id", F.get_json_object(text, "$.k").try_cast("double").alias("k"))


@check("X-13", "SELECT event_id, event_type IN ('error', 'click') AS hit FROM events")
def _(d):
    return events(d).select("event_id", F.col("event_type").isin("error", "click").alias("hit"))


@check("X-14", "SELECT event_id, sha1(event_type || '|' || CAST(user_id AS VARCHAR) || '|' || props) AS id FROM events")
def _(d):
    return events(d).select("event_id", ex.sha1_id(F.col("event_type"), F.col("user_id").cast("string"), F.col("props")).alias("id"))


@check("X-15", query(M15, f"SELECT {K}, least(open, close) AS lo, greatest(open, close, (high + low) / 2) AS hi, open > close OR volume > 5 AS hit FROM bars", "lo hi"))
def _(d):
    o, c = F.col("open"), F.col("close")
    return d.bars().select(
        *KEYS, F.least(o, c).alias("lo"), F.greatest(o, c, (F.col("high") + F.col("low")) / 2).alias("hi"), ((o > c) | (F.col("volume") > 5)).alias("hit")
    )
