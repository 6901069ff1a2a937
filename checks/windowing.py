"""Window functions, ranks and top-k, aggregates (W, K, A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions.rolling import Rows, average_rank, scaled_rank
from barloom.functions.timegrid import off_grid, snap
from barloom.operators import calendar as cal
from barloom.operators import decisions as dc
from barloom.operators.blocks import exponential_means
from barloom.operators.flow import day_range_zone, flow_sums, side_signed
from barloom.operators.volatility import return_zscores
from barloom.operators.windows import first_per_column
from barloom.session import cut_lineage
from barloom.sources.tables import EVALUATION

from .base import BY_DAY, CALENDAR, M15, TICKS, check, lag, mean, over, query, rolled, rounded, std, total, true_range
from .families import PANEL, TOP_SQL, ewm, market
from .tables import CTX, LINES, lines

KEYS = ("instrument", "anchor_tf", "ts")
K = "instrument, anchor_tf, ts"
X = F.col


def rows_of(d):
    return d.bars(), Rows()


@check("W-01", query(M15, f"SELECT {K}, {mean('close', 5, BY_DAY, 3)} AS a, {std('close', 5, BY_DAY, 3)} AS b, {total('volume', 5, BY_DAY, 1)} AS c, {rolled('min', 'low', 5, BY_DAY)} AS d, {rolled('max', 'high', 5, BY_DAY)} AS e FROM bars", "a b c d e"))
def _(d):
    b, r = rows_of(d)
    c = F.col("close")
    return b.select(*KEYS, r.mean(c, 5, 3).alias("a"), r.std(c, 5, 3).alias("b"), r.sum(F.col("volume"), 5, 1).alias("c"), r.min(F.col("low"), 5).alias("d"), r.max(F.col("high"), 5).alias("e"))


@check("W-02", query(M15, f"SELECT {K}, count(CASE WHEN close > 30 THEN close END) OVER {over(7, BY_DAY)} AS n FROM bars"))
def _(d):
    b, r = rows_of(d)
    return b.select(*KEYS, r.count(F.when(F.col("close") > 30, F.col("close")), 7).alias("n"))


@check("W-03", query(M15, f"""SELECT {K}, CASE WHEN count(close) OVER {over(9, BY_DAY)} >= 4 THEN
  list_sort(list(close) OVER {over(9, BY_DAY)})[CAST(floor(0.33 * (count(close) OVER {over(9, BY_DAY)} - 1) + 0.5) AS INTEGER) + 1] END AS q FROM bars""", "q"))
def _(d):
    from barloom.functions.sliding import sliding_quantiles

    return sliding_quantiles(d.bars(), {"q": (F.col("close"), 0.33, 9, 4)}).select(*KEYS, "q")


@check("W-04", query(M15, f"SELECT {K}, {lag('close', BY_DAY)} AS a, {lag('close', BY_DAY, -2)} AS b, close - {lag('close', BY_DAY)} AS c, close / nullif({lag('close', BY_DAY)}, 0) - 1 AS e FROM bars", "a b c e"))
def _(d):
    b, r = rows_of(d)
    c = F.col("close")
    return b.select(*KEYS, r.shift(c).alias("a"), r.shift(c, -2).alias("b"), r.diff(c).alias("c"), r.pct_change(c).alias("e"))


@check("W-05", query(M15, f"SELECT {K}, avg(close) OVER (PARTITION BY {BY_DAY}) AS m, stddev_samp(close) OVER (PARTITION BY {BY_DAY}) AS s FROM bars", "m s"))
def _(d):
    b, r = rows_of(d)
    enough = F.count("close").over(r.whole) >= 2
    return b.select(*KEYS, F.avg("close").over(r.whole).alias("m"), F.when(enough, F.stddev_samp("close").over(r.whole)).alias("s"))


@check("W-06", query(M15, f"""SELECT {K}, CASE WHEN count(*) OVER t = 1 THEN 0.0 ELSE (rank() OVER (PARTITION BY ts ORDER BY volume) + (count(*) OVER (PARTITION BY ts, volume) - 1) / 2.0 - 1) / (count(*) OVER t - 1) END AS r
  FROM bars WINDOW t AS (PARTITION BY ts)""", "r"))
def _(d):
    return d.bars().select(*KEYS, scaled_rank(F.col("volume"), ["ts"]).alias("r"))


@check("W-07", query(M15, f"SELECT {K}, rank() OVER (PARTITION BY {BY_DAY} ORDER BY volume) + (count(*) OVER (PARTITION BY {BY_DAY}, volume) - 1) / 2.0 AS r FROM bars", "r"))
def _(d):
    return d.bars().select(*KEYS, average_rank(F.col("volume"), ["instrument", "anchor_tf", "dt"]).alias("r"))


@check("W-08", query(M15, f"SELECT {K}, row_number() OVER (PARTITION BY {BY_DAY} ORDER BY ts) - 1 AS i FROM bars"))
def _(d):
    b, r = rows_of(d)
    return b.select(*KEYS, r.row().cast("long").alias("i"))


@check("W-09", query(M15, f"SELECT {K}, {ewm('close', 0.2, BY_DAY)} AS y FROM bars", "y"))
def _(d):
    # Blocks of 8 rows, so that a day spans several.
    return exponential_means(d.bars(), {"y": (F.col("close"), 0.2)}, ("instrument", "anchor_tf", "dt")).select(*KEYS, "y")


@check("W-10", query(M15, f"SELECT {K}, last_value(CASE WHEN volume > 4 THEN close END IGNORE NULLS) OVER (PARTITION BY {BY_DAY} ORDER BY ts) AS y FROM bars", "y"))
def _(d):
    b, r = rows_of(d)
    return b.select(*KEYS, r.forward_fill(F.when(F.col("volume") > 4, F.col("close"))).alias("y"))


@check("W-11", query(M15, f"SELECT {K}, tr, {mean('tr', 14, BY_DAY)} AS atr FROM (SELECT *, {true_range(BY_DAY)} AS tr FROM bars)", "tr atr"))
def _(d):
    b, r = rows_of(d)
    return b.withColumn("tr", r.true_range()).select(*KEYS, "tr", r.mean(F.col("tr"), 14).alias("atr"))


@check("W-12", query(M15, f"""SELECT {K}, CASE WHEN up THEN sum(CAST(up AS INT)) OVER (PARTITION BY {BY_DAY}, g ORDER BY ts) ELSE 0 END::BIGINT AS run
  FROM (SELECT *, sum(CASE WHEN up THEN 0 ELSE 1 END) OVER (PARTITION BY {BY_DAY} ORDER BY ts) AS g FROM (SELECT *, close > open AS up FROM bars))"""))
def _(d):
    b, r = rows_of(d)
    up = F.col("close") > F.col("open")
    b = b.withColumn("g", F.sum(F.when(up, 0).otherwise(1)).over(r.so_far))
    island = Rows(["instrument", "anchor_tf", "dt", "g"])
    return b.select(*KEYS, F.when(up, F.sum(up.cast("int")).over(island.so_far)).otherwise(0).cast("long").alias("run"))


@check("W-13", query(M15, f"SELECT {K}, i - max(CASE WHEN volume > 4 THEN i END) OVER (PARTITION BY {BY_DAY} ORDER BY ts) AS age FROM (SELECT *, row_number() OVER (PARTITION BY {BY_DAY} ORDER BY ts) AS i FROM bars)"))
def _(d):
    b, r = rows_of(d)
    b = b.withColumn("i", r.row())
    last = F.last(F.when(F.col("volume") > 4, F.col("i")), ignorenulls=True).over(r.so_far)
    return b.select(*KEYS, (F.col("i") - last).cast("long").alias("age"))


@check("W-14", query(M15, f"SELECT {K}, high = max(high) OVER (PARTITION BY {BY_DAY} ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS pivot FROM bars"))
def _(d):
    b, r = rows_of(d)
    return b.select(*KEYS, (F.col("high") == F.max("high").over(r.around(3, 3))).alias("pivot"))


@check("W-15", query(M15, f"""SELECT {K}, max(high) OVER n AS top, CASE WHEN {lag('close', BY_DAY, -1)} > high THEN 1 WHEN {lag('close', BY_DAY, -2)} > high THEN 2 WHEN {lag('close', BY_DAY, -3)} > high THEN 3 END AS touch
  FROM bars WINDOW n AS (PARTITION BY {BY_DAY} ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)""", "top"))
def _(d):
    b, r = rows_of(d)
    touch = F.lit(None).cast("int")
    for k in (3, 2, 1):
        touch = F.when(r.shift(F.col("close"), -k) > F.col("high"), k).otherwise(touch)
    return b.select(*KEYS, F.max("high").over(r.next(3)).alias("top"), touch.alias("touch"))


# --- ordering -----------------------------------------------------------------------------------------


@check("K-01", query(M15, f"SELECT {K}, close, row_number() OVER (ORDER BY instrument, ts) AS place FROM bars", "close"))
def _(d):
    from barloom.operators.blocks import number_all

    return number_all(d.bars(), ["instrument", "ts"], "n", cut_lineage).select(*KEYS, "close", (F.col("n") + 1).alias("place"))


@check("K-02", query(TOP_SQL, "SELECT a AS instrument, ts, b AS peer, rho AS corr, k AS place FROM ranked WHERE k <= 5", "corr"))
def _(d):
    from barloom.operators.peers import top_peers

    cfg = {"window": 50, "min_periods": 12, "topk": 5, "min_abs": 0.4}
    out = top_peers(market(d), cfg, PANEL, tiles=2)
    ranked = out.select("instrument", "ts", F.posexplode(F.arrays_zip("peers", "corrs")).alias("k", "p"))
    return ranked.select("instrument", "ts", F.col("p.peers").alias("peer"), F.col("p.corrs").alias("corr"), (F.col("k") + 1).cast("long").alias("place"))


@check("K-03", query(TOP_SQL.replace("WHERE abs(rho) >= 0.4)", "WHERE rho IS NOT NULL)"), "SELECT a AS instrument, ts, b AS peer, rho AS corr FROM ranked WHERE k = 1", "corr"))
def _(d):
    from barloom.operators.peers import primary_peer

    out = primary_peer(market(d), {"window": 50, "min_periods": 12, "min_corr": 0.0}, PANEL, tiles=2)
    return out.where("peer is not null").select("instrument", "ts", "peer", "corr")


@check("K-04", f"SELECT count(*) AS n, bool_and(epoch_us(stamp) % 300000000 <> 0) AS all_bad FROM (SELECT stamp FROM {LINES} WHERE epoch_us(stamp) % 300000000 <> 0 LIMIT 50)")
def _(d):
    from barloom.functions.timegrid import micros

    # Which rows are sampled is free; that there are at most fifty and all are bad is not.
    bad = off_grid(lines(d), F.lit("M5"), "stamp").limit(50)
    return bad.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.pmod(micros(F.col("stamp")), F.lit(300_000_000)) != 0).alias("all_bad"))


@check("K-05", query(TICKS, "SELECT instrument, CAST(ts AS DATE) AS dt, first(price ORDER BY ts, event_id) AS head, last(price ORDER BY ts, event_id) AS tail FROM ticks GROUP BY 1, 2", "head tail"))
def _(d):
    from barloom.operators.bars import order_key

    t = d.ticks().withColumn("o", order_key(F.col("ts"), F.col("event_id")))
    return t.groupBy("instrument", F.to_date("ts").alias("dt")).agg(F.min_by("price", "o").alias("head"), F.max_by("price", "o").alias("tail"))


# --- aggregates ------------------------------------------------------------------------------------------


@check("A-01", query(TICKS, "SELECT instrument, 'M15' AS anchor_tf, time_bucket(INTERVAL 15 MINUTE, ts) AS ts, sum(size) AS total_size, sum(size * CASE WHEN side = 'buy' THEN 1 ELSE -1 END) AS delta_size, count(*) AS ticks FROM ticks GROUP BY ALL", "total_size delta_size"))
def _(d):
    return flow_sums(side_signed(d.ticks()), "M15")


@check("A-02", query(M15, f"SELECT ts, avg(r) AS market_ret FROM (SELECT *, close / nullif({lag('close', BY_DAY)}, 0) - 1 AS r FROM bars) GROUP BY ts", "market_ret"))
def _(d):
    return return_zscores(d.bars()).groupBy("ts").agg(F.avg("stat_ts_return").alias("market_ret"))


@check("A-03", query(M15, "SELECT instrument, dt, max(high) AS hi, min(low) AS lo, (max(high) + min(low)) / 2 AS mid, max(high) - min(low) AS width FROM bars GROUP BY instrument, dt", "hi lo mid width"))
def _(d):
    z = day_range_zone(d.bars())
    return z.select("instrument", "dt", F.col("zmf_zone_hi").alias("hi"), F.col("zmf_zone_lo").alias("lo"), F.col("zmf_zone_mid").alias("mid"), F.col("zmf_zone_width").alias("width")).distinct()


@check("A-04", query(TICKS, "SELECT instrument, time_bucket(INTERVAL 1 HOUR, ts) AS h, first(CASE WHEN size > 2 THEN price END ORDER BY event_id) AS price, first(side ORDER BY event_id) AS side FROM ticks GROUP BY 1, 2", "price"))
def _(d):
    t = d.ticks().withColumns({"h": snap(F.col("ts"), "H1"), "price": F.when(F.col("size") > 2, F.col("price"))})
    return first_per_column(t, ["instrument", "h"], F.col("event_id"), ["price", "side"])


@check("A-05", query(f"{M15}, {CALENDAR}", "SELECT b.ts, CAST(max(impact) AS INTEGER) AS impact FROM (SELECT DISTINCT ts FROM bars) b JOIN calendar c ON b.ts >= c.blackout_start_ts AND b.ts < c.blackout_end_ts GROUP BY b.ts"))
def _(d):
    slots = cal.blackout_slots(d.calendar(), "M15").select("ts", F.col("macro_blackout_max_impact").alias("impact"))
    return d.bars().select("ts").distinct().join(slots, "ts")


EVALS = "'ict' AS paradigm_id, o_orderpriority AS principle_id, o_orderstatus AS candidate_id, '∅' AS experiment_id"


def scored(d):
    return d.table("orders").select(
        F.lit("snap1").alias("snapshot_id"), F.lit("run1").alias("run_id"), F.lit("backtest").alias("mode"),
        F.lit("ict").alias("paradigm_id"), F.col("o_orderpriority").alias("principle_id"), F.col("o_orderstatus").alias("candidate_id"),
        F.lit("∅").alias("experiment_id"), F.col("o_orderkey").cast("string").alias("trade_id"),
        (F.col("o_custkey") % 5).cast("string").alias("instrument"), F.when(F.col("o_custkey") % 2 == 0, "long").otherwise("short").alias("side"),
        F.to_date("o_orderdate").alias("dt"), (F.col("o_totalprice") / 100000).alias("critic_score_at_entry"),
        (F.col("o_custkey") % 3 == 0).alias("macro_is_blackout"), F.col("o_orderpriority").alias("vol_regime_entry"),
        (F.col("o_custkey") % 7).cast("string").alias("instrument_cluster_id"),
    )


@check("A-06", query("", f"SELECT 'snap1' AS snapshot_id, 'run1' AS run_id, 'backtest' AS mode, {EVALS}, count(*) AS n_trades, {rounded('avg(o_totalprice / 100000)')} AS avg_critic_score FROM orders GROUP BY o_orderpriority, o_orderstatus"))
def _(d):
    return dc.critic_summary(scored(d))


@check("A-07", f"SELECT {EVALS}, CAST(o_custkey % 5 AS VARCHAR) AS instrument, CASE WHEN o_custkey % 2 = 0 THEN 'long' ELSE 'short' END AS side, o_orderpriority AS vol_regime_entry, count(*) AS trade_count FROM orders GROUP BY o_orderpriority, o_orderstatus, o_custkey % 5, o_custkey % 2")
def _(d):
    return dc.context_counts(scored(d), extra=())


@check("A-08", f"SELECT {EVALS}, CAST(o_custkey % 7 AS VARCHAR) AS instrument_cluster_id, CAST(o_orderdate AS DATE) AS dt, count(*) AS trade_count FROM orders GROUP BY o_orderpriority, o_orderstatus, o_custkey % 7, CAST(o_orderdate AS DATE)")
def _(d):
    return dc.cluster_counts(scored(d))


STAGES = {"trade_paths": 1, "decisions_hypotheses": 1, "decisions_critic": 1, "decisions_pretrade": 3, "decisions_gatekeeper": 3, "decisions_portfolio": 4, "brackets": 1, "critic": 5}
LEVELS = ", ".join(f"count(*) FILTER (o_custkey % {n} = 0) AS {dc.REPORT_COUNTS[t]}" for t, n in STAGES.items())


def staged(d):
    base = scored(d).withColumn("c", F.col("trade_id"))
    keyed = base.join(d.table("orders").select(F.col("o_orderkey").cast("string").alias("trade_id"), "o_custkey"), "trade_id")
    keep = ("instrument", "trade_id", "dt", *EVALUATION)
    return {t: keyed.where(F.col("o_custkey") % n == 0).select(*keep) for t, n in STAGES.items()}


@check("A-09", f"SELECT {EVALS}, {LEVELS} FROM orders GROUP BY o_orderpriority, o_orderstatus")
def _(d):
    report = dc.run_report(staged(d), scored(d).select("dt"), CTX)
    return report.where("report_level = 'evaluation'").select(*EVALUATION, *dc.REPORT_COUNTS.values())


@check("A-10", f"""SELECT CASE WHEN grouping(o_orderstatus) = 1 THEN 'run_total' ELSE 'evaluation' END AS report_level, coalesce(o_orderpriority, '∅') AS principle_id, coalesce(o_orderstatus, '∅') AS candidate_id,
  (SELECT count(DISTINCT (o_orderpriority, o_orderstatus)) FROM orders) AS n_eval_groups, (SELECT count(*) FROM orders) AS n_windows, {LEVELS}
  FROM orders GROUP BY GROUPING SETS ((o_orderpriority, o_orderstatus), ())""")
def _(d):
    report = dc.run_report(staged(d), scored(d).select("dt"), CTX)
    return report.select("report_level", "principle_id", "candidate_id", "n_eval_groups", "n_windows", *dc.REPORT_COUNTS.values())


@check("A-11", f"SELECT {EVALS}, count(*) AS n_before, count(*) FILTER (o_custkey % 3 = 0) AS n_dropped, count(*) FILTER (o_custkey % 3 <> 0) AS n_after FROM orders GROUP BY o_orderpriority, o_orderstatus")
def _(d):
    return dc.drop_counts(scored(d))


@check("A-12", query(f"{M15}, {CALENDAR}", """SELECT count(*) AS bars, count(*) FILTER (hit) AS blackout_bars, count(*) FILTER (hit) * 100.0 / count(*) AS blackout_pct
  FROM (SELECT EXISTS (SELECT 1 FROM calendar c WHERE b.ts >= c.blackout_start_ts AND b.ts < c.blackout_end_ts) AS hit FROM bars b)""", "blackout_pct"))
def _(d):
    grid = d.bars().select(*KEYS)
    return cal.blackout_coverage(cal.blackout_flags(grid, d.calendar(), ["M15"]))


@check("A-13", "SELECT DISTINCT event_type, user_id FROM events")
def _(d):
    return d.table("events").select("event_type", "user_id").distinct()


@check("A-14", query(M15, "SELECT count(*) AS rows, count(DISTINCT instrument) AS instruments, count(DISTINCT anchor_tf) AS tfs, count(DISTINCT ts) AS stamps FROM bars"))
def _(d):
    return d.bars().agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("instrument").alias("instruments"), F.count_distinct("anchor_tf").alias("tfs"), F.count_distinct("ts").alias("stamps"))


@check("A-15", query(f"{M15}, names AS (SELECT instrument, dense_rank() OVER (ORDER BY instrument) AS place FROM (SELECT DISTINCT instrument FROM bars))",
  f"""SELECT ts, string_agg(place || '=' || CAST(close AS VARCHAR), ';' ORDER BY place) AS wide, count(*) AS n
  FROM (SELECT ts, place, CAST(floor(max(close) * 1e6 + 0.50013) AS BIGINT) AS close FROM bars JOIN names USING (instrument) GROUP BY ts, place) GROUP BY ts"""))
def _(d):
    """Wide by all instruments there are; shown as one text, since the columns depend on the data."""
    bars = d.bars()
    names = sorted(r[0] for r in bars.select("instrument").distinct().collect())
    wide = bars.groupBy("ts").pivot("instrument", names).agg(F.max("close"))
    cells = [F.when(F.col(f"`{n}`").isNotNull(), F.concat(F.lit(f"{k}="), F.floor(F.col(f"`{n}`") * 1e6 + 0.50013).cast("string"))) for k, n in enumerate(names, 1)]
    return wide.select("ts", F.concat_ws(";", *cells).alias("wide"), sum(F.col(f"`{n}`").isNotNull().cast("long") for n in names).alias("n"))
