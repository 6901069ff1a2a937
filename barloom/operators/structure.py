"""Market structure: displacement, gaps, order blocks, equal levels, sweeps,
dealing range, swings, breaks and the event stream.

All detectors are column expressions over one ordered series. Two rules carry
real state and run as scans over the array of a group's rows: accepted swing
points and the accumulation phases. Outputs marked look-ahead use later bars.

The input is bars; ``tick_size`` is a column (per-instrument lookup) or cfg.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expr import clamp01, safe_div, settings
from ..functions.fold import let, scanned, updated
from ..functions.rolling import DAY, Rows

EPS = 1e-9

STRUCTURE = {
    "tick_size": 0.0001,
    "atr_window": 14,
    "atr_z_window": 50,
    "atr_z_min_periods": 10,
    "displacement_range_atr_min": 1.2,
    "displacement_body_ratio_min": 0.6,
    "displacement_close_loc_min": 0.7,
    "displacement_followthrough_bars": 2,
    "fvg_min_gap_ticks": 8.0,
    "fvg_max_fill_bars": 6,
    "fvg_partial_fill_cut": 0.5,
    "fvg_origin_impulse_range_atr_min": 1.0,
    "fvg_origin_body_ratio_min": 0.55,
    "fvg_max_origin_age_bars": 200,
    "fvg_min_reaction_atr": 0.3,
    "ob_lookback_bars": 50,
    "ob_height_ticks_min": 8.0,
    "ob_mitigation_bars_max": 200,
    "ob_min_impulse_range_atr": 1.0,
    "ob_min_body_ratio": 0.55,
    "ob_max_origin_age_bars": 300,
    "ob_min_reaction_atr": 0.3,
    "ob_breaker_confirm_bars": 2,
    "eq_lookback_bars": 50,
    "eq_level_ticks_max": 4.0,
    "eq_min_hits": 2,
    "eq_min_sep_bars": 3,
    "sweep_depth_ticks_min": 6.0,
    "sweep_reclaim_bars_max": 3,
    "sweep_requires_displacement": 0,
    "sweep_displacement_range_atr_min": 1.0,
    "liq_grab_wick_ratio_cut": 0.6,
    "liq_grab_body_ratio_max": 0.3,
    "liq_grab_followthrough_bars": 3,
    "dealing_range_lookback_bars": 100,
    "pd_index_bins": 10,
    "pd_location_discount_max_frac": 0.3,
    "pd_location_premium_min_frac": 0.7,
    "dealing_range_min_height_atr": 1.0,
    "mms_compression_window_bars": 50,
    "mms_compression_atr_z_max": 0.5,
    "mms_manipulation_requires_sweep": 1,
    "mms_distribution_range_atr_min": 1.5,
    "mms_phase_persist_bars_min": 3,
    "swing_lookback_bars": 3,
    "swing_strength_min_bars": 5,
    "swing_trend_dir_window": 6,
    "bos_window_bars_min": 2,
    "bos_window_bars_max": 20,
    "bos_min_distance_ticks": 4.0,
    "choch_z_cut": 1.0,
    "choch_min_distance_ticks": 4.0,
}

def _column(name: str):
    return lambda: F.col(name)


# Functions, since a column needs a running session.
px_open, px_high, px_low, px_close = (_column(n) for n in ("open", "high", "low", "close"))
px_atr, row_no, tick_px = _column("atr_anchor"), _column("_row"), _column("_tick")


def with_basics(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """atr_anchor, atr_z, the row number and the tick size."""
    c = settings(STRUCTURE, cfg)
    rows = Rows(by)
    tick = F.coalesce(F.col("tick_size"), F.lit(c["tick_size"])) if "tick_size" in bars.columns else F.lit(c["tick_size"])
    out = bars.withColumns({"_tr": F.coalesce(rows.true_range(), F.lit(0.0)), "_row": rows.row(), "_tick": tick})
    out = out.withColumn("atr_anchor", rows.mean(F.col("_tr"), c["atr_window"], 1))
    w, m = c["atr_z_window"], c["atr_z_min_periods"]
    return out.withColumn("atr_z", safe_div(px_atr() - rows.mean(px_atr(), w, m), rows.std(px_atr(), w, m))).drop("_tr")


def _over_range(x: Column) -> Column:
    return x / F.greatest(px_high() - px_low(), F.lit(EPS))


def displacement(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """displacement_*: wide bars closing at the far end; quality looks ahead."""
    c = settings(STRUCTURE, cfg)
    rows = Rows(by)
    direction = F.when(px_close() > px_open(), "up").when(px_close() < px_open(), "down").otherwise("none")
    out = bars.withColumns(
        {
            "displacement_dir": direction,
            "displacement_range_atr": F.when(px_atr() > EPS, (px_high() - px_low()) / px_atr()).otherwise(0.0),
            "displacement_body_ratio": _over_range(F.abs(px_close() - px_open())),
            "displacement_close_loc": _over_range(px_close() - px_low()),
        }
    )
    ratio, body, loc = (F.col(f"displacement_{n}") for n in ("range_atr", "body_ratio", "close_loc"))
    side = F.col("displacement_dir")
    min_ratio, min_body, min_loc = (
        c["displacement_range_atr_min"],
        c["displacement_body_ratio_min"],
        c["displacement_close_loc_min"],
    )
    at_end = ((side == "up") & (loc >= min_loc)) | ((side == "down") & (1.0 - loc >= min_loc))
    flag = (ratio >= min_ratio) & (body >= min_body) & at_end
    reach = F.when(side == "up", loc).otherwise(1.0 - loc)
    base = clamp01(
        (ratio / max(min_ratio, EPS) + body / max(min_body, EPS) + reach / max(min_loc, EPS)) / 3.0
    )
    ahead = max(0, c["displacement_followthrough_bars"])
    if ahead:
        after = rows.next(ahead)
        follow = F.when(side == "up", F.max("high").over(after) - px_high()).when(side == "down", px_low() - F.min("low").over(after))
        held = F.coalesce(follow >= 0.25 * px_atr(), F.lit(False))
        quality = F.when(~flag, base).when(px_atr() <= EPS, 0.0).when(held, base).otherwise(base * 0.25)
    else:
        quality = base
    return out.withColumns({"displacement_flag": flag, "displacement_quality": quality})


def fair_value_gap(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """fvg_* of the bar that completes a three-bar gap."""
    c = settings(STRUCTURE, cfg)
    rows = Rows(by)
    high2, low2 = rows.shift(px_high(), 2), rows.shift(px_low(), 2)
    bull, bear = px_low() > high2, px_high() < low2
    out = bars.withColumns(
        {
            "_bull": F.coalesce(bull, F.lit(False)),
            "_lower": F.when(bull, high2).when(bear, px_high()),
            "_upper": F.when(bull, px_low()).when(bear, low2),
            "_impulse": F.when(rows.shift(px_atr()) > EPS, rows.shift(px_high() - px_low()) / rows.shift(px_atr())).otherwise(0.0),
            "_body": rows.shift(_over_range(F.abs(px_close() - px_open()))),
        }
    )
    gap = F.col("_upper") - F.col("_lower")
    ticks = F.when(tick_px() > EPS, gap / tick_px()).otherwise(0.0)
    valid = F.coalesce(
        (gap > 0)
        & (ticks >= c["fvg_min_gap_ticks"])
        & (F.col("_impulse") >= c["fvg_origin_impulse_range_atr_min"])
        & (F.col("_body") >= c["fvg_origin_body_ratio_min"]),
        F.lit(False),
    )
    out = out.withColumn("_gap", valid)
    is_gap = F.col("_gap")
    return out.withColumns(
        {
            "fvg_direction": F.when(is_gap, F.when(F.col("_bull"), "bull").otherwise("bear")).otherwise("none"),
            "fvg_gap_ticks": F.when(is_gap, ticks).otherwise(0.0),
            "fvg_upper": F.when(is_gap, F.col("_upper")),
            "fvg_lower": F.when(is_gap, F.col("_lower")),
            "fvg_mid": F.when(is_gap, (F.col("_upper") + F.col("_lower")) / 2.0),
            "fvg_origin_tf": F.col("anchor_tf"),
            "fvg_origin_ts": F.when(is_gap, F.col("ts")),
            "fvg_age_bars": F.when(is_gap, 0),
            "fvg_origin_impulse_atr": F.when(is_gap, F.col("_impulse")),
            "fvg_origin_body_ratio": F.when(is_gap, F.col("_body")),
        }
    ).drop("_bull", "_lower", "_upper", "_impulse", "_body", "_gap")


def _bars_ahead(bars: DataFrame, c: Mapping, by: Sequence[str], more: Mapping[str, Column] | None = None) -> DataFrame:
    """by, _j, _h, _l, _a, the extremes of each bar and the follow-through bars after it, and more columns."""
    here = Rows(by).around(0, max(0, c["displacement_followthrough_bars"]))
    shown = {"_j": row_no(), "_h": px_high(), "_l": px_low(), "_a": px_atr(), "_max_next": F.max("high").over(here), "_min_next": F.min("low").over(here)}
    return bars.select(*by, *[x.alias(name) for name, x in {**shown, **(more or {})}.items()])


#: Bars of a series packed into one row.
PACK = 64


def _later_cells(origin: DataFrame, row: str, later: DataFrame, by: Sequence[str], reach: int, may: Column) -> DataFrame:
    """Origin rows with the packs of bars among the ``reach`` after them that may matter.

    later: by, _j and what else a bar shows; a pack has the bars of PACK row numbers in order, _bars, and their
    extremes _pack_high, _pack_low, _pack_run_low, _pack_run_high. An origin meets a few packs, never its single bars;
    ``may`` is decided on the extremes.
    """
    bars = [c for c in later.columns if c not in by]
    packs = later.groupBy(*by, F.floor(F.col("_j") / PACK).alias("_pack")).agg(
        F.sort_array(F.collect_list(F.struct(*bars))).alias("_bars"),
        F.max("_h").alias("_pack_high"),
        F.min("_l").alias("_pack_low"),
        *([F.min("_run_max").alias("_pack_run_low"), F.max("_run_min").alias("_pack_run_high")] if "_run_max" in bars else []),
    )
    span = F.sequence(F.floor((F.col(row) + 1) / PACK), F.floor((F.col(row) + reach) / PACK))
    return origin.withColumn("_pack", F.explode(span)).join(packs, [*by, "_pack"]).where(may).drop("_pack")


def _first(bars: Column) -> Column:
    return F.get(bars, F.lit(0))


def gap_fills(gaps: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """fvg fill state of every bar (look-ahead up to the origin age)."""
    measured = gaps.join(fill_measures(gaps, cfg, by), [*by, "_row"], "left")
    return label_fills(measured, cfg, by)


def fill_measures(gaps: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """Largest fill, first touch and reaction per gap, keyed by the gap's row; gaps that nothing reaches have no row."""
    c = settings(STRUCTURE, cfg)
    by = list(by)
    later = _bars_ahead(gaps, c, by)
    origin = gaps.where(F.col("fvg_direction") != "none").select(
        *by, "_row", "fvg_direction", "fvg_upper", "fvg_lower"
    )
    reach = c["fvg_max_origin_age_bars"]
    upper, lower = F.col("fvg_upper"), F.col("fvg_lower")
    bull = F.col("fvg_direction") == "bull"
    met = _later_cells(origin, "_row", later, by, reach, (F.col("_pack_low") < upper) & (F.col("_pack_high") > lower))

    def part(b: Column) -> Column:
        return F.greatest(F.lit(0.0), F.least(b["_h"], upper) - F.greatest(b["_l"], lower)) / (upper - lower)

    inside = F.filter("_bars", lambda b: (b["_j"] > row_no()) & (b["_j"] <= row_no() + reach) & (part(b) > 0))
    met = met.withColumn("_bars", inside).where(F.size("_bars") > 0)
    first = _first(F.col("_bars"))
    touch = F.when(bull, F.least(first["_h"], upper)).otherwise(F.greatest(first["_l"], lower))
    reaction = F.when(bull, first["_max_next"] - touch).otherwise(touch - first["_min_next"])
    reacted = (first["_a"] > EPS) & (reaction >= c["fvg_min_reaction_atr"] * first["_a"])
    return met.groupBy(*by, "_row").agg(
        F.max(F.array_max(F.transform("_bars", part))).alias("_fill"),
        F.min(first["_j"]).alias("_touch"),
        F.min_by(reacted.cast("int"), first["_j"]).alias("_reacted"),
    )


def label_fills(measured: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """fvg_fill_* and fvg_quality from the measures on each bar."""
    c = settings(STRUCTURE, cfg)
    is_gap = F.col("fvg_direction") != "none"
    fill = F.coalesce(F.least(F.greatest(F.col("_fill"), F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    duration = F.col("_touch") - row_no()
    return measured.withColumns(
        {
            "fvg_fill_frac": fill,
            "fvg_fill_state": F.when(~is_gap, "none")
            .when(fill >= 1.0, "filled")
            .when((fill > 0) & (fill >= c["fvg_partial_fill_cut"]), "partially_filled")
            .otherwise("unfilled"),
            "fvg_fill_duration_bars": duration.cast("int"),
            "fvg_was_mitigated_flag": duration.isNotNull(),
            "fvg_quality": F.when(~is_gap, 0.0)
            .when(duration.isNull(), 1.0)
            .when((duration <= c["fvg_max_fill_bars"]) & (F.col("_reacted") == 1), 1.0)
            .otherwise(0.0),
        }
    ).drop("_fill", "_touch", "_reacted")


def order_block(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """ob_* on each bar: the last opposite bar before the latest displacement.

    The displacement row carries its opposite bar along, so one running ``last``
    over the lookback finds both.
    """
    c = settings(STRUCTURE, cfg)
    rows = Rows(by)
    block = F.struct(row_no().alias("row"), F.col("ts").alias("ts"), px_high().alias("high"), px_low().alias("low"))
    out = bars.withColumns(
        {
            "_last_down": F.last(F.when(px_close() < px_open(), block), ignorenulls=True).over(rows.before),
            "_last_up": F.last(F.when(px_close() > px_open(), block), ignorenulls=True).over(rows.before),
        }
    )
    up = F.col("displacement_dir") == "up"
    found = F.struct(
        up.alias("up"),
        F.col("displacement_range_atr").alias("ratio"),
        F.col("displacement_body_ratio").alias("body"),
        F.when(up, F.col("_last_down")).otherwise(F.col("_last_up")).alias("block"),
    )
    out = out.withColumn(
        "_disp",
        F.last(F.when(F.col("displacement_flag"), found), ignorenulls=True).over(rows.last(c["ob_lookback_bars"] + 1)),
    )
    origin = F.col("_disp.block")
    height = F.when(tick_px() > EPS, (origin["high"] - origin["low"]) / tick_px()).otherwise(0.0)
    age = row_no() - origin["row"]
    valid = F.coalesce(
        (F.col("_disp.ratio") >= c["ob_min_impulse_range_atr"])
        & (F.col("_disp.body") >= c["ob_min_body_ratio"])
        & (height >= c["ob_height_ticks_min"])
        & (age <= c["ob_max_origin_age_bars"]),
        F.lit(False),
    )
    out = out.withColumn("_ob", valid)
    is_ob = F.col("_ob")
    mid = (origin["high"] + origin["low"]) / 2.0
    return out.withColumns(
        {
            "ob_type": F.when(is_ob, F.when(F.col("_disp.up"), "bullish").otherwise("bearish")).otherwise("none"),
            "ob_high": F.when(is_ob, origin["high"]),
            "ob_low": F.when(is_ob, origin["low"]),
            "ob_mid": F.when(is_ob, mid),
            "ob_height_ticks": F.when(is_ob, height),
            "ob_origin_ts": F.when(is_ob, origin["ts"]),
            "ob_age_bars": F.when(is_ob, age.cast("int")),
            "ob_distance_ticks": F.when(is_ob, F.when(tick_px() > EPS, F.abs(px_close() - mid) / tick_px()).otherwise(0.0)),
            "_ob_row": F.when(is_ob, origin["row"]),
        }
    ).drop("_last_down", "_last_up", "_disp", "_ob")


def block_history(blocks: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """Freshness, reaction quality and breaker of the order block named on each bar."""
    measured = blocks.join(block_measures(blocks, cfg, by), [*by, "_ob_row", "ob_type"], "left")
    return label_blocks(measured, cfg, by)


def block_measures(blocks: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """First touch, reaction and first confirmed break, once per distinct block.

    The reaction looks ahead.
    """
    c = settings(STRUCTURE, cfg)
    by = list(by)
    confirm = c["ob_breaker_confirm_bars"]
    origin = blocks.where(F.col("_ob_row").isNotNull()).select(*by, "_ob_row", "ob_type", "ob_high", "ob_low").distinct()
    run = Rows(by).last(max(1, confirm))
    whole = F.count("close").over(run) == max(1, confirm)
    runs = {"_run_max": F.when(whole, F.max("close").over(run)), "_run_min": F.when(whole, F.min("close").over(run)), "_run_ts": F.first("ts").over(run)}
    later = _bars_ahead(blocks, c, by, runs)
    reach = c["ob_max_origin_age_bars"]
    bull = F.col("ob_type") == "bullish"
    top, bottom, row = F.col("ob_high"), F.col("ob_low"), F.col("_ob_row")
    near = (F.col("_pack_low") <= top) & (F.col("_pack_high") >= bottom)
    beyond = F.when(bull, F.col("_pack_run_low") < bottom).otherwise(F.col("_pack_run_high") > top)
    met = _later_cells(origin, "_ob_row", later, by, reach, F.coalesce(near, F.lit(False)) | F.coalesce(beyond, F.lit(False)))
    inside = F.filter("_bars", lambda b: (b["_j"] > row) & (b["_j"] <= row + reach))
    met = met.withColumn("_bars", inside)
    met = met.withColumns(
        {
            "_seen": _first(F.filter("_bars", lambda b: (b["_l"] <= top) & (b["_h"] >= bottom))),
            # the whole run of closes comes after the block
            "_broken": _first(
                F.filter(
                    "_bars",
                    lambda b: (b["_j"] >= row + max(1, confirm)) & F.when(bull, b["_run_max"] < bottom).otherwise(b["_run_min"] > top),
                )
            ),
        }
    )
    seen = F.col("_seen")
    price = F.when(bull, F.least(seen["_h"], top)).otherwise(F.greatest(seen["_l"], bottom))
    reaction = F.when(bull, seen["_max_next"] - price).otherwise(price - seen["_min_next"])
    reacted = (seen["_a"] > EPS) & (reaction >= c["ob_min_reaction_atr"] * seen["_a"])
    return met.groupBy(*by, "_ob_row", "ob_type").agg(
        F.min(seen["_j"]).alias("_ob_touch"),
        F.min_by(reacted.cast("int"), seen["_j"]).alias("_ob_reacted"),
        F.min(F.col("_broken")["_j"]).alias("_ob_break"),
        F.min_by(F.col("_broken")["_run_ts"], F.col("_broken")["_j"]).alias("_ob_break_ts"),
    )


def label_blocks(measured: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """ob_freshness_bucket, ob_quality and ob_breaker_*: the measures against the bar's own row."""
    c = settings(STRUCTURE, cfg)
    confirm = c["ob_breaker_confirm_bars"]
    is_ob = F.col("ob_type") != "none"
    mitigated = F.coalesce(F.col("_ob_touch") <= row_no(), F.lit(False))
    broken = is_ob & F.coalesce(F.col("_ob_break") <= row_no(), F.lit(False)) & F.lit(confirm > 0)
    return measured.withColumns(
        {
            "ob_freshness_bucket": F.when(~is_ob, "none")
            .when(mitigated, "mitigated")
            .when(F.col("ob_age_bars") > c["ob_mitigation_bars_max"], "old")
            .otherwise("fresh"),
            "ob_quality": F.when(~is_ob, 0.0).when(mitigated & (F.col("_ob_reacted") == 0), 0.0).otherwise(1.0),
            "ob_breaker_flag": broken,
            "ob_breaker_dir": F.when(broken, F.when(F.col("ob_type") == "bullish", "down").otherwise("up")),
            "ob_breaker_ts": F.when(broken, F.col("_ob_break_ts")),
        }
    ).drop("_ob_touch", "_ob_reacted", "_ob_break", "_ob_break_ts")


def _greedy_clusters(hits: Column, c: Mapping) -> Column:
    """Hits in bar order to clusters (total, n, first, last): a hit joins the latest
    cluster when near its mean (and far enough from its last bar), else opens one."""
    blank = "array<struct<total:double,n:int,first:bigint,last:bigint>>"

    def step(acc, hit):
        last = F.try_element_at(acc, F.lit(-1))
        single = F.struct(
            hit["level"].alias("total"), F.lit(1).alias("n"), hit["row"].alias("first"), hit["row"].alias("last")
        )
        near = F.abs(hit["level"] - last["total"] / last["n"]) <= c["eq_level_ticks_max"] * hit["tick"]
        grown = F.struct(
            (last["total"] + hit["level"]).alias("total"),
            (last["n"] + 1).alias("n"),
            last["first"].alias("first"),
            hit["row"].alias("last"),
        )
        head = F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
        return (
            F.when((F.size(acc) == 0) | ~near, F.concat(acc, F.array(single)))
            .when(hit["row"] - last["last"] >= c["eq_min_sep_bars"], F.concat(head, F.array(grown)))
            .otherwise(acc)
        )

    return F.aggregate(hits, F.array().cast(blank), step)


def _best_cluster(clusters: Column, min_hits: int) -> Column:
    """Most hits, then the latest last bar."""
    ranked = F.transform(
        F.filter(clusters, lambda k: k["n"] >= min_hits),
        lambda k: F.struct(
            k["n"].alias("n"), k["last"].alias("last"), (-k["first"]).alias("neg_first"), (k["total"] / k["n"]).alias("level")
        ),
    )
    return F.array_max(ranked)


def equal_levels(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """eqh_* / eql_*: clusters of nearly equal local extremes in the lookback."""
    c = settings(STRUCTURE, cfg)
    rows = Rows(by)
    n = c["eq_lookback_bars"]

    def hit(price: Column, extreme: Column) -> Column:
        return F.when(extreme, F.struct(row_no().alias("row"), price.alias("level"), tick_px().alias("tick")))

    out = bars.withColumns(
        {
            "_hit_high": hit(px_high(), (px_high() >= rows.shift(px_high())) & (px_high() >= rows.shift(px_high(), -1))),
            "_hit_low": hit(px_low(), (px_low() <= rows.shift(px_low())) & (px_low() <= rows.shift(px_low(), -1))),
        }
    )
    # An extreme needs both neighbours inside the window, which ends at the bar itself.
    frame = rows.spec.rowsBetween(-max(1, n - 2), -1)
    out = out.withColumns(
        {f"_hits_{s}": F.collect_list(f"_hit_{s}").over(frame) for s in ("high", "low")}
    ).drop("_hit_high", "_hit_low")
    out = out.withColumns(
        {f"_best_{s}": _best_cluster(_greedy_clusters(F.col(f"_hits_{s}"), c), c["eq_min_hits"]) for s in ("high", "low")}
    )
    top, bottom = F.col("_best_high"), F.col("_best_low")

    def span(k: Column) -> Column:
        return k["last"] + k["neg_first"]

    low_wins = bottom.isNotNull() & (top.isNull() | (bottom["n"] > top["n"]))
    return out.withColumns(
        {
            "eqh_flag": top.isNotNull(),
            "eql_flag": bottom.isNotNull(),
            "eqh_level_px": top["level"],
            "eql_level_px": bottom["level"],
            "eq_level_hit_count": F.when(low_wins, bottom["n"]).otherwise(top["n"]).cast("int"),
            "eq_level_span_bars": F.when(low_wins, span(bottom)).otherwise(span(top)).cast("int"),
        }
    ).drop("_hits_high", "_hits_low", "_best_high", "_best_low")


def liquidity_sweep(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """liq_sweep_*: a level pierced and reclaimed within a few bars (look-ahead)."""
    c = settings(STRUCTURE, cfg)
    rows = Rows(by)
    n, ahead = c["sweep_reclaim_bars_max"], c["liq_grab_followthrough_bars"]
    closes = [rows.shift(px_close(), -k) for k in range(1, n + 1)]
    need_disp = c["sweep_requires_displacement"] == 1
    wide = []
    if need_disp:
        ratio = F.col("displacement_range_atr")
        wide = [rows.shift(ratio, -k) >= c["sweep_displacement_range_atr_min"] for k in range(1, n + ahead + 1)]
    scratch = {f"_c{k}": x for k, x in enumerate(closes, 1)}
    scratch |= {f"_w{k}": F.coalesce(x, F.lit(False)) for k, x in enumerate(wide, 1)}
    out = bars.withColumns(scratch)

    def first(cond) -> Column:
        chain = F.lit(None).cast("int")
        for k in range(n, 0, -1):
            chain = F.when(cond(F.col(f"_c{k}")), F.lit(k)).otherwise(chain)
        return chain

    high_px, low_px = F.col("eqh_level_px"), F.col("eql_level_px")
    depth_min = c["sweep_depth_ticks_min"] * tick_px()
    up_depth, down_depth = px_high() - high_px, low_px - px_low()
    out = out.withColumns(
        {
            "_up": F.when(up_depth >= depth_min, first(lambda x: x < high_px)),
            "_down": F.when(down_depth >= depth_min, first(lambda x: x > low_px)),
        }
    )
    up, down = F.col("_up").isNotNull(), F.col("_down").isNotNull()
    bars_taken = F.coalesce("_up", "_down")
    ticks = F.when(tick_px() > EPS, F.when(up, up_depth).when(down, down_depth) / tick_px()).otherwise(F.when(up | down, 0.0))
    base = clamp01(
        (F.least(F.lit(1.0), ticks / max(c["sweep_depth_ticks_min"], EPS)) + 1.0 - bars_taken / float(n + 1)) / 2.0
    )
    if need_disp:
        moved = F.lit(False)
        for k in range(1, n + 1):
            any_after = F.lit(False)
            for d in range(1, ahead + 1):
                any_after = any_after | F.col(f"_w{k + d}")
            moved = F.when(bars_taken == k, any_after).otherwise(moved)
        base = F.when(moved, base).otherwise(F.when(bars_taken.isNotNull(), 0.0))
    side = F.when(up, "eqh").when(down, "eql").otherwise("none")
    tag = (
        F.when(up, "sweep_eqh")
        .when(down, "sweep_eql")
        .when(F.col("eqh_flag") & F.col("eql_flag"), "pool_both")
        .when(F.col("eqh_flag"), "pool_eqh")
        .when(F.col("eql_flag"), "pool_eql")
        .otherwise("none")
    )
    return out.withColumns(
        {
            "liq_sweep_flag": up | down,
            "liq_sweep_side": side,
            "liq_sweep_level_px": F.when(up, high_px).when(down, low_px),
            "liq_sweep_depth_ticks": ticks,
            "liq_sweep_reclaim_bars": bars_taken,
            "liq_sweep_quality": F.coalesce(base, F.lit(0.0)),
            "ict_struct_liquidity_tag": tag,
        }
    ).drop("_up", "_down", *scratch)


def liquidity_grab(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """liq_grab_flag: long wicks, small body, and a later close the expected way (look-ahead)."""
    c = settings(STRUCTURE, cfg)
    after = Rows(by).next(max(1, c["liq_grab_followthrough_bars"]))
    wicks = (px_high() - F.greatest(px_open(), px_close())) + (F.least(px_open(), px_close()) - px_low())
    shape = (_over_range(wicks) >= c["liq_grab_wick_ratio_cut"]) & (
        _over_range(F.abs(px_close() - px_open())) <= c["liq_grab_body_ratio_max"]
    )
    side = F.col("liq_sweep_side")
    down = F.when(side == "eqh", True).when(side == "eql", False).otherwise(px_close() < px_open())
    follow = F.when(down, F.min("close").over(after) < px_close()).otherwise(F.max("close").over(after) > px_close())
    return bars.withColumn("liq_grab_flag", shape & F.coalesce(follow, F.lit(False)))


def _bin_index(location: Column, bins) -> Column:
    if isinstance(bins, int):
        if bins <= 0:
            return F.lit(None).cast("int")
        return F.least(F.greatest(F.floor(location * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    index = F.when(location == bins[-1], len(bins) - 2)
    for i in range(len(bins) - 2, -1, -1):
        index = F.when((location >= bins[i]) & (location < bins[i + 1]), i).otherwise(index)
    return index.cast("int")


def dealing_location(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """Dealing range, location in it, discount / premium bucket, bin, age of the range."""
    c = settings(STRUCTURE, cfg)
    n = c["dealing_range_lookback_bars"]
    rows = Rows(by)
    frame = rows.last(n)
    out = bars.withColumns({"_hi": F.max("high").over(frame), "_lo": F.min("low").over(frame)})
    hi, lo = F.col("_hi"), F.col("_lo")
    tall = F.coalesce((px_atr() > EPS) & (hi - lo >= c["dealing_range_min_height_atr"] * px_atr()), F.lit(False))
    location = F.when(tall, clamp01((px_close() - lo) / F.greatest(hi - lo, F.lit(EPS)))).otherwise(0.5)
    changed = (hi != rows.shift(hi)) | (lo != rows.shift(lo))
    out = out.withColumns({"pd_location_frac": location, "_changed": F.coalesce(changed, F.lit(True))})
    frac = F.col("pd_location_frac")
    bucket = (
        F.when(frac <= c["pd_location_discount_max_frac"], "discount")
        .when(frac >= c["pd_location_premium_min_frac"], "premium")
        .otherwise("equilibrium")
    )
    since = row_no() - F.last(F.when(F.col("_changed"), row_no()), ignorenulls=True).over(rows.so_far)
    return out.withColumns(
        {
            "ict_struct_dealing_range_high": hi,
            "ict_struct_dealing_range_low": lo,
            "ict_struct_dealing_range_mid": (hi + lo) / 2.0,
            "pd_location_bucket": bucket,
            "fvg_location_bucket": bucket,
            "ict_struct_pd_index": _bin_index(frac, c["pd_index_bins"]),
            "dealing_range_age_bars": since.cast("int"),
        }
    ).drop("_hi", "_lo", "_changed")


def compression(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """_box_high/_box_low over the compression window and whether it is compressed."""
    c = settings(STRUCTURE, cfg)
    n = c["mms_compression_window_bars"]
    rows = Rows(by)
    out = bars.withColumns(
        {
            "_box_high": rows.max(px_high(), n),
            "_box_low": rows.min(px_low(), n),
            "_box_atr": rows.mean(px_atr(), n),
            "_box_z": rows.mean(F.col("atr_z"), n),
        }
    )
    width = F.col("_box_high") - F.col("_box_low")
    narrow = F.when(F.col("_box_atr") > EPS, width / F.col("_box_atr")).otherwise(0.0)
    ok = (F.col("_box_z") <= c["mms_compression_atr_z_max"]) & (narrow < c["mms_distribution_range_atr_min"])
    return out.withColumn(
        "_compressed", F.col("_box_high").isNotNull() & F.coalesce(ok, F.lit(False))
    ).drop("_box_atr", "_box_z")


_BOX_PHASE = "struct<mms_phase:string,mms_range_high:double,mms_range_low:double,mms_range_age_bars:int,mms_manipulation_side:string,mms_distribution_dir:string>"
_BOX_STATE = "struct<phase:string,side:string,direction:string,high:double,low:double,age:int,streak:int>"


def accumulation_step(c: Mapping):
    """Accumulation → manipulation → distribution, one bar at a time, as a column expression over (state, bar)."""
    need = c["mms_phase_persist_bars_min"]
    names = ("phase", "side", "direction", "high", "low", "age", "streak")
    none, no = F.lit("none"), F.lit(None).cast("double")

    def bar(state: Column, b: Column) -> Column:
        compressed = F.coalesce(b["compressed"], F.lit(False))
        trigger = (b["sweep"] != "none") | (b["grab"] if not c["mms_manipulation_requires_sweep"] else F.lit(False))

        def open_box(s: Column) -> Column:
            begins = (s["phase"] == "none") & compressed & (s["streak"] >= need)
            return updated(s, names, begins, {"phase": F.lit("accumulation"), "side": none, "direction": none, "high": b["box_high"], "low": b["box_low"], "age": F.lit(0)})

        def grow(s: Column) -> Column:
            return updated(s, names, (s["phase"] != "none") & s["high"].isNotNull(), {"age": s["age"] + 1})

        def manipulate(s: Column) -> Column:
            up = (b["sweep"] == "eqh") | ((b["sweep"] == "none") & (b["close"] < b["open"]))
            begins = (s["phase"] == "accumulation") & trigger & (s["streak"] >= need)
            return updated(s, names, begins, {"phase": F.lit("manipulation"), "side": F.when(up, "buyside").otherwise("sellside"), "direction": none, "streak": F.lit(0)})

        def distribute(s: Column) -> Column:
            wanted = F.when(s["side"] == "buyside", "down").otherwise("up")
            beyond = F.when(wanted == "down", s["low"] - b["low"]).otherwise(b["high"] - s["high"])
            leaves = (b["atr"] > EPS) & (beyond >= c["mms_distribution_range_atr_min"] * b["atr"])
            begins = (s["phase"] == "manipulation") & (s["streak"] >= need) & b["displaced"] & (b["direction"] == wanted) & leaves
            return updated(s, names, begins, {"phase": F.lit("distribution"), "direction": wanted, "streak": F.lit(0)})

        def reset(s: Column) -> Column:
            shift = F.abs((b["box_high"] + b["box_low"]) / 2.0 - (s["high"] + s["low"]) / 2.0)
            shared = F.greatest(F.lit(0.0), F.least(s["high"], b["box_high"]) - F.greatest(s["low"], b["box_low"])) / F.greatest(s["high"] - s["low"], F.lit(EPS))
            moved = (s["phase"] != "none") & s["high"].isNotNull() & b["box_high"].isNotNull() & (b["atr"] > EPS) & ((shift > b["atr"]) | (shared < 0.5))
            return updated(s, names, moved, {"phase": none, "side": none, "direction": none, "high": no, "low": no, "age": F.lit(0), "streak": F.lit(0)})

        def show(s: Column) -> Column:
            age = F.when(s["high"].isNotNull(), s["age"]).otherwise(0)
            out = F.struct(s["phase"], s["high"], s["low"], age, s["side"], s["direction"]).cast(_BOX_PHASE)
            return F.struct(s.alias("state"), out.alias("result"))

        def through(value: Column, stages: Sequence) -> Column:
            return let(value.cast(_BOX_STATE), lambda s: through(stages[0](s), stages[1:]) if stages else show(s))

        streak = F.when(compressed, state["streak"] + 1).otherwise(F.greatest(F.lit(0), state["streak"] - 1))
        counted = F.struct(*[(streak if n == "streak" else state[n]).alias(n) for n in names])
        return through(counted, (open_box, grow, manipulate, distribute, reset))

    return bar


def market_phases(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """mms_*: the phase fold over a bounded group, and its confidence."""
    return phase_confidence(bars.join(phase_fold(bars, cfg, by), [*by, "_row"]))


def phase_fold(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """The phases keyed by row.

    bars carry displacement, sweep, grab and compression columns.
    """
    c = settings(STRUCTURE, cfg)
    by = list(by)
    slim = bars.select(
        *by,
        "_row",
        "open",
        "high",
        "low",
        "close",
        F.coalesce(px_atr(), F.lit(0.0)).alias("atr"),
        F.col("_compressed").alias("compressed"),
        F.col("_box_high").alias("box_high"),
        F.col("_box_low").alias("box_low"),
        F.col("liq_sweep_side").alias("sweep"),
        F.col("liq_grab_flag").alias("grab"),
        F.col("displacement_flag").alias("displaced"),
        F.col("displacement_dir").alias("direction"),
    )
    start = F.struct(F.lit("none"), F.lit("none"), F.lit("none"), F.lit(None), F.lit(None), F.lit(0), F.lit(0)).cast(_BOX_STATE)
    found = scanned(slim, by, "_row", start, _BOX_STATE, _BOX_PHASE, accumulation_step(c))
    return found.drop(*[n for n in slim.columns if n not in (*by, "_row")])


def phase_confidence(bars: DataFrame) -> DataFrame:
    score = (
        F.col("_compressed").cast("double")
        + F.when(F.col("liq_sweep_flag"), F.col("liq_sweep_quality")).otherwise(0.0)
        + F.col("displacement_quality")
        + (F.col("mms_phase") == "distribution").cast("double")
    )
    return bars.withColumn("mms_confidence", clamp01(score / 4.0))


def swing_candidates(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """_inner (a full centred window fits), _cand_high, _cand_low (look-ahead)."""
    k = max(1, settings(STRUCTURE, cfg)["swing_lookback_bars"])
    around = Rows(by).around(k, k)
    inner = F.count(F.lit(1)).over(around) == 2 * k + 1
    return bars.withColumns(
        {
            "_inner": inner,
            "_cand_high": inner & (px_high() == F.max("high").over(around)),
            "_cand_low": inner & (px_low() == F.min("low").over(around)),
        }
    )


_SWING, _SWING_STATE = "struct<_is_high:boolean,_is_low:boolean,_strength:double>", "struct<high:bigint,low:bigint>"


def swing_step(gap: int):
    """Accept a candidate that is at least ``gap`` bars after the opposite swing; a column expression over (state, candidate)."""

    def bar(last: Column, b: Column) -> Column:
        row = b["_row"]
        high = F.coalesce(b["_cand_high"], F.lit(False)) & (last["low"].isNull() | (row - last["low"] >= gap))

        def then(t: Column) -> Column:
            low = F.coalesce(b["_cand_low"], F.lit(False)) & (t["high"].isNull() | (row - t["high"] >= gap))
            strength = F.when(low, row - t["high"]).when(t["is_high"], row - last["low"])
            state = F.struct(t["high"].alias("high"), F.when(low, row).otherwise(last["low"]).alias("low")).cast(_SWING_STATE)
            return F.struct(state.alias("state"), F.struct(t["is_high"], low, strength).cast(_SWING).alias("result"))

        return let(F.struct(F.when(high, row).otherwise(last["high"]).alias("high"), high.alias("is_high")), then)

    return bar


def swings(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """ict_struct_swing_high / _low / _strength."""
    cand = swing_candidates(bars, cfg, by)
    return label_swings(cand.join(accepted_swings(cand, cfg, by), [*by, "_row"], "left"))


def accepted_swings(cand: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """Accepted candidates keyed by row; the fold sees only the candidate rows of a bounded group."""
    c = settings(STRUCTURE, cfg)
    by = list(by)
    slim = cand.where("_cand_high or _cand_low").select(*by, "_row", "_cand_high", "_cand_low")
    start = F.lit(None).cast("bigint")
    step = swing_step(c["swing_strength_min_bars"])
    found = scanned(slim, by, "_row", F.struct(start, start).cast(_SWING_STATE), _SWING_STATE, _SWING, step)
    return found.drop("_cand_high", "_cand_low")


def label_swings(joined: DataFrame) -> DataFrame:
    return joined.withColumns(
        {
            "ict_struct_swing_high": F.when(F.col("_is_high"), px_high()),
            "ict_struct_swing_low": F.when(F.col("_is_low"), px_low()),
            "ict_struct_swing_strength": F.col("_strength"),
        }
    ).drop("_is_high", "_is_low", "_strength", "_cand_high", "_cand_low")


def swing_trend(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """ict_struct_swing_trend_dir and struct_trend_strength from the latest swings.

    The running list of swing points of a group is cut to the last few; rows
    without a full centred window read range and 0.
    """
    c = settings(STRUCTURE, cfg)
    rows = Rows(by)
    n = c["swing_trend_dir_window"]

    def point(px: str, kind: str) -> Column:
        return F.when(
            F.col(px).isNotNull(),
            F.struct(row_no().cast("double").alias("x"), F.lit(kind).alias("kind"), F.col(px).alias("y")),
        )

    here = F.array_compact(F.array(point("ict_struct_swing_high", "high"), point("ict_struct_swing_low", "low")))
    out = bars.withColumn("_here", here)
    # Collected over swing rows only, so a list is never longer than the window asks for.
    out = out.withColumn("_has", F.size("_here") > 0)
    recent = F.flatten(F.collect_list("_here").over(Rows([*by, "_has"]).last(max(n, 1))))
    recent = F.slice(recent, F.greatest(F.size(recent) - n + 1, F.lit(1)), F.lit(max(n, 1)))
    out = out.withColumn("_recent", F.when(F.col("_has"), recent))
    none = F.slice(F.array(F.struct(row_no().cast("double").alias("x"), F.lit("").alias("kind"), px_close().alias("y"))), 1, 0)
    out = out.withColumn(
        "_points", F.coalesce(F.last("_recent", ignorenulls=True).over(rows.so_far), none)
    )
    pts = F.col("_points")

    def steps(kind: str) -> tuple[Column, Column]:
        ys = F.transform(F.filter(pts, lambda p: p["kind"] == kind), lambda p: p["y"])
        later = F.slice(ys, 2, F.greatest(F.size(ys) - 1, F.lit(0)))
        signs = F.zip_with(later, ys, lambda b, a: F.when(b.isNull(), 0).when(b > a, 1).otherwise(-1))
        return F.size(ys), F.aggregate(signs, F.lit(0), lambda s, v: s + v)

    n_high, up = steps("high")
    n_low, low_up = steps("low")
    count = F.size(pts)

    def total(fn) -> Column:
        return F.aggregate(F.transform(pts, fn), F.lit(0.0), lambda s, v: s + v)

    enough = F.col("_inner") & (n_high >= 2) & (n_low >= 2)
    safe = F.greatest(count, F.lit(1))
    out = out.withColumns(
        {"_xm": total(lambda p: p["x"]) / safe, "_ym": total(lambda p: p["y"]) / safe, "_enough": enough}
    )
    xm, ym = F.col("_xm"), F.col("_ym")
    cov = total(lambda p: (p["x"] - xm) * (p["y"] - ym))
    var = total(lambda p: (p["x"] - xm) * (p["x"] - xm))
    spread = F.sqrt(total(lambda p: (p["y"] - ym) * (p["y"] - ym)) / safe)
    slope = F.when(var > EPS, cov / var).otherwise(0.0)
    return out.withColumns(
        {
            "ict_struct_swing_trend_dir": F.when(~F.col("_enough"), "range")
            .when((up > 0) & (low_up > 0), "up")
            .when((up < 0) & (low_up < 0), "down")
            .otherwise("range"),
            "struct_trend_strength": F.when(F.col("_enough"), slope / (spread + EPS)).otherwise(0.0),
        }
    ).drop("_here", "_has", "_recent", "_points", "_xm", "_ym", "_enough")


def structure_break(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """bos_*: close beyond the last swing within the bar window after it."""
    c = settings(STRUCTURE, cfg)
    rows = Rows(by)

    def latest(px: str) -> Column:
        return F.last(F.when(F.col(px).isNotNull(), F.struct(row_no().alias("row"), F.col(px).alias("px"))), ignorenulls=True)

    out = bars.withColumns(
        {
            "_swing_high": latest("ict_struct_swing_high").over(rows.so_far),
            "_swing_low": latest("ict_struct_swing_low").over(rows.so_far),
        }
    )
    top, bottom = F.col("_swing_high"), F.col("_swing_low")
    lo, hi = c["bos_window_bars_min"], c["bos_window_bars_max"]
    margin = c["bos_min_distance_ticks"] * tick_px()

    def in_time(s: Column) -> Column:
        return (row_no() - s["row"]).between(lo, hi)

    out = out.withColumns(
        {
            "_bos_up": F.coalesce(F.col("_inner") & in_time(top) & (px_close() > top["px"] + margin), F.lit(False)),
            "_bos_down": F.coalesce(F.col("_inner") & in_time(bottom) & (px_close() < bottom["px"] - margin), F.lit(False)),
        }
    )
    up, down = F.col("_bos_up"), F.col("_bos_down")
    last = F.last(F.when(up | down, row_no()), ignorenulls=True).over(rows.so_far)
    # Where both sides break on one bar the downward one is reported.
    distance = F.when(down, bottom["px"] - px_close()).when(up, px_close() - top["px"])
    return out.withColumns(
        {
            "bos_flag": up | down,
            "bos_dir": F.when(down, "bearish").when(up, "bullish").otherwise("none"),
            "bos_level_px": F.when(down, bottom["px"]).when(up, top["px"]),
            "bos_distance_ticks": F.when(tick_px() > EPS, distance / tick_px()).otherwise(F.when(up | down, 0.0)),
            "bos_type": F.when(down, "bos_down").when(up, "bos_up").otherwise("none"),
            "bos_age_bars": (row_no() - last).cast("int"),
        }
    )


def character_change(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """choch_* and struct_state.

    A break sets the state; the first opposite break with wide ranges after it
    turns the state to transition until the next break. So the state is found per
    island between breaks, without a fold.
    """
    c = settings(STRUCTURE, cfg)
    rows = Rows(by)
    margin = c["choch_min_distance_ticks"] * tick_px()
    flag = F.col("bos_flag")
    out = bars.withColumns(
        {
            "_island": F.sum(flag.cast("int")).over(rows.so_far),
            "_trend": F.last(F.when(flag, F.col("bos_dir")), ignorenulls=True).over(rows.so_far),
        }
    )
    trend = F.col("_trend")
    wide = F.col("_inner") & (F.coalesce("atr_z", F.lit(0.0)) >= c["choch_z_cut"])
    top, bottom = F.col("_swing_high.px"), F.col("_swing_low.px")
    against = F.when(trend == "bullish", px_close() < bottom - margin).when(trend == "bearish", px_close() > top + margin)
    out = out.withColumn("_against", F.coalesce(wide & against, F.lit(False)))
    island = Rows([*by, "_island"])
    hits = F.sum(F.col("_against").cast("int")).over(island.so_far)
    out = out.withColumn("_hits", hits)
    choch = F.col("_against") & (F.col("_hits") == 1)
    out = out.withColumn("choch_flag", choch)
    down = trend == "bullish"
    last = F.last(F.when(F.col("choch_flag"), row_no()), ignorenulls=True).over(rows.so_far)
    level = F.when(down, bottom).otherwise(top)
    distance = F.when(tick_px() > EPS, F.abs(px_close() - level) / tick_px()).otherwise(0.0)
    is_choch = F.col("choch_flag")
    return out.withColumns(
        {
            "choch_dir": F.when(is_choch, F.when(down, "bearish").otherwise("bullish")).otherwise("none"),
            "choch_level_px": F.when(is_choch, level),
            "choch_distance_ticks": F.when(is_choch, distance),
            "choch_age_bars": (row_no() - last).cast("int"),
            "struct_state": F.when(trend.isNull(), "range").when(F.col("_hits") > 0, "transition").otherwise(trend),
        }
    ).drop("_island", "_trend", "_against", "_hits")


def structure(
    bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY, materialise=lambda df: df
) -> DataFrame:
    """All structure columns on the bars of a bounded group.

    First come all detectors that only need windows: one exchange. Then the four
    that look at other rows by a join or a fold, each as a narrow frame keyed by
    row and taken from the same core, so that none of them repeats another. The
    core is read five times: pass ``cut_lineage`` as ``materialise`` on big data.
    """
    by = list(by)
    core = with_basics(bars, cfg, by)
    for step in (
        displacement,
        fair_value_gap,
        order_block,
        equal_levels,
        liquidity_sweep,
        liquidity_grab,
        dealing_location,
        compression,
        swing_candidates,
    ):
        core = step(core, cfg, by)
    core = materialise(core)
    row = [*by, "_row"]
    out = (
        core.join(fill_measures(core, cfg, by), row, "left")
        .join(block_measures(core, cfg, by), [*by, "_ob_row", "ob_type"], "left")
        .join(phase_fold(core, cfg, by), row, "left")
        .join(accepted_swings(core, cfg, by), row, "left")
    )
    out = label_swings(phase_confidence(label_blocks(label_fills(out, cfg, by), cfg, by)))
    for step in (swing_trend, structure_break, character_change):
        out = step(out, cfg, by)
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def structure_events(struct: DataFrame) -> DataFrame:
    """One row per detector hit: bars unpivoted by an array of events, no shuffle.

    Columns of a detector that others lack are null for those.
    """

    def event(cond, kind, side, level=None, low=None, high=None, strength=None, **extra) -> Column:
        def num(x):
            return (F.col(x) if isinstance(x, str) else F.lit(None)).cast("double")

        fields = [
            F.lit(kind).alias("event_type"),
            (side if isinstance(side, Column) else F.lit(side)).alias("event_side"),
            num(level).alias("ref_level"),
            num(low).alias("ref_low"),
            num(high).alias("ref_high"),
            num(strength).alias("event_strength"),
            num(strength).alias("event_quality"),
        ]
        return F.when(cond, F.struct(*fields))

    c = F.col
    events = F.array_compact(
        F.array(
            event(c("fvg_direction") != "none", "FVG", c("fvg_direction"), "fvg_mid", "fvg_lower", "fvg_upper", "fvg_quality"),
            event(c("ob_type") != "none", "OB", c("ob_type"), "ob_mid", "ob_low", "ob_high", "ob_quality"),
            event(c("liq_sweep_flag"), "LIQ_SWEEP", c("liq_sweep_side"), "liq_sweep_level_px", strength="liq_sweep_quality"),
            event(c("eqh_flag"), "EQ_HIGH", "high", "eqh_level_px", strength="eq_level_hit_count"),
            event(c("eql_flag"), "EQ_LOW", "low", "eql_level_px", strength="eq_level_hit_count"),
            event(c("bos_flag"), "BOS", c("bos_dir"), "bos_level_px", strength="bos_distance_ticks"),
            event(c("choch_flag"), "CHOCH", c("choch_dir"), "choch_level_px", strength="choch_distance_ticks"),
            event(c("displacement_flag"), "DISPLACEMENT", c("displacement_dir"), strength="displacement_quality"),
        )
    )
    return struct.select("instrument", "anchor_tf", "ts", "dt", F.explode(events).alias("e")).select(
        "instrument", "anchor_tf", "ts", "dt", "e.*", F.lit("ict_struct").alias("event_source")
    )
