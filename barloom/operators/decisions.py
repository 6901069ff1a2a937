"""Candidate trades and the decision stages after them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expr import SENTINEL, coalesce_present, column_or, is_blank, json_tags, safe_div, settings
from ..functions.timegrid import is_aligned, micros, snap_by
from .bars import keep_first
from .conform import EVAL_KEYS, RunContext, fill_evaluation, normalise_evaluation, union_all
from .passage import CELL_US, first_passages
from .windows import row_order

# Where side, entry and exit prices are looked for, in order.
SIDE_SOURCES = ("bos_dir", "choch_dir", "ict_struct_swing_trend_dir", "mms_distribution_dir", "liq_sweep_side")
ENTRY_LONG = ("ict_struct_swing_low", "bos_level_px", "choch_level_px", "ict_struct_dealing_range_mid")
ENTRY_SHORT = ("ict_struct_swing_high", "bos_level_px", "choch_level_px", "ict_struct_dealing_range_mid")
EXIT_LONG = ("ict_struct_dealing_range_high", "eqh_level_px", "bos_level_px")
EXIT_SHORT = ("ict_struct_dealing_range_low", "eql_level_px", "bos_level_px")

# Signal words and the side they stand for.
LONG_WORDS = ("long", "up", "bull", "buy", "bullish")
SHORT_WORDS = ("short", "down", "bear", "sell", "bearish")
NO_SIGNAL_WORDS = ("none", "range")

CANDIDATES = {
    "paradigm_id": "ict",
    "principle_id": "ict_all_windows",
    "tf_entry_allowlist": (),
    "vol_z_abs_min": 1.0,
    "fallback_all": True,
    "phase_allowlist": (),
    "side_sources": SIDE_SOURCES,
    "entry_long": ENTRY_LONG,
    "entry_short": ENTRY_SHORT,
    "exit_long": EXIT_LONG,
    "exit_short": EXIT_SHORT,
    "stop_atr_mult": 1.0,
}


def signal_side(df: DataFrame, sources: Sequence[str]) -> Column:
    """Side of the first source that carries a signal; long when none does."""
    found = []
    for name in sources:
        if name in df.columns:
            text = F.col(name).cast("string")
            found.append(F.when(~text.isin(*NO_SIGNAL_WORDS), text))
    raw = F.coalesce(*found) if found else F.lit(None).cast("string")
    return F.when(raw.isin(*SHORT_WORDS), "short").otherwise("long")


def is_candidate(df: DataFrame, vol_z_abs_min: float) -> Column:
    """A swing on the bar, or a wide volatility z-score."""
    tests = [F.col(n).isNotNull() for n in ("ict_struct_swing_high", "ict_struct_swing_low") if n in df.columns]
    if "stat_ts_vol_zscore" in df.columns:
        tests.append(F.abs(F.coalesce(F.col("stat_ts_vol_zscore"), F.lit(0.0))) > vol_z_abs_min)
    any_test = F.lit(not tests)
    for t in tests:
        any_test = any_test | t
    return any_test


def pick_candidates(windows: DataFrame, cfg: Mapping | None = None, unit: Sequence[str] = ("dt",)) -> DataFrame:
    """Rows that pass the candidate test; units (days) without any keep all rows.

    Whether a unit has one is an aggregate of one row per unit, joined back; no
    unit is gathered in a task.
    """
    c = settings(CANDIDATES, cfg)
    df = windows
    if c["tf_entry_allowlist"]:
        df = df.where(F.col("tf_entry").isin(*c["tf_entry_allowlist"]))
    if c["phase_allowlist"] and "dr_phase" in df.columns:
        df = df.where(F.col("dr_phase").isin(*c["phase_allowlist"]))
    df = df.withColumn("_hit", is_candidate(df, c["vol_z_abs_min"]))
    if not c["fallback_all"]:
        return df.where("_hit").drop("_hit")
    units = df.groupBy(*unit).agg(F.max("_hit").alias("_any"))
    return df.join(units, list(unit)).where(F.col("_hit") | ~F.col("_any")).drop("_hit", "_any")


def candidate_trades(windows: DataFrame, ctx: RunContext, cfg: Mapping | None = None) -> DataFrame:
    """Trade candidates with side, prices and ids; decisions and paths are projections of it.

    trade_id names run, instrument, anchor timeframe and time, and the entry
    timeframe, which keeps ids apart when there are several.
    """
    c = settings(CANDIDATES, cfg)
    df = pick_candidates(windows, c)
    df = df.withColumns(
        {"side": signal_side(df, c["side_sources"]), "anchor_ts": snap_by(F.col("anchor_ts"), F.col("anchor_tf"))}
    )
    long = F.col("side") == "long"
    entry = F.when(long, coalesce_present(df, c["entry_long"], "double")).otherwise(
        coalesce_present(df, c["entry_short"], "double")
    )
    target = F.when(long, coalesce_present(df, c["exit_long"], "double")).otherwise(
        coalesce_present(df, c["exit_short"], "double")
    )
    df = df.withColumns({"entry_px": entry, "exit_px": target})
    reach = column_or(df, "atr_anchor", "double") * c["stop_atr_mult"]
    return df.withColumns(
        {
            "snapshot_id": F.lit(ctx.snapshot_id),
            "run_id": F.lit(ctx.run_id),
            "mode": F.lit(ctx.mode),
            "paradigm_id": F.lit(c["paradigm_id"]),
            "principle_id": F.lit(c["principle_id"]),
            "trade_id": F.concat_ws(
                "-",
                F.lit(ctx.run_id),
                "instrument",
                "anchor_tf",
                F.date_format("anchor_ts", "yyyyMMdd'T'HHmmss"),
                "tf_entry",
            ),
            "tp_px": F.col("exit_px"),
            "sl_px": F.when(long, F.col("entry_px") - reach).otherwise(F.col("entry_px") + reach),
            "macro_is_blackout": F.coalesce(column_or(df, "macro_is_blackout", "boolean"), F.lit(False)),
            "macro_blackout_max_impact": column_or(df, "macro_blackout_max_impact", "int64"),
        }
    )


IDENTITY = ("snapshot_id", "run_id", "mode", "dt", "paradigm_id", "principle_id")


def decisions_of(trades: DataFrame) -> DataFrame:
    return trades.select(
        *IDENTITY,
        *[k for k in EVAL_KEYS[2:] if k in trades.columns],
        "instrument",
        "trade_id",
        "anchor_tf",
        "anchor_ts",
        "tf_entry",
        "side",
        "macro_is_blackout",
        "macro_blackout_max_impact",
    )


def paths_of(trades: DataFrame) -> DataFrame:
    ids = [F.col(k) if k in trades.columns else F.lit(SENTINEL).alias(k) for k in EVAL_KEYS[2:]]
    return trades.select(
        *IDENTITY,
        *ids,
        "instrument",
        "trade_id",
        "side",
        "anchor_tf",
        "tf_entry",
        "anchor_ts",
        F.col("anchor_ts").alias("entry_ts"),
        F.lit("anchor_close").alias("entry_ts_source"),
        F.lit(None).cast("long").alias("entry_ts_offset_ms"),
        "entry_px",
        "exit_px",
        "tp_px",
        "sl_px",
        F.lit("candidate").alias("principle_status_at_entry"),
        F.lit("phaseA_auto").alias("entry_mode"),
    )


@dataclass(frozen=True)
class Evaluation:
    """One parameter set of a principle."""

    paradigm_id: str
    principle_id: str
    candidate_id: str | None = None
    experiment_id: str | None = None
    params: Mapping = field(default_factory=dict)


Builder = Callable[[DataFrame, RunContext, Mapping], DataFrame]


def evaluate_all(
    windows: DataFrame,
    ctx: RunContext,
    evaluations: Sequence[Evaluation],
    base_cfg: Mapping | None = None,
    builders: Mapping[tuple[str, str], Builder] | None = None,
) -> DataFrame:
    """Candidates of every evaluation in one plan, stamped with its ids.

    A builder is any function (windows, ctx, cfg) → trades; ("name", "*") serves
    all principles of a paradigm. Evaluations of the standard builder that differ in
    their ids alone are a small table of ids, exploded over one reading of the windows.
    """
    known, shared, parts = builders or {}, {}, []
    for e in evaluations:
        build = known.get((e.paradigm_id, e.principle_id)) or known.get((e.paradigm_id, "*"))
        cfg = {**(base_cfg or {}), **e.params}
        ids = {"paradigm_id": e.paradigm_id, "principle_id": e.principle_id}
        ids |= {k: v if v and v.strip() else SENTINEL for k, v in (("candidate_id", e.candidate_id), ("experiment_id", e.experiment_id))}
        if build is None:
            shared.setdefault(repr(sorted(cfg.items(), key=lambda x: x[0])), (cfg, []))[1].append(ids)
        else:
            parts.append(build(windows, ctx, {**cfg, "paradigm_id": e.paradigm_id, "principle_id": e.principle_id}).withColumns({k: F.lit(ids[k]) for k in ("candidate_id", "experiment_id")}))
    for cfg, table in shared.values():
        trades = candidate_trades(windows, ctx, {**cfg, "paradigm_id": "", "principle_id": ""})
        rows = F.explode(F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in ids.items()]) for ids in table]))
        parts.append(trades.withColumn("_ids", rows).withColumns({k: F.col("_ids")[k] for k in ("paradigm_id", "principle_id", "candidate_id", "experiment_id")}).drop("_ids"))
    return union_all(parts)


def finish_paths(paths: DataFrame) -> DataFrame:
    """anchor_ts default, time-source label, offset in ms, and both alignment flags."""
    df = paths.withColumns(
        {
            "candidate_id": F.coalesce(column_or(paths, "candidate_id", "string"), F.lit(SENTINEL)),
            "experiment_id": F.coalesce(column_or(paths, "experiment_id", "string"), F.lit(SENTINEL)),
            "anchor_ts": F.coalesce(column_or(paths, "anchor_ts", "timestamp"), F.col("entry_ts")),
        }
    )
    same = F.col("entry_ts") == F.col("anchor_ts")
    source = column_or(df, "entry_ts_source", "string")
    offset = F.floor((micros(F.col("entry_ts")) - micros(F.col("anchor_ts"))) / 1000).cast("long")
    return df.withColumns(
        {
            "entry_ts_source": F.when(
                is_blank(source), F.when(F.coalesce(same, F.lit(False)), "anchor_close").otherwise("signal_ts")
            ).otherwise(source),
            "entry_ts_offset_ms": F.coalesce(column_or(df, "entry_ts_offset_ms", "int64"), offset),
            "entry_ts_is_aligned_anchor_tf": is_aligned(F.col("entry_ts"), F.col("anchor_tf")),
            "entry_ts_is_aligned_entry_tf": is_aligned(F.col("entry_ts"), F.col("tf_entry")),
        }
    )


def shared_keys(left: DataFrame, right: DataFrame) -> list[str]:
    """Trade keys and evaluation ids that both sides carry."""
    keys = [k for k in ("trade_id", "instrument", *EVAL_KEYS) if k in left.columns and k in right.columns]
    if "trade_id" not in keys:
        raise ValueError("no trade_id to join on")
    return keys


def enrich_anchor(decisions: DataFrame, paths: DataFrame) -> DataFrame:
    """anchor_tf and anchor_ts of decisions filled from their trade paths, then snapped."""
    keys = shared_keys(decisions, paths)
    source = paths.select(
        *keys, F.col("anchor_tf").alias("_tf"), F.col("entry_ts").alias("_entry")
    ).distinct()
    df = decisions.join(source, keys, "left")
    df = df.withColumns(
        {
            "anchor_tf": F.coalesce(column_or(df, "anchor_tf", "string"), F.col("_tf")),
            "anchor_ts": F.coalesce(
                column_or(df, "anchor_ts", "timestamp"), column_or(df, "entry_ts", "timestamp"), F.col("_entry")
            ),
        }
    ).drop("_tf", "_entry")
    return df.withColumn("anchor_ts", snap_by(F.col("anchor_ts"), F.col("anchor_tf")))


CRITIC = {
    "vol_z_abs_min": 1.0,
    "vol_z_abs_max": 3.0,
    "macro_impact_threshold": 3.0,
    "macro_blackout_penalty": 1.0,
    "macro_impact_penalty": 0.4,
    "volatility_bonus": 0.5,
    "volatility_penalty": 0.2,
    "structure_bonus": 0.3,
    "regime_mismatch_penalty": 0.15,
    "corr_penalty": 0.1,
}

CRITIC_FIELDS = ("critic_score_at_entry", "critic_reason_tags_at_entry", "critic_reason_cluster_id")


def context_critic(trades: DataFrame, cfg: Mapping | None = None) -> DataFrame:
    """Score and ordered reason tags of each trade from its context columns.

    Context may sit in columns or in hypothesis_features_json; unreadable JSON
    counts as no context. A swing column counts when it is not null.
    """
    c = settings(CRITIC, cfg)
    text = column_or(trades, "hypothesis_features_json", "string")

    def number(name: str) -> Column:
        inside = F.get_json_object(text, f"$.{name}").try_cast("double")
        return F.coalesce(column_or(trades, name, "double"), inside)

    def lower(name: str) -> Column:
        return F.lower(F.coalesce(column_or(trades, name, "string"), F.lit("")))

    blackout = F.coalesce(column_or(trades, "macro_is_blackout", "boolean"), F.lit(False))
    impact = column_or(trades, "macro_blackout_max_impact", "double")
    severe = F.coalesce(impact >= c["macro_impact_threshold"], F.lit(False))
    vol = number("stat_ts_vol_zscore")
    wide = F.least(F.abs(vol), F.lit(c["vol_z_abs_max"])) >= c["vol_z_abs_min"]
    swing = number("ict_struct_swing_high").isNotNull() | number("ict_struct_swing_low").isNotNull()
    vol_regime, trend_regime, corr = lower("vol_regime"), lower("trend_regime"), lower("micro_corr_regime")
    context = (vol_regime != "") & (trend_regime != "")
    calm_strong = context & vol_regime.contains("low") & trend_regime.contains("strong")
    wild_range = context & vol_regime.contains("high") & trend_regime.contains("range")
    stress = corr.contains("high") | corr.contains("stress")

    def amount(cond: Column, value: float) -> Column:
        return F.when(cond, F.lit(value)).otherwise(0.0)

    score = (
        amount(blackout, -c["macro_blackout_penalty"])
        + amount(severe, -c["macro_impact_penalty"])
        + F.when(vol.isNull(), 0.0).when(wide, c["volatility_bonus"]).otherwise(-c["volatility_penalty"])
        + amount(swing, c["structure_bonus"])
        + amount(calm_strong, -c["regime_mismatch_penalty"])
        + amount(wild_range, -c["regime_mismatch_penalty"])
        + amount(stress, -c["corr_penalty"])
    )
    tf, inst = column_or(trades, "anchor_tf", "string"), column_or(trades, "instrument", "string")
    tags = [
        F.when(blackout, F.lit("macro_blackout")),
        F.when(severe, F.lit("macro_blackout_impact_high")),
        F.when(vol.isNull(), F.lit("volatility_missing"))
        .when(wide, F.lit("volatility_confluence"))
        .otherwise(F.lit("volatility_below_threshold")),
        F.when(swing, F.lit("structural_confluence")),
        F.when(calm_strong, F.lit("regime_mismatch_vol_low_trend_strong")),
        F.when(wild_range, F.lit("regime_mismatch_vol_high_range")),
        F.when(~context, F.lit("regime_context_missing")),
        F.when(stress, F.lit("corr_regime_high")),
        F.when(tf != "", F.concat(F.lit("anchor_tf:"), tf)),
        F.when(inst != "", F.concat(F.lit("instrument:"), inst)),
    ]
    return trades.withColumns(
        {
            "critic_score_at_entry": score,
            "critic_reason_tags_at_entry": json_tags(tags),
            "critic_reason_cluster_id": F.coalesce(
                F.get(F.array_compact(F.array(*tags)), F.lit(0)), F.lit("ict_context_neutral")
            ),
        }
    )


def neutral_critic(trades: DataFrame) -> DataFrame:
    """0.0 and one constant tag per distinct trade, where no critic is given."""
    keys = [k for k in ("trade_id", *EVAL_KEYS, "instrument") if k in trades.columns]
    return normalise_evaluation(trades.select(*keys).distinct()).withColumns(
        {
            "critic_score_at_entry": F.lit(0.0),
            "critic_reason_tags_at_entry": F.lit("dev_noop"),
            "critic_reason_cluster_id": F.lit("dev_noop"),
        }
    )


def critic_summary(scored: DataFrame) -> DataFrame:
    """Trades and mean score per run and evaluation."""
    keys = [k for k in ("snapshot_id", "run_id", "mode", *EVAL_KEYS) if k in scored.columns]
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_trades"), F.avg("critic_score_at_entry").alias("avg_critic_score")
    )


def write_back_scores(paths: DataFrame, scored: DataFrame) -> DataFrame:
    """Critic fields on the trade paths."""
    keys = shared_keys(paths, scored)
    return paths.drop(*CRITIC_FIELDS).join(scored.select(*keys, *CRITIC_FIELDS), keys, "left")


def apply_critics(
    paths: DataFrame, trades: DataFrame, critics: Mapping[str, Callable[[DataFrame], DataFrame]]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scored decisions, summary and updated paths; one critic per paradigm, neutral for the others."""
    trades = normalise_evaluation(trades)
    parts = [fn(trades.where(F.col("paradigm_id") == name)) for name, fn in critics.items()]
    rest = trades.where(~F.col("paradigm_id").isin(*critics)) if critics else trades
    keep = [k for k in ("snapshot_id", "run_id", "mode", *EVAL_KEYS, "instrument", "trade_id") if k in trades.columns]
    ids = rest.select(*keep).distinct()
    neutral = write_back_scores(ids, neutral_critic(rest))
    scored = union_all([p.select(*keep, *CRITIC_FIELDS) for p in parts] + [neutral])
    return scored, critic_summary(scored), write_back_scores(normalise_evaluation(paths), scored)


def enrich_macro(decisions: DataFrame, windows: DataFrame) -> DataFrame:
    """Blackout columns of the decision's window, where decisions lack them."""
    if "macro_is_blackout" in decisions.columns:
        return decisions
    ts = next(n for n in ("anchor_ts", "window_ts", "ts", "entry_ts") if n in decisions.columns)
    stamp = F.col(ts).cast("timestamp_ntz")
    if ts == "entry_ts":
        stamp = snap_by(stamp, F.col("anchor_tf"))
    keys = ["instrument", "anchor_tf", "_at"]
    macro = windows.select(
        "instrument",
        "anchor_tf",
        F.col("anchor_ts").alias("_at"),
        F.col("macro_is_blackout").cast("boolean").alias("macro_is_blackout"),
        column_or(windows, "macro_blackout_max_impact", "int64").alias("macro_blackout_max_impact"),
        column_or(windows, "macro_state", "string").alias("macro_state"),
    )
    macro = keep_first(macro, keys, row_order(macro, keys))
    return decisions.withColumn("_at", stamp).join(macro, keys, "left").drop("_at")


def blackout_policy(decisions: DataFrame, on_blackout: str = "drop", enabled: bool = True) -> DataFrame:
    """Drop blackout decisions, or only tag them."""
    df = normalise_evaluation(decisions, "decisions")
    if not enabled or "macro_is_blackout" not in df.columns:
        return df
    flag = F.coalesce(F.col("macro_is_blackout").try_cast("boolean"), F.lit(False))
    df = df.withColumn("macro_is_blackout", flag)
    if on_blackout == "tag_only":
        return df.withColumn("macro_blackout_tag", F.when(F.col("macro_is_blackout"), "macro_blackout").otherwise(""))
    return df.where(~F.col("macro_is_blackout"))


def drop_counts(decisions: DataFrame) -> DataFrame:
    """Decisions before, dropped and kept per evaluation."""
    n, gone = F.count(F.lit(1)), F.sum(F.coalesce(F.col("macro_is_blackout"), F.lit(False)).cast("long"))
    return normalise_evaluation(decisions).groupBy(*EVAL_KEYS).agg(
        n.alias("n_before"), gone.alias("n_dropped"), (n - gone).alias("n_after")
    )


def gatekeep(decisions: DataFrame) -> DataFrame:
    return normalise_evaluation(decisions).withColumn("gatekeeper_status", F.lit("allowed_dev_stub"))


def size_positions(decisions: DataFrame) -> DataFrame:
    return normalise_evaluation(decisions).withColumn("portfolio_risk_bps_at_entry", F.lit(0.0))


# Context columns counted by when a trade path carries them.
CONTEXT_COLUMNS = (
    "tod_bucket",
    "dow_bucket",
    "vol_regime_entry",
    "trend_regime_entry",
    "macro_state_entry",
    "micro_corr_regime_entry",
    "corr_cluster_id_entry",
    "minutes_since_session_open_bucket",
)
CLUSTER_COLUMNS = ("corr_cluster_id_entry", "corr_cluster_id", "instrument_cluster_id", "cluster_id")


def context_counts(paths: DataFrame, extra: Sequence[str] = ("dt",)) -> DataFrame:
    """trade_count per evaluation, instrument, timeframes, side and context."""
    wanted = (*EVAL_KEYS, "instrument", "anchor_tf", "tf_entry", "side", *CONTEXT_COLUMNS, *extra)
    return paths.groupBy(*[c for c in wanted if c in paths.columns]).agg(F.count(F.lit(1)).alias("trade_count"))


def cluster_counts(paths: DataFrame, extra: Sequence[str] = ("dt",)) -> DataFrame:
    """trade_count per evaluation and the first cluster column there is."""
    cluster = [c for c in CLUSTER_COLUMNS if c in paths.columns][:1]
    keys = [c for c in (*EVAL_KEYS, *cluster, *extra) if c in paths.columns]
    return paths.groupBy(*keys).agg(F.count(F.lit(1)).alias("trade_count"))


def brackets(source: DataFrame, ctx: RunContext) -> DataFrame:
    """Entry, stop and target per trade, from trade paths or from decisions."""
    df = normalise_evaluation(source, "bracket source")
    fields = {
        "trade_id": "string",
        "instrument": "string",
        "side": "string",
        "tf_entry": "string",
        "entry_ts": "timestamp",
        "entry_px": "double",
        "sl_px": "double",
        "tp_px": "double",
    }
    ids = [k for k in EVAL_KEYS if k in df.columns]
    return df.select(
        F.lit(ctx.snapshot_id).alias("snapshot_id"),
        F.lit(ctx.run_id).alias("run_id"),
        F.lit(ctx.mode).alias("mode"),
        column_or(df, "dt", "date").alias("dt"),
        *[column_or(df, n, t).alias(n) for n, t in fields.items()],
        F.lit("dev_stub").alias("order_type"),
        *ids,
    )


def fill_entry_price(
    orders: DataFrame, candles: DataFrame, slice_keys: Sequence[str] = ("instrument", "tf_entry", "dt")
) -> DataFrame:
    """Missing entry prices from the first candle at or after the entry of the same day.

    Forward as-of join: the day's candles and requests are unioned and read
    backwards from the next candle. The frame is one timeframe of one
    instrument's day.
    """
    keys = ["_day" if k == "dt" else k for k in slice_keys]  # the day of the entry; dt stays as it is
    prices = candles.select(
        "instrument",
        F.col("tf").alias("tf_entry"),
        F.to_date("ts").alias("_day"),
        F.col("ts").alias("_at"),
        F.coalesce("open", "close").alias("_px"),
        F.lit(1).alias("_kind"),
    )
    wanted = orders.withColumn("_day", F.to_date("entry_ts"))
    asks = wanted.where(F.col("entry_px").isNull() & F.col("entry_ts").isNotNull())
    asks = asks.select(*keys, F.col("entry_ts").alias("_at")).distinct()
    asks = asks.withColumns({"_px": F.lit(None).cast("double"), "_kind": F.lit(0)})
    ahead = W.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(0, W.unboundedFollowing)
    found = (
        prices.select(*asks.columns)
        .unionByName(asks)
        .withColumn("_next", F.first("_px", ignorenulls=True).over(ahead))
        .where("_kind = 0")
        .select(*keys, F.col("_at").alias("entry_ts"), "_next")
    )
    joined = wanted.join(found, [*keys, "entry_ts"], "left")
    return joined.withColumn("entry_px", F.coalesce("entry_px", "_next")).select(*orders.columns)


def _touches(side: Column, high: Column, low: Column) -> tuple[Column, Column]:
    """Whether prices between low and high reach the target, and the stop."""
    target = F.when(side == "long", high >= F.col("tp_px")).otherwise(low <= F.col("tp_px"))
    stop = F.when(side == "long", low <= F.col("sl_px")).otherwise(high >= F.col("sl_px"))
    return F.coalesce(target, F.lit(False)), F.coalesce(stop, F.lit(False))


def barrier_outcomes(orders: DataFrame, candles: DataFrame, cell_us: int = CELL_US) -> DataFrame:
    """Entry fill, and exit at the first bar that touches target or stop.

    The target is looked at first inside a bar; without a touch the exit is the
    last close of the day. An order meets the extremes of the later time cells of
    its day, then only the bars of its own cell and of the first cell with a touch.
    """
    keys = [k for k in ("trade_id", *EVAL_KEYS, "instrument") if k in orders.columns]
    series = ["instrument", "tf_entry", "_day"]
    facts = [*series, "entry_ts", "side", "tp_px", "sl_px", "_own"]

    def cell(ts: str) -> Column:
        return F.floor(micros(F.col(ts)) / cell_us)

    bars = candles.select(
        "instrument",
        F.col("tf").alias("tf_entry"),
        F.to_date("ts").alias("_day"),
        F.col("ts").alias("_ts"),
        micros(F.col("ts")).alias("_at"),
        cell("ts").alias("_cell"),
        F.coalesce("open", "close").alias("_px"),
        F.col("high").alias("_high"),
        F.col("low").alias("_low"),
        F.col("close").alias("_close"),
    )
    cells = bars.groupBy(*series, "_cell").agg(
        F.min("_ts").alias("_c_first"),
        F.min_by("_px", "_at").alias("_c_px"),
        F.max("_at").alias("_c_last"),
        F.max_by("_close", "_at").alias("_c_close"),
        F.max("_high").alias("_c_high"),
        F.min("_low").alias("_c_low"),
    )
    wanted = orders.withColumns({"_day": F.to_date("entry_ts"), "_own": cell("entry_ts")})
    wanted = wanted.select(*dict.fromkeys([*keys, *facts]))
    met = wanted.join(cells, series).where(F.col("_cell") >= F.col("_own"))
    after = F.when(F.col("_cell") > F.col("_own"), F.col("_cell"))
    target, stop = _touches(F.col("side"), F.col("_c_high"), F.col("_c_low"))
    later = met.groupBy(*dict.fromkeys([*keys, *facts])).agg(
        F.min(F.when(after.isNotNull(), F.col("_c_first"))).alias("_next_ts"),
        F.min_by("_c_px", after).alias("_next_px"),
        F.max(F.when(after.isNotNull(), F.col("_c_last"))).alias("_end"),
        F.max_by("_c_close", after).alias("_end_px"),
        F.min(F.when(target | stop, after)).alias("_touched"),
    )
    looked = later.withColumn("_cell", F.explode(F.array_compact(F.array("_own", "_touched"))))
    target, stop = _touches(F.col("side"), F.col("_high"), F.col("_low"))
    kind = F.when(target, "target").when(stop, "stop")
    price = F.when(F.col("_kind") == "target", F.col("tp_px")).otherwise(F.col("sl_px"))
    pairs = (
        looked.join(bars.withColumnRenamed("_ts", "_bar_ts"), [*series, "_cell"], "left")
        .withColumn("_ts", F.when(F.col("_bar_ts") >= F.col("entry_ts"), F.col("_bar_ts")))
        .withColumns({"_at": F.when(F.col("_ts").isNotNull(), F.col("_at")), "_kind": F.when(F.col("_ts").isNotNull(), kind)})
        .withColumns({"_exit": price, "_hit": F.when(F.col("_kind").isNotNull(), F.col("_at"))})
    )
    found = pairs.groupBy(*keys).agg(
        F.least(F.min("_ts"), F.min("_next_ts")).alias("entry_fill_ts"),
        F.when(F.min("_ts") <= F.min("_next_ts"), F.min_by("_px", "_at"))
        .when(F.min("_next_ts").isNotNull(), F.min_by("_next_px", "_next_ts"))
        .otherwise(F.min_by("_px", "_at"))
        .alias("_entry_open"),
        F.min("_hit").alias("_first"),
        F.min_by("_exit", "_hit").alias("_hit_px"),
        F.min_by("_kind", "_hit").alias("_hit_kind"),
        F.coalesce(F.max("_end"), F.max("_at")).alias("_last"),
        F.when(F.max("_end").isNotNull(), F.max_by("_end_px", "_end")).otherwise(F.max_by("_close", "_at")).alias("_last_px"),
    )
    return orders.join(found.where(F.col("entry_fill_ts").isNotNull()), keys).withColumns(
        {
            "entry_fill_px": F.coalesce("entry_px", "_entry_open"),
            "exit_fill_ts": F.timestamp_micros(F.coalesce("_first", "_last")).cast("timestamp_ntz"),
            "exit_fill_px": F.when(F.col("_first").isNotNull(), F.col("_hit_px")).otherwise(F.col("_last_px")),
            "exit_reason": F.coalesce("_hit_kind", F.lit("last_close")),
        }
    ).drop("_entry_open", "_first", "_hit_px", "_hit_kind", "_last", "_last_px")


def order_rows(orders: DataFrame) -> DataFrame:
    """One intent row per trade."""
    ids = [k for k in EVAL_KEYS if k in orders.columns]
    return orders.select(
        "snapshot_id",
        "run_id",
        "mode",
        "dt",
        *ids,
        "trade_id",
        "instrument",
        "side",
        F.col("entry_ts").alias("submitted_ts"),
        F.col("entry_px").alias("limit_px"),
        "sl_px",
        "tp_px",
        F.lit("SIM").alias("venue"),
        F.lit("submitted").alias("status"),
    )


def fill_rows(outcomes: DataFrame) -> DataFrame:
    """Entry and exit row per trade."""
    ids = [k for k in EVAL_KEYS if k in outcomes.columns]
    fills = F.array(
        F.struct(
            F.col("entry_fill_ts").alias("fill_ts"), F.col("entry_fill_px").alias("fill_px"), F.lit("entry").alias("fill_type")
        ),
        F.struct(
            F.col("exit_fill_ts").alias("fill_ts"), F.col("exit_fill_px").alias("fill_px"), F.lit("exit").alias("fill_type")
        ),
    )
    base = ["snapshot_id", "run_id", "mode", "dt", *ids, "trade_id", "instrument", "side"]
    return outcomes.select(*base, F.explode(fills).alias("f")).select(*base, "f.*")


def excursions(orders: DataFrame, candles: DataFrame) -> DataFrame:
    """Bars to 1R and 2R, largest adverse and favourable move in R, over the bars of the day after entry.

    One R is |entry - stop|; a zero or unknown R leaves the measures null.
    """
    risk = F.abs(F.col("entry_px") - F.col("sl_px"))
    long = F.col("side") == "long"

    def gain(high: Column, low: Column) -> Column:
        return safe_div(F.when(long, high - F.col("entry_px")).otherwise(F.col("entry_px") - low), risk, None)

    def loss(high: Column, low: Column) -> Column:
        return safe_div(F.when(long, F.col("entry_px") - low).otherwise(high - F.col("entry_px")), risk, None)

    levels = {"time_to_1R_bars": 1.0, "time_to_2R_bars": 2.0}
    found = first_passages(orders, candles, F.col("entry_ts"), gain, levels, {"_mae": loss, "_mfe": gain})
    known = F.col("_mfe").isNotNull()
    measures = {"mae_R": F.when(known, F.greatest("_mae", F.lit(0.0))), "mfe_R": F.when(known, F.greatest("_mfe", F.lit(0.0)))}
    return found.withColumns(measures).drop("_mae", "_mfe")


def attach_evaluation(df: DataFrame, source: DataFrame) -> DataFrame:
    """Evaluation ids by (instrument, trade_id); own ids stay unless they are ∅."""
    if not {"instrument", "trade_id"} <= set(df.columns):
        return fill_evaluation(df)
    ids = fill_evaluation(source).select(
        "instrument", "trade_id", *[F.col(k).alias(f"_{k}") for k in EVAL_KEYS]
    ).distinct()
    out = fill_evaluation(df).join(ids, ["instrument", "trade_id"], "left")
    return out.withColumns(
        {
            k: F.when(F.col(k) == SENTINEL, F.coalesce(F.col(f"_{k}"), F.lit(SENTINEL))).otherwise(F.col(k))
            for k in EVAL_KEYS
        }
    ).drop(*[f"_{k}" for k in EVAL_KEYS])


# Report columns in order, by the table they count.
REPORT_COUNTS = {
    "trade_paths": "n_trades",
    "decisions_hypotheses": "n_decisions_hypotheses",
    "decisions_critic": "n_decisions_critic",
    "decisions_pretrade": "n_decisions_pretrade",
    "decisions_gatekeeper": "n_decisions_gatekeeper",
    "decisions_portfolio": "n_decisions_portfolio",
    "brackets": "n_brackets",
    "critic": "n_critic_rows",
}


def run_report(
    tables: Mapping[str, DataFrame],
    windows: DataFrame,
    ctx: RunContext,
    unit: Sequence[str] = (),
    source: DataFrame | None = None,
) -> DataFrame:
    """A run_total row and one row per evaluation, from one pass of grouping sets.

    Tables are reduced to ids and a tag before the union; ``unit`` (such as dt)
    repeats the report per unit.
    """
    unit = list(unit)
    if source is None:
        source = tables.get("brackets", tables.get("trade_paths"))
    tagged = [
        attach_evaluation(df, source).select(*unit, *EVAL_KEYS, F.lit(name).alias("_table"))
        for name, df in tables.items()
        if name in REPORT_COUNTS
    ]
    counts = [
        F.count(F.when(F.col("_table") == name, 1)).alias(out) for name, out in REPORT_COUNTS.items()
    ]
    level = F.grouping(EVAL_KEYS[0]).alias("_total")
    sets = [[F.col(u) for u in unit] + [F.col(k) for k in EVAL_KEYS], [F.col(u) for u in unit]]
    per_eval = union_all(tagged).groupingSets(sets, *unit, *EVAL_KEYS).agg(level, *counts)
    is_total = F.col("_total") == 1
    groups = per_eval.where(~is_total).groupBy(*unit).agg(F.count(F.lit(1)).alias("n_eval_groups"))
    wins = windows.groupBy(*unit).agg(F.count(F.lit(1)).alias("n_windows"))
    if unit:
        out = per_eval.join(groups, unit, "left").join(wins, unit, "left")
    else:
        # Both sides are single-row aggregates, put on the few report rows by a constant key.
        one = F.lit(1).alias("_one")
        out = (
            per_eval.withColumn("_one", F.lit(1))
            .join(groups.select("*", one), "_one", "left")
            .join(wins.select("*", one), "_one", "left")
            .drop("_one")
        )
    return out.select(
        F.lit(ctx.snapshot_id).alias("snapshot_id"),
        F.lit(ctx.run_id).alias("run_id"),
        F.lit(ctx.mode).alias("mode"),
        *unit,
        F.when(is_total, "run_total").otherwise("evaluation").alias("report_level"),
        *[F.when(is_total, SENTINEL).otherwise(F.col(k)).alias(k) for k in EVAL_KEYS],
        F.coalesce("n_eval_groups", F.lit(0)).alias("n_eval_groups"),
        F.coalesce("n_windows", F.lit(0)).alias("n_windows"),
        *REPORT_COUNTS.values(),
    )


def threshold_sweep(features: DataFrame, thresholds: Sequence[float], by: Sequence[str] = ("dt",)) -> DataFrame:
    """Candidates per threshold and day; every threshold and day has a row.

    Counted as conditional sums in one aggregate and unpivoted after it, so rows
    are not multiplied by the number of thresholds.
    """
    sums = [
        F.sum(is_candidate(features, t).cast("long")).alias(f"_t{i}") for i, t in enumerate(thresholds)
    ]
    wide = features.groupBy(*by).agg(*sums)
    pairs = F.array(
        *[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_t{i}").alias("candidates")) for i, t in enumerate(thresholds)]
    )
    return wide.select(*by, F.inline(pairs))
