"""The whole chain as one lazy plan over many days and clusters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import decisions as d
from ..operators.bars import keep_last, to_bars
from ..operators.conform import RunContext
from ..operators.flow import side_signed, signed_ticks
from ..operators.paths import path_classes
from ..operators.range_phase import range_phases
from ..operators.structure import structure_events
from ..operators.windows import context_windows
from ..sources.store import write_table
from .features import correlation_table, feature_table, zones_table


def run(
    ctx: RunContext,
    candles: DataFrame,
    tfs: Sequence[str],
    tf_entries: Sequence[str],
    ticks: DataFrame | None = None,
    calendar: DataFrame | None = None,
    evaluations: Sequence[d.Evaluation] = (d.Evaluation("ict", "ict_all_windows"),),
    critics: Mapping[str, Callable] | None = None,
    on_blackout: str = "drop",
    cfg: Mapping[str, Mapping] | None = None,
    ticks_have_sides: bool = False,
    backtest: bool = True,
    materialise: Callable[[DataFrame], DataFrame] = lambda df: df,
    universe: DataFrame | None = None,
    tiles: int = 1,
) -> dict[str, DataFrame]:
    """All tables by name; without ``materialise`` nothing is computed yet.

    Of candles that repeat a key one is kept, by a hash of its values, before anything
    reads them. A universe (instrument, cluster_id) adds features_corr.

    It is applied to the structure core, the feature table and the candidates,
    which several later tables read: pass ``cut_lineage`` or a write-and-read.
    """
    cfg = cfg or {}
    candles = keep_last(candles, ["instrument", "tf", "ts"], F.xxhash64(*candles.columns))
    bars = to_bars(candles, tfs)
    signed = None
    if ticks is not None:
        signed = side_signed(ticks) if ticks_have_sides else signed_ticks(ticks)
    features = materialise(feature_table(bars, calendar, signed, cfg, tfs, materialise=materialise))
    features = features.withColumn("dt", F.to_date("ts"))
    zones = zones_table(bars, cfg)
    phases = range_phases(bars, cfg.get("dealing_range_state"))
    windows = context_windows(candles, features, zones, phases, tfs, tf_entries)

    trades = materialise(d.evaluate_all(windows, ctx, evaluations, cfg.get("candidates")))
    hypotheses = d.decisions_of(trades)
    critics = {"ict": d.context_critic} if critics is None else critics
    scored, critic, paths = d.apply_critics(d.finish_paths(d.paths_of(trades)), trades, critics)
    pretrade = d.blackout_policy(hypotheses, on_blackout)
    gated = d.gatekeep(pretrade)
    sized = d.size_positions(gated)
    orders = d.fill_entry_price(d.brackets(paths, ctx), candles)
    tables = {
        "features": features,
        "market_events": structure_events(features),
        "zones_state": zones.withColumn("dt", F.to_date("ts")),
        "windows": windows,
        "trade_paths": paths,
        "decisions_hypotheses": hypotheses,
        "decisions_critic": scored,
        "critic": critic,
        "decisions_pretrade": pretrade,
        "decisions_gatekeeper": gated,
        "decisions_portfolio": sized,
        "principles_context": d.context_counts(paths),
        "trade_clusters": d.cluster_counts(paths),
        "brackets": orders,
    }
    if universe is not None:
        tables["features_corr"] = correlation_table(bars, universe, cfg.get("corr"), tiles).withColumn("dt", F.to_date("ts"))
    if backtest:
        outcomes = d.barrier_outcomes(orders, candles)
        tables |= {"orders": d.order_rows(orders), "fills": d.fill_rows(outcomes)}
        tables["path_classes"] = path_classes(
            d.excursions(outcomes, candles).withColumn("path_cluster_id", F.lit(None).cast("string"))
        )
    counted = {k: v for k, v in tables.items() if k in d.REPORT_COUNTS and k != "critic"}
    tables["reports"] = d.run_report(
        {**counted, "critic": scored.select("instrument", "trade_id", *d.EVAL_KEYS)}, windows, ctx, source=orders
    )
    return tables


def store(tables: Mapping[str, DataFrame], root: str, ctx: RunContext, cluster_id: str = "all", names: Sequence[str] | None = None) -> None:
    """Action: write the stored tables of a run."""
    keep = names or [n for n in tables if n not in ("critic", "path_classes", "reports")]
    for name in keep:
        write_table(tables[name], name, root, ctx, cluster_id=cluster_id)
