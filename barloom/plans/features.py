"""Feature families by table, and the tables built from them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rolling import DAY
from ..operators import crosssection, flow, liquidity, range_phase, structure, trend, volatility
from ..operators.bars import keep_last
from ..operators.blocks import in_blocks
from ..operators.calendar import blackout_flags
from ..operators.conform import union_all
from ..operators.windows import assemble

POLICY = ("phase_version", "threshold_bundle_id", "micro_policy_id", "jump_policy_id", "impact_policy_id", "options_policy_id")


@dataclass(frozen=True)
class Family:
    """A function that adds columns to bars.

    back is how many earlier rows it reads at its default settings; families
    without it need their whole (bounded) group. Given settings add ``reach`` rows for
    each row that they name, either way for offsets, which is never too few: windows of a family are nested at
    most twice, and a recursive mean of n rows remembers 50 n.
    """

    add: Callable[..., DataFrame]
    table: str = "features"
    key: str = "ts"
    back: int | None = None
    ahead: int = 0
    reach: int = 2

    def halo(self, cfg: Mapping | None) -> tuple[int, int]:
        """Rows back and ahead that a block needs under these settings."""
        named = sum(abs(v) for v in (cfg or {}).values() if isinstance(v, int) and not isinstance(v, bool))
        return self.back + self.reach * named, self.ahead + (self.reach * named if self.ahead else 0)


def _trend(bars, cfg=None, by=DAY):
    return trend.rsi(trend.ema(bars, cfg, by), cfg, by)


def _vol(bars, cfg=None, by=DAY):
    return volatility.return_range(volatility.atr(bars, cfg, by), cfg, by)


FAMILIES = {
    "ta_trend": Family(_trend),
    "ta_vol": Family(_vol, back=trend.memory_rows(1 / 14) + 1, reach=51),
    "stat_ts": Family(volatility.return_zscores),
    "vol_range": Family(volatility.range_regime, "windows", "anchor_ts", back=200),
    "consolidation_bar": Family(volatility.consolidation, "windows", "anchor_ts", back=221),
    "unsup_regime": Family(volatility.vol_bucket_regime, "windows", "anchor_ts"),
    "carry_ts": Family(volatility.carry, "windows", "anchor_ts", back=504),
    "jump_variation": Family(volatility.jump_variation, back=52),
    "impact_lambda": Family(volatility.price_impact, back=51),
    "pcra_bar": Family(flow.bar_flow, "pcr_a", "pcr_window_ts", back=250),
    "pac_bar": Family(flow.bar_path, "windows", "anchor_ts", back=11, ahead=2),
    "vp_core": Family(flow.volume_profile, "zones_state", back=50),
    "zmf_core": Family(lambda bars, cfg=None, by=DAY: flow.day_range_zone(bars), "zones_state"),
    "internal_liquidity": Family(liquidity.interior_levels, "windows", "anchor_ts", back=164, ahead=2),
    "ict_struct": Family(structure.structure),
    "dealing_range_state": Family(range_phase.range_phases, "windows", "anchor_ts"),
}


def family_frame(
    name: str,
    bars: DataFrame,
    cfg: Mapping | None = None,
    by: Sequence[str] = DAY,
    continuous: bool = False,
    drop_policy: bool = False,
    **extra,
) -> DataFrame:
    """Keys and output columns of one family; extra goes to its function.

    continuous=True runs a family with a bounded reach over the series without
    a day cut, in blocks with a halo.
    """
    f = FAMILIES[name]
    if continuous:
        if f.back is None:
            raise ValueError(f"{name} needs its whole group and has no continuous form")
        if (cfg or {}).get("level_rank_method") == "recency_weighted":
            raise ValueError("recency-weighted levels look back without bound and have no continuous form")
        back, ahead = f.halo(cfg)
        out = in_blocks(
            bars, ["instrument", "anchor_tf"], ["ts"], lambda df, b: f.add(df, cfg, b), back=back, ahead=ahead
        )
    else:
        out = f.add(bars, cfg, by, **extra)
    inputs = set(bars.columns) | {"anchor_ts"}
    fresh = [c for c in out.columns if c not in inputs and not (drop_policy and c in POLICY)]
    keys = ["instrument", "anchor_tf"]
    stamp = F.col("anchor_ts") if "anchor_ts" in out.columns else F.col("ts").alias(f.key)
    return out.select(*keys, stamp, *fresh)


def feature_table(
    bars: DataFrame,
    calendar: DataFrame | None = None,
    signed_ticks: DataFrame | None = None,
    cfg: Mapping[str, Mapping] | None = None,
    tfs: Sequence[str] = (),
    families: Sequence[str] = ("ta_trend", "ta_vol", "stat_ts", "jump_variation", "impact_lambda", "ict_struct"),
    materialise: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The features table of many instruments and days in one plan.

    Families share the exchange of the bars by (instrument, anchor_tf, dt). Of bars that
    repeat a key one is kept, by a hash of its values, so that copies don't multiply rows.
    materialise is handed to the structure family, which reads its core several times.
    """
    cfg = cfg or {}
    bars = keep_last(bars, ["instrument", "anchor_tf", "ts"], F.xxhash64(*bars.columns))
    frames = {}
    for n in families:
        extra = {"materialise": materialise} if n == "ict_struct" and materialise else {}
        frames[n] = family_frame(n, bars, cfg.get(n), drop_policy=True, **extra)
    if calendar is not None:
        grid = bars.select("instrument", "anchor_tf", "ts").distinct()
        frames["macro_calendar"] = blackout_flags(grid, calendar, tfs)
    if signed_ticks is not None:
        parts = [flow.bucketed_flow(bars, signed_ticks, tf, cfg.get("microstructure_flow")) for tf in tfs]
        frames["microstructure_flow"] = union_all(parts).drop(*POLICY)
    return assemble(frames, dedupe=False)


def zones_table(bars: DataFrame, cfg: Mapping[str, Mapping] | None = None) -> DataFrame:
    """Day-range and volume-profile zones side by side; keys never coincide."""
    cfg = cfg or {}
    zones = [family_frame(n, bars, cfg.get(n)) for n in ("zmf_core", "vp_core")]
    return union_all(zones)


def window_families(bars: DataFrame, cfg: Mapping[str, Mapping] | None = None, names: Sequence[str] | None = None) -> DataFrame:
    """Window-keyed families joined on their keys."""
    cfg = cfg or {}
    names = names or [n for n, f in FAMILIES.items() if f.table == "windows" and n != "dealing_range_state"]
    frames = {n: family_frame(n, bars, cfg.get(n)) for n in names}
    return assemble(frames, ("instrument", "anchor_tf", "anchor_ts"), dedupe=False)


def correlation_table(bars: DataFrame, universe: DataFrame, cfg: Mapping | None = None, tiles: int = 1) -> DataFrame:
    """features_corr: fast and slow correlation and relative value per (instrument, ts)."""
    cs = crosssection
    base = cs.with_market(cs.with_cluster(bars, universe))
    out = cs.peer_correlation(cs.market_correlation(base, cfg), cfg, tiles=tiles)
    out = cs.volatility_correlation(cs.lagged_correlation(cs.correlation_state(out, cfg), cfg), cfg)
    out = cs.slow_correlation(out, cfg, tiles=tiles)
    out = cs.cross_ranks(cs.spread(cs.primary_hedge(out, cfg, tiles=tiles), cfg))
    return out.drop("open", "high", "low", "close", "volume", "ret", "market_ret", "xs_relval_residual")
