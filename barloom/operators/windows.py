"""Feature-table and context-window assembly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timegrid import snap_by
from .bars import keep_first
from .conform import cast_keys, order_columns, require_disjoint

FEATURE_KEYS = ("instrument", "anchor_tf", "ts")
WINDOW_KEYS = ("instrument", "anchor_tf", "anchor_ts")


def row_order(df: DataFrame, keys: Sequence[str]) -> Column:
    """A total order for rows that share a key: their own values, as one hash.

    Which copy is kept does not matter to the meaning, only that every run keeps
    the same one.
    """
    return F.xxhash64(*sorted(c for c in df.columns if c not in keys))


def full_join(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Families side by side on their keys; each join keeps the key partitioning."""
    return reduce(lambda a, b: a.join(b, list(keys), "full"), frames)


def assemble(
    families: Mapping[str, DataFrame],
    keys: Sequence[str] = FEATURE_KEYS,
    days: Sequence | None = None,
    dedupe: bool = True,
) -> DataFrame:
    """Families of one table: key casts, day filter, one row per key, full join, column order.

    The checks on columns happen while the plan is built; ``require_grid`` is the
    separate action for off-grid rows.
    """
    require_disjoint(families, keys)
    ts = next((k for k in keys if k.endswith("ts")), None)
    frames = []
    for df in families.values():
        df = cast_keys(df, keys)
        if days is not None and ts:
            df = df.where(F.to_date(ts).isin(*days))
        if dedupe:
            df = keep_first(df, list(keys), row_order(df, keys))
        frames.append(df)
    return order_columns(full_join(frames, keys), keys)


def base_windows(candles: DataFrame | None, features: DataFrame | None, tfs: Sequence[str]) -> DataFrame:
    """Anchor times of each timeframe from candles; from features for timeframes without candles. Each source is read once, rows carrying their timeframe."""
    sources = [(candles, "tf"), (features, "anchor_tf")]
    parts = [
        df.where(F.col(tf).isin(list(tfs))).select("instrument", F.col(tf).alias("anchor_tf"), snap_by(F.col("ts"), F.col(tf)).alias("anchor_ts"), F.lit(k).alias("_from"))
        for k, (df, tf) in enumerate(sources) if df is not None
    ]
    both = reduce(DataFrame.unionByName, parts).groupBy("instrument", "anchor_tf", "anchor_ts").agg(F.min("_from").alias("_from"))
    if len(parts) > 1:
        first = both.groupBy("anchor_tf").agg(F.min("_from").alias("_first"))  # a row a timeframe
        both = both.join(first, "anchor_tf").where(F.col("_from") == F.col("_first"))
    return both.select("instrument", "anchor_tf", "anchor_ts")


def expand_entries(base: DataFrame, tf_entries: Sequence[str]) -> DataFrame:
    """Each window for each entry timeframe, by exploding a literal array."""
    return base.withColumn("tf_entry", F.explode(F.array(*[F.lit(t) for t in tf_entries])))


def first_per_column(df: DataFrame, keys: Sequence[str], order: Column, columns: Sequence[str]) -> DataFrame:
    """One row per key holding the first value of every column by an explicit order."""
    return keep_first(df.select(*keys, *columns, order.alias("_by")), keys, F.col("_by")).drop("_by")


def reduce_features(features: DataFrame) -> DataFrame:
    """One row per bar, with ts renamed to anchor_ts."""
    keys = list(FEATURE_KEYS)
    rest = [c for c in features.columns if c not in keys]
    one = first_per_column(features, keys, row_order(features, keys), rest) if rest else features.distinct()
    return one.withColumnRenamed("ts", "anchor_ts")


# Zone buckets a window carries, and the family columns they come from.
ZONE_CONTEXT = {
    "zone_behaviour_type_bucket": "zmf_zone_behaviour_type_bucket",
    "zone_freshness_bucket": "zmf_zone_freshness_bucket",
    "zone_stack_depth_bucket": "zmf_zone_stack_depth_bucket",
    "zone_htf_confluence_bucket": "zmf_zone_htf_confluence_bucket",
    "zone_vp_type_bucket": "zone_vp_type_bucket",
}


def zone_context(zones: DataFrame) -> DataFrame:
    """Zone buckets per bar, each from the bar's smallest zone_id (null there stays null)."""
    named = {}
    for out, source in ZONE_CONTEXT.items():
        present = [F.col(n).cast("string") for n in dict.fromkeys((out, source)) if n in zones.columns]
        if present:
            named[out] = F.coalesce(*present)
    firsts = [F.min_by(v, "zone_id").alias(n) for n, v in named.items()]
    return zones.groupBy(*FEATURE_KEYS).agg(*firsts).withColumnRenamed("ts", "anchor_ts")


def context_windows(
    candles: DataFrame | None,
    features: DataFrame | None,
    zones: DataFrame | None,
    phases: DataFrame | None,
    tfs: Sequence[str],
    tf_entries: Sequence[str],
) -> DataFrame:
    """Base grid × entry timeframe with features, zone context and range phases.

    Joins run before the expansion by entry timeframe, so the wide rows are
    shuffled once and multiplied afterwards, without a further exchange.
    """
    out = base_windows(candles, features, tfs)
    keys = list(WINDOW_KEYS)
    if features is not None:
        out = out.join(reduce_features(features).drop("dt"), keys, "left")
    if zones is not None:
        out = out.join(zone_context(zones), keys, "left")
    if phases is not None:
        clash = [c for c in phases.columns if c in out.columns and c not in keys]
        out = out.join(phases.drop(*clash), keys, "left")
    return expand_entries(out, tf_entries).withColumn("dt", F.to_date("anchor_ts"))
