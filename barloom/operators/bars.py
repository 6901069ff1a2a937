"""Ticks and candles to bars on a fixed time grid."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timegrid import micros, snap

BAR_COLUMNS = ("instrument", "anchor_tf", "ts", "dt", "open", "high", "low", "close", "volume")


def order_key(ts: Column, tie: Column | None = None) -> Column:
    """One orderable number for (ts, tie), so that min_by/max_by stay hash aggregates.

    A struct would be ordered too, but its buffer forces a sort-based aggregate.
    """
    if tie is None:
        return micros(ts)
    shifted = micros(ts).cast("decimal(19,0)") * F.lit(Decimal(10**19))
    return shifted + tie.cast("decimal(19,0)")


def ticks_to_bars(ticks: DataFrame, tf: str, tie: str | None = None) -> DataFrame:
    """OHLCV candles of one timeframe; empty buckets give no row.

    One partial and one final hash aggregate: a hot instrument is reduced on the
    map side before the shuffle.
    """
    key = order_key(F.col("ts"), F.col(tie) if tie else None)
    return (
        ticks.withColumns({"_order": key, "_bar": snap(F.col("ts"), tf)})
        .groupBy("instrument", F.col("_bar").alias("ts"))
        .agg(
            F.min_by("price", "_order").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "_order").alias("close"),
            F.sum("size").alias("volume"),
        )
        .select("instrument", F.lit(tf).alias("tf"), "ts", "open", "high", "low", "close", "volume")
    )


def resample(candles: DataFrame, tf: str) -> DataFrame:
    """Coarser candles from finer ones, by time bucket; ts is the first bar's."""
    return (
        candles.withColumns({"_order": micros(F.col("ts")), "_bar": snap(F.col("ts"), tf)})
        .groupBy("instrument", "_bar")
        .agg(
            F.min("ts").alias("ts"),
            F.min_by("open", "_order").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "_order").alias("close"),
            F.sum("volume").alias("volume"),
        )
        .select("instrument", F.lit(tf).alias("tf"), "ts", "open", "high", "low", "close", "volume")
    )


def keep_last(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row per key, the one with the greatest order value.

    An aggregate, not a window: copies of a hot key are reduced before the
    shuffle and never meet in one sorted group.
    """
    return _keep(df, keys, order, F.max_by)


def keep_first(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row per key, the one with the smallest order value."""
    return _keep(df, keys, order, F.min_by)


def _keep(df, keys, order, pick):
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    picked = df.withColumn("_order", order).groupBy(*keys).agg(*[pick(c, "_order").alias(c) for c in rest])
    return picked.select(*df.columns)


def to_bars(candles: DataFrame, tfs: Sequence[str] | None = None) -> DataFrame:
    """Candles as bars: tf becomes anchor_tf, dt is the UTC day, null keys go."""
    if tfs is not None:
        candles = candles.where(F.col("tf").isin(*tfs))
    return (
        candles.dropna(subset=["instrument", "tf", "ts"])
        .withColumnRenamed("tf", "anchor_tf")
        .withColumn("dt", F.to_date("ts"))
    )
