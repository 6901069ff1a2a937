"""Vendor candles, ticks and calendars to canonical rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import column_or
from ..functions.timegrid import micros
from ..operators.bars import keep_last
from ..operators.conform import require_columns
from ..operators.windows import row_order
from .store import with_text_default, write_partitioned
from .tables import CANDLES, QUOTES, TABLES

# Vendor column names and the canonical ones.
CANDLE_ALIASES = {"timestamp": "ts"}
TICK_ALIASES = {
    "timestamp": "ts",
    "time": "ts",
    "bidPrice": "bid",
    "askPrice": "ask",
    "bid_volume": "bid_size",
    "ask_volume": "ask_size",
    "bidVolume": "bid_size",
    "askVolume": "ask_size",
}


def rename_known(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Renames present aliases unless the canonical column exists already."""
    taken, renames = set(df.columns), {}
    for source, target in aliases.items():
        if source in taken and target not in taken:
            renames[source] = target
            taken.add(target)
    return df.withColumnsRenamed(renames)


def naive_utc(df: DataFrame, name: str) -> Column:
    """Zoned timestamps become UTC zone-less ones; zone-less ones stay."""
    c = F.col(name)
    if dict(df.dtypes)[name] == "timestamp":
        c = F.to_utc_timestamp(c, F.current_timezone())
    return c.cast("timestamp_ntz")


def import_candles(raw: DataFrame, instrument: str | None = None, tf: str | None = None) -> DataFrame:
    df = rename_known(raw, CANDLE_ALIASES)
    require_columns(df, ["ts", "open", "high", "low", "close"], "candle import")
    df = with_text_default(with_text_default(df, "instrument", instrument), "tf", tf)
    df = df.withColumn("ts", naive_utc(df, "ts"))
    return df.select(*[column_or(df, n, t).alias(n) for n, t in CANDLES.items()])


def import_ticks(raw: DataFrame, instrument: str | None = None) -> DataFrame:
    df = rename_known(raw, TICK_ALIASES)
    require_columns(df, ["ts", "bid", "ask"], "tick import")
    df = with_text_default(df, "instrument", instrument)
    df = df.withColumn("ts", naive_utc(df, "ts"))
    return df.select(*[column_or(df, n, t).alias(n) for n, t in QUOTES.items()])


def market_day(ts: Column, market_tz: str | None = None) -> Column:
    """Date of a UTC time, in UTC or as seen in a market's zone."""
    if market_tz is None:
        return F.to_date(ts)
    return F.to_date(F.from_utc_timestamp(ts.cast("timestamp"), market_tz))


def write_by_market_day(df: DataFrame, path: str, mode: str, market_tz: str | None = None) -> None:
    """Action: split rows over mode / instrument / dt directories."""
    rows = df.withColumns({"mode": F.lit(mode), "dt": market_day(F.col("ts"), market_tz)})
    write_partitioned(rows, path, ["mode", "instrument", "dt"], ["ts"])


def day_violations(df: DataFrame, by=("dt",), ts: str = "ts") -> DataFrame:
    """Partitions whose times leave [dt, dt + 1 day), with their range."""
    start = micros(F.col("dt").cast("timestamp_ntz"))
    return (
        df.groupBy(*by)
        .agg(F.min(ts).alias("ts_min"), F.max(ts).alias("ts_max"), F.count(F.lit(1)).alias("rows"))
        .where((micros(F.col("ts_min")) < start) | (micros(F.col("ts_max")) >= start + 86_400_000_000))
    )


def guard_days(df: DataFrame, on_violation: str = "warn", by=("dt",)) -> DataFrame:
    """Action unless ignored: warn prints, error raises, when times leave their day."""
    if on_violation != "ignore":
        bad = day_violations(df, by).limit(5).collect()
        if bad and on_violation == "error":
            raise ValueError(f"times outside their dt day: {bad}")
        if bad:
            print(f"times outside their dt day: {bad}")
    return df


def project_timeframes(candles: DataFrame, tfs) -> DataFrame:
    """Candles of the wanted timeframes, one row per key, volume as a whole number."""
    df = rename_known(candles, CANDLE_ALIASES)
    require_columns(df, ["instrument", "tf", "ts", "open", "high", "low", "close"], "timeframe projection")
    df = df.select(*[column_or(df, n, t).alias(n) for n, t in CANDLES.items()]).where(F.col("tf").isin(*tfs))
    df = df.withColumn("volume", F.col("volume").cast("long"))
    keys = ["instrument", "tf", "ts"]
    return keep_last(df, keys, row_order(df, keys))


def write_timeframes(candles: DataFrame, tfs, path: str, mode: str) -> None:
    """Action: timeframe directories under mode / instrument / tf / dt."""
    rows = project_timeframes(candles, tfs).withColumns({"mode": F.lit(mode), "dt": F.to_date("ts")})
    write_partitioned(rows, path, TABLES["candles_tf"].partitions, ["ts"])


def read_calendar_csv(spark: SparkSession, path: str) -> DataFrame:
    """Vendor calendar CSV; every column is text, nothing is inferred."""
    return spark.read.option("header", True).csv(path)
