"""Timeframe codes and snapping to the epoch-aligned grid."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNIT_SECONDS = {"S": 1, "M": 60, "H": 3600}

# The codes that stand for one day.
_DAY_CODES = {"D1", "1D", "D"}


def tf_seconds(tf: str) -> int:
    """Seconds of S#, M#, H# or D1; anything else raises."""
    code = (tf or "").strip().upper()
    if code in _DAY_CODES:
        return 86400
    match = re.fullmatch(r"([SMH])(\d+)", code)
    if not match or int(match[2]) == 0:
        raise ValueError(f"unsupported timeframe {tf!r} (expected S#, M#, H#, D1)")
    return _UNIT_SECONDS[match[1]] * int(match[2])


def tf_interval(tf: str) -> str:
    return f"{tf_seconds(tf)} seconds"


def tf_micros(tf: Column) -> Column:
    """Duration in microseconds of a timeframe held in a column; null if unknown."""
    code = F.upper(F.trim(tf))
    unit = F.substring(code, 1, 1)
    count = F.substring(code, 2, 9).try_cast("long")
    seconds = (
        F.when(code.isin(*_DAY_CODES), F.lit(86400).cast("long"))
        .when(unit == "S", count)
        .when(unit == "M", count * 60)
        .when(unit == "H", count * 3600)
    )
    return F.when(seconds > 0, seconds * 1_000_000)


def micros(ts: Column) -> Column:
    """Microseconds since the epoch; needs the session time zone to be UTC."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def snap(ts: Column, tf: str) -> Column:
    """Start of the grid cell of one timeframe, as a zone-less timestamp."""
    us = micros(ts)
    return from_micros(us - F.pmod(us, F.lit(tf_seconds(tf) * 1_000_000)))


def snap_by(ts: Column, tf: Column) -> Column:
    """As snap, each row by its own timeframe; rows without a known one keep ts."""
    us, step = micros(ts), tf_micros(tf)
    return F.when(step.isNull(), ts.cast("timestamp_ntz")).otherwise(from_micros(us - F.pmod(us, step)))


def is_aligned(ts: Column, tf: Column) -> Column:
    """True when ts lies on the grid of its row's timeframe; unknown timeframe gives null."""
    return F.pmod(micros(ts), tf_micros(tf)) == 0


def anchor_grid(bars: DataFrame, tf: str, ts="ts", instrument="instrument") -> DataFrame:
    """Distinct (instrument, anchor_tf, ts) with ts snapped to the grid."""
    return bars.select(
        F.col(instrument).alias("instrument"),
        F.lit(tf).alias("anchor_tf"),
        snap(F.col(ts), tf).alias("ts"),
    ).distinct()


def off_grid(df: DataFrame, tf: Column | str = "anchor_tf", ts="ts") -> DataFrame:
    """Rows whose ts is not on the grid of their own timeframe."""
    tf = F.col(tf) if isinstance(tf, str) else tf
    return df.where(~is_aligned(F.col(ts), tf))


def grid_report(df: DataFrame, tf_col="anchor_tf", ts="ts") -> DataFrame:
    """Rows and off-grid rows per timeframe."""
    bad = (~is_aligned(F.col(ts), F.col(tf_col))).cast("int")
    return df.groupBy(tf_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(bad).alias("bad_rows"),
    )


def require_grid(df: DataFrame, tf_col="anchor_tf", ts="ts", sample=20) -> None:
    """Action: raise with a small sample when any row is off its grid."""
    bad = off_grid(df, tf_col, ts).limit(sample).collect()
    if bad:
        raise ValueError(f"{ts} is not on the {tf_col} grid, e.g. {bad}")
