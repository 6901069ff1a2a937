"""Trend families: exponential means and RSI.

Families add their columns to bars (instrument, anchor_tf, ts, …). ``by`` is the
partition of a series: a bounded group such as the default day, or the block of
``in_blocks`` for a continuous series.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import settings
from ..functions.rolling import DAY, Rows
from .blocks import exponential_means

TREND = {
    "rsi_period": 14,
    "rsi_oversold_cut": 30.0,
    "rsi_overbought_cut": 70.0,
    "rsi_smoothing": "wilder",
    "rsi_warmup_bars": None,
    "ema_fast_period": 20,
    "ema_slow_period": 50,
    "doji_epsilon": 1e-12,
}


def span_alpha(span: int) -> float:
    return 2.0 / (span + 1.0)


def memory_rows(alpha: float) -> int:
    """Rows after which a recursive mean has forgotten its start (below double precision)."""
    return int(50.0 / alpha) + 1


def ema(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """ema_fast, ema_slow over close; the shorter span is always the fast one."""
    c = settings(TREND, cfg)
    fast, slow = sorted((max(1, c["ema_fast_period"]), max(1, c["ema_slow_period"])))
    close = F.col("close")
    means = {"ema_fast": (close, span_alpha(fast)), "ema_slow": (close, span_alpha(slow))}
    return exponential_means(bars, means, by)


def rsi(bars: DataFrame, cfg: Mapping | None = None, by: Sequence[str] = DAY) -> DataFrame:
    """rsi_value (null during warm-up) and rsi_bucket."""
    c = settings(TREND, cfg)
    period = max(1, c["rsi_period"])
    warmup = 2 * period if c["rsi_warmup_bars"] is None else max(0, c["rsi_warmup_bars"])
    alpha = span_alpha(period) if c["rsi_smoothing"] == "ema" else 1.0 / period
    rows = Rows(by)
    eps = c["doji_epsilon"]
    moved = bars.withColumns({"_move": rows.diff(F.col("close")), "_row": rows.row()})
    gain = F.when(F.col("_move") > 0, F.col("_move")).otherwise(0.0)
    loss = F.when(F.col("_move") < 0, -F.col("_move")).otherwise(0.0)
    out = exponential_means(moved, {"_gain": (gain, alpha), "_loss": (loss, alpha)}, by)
    value = (
        F.when((F.col("_loss") <= eps) & (F.col("_gain") <= eps), F.lit(50.0))
        .when(F.col("_loss") <= eps, F.lit(100.0))
        .otherwise(100.0 - 100.0 / (1.0 + F.col("_gain") / F.col("_loss")))
    )
    # Inside in_blocks the row number restarts, so the warm-up looks at the carried one.
    row = F.col("_series_row") if "_series_row" in out.columns else F.col("_row")
    out = out.withColumn("rsi_value", F.when(row >= warmup, value))
    bucket = (
        F.when(F.col("rsi_value").isNull(), "na")
        .when(F.col("rsi_value") <= c["rsi_oversold_cut"], "oversold")
        .when(F.col("rsi_value") >= c["rsi_overbought_cut"], "overbought")
        .otherwise("neutral")
    )
    return out.withColumn("rsi_bucket", bucket).drop("_move", "_row", "_gain", "_loss")
