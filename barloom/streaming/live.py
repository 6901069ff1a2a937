"""Live bars, flow, range phases and blackout flags.

Each function takes a streaming DataFrame and gives one; with in-order input and
everything inside the watermark the results equal the batch operators'.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.timegrid import micros, tf_interval, tf_micros
from ..operators.bars import order_key
from ..operators.flow import label_flow
from ..session import shared_folder
from ..operators.range_phase import (
    FOLD_INPUT,
    PHASE_COLUMNS,
    PHASE_SCHEMA,
    STATE_SCHEMA,
    PhaseState,
    bar_dicts,
    range_settings,
    step,
)


def _event_time(df: DataFrame) -> DataFrame:
    """Watermarks need a zoned time; the session is in UTC, so the instant is the same."""
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def live_bars(ticks: DataFrame, tf: str, delay: str = "10 minutes", tie: str | None = None) -> DataFrame:
    """Ticks to candles, emitted once a bucket falls behind the watermark; later ticks are dropped."""
    key = order_key(F.col("ts"), F.col(tie) if tie else None)
    return (
        _event_time(ticks.withColumn("_order", key))
        .withWatermark("ts", delay)
        .groupBy("instrument", F.window("ts", tf_interval(tf)).alias("w"))
        .agg(
            F.min_by("price", "_order").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "_order").alias("close"),
            F.sum("size").alias("volume"),
        )
        .select(
            "instrument", F.lit(tf).alias("tf"), F.col("w.start").cast("timestamp_ntz").alias("ts"), "open", "high", "low", "close", "volume"
        )
    )


def live_flow(signed: DataFrame, tf: str, delay: str = "10 minutes", cfg: Mapping | None = None) -> DataFrame:
    """Flow buckets of ticks that carry signed_size (side-signed; the tick rule needs order)."""
    sums = (
        _event_time(signed)
        .withWatermark("ts", delay)
        .groupBy("instrument", F.window("ts", tf_interval(tf)).alias("w"))
        .agg(
            F.sum("size").alias("total_size"),
            F.sum("signed_size").alias("delta_size"),
            F.count("signed_size").alias("ticks"),
        )
        .select("instrument", F.lit(tf).alias("anchor_tf"), F.col("w.start").cast("timestamp_ntz").alias("ts"), "total_size", "delta_size", "ticks")
    )
    return label_flow(sums, cfg)


def live_blackout(bars: DataFrame, calendar: DataFrame, tf: str) -> DataFrame:
    """Stream-static left join of bars to the blackout intervals of their grid cell, on the grid or off it.

    A cell has one row with the intervals that touch it, so a bar stays one row; its own time decides.
    """
    step = tf_micros(F.lit(tf))
    start, end = micros(F.col("blackout_start_ts")), micros(F.col("blackout_end_ts"))
    spans = F.struct(start.alias("from"), end.alias("to"), F.col("impact").cast("int").alias("impact"))
    cells = calendar.where(start < end).select(spans.alias("span"), F.explode(F.sequence(F.floor(start / step), F.floor((end - 1) / step))).alias("_cell"))
    cells = cells.groupBy("_cell").agg(F.collect_list("span").alias("_spans"))
    at = micros(F.col("ts"))
    met = bars.withColumn("_cell", F.floor(at / step)).join(cells, "_cell", "left")
    hits = F.filter("_spans", lambda s: (s["from"] <= at) & (at < s["to"]))
    impact = F.array_max(F.transform(hits, lambda s: s["impact"]))
    return met.withColumns(
        {"macro_is_blackout": impact.isNotNull(), "macro_blackout_max_impact": F.coalesce(impact, F.lit(0))}
    ).select(*bars.columns, "macro_blackout_max_impact", "macro_is_blackout")


def _evidence(bars: pd.DataFrame, c: Mapping) -> pd.DataFrame:
    """The batch evidence columns over the bars at hand, for the rows of one key."""
    w, aw = max(2, c["lookback_bars"]), max(2, c["atr_window"])
    high, low, close = bars["high"], bars["low"], bars["close"]
    prev = close.shift(1)
    tr = pd.concat([high - low, (high - prev).abs(), (low - prev).abs()], axis=1).max(axis=1)
    atr = tr.rolling(aw).mean()
    hi, lo = high.rolling(w).max(), low.rolling(w).min()
    width, known = hi - lo, hi.notna() & atr.notna()
    probe = atr * c["probe_atr_mult"]
    trend = pd.concat([atr * c["trend_atr_mult"], width * c["trend_width_mult"]], axis=1).max(axis=1)
    flags = {
        "inside": (close >= lo) & (close <= hi),
        "probe_low": (lo - low).clip(lower=0.0) >= probe,
        "probe_high": (high - hi).clip(lower=0.0) >= probe,
        "reclaim_from_low": close >= lo + atr * c["reclaim_atr_mult"],
        "reclaim_from_high": close <= hi - atr * c["reclaim_atr_mult"],
        "outside_up": close >= hi + atr * c["accept_atr_mult"],
        "outside_dn": close <= lo - atr * c["accept_atr_mult"],
        "trend_far": (close - (hi + lo) / 2.0).abs() >= trend,
    }
    tests = (high >= hi - atr * c["test_atr_mult"]).astype(float) + (low <= lo + atr * c["test_atr_mult"]).astype(float)
    out = pd.DataFrame({k: v.astype(object).where(known, None) for k, v in flags.items()})
    out["dr_high"] = hi
    out["dr_width_atr"] = width / atr.where(atr != 0)
    # A test or inside flag is only known where the range is, as in the batch columns.
    out["inside_ratio"] = flags["inside"].astype(float).where(hi.notna()).rolling(w).mean()
    out["tests_count"] = tests.where(known).rolling(w).sum()
    return out


BARS_STATE = "us array<bigint>, high array<double>, low array<double>, close array<double>"
BAR_COLUMNS = ["us", "high", "low", "close"]


class PhaseProcessor(StatefulProcessor):
    """Event-time phases: bars wait in a buffer until the watermark passes them, then go through the fold in order.

    Kept per series: the waiting bars, the fold state and the last bars that evidence reads (at most twice the
    lookback). Bars in time for the watermark count wherever they arrive, later ones don't. A timer stands at the
    first waiting bar; without any, one stands ``idle`` after the last bar and clears the series. A new day starts a
    new fold, as the batch operator's day groups do.
    """

    def __init__(self, cfg: Mapping | None = None, idle_ms: int = 7 * 86_400_000):
        self.cfg, self.idle_ms = range_settings(cfg), idle_ms
        self.keep = 2 * max(2, self.cfg["lookback_bars"]) + max(2, self.cfg["atr_window"])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.fold = handle.getValueState("fold", STATE_SCHEMA)
        self.bars = handle.getValueState("bars", BARS_STATE)
        self.waiting = handle.getValueState("waiting", BARS_STATE)

    @staticmethod
    def _held(state) -> pd.DataFrame:
        columns = state.get() if state.exists() else ([], [], [], [])
        return pd.DataFrame({n: pd.Series(list(v), dtype="int64" if n == "us" else "float64") for n, v in zip(BAR_COLUMNS, columns)})

    @staticmethod
    def _keep(state, bars: pd.DataFrame) -> None:
        state.update(tuple(bars[c].tolist() for c in BAR_COLUMNS))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        old = self._held(self.bars)
        fresh = pd.concat([self._held(self.waiting), *[r[BAR_COLUMNS] for r in rows]], ignore_index=True)
        if len(old):  # what has gone through the fold is settled
            fresh = fresh[fresh["us"] > old["us"].iloc[-1]]
        self._keep(self.waiting, fresh.sort_values("us", kind="stable").drop_duplicates("us"))
        yield from self._advance(key, old, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, old = timerValues.getCurrentWatermarkInMs(), self._held(self.bars)
        waiting = self._held(self.waiting)
        if not len(waiting) and len(old) and now * 1000 >= int(old["us"].iloc[-1]) + self.idle_ms * 1000:
            for state in (self.fold, self.bars, self.waiting):
                state.clear()
            return
        yield from self._advance(key, old, now)

    def _advance(self, key, old: pd.DataFrame, watermark_ms: int) -> Iterator[pd.DataFrame]:
        """Folds the waiting bars that the watermark has passed, and sets the next timer."""
        waiting = self._held(self.waiting)
        ready = waiting[waiting["us"] <= watermark_ms * 1000]
        rest = waiting.iloc[len(ready) :]
        if len(ready):
            self._keep(self.waiting, rest)
        state = PhaseState(*self.fold.get()) if self.fold.exists() else PhaseState()
        out = []
        for day, part in ready.groupby(ready["us"] // 86_400_000_000, sort=True):
            if len(old) and old["us"].iloc[-1] // 86_400_000_000 != day:
                old, state = old.iloc[:0], PhaseState()
            bars = pd.concat([old, part], ignore_index=True) if len(old) else part.reset_index(drop=True)
            evidence = _evidence(bars, self.cfg)
            evidence["us"] = bars["us"]
            new = evidence.iloc[len(old) :]
            folded = [step(state, b, self.cfg) for b in bar_dicts(new[["us", *FOLD_INPUT]])]
            result = pd.DataFrame(folded, columns=PHASE_COLUMNS, dtype=object)
            result.insert(0, "us", new["us"].to_numpy())
            out.append(result)
            old = bars.iloc[-self.keep :]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(rest):
            self.handle.registerTimer(int(rest["us"].iloc[0]) // 1000)
        elif len(old):
            self.handle.registerTimer(int(old["us"].iloc[-1]) // 1000 + self.idle_ms)
        if not out:
            return
        self.fold.update(state.as_row())
        self._keep(self.bars, old)
        result = pd.concat(out, ignore_index=True)
        result.insert(0, "anchor_tf", key[1])
        result.insert(0, "instrument", key[0])
        yield result

    def close(self) -> None:
        pass


def live_phases(bars: DataFrame, cfg: Mapping | None = None, delay: str = "10 minutes", idle_ms: int = 7 * 86_400_000) -> DataFrame:
    """Range phases of arriving bars (instrument, anchor_tf, ts, high, low, close), given out once the watermark has passed a bar.

    Bars may come in any order within ``delay``; later ones are dropped, and of bars of one time the first counts.
    A series without bars for ``idle_ms`` of event time is forgotten. Needs the RocksDB state store provider to be
    set in the session.
    """
    slim = _event_time(bars).withWatermark("ts", delay).select(
        "instrument", "anchor_tf", "ts", F.unix_micros("ts").alias("us"), "high", "low", "close"
    )
    return slim.groupBy("instrument", "anchor_tf").transformWithStateInPandas(
        statefulProcessor=PhaseProcessor(cfg, idle_ms),
        outputStructType="instrument string, anchor_tf string, us bigint, " + PHASE_SCHEMA,
        outputMode="append",
        timeMode="eventTime",
    )


def drain(stream: DataFrame, spark, name: str, mode: str = "append", options: Mapping | None = None) -> DataFrame:
    """Run a stream over what is available into Parquet files and read them back.

    Files and checkpoint lie in the shared folder, so a restart goes on where it stopped.
    In append mode buckets that the watermark has not passed are still open and missing.
    """
    folder = shared_folder(spark, name)
    query = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .options(**(options or {}))
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")
