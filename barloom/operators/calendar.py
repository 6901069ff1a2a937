"""Event calendar: import, blackout intervals, flags on bars, regime."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import clip, column_or, map_values, sha1_id
from ..functions.timegrid import from_micros, micros, tf_micros
from .bars import keep_last
from .conform import require_columns

CANONICAL = {
    "event_id": "string",
    "event_ts": "timestamp",
    "blackout_start_ts": "timestamp",
    "blackout_end_ts": "timestamp",
    "currency": "string",
    "impact": "string",
    "name": "string",
    "source": "string",
    "raw_start": "string",
}

# Columns a stored calendar must have.
REQUIRED = ("event_id", "event_ts", "currency", "impact", "blackout_start_ts", "blackout_end_ts")

# Header names of the vendor CSV, and start formats in the order they are tried.
CSV_HEADERS = {"Start": "raw_start", "Name": "name", "Impact": "impact", "Currency": "currency"}
START_FORMATS = (
    "M/d/yyyy H:m",
    "M/d/yyyy H:m:s",
    "d/M/yyyy H:m",
    "d/M/yyyy H:m:s",
    "yyyy-M-d H:m",
    "yyyy-M-d H:m:s",
)


def impact_level(impact: Column) -> Column:
    """Impact label or number text as int 0-3; unknown text is 0."""
    text = F.upper(F.trim(impact.cast("string")))
    return (
        F.when(text.isin("HIGH", "H", "3"), 3)
        .when(text.isin("MEDIUM", "MED", "M", "2"), 2)
        .when(text.isin("LOW", "L", "1"), 1)
        .otherwise(F.coalesce(text.try_cast("int"), F.lit(0)))
        .cast("int")
    )


def stored_calendar(df: DataFrame) -> DataFrame:
    """A stored calendar with UTC zone-less times, upper-case currency and int impact."""
    require_columns(df, REQUIRED, "calendar")
    numeric = dict(df.dtypes)["impact"] in ("tinyint", "smallint", "int", "bigint")
    impact = F.col("impact").cast("int") if numeric else impact_level(F.col("impact"))
    stamps = ("event_ts", "blackout_start_ts", "blackout_end_ts")
    return df.withColumns(
        {
            "event_id": F.col("event_id").cast("string"),
            "currency": F.upper(F.trim(F.col("currency").cast("string"))),
            "impact": impact,
            **{s: F.col(s).cast("timestamp_ntz") for s in stamps},
        }
    )


def parse_start(raw: Column, zone: str) -> Column:
    """Start text in one of the known formats, read in the zone, as UTC zone-less time."""
    text = F.trim(raw.cast("string"))
    local = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in START_FORMATS], text.try_cast("timestamp"))
    return F.to_utc_timestamp(local, zone).cast("timestamp_ntz")


def blackout_bounds(
    df: DataFrame, default: tuple[int, int] = (15, 15), by_impact: Mapping[str, tuple[int, int]] | None = None
) -> DataFrame:
    """[event - pre, event + post) in minutes, by impact label with a default.

    The lookup is a literal map: a handful of labels from configuration.
    """
    rules = by_impact or {}

    def minutes(side: int) -> Column:
        value = F.lit(default[side])
        for label, rule in rules.items():
            value = F.when(F.col("impact") == label, F.lit(rule[side])).otherwise(value)
        return value.cast("long") * 60_000_000

    us = micros(F.col("event_ts"))
    return df.withColumns(
        {"blackout_start_ts": from_micros(us - minutes(0)), "blackout_end_ts": from_micros(us + minutes(1))}
    )


def import_calendar(
    raw: DataFrame,
    source: str,
    zone: str = "UTC",
    on_parse_fail: str = "drop",
    currency_map: Mapping[str, str] | None = None,
    impact_map: Mapping[str, str] | None = None,
    default: tuple[int, int] = (15, 15),
    by_impact: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Vendor calendar rows in canonical form, with blackout bounds and event ids.

    on_parse_fail="error" is an action: it looks for a row whose start cannot be read.
    """
    df = raw.drop("Unnamed: 0").withColumnsRenamed({k: v for k, v in CSV_HEADERS.items() if k in raw.columns})
    require_columns(df, ["raw_start", "name", "impact", "currency"], "calendar import")
    df = df.withColumns(
        {
            "event_ts": parse_start(F.col("raw_start"), zone),
            "currency": F.upper(F.trim(F.col("currency").cast("string"))),
            "impact": F.upper(F.trim(F.col("impact").cast("string"))),
            "name": F.trim(F.col("name").cast("string")),
            "source": F.lit(source),
        }
    )
    if on_parse_fail == "error":
        bad = df.where(F.col("event_ts").isNull()).select("raw_start", "name").limit(20).collect()
        if bad:
            raise ValueError(f"start cannot be read, e.g. {bad}")
    df = df.where(F.col("event_ts").isNotNull()).withColumns(
        {
            "currency": map_values(F.col("currency"), currency_map or {}),
            "impact": map_values(F.col("impact"), impact_map or {}),
        }
    )
    df = blackout_bounds(df, default, by_impact)
    # ISO time: microseconds appear only when there are any.
    iso = F.when(
        micros(F.col("event_ts")) % 1_000_000 == 0, F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss")
    ).otherwise(F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    parts = [F.coalesce(F.col(c), F.lit("None")) for c in ("currency", "impact", "name", "source")]
    return df.withColumn("event_id", sha1_id(iso, *parts)).select(*CANONICAL)


def canonical_calendar(df: DataFrame) -> DataFrame:
    """Older layouts brought to the canonical columns."""
    if "ts" in df.columns and "event_ts" not in df.columns:
        df = df.withColumnRenamed("ts", "event_ts")
    return df.select(*[column_or(df, n, t).alias(n) for n, t in CANONICAL.items()])


def upsert_calendar(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Existing and incoming rows, the incoming one winning per event_id."""
    old = canonical_calendar(existing).withColumn("_batch", F.lit(0))
    new = incoming.select(*CANONICAL).withColumn("_batch", F.lit(1))
    return keep_last(old.unionByName(new), ["event_id"], F.col("_batch")).drop("_batch")


def blackout_slots(calendar: DataFrame, tf: str) -> DataFrame:
    """Grid times of one timeframe that lie in any [start, end), with the largest impact.

    Each interval is written out as its grid times and reduced at once, so the
    table has at most one row per grid time however many events overlap.
    """
    step = tf_micros(F.lit(tf))
    start, end = micros(F.col("blackout_start_ts")), micros(F.col("blackout_end_ts"))
    first = start + F.pmod(-start, step)
    slots = calendar.where(first < end).select("impact", F.explode(F.sequence(first, end - 1, step)).alias("_us"))
    return (
        slots.groupBy("_us")
        .agg(F.max("impact").cast("int").alias("macro_blackout_max_impact"))
        .select(F.lit(tf).alias("anchor_tf"), from_micros(F.col("_us")).alias("ts"), "macro_blackout_max_impact")
    )


def blackout_cells(calendar: DataFrame, tf: str) -> DataFrame:
    """Intervals by the grid cells of one timeframe that they only partly cover."""
    step = tf_micros(F.lit(tf))
    start, end = micros(F.col("blackout_start_ts")), micros(F.col("blackout_end_ts"))
    first, last = start - F.pmod(start, step), end - 1 - F.pmod(end - 1, step)
    edges = F.array_distinct(F.array(first, last))
    cells = calendar.where(start < end).select("impact", start.alias("_from"), end.alias("_to"), F.explode(edges).alias("_us"))
    return cells.where((F.col("_from") > F.col("_us")) | (F.col("_to") < F.col("_us") + step)).select(
        F.lit(tf).alias("anchor_tf"), "_us", "_from", "_to", "impact"
    )


def blackout_flags(grid: DataFrame, calendar: DataFrame, tfs) -> DataFrame:
    """macro_is_blackout and largest impact of the intervals [start, end) that hold a bar's own time.

    Equi-joins in place of a range join, without a broadcast that grows with the calendar:
    bars on the grid meet one row per grid time. Bars off the grid meet the cells of their
    grid: those that an interval covers whole, and those that one covers in part, where
    the bar's own time decides.
    """
    slots, cells, steps = None, None, None
    for tf in tfs:
        slot, cell = blackout_slots(calendar, tf), blackout_cells(calendar, tf)
        slots = slot if slots is None else slots.unionByName(slot)
        cells = cell if cells is None else cells.unionByName(cell)
        step = F.when(F.col("anchor_tf") == tf, tf_micros(F.lit(tf)))
        steps = step if steps is None else F.coalesce(steps, step)
    at = micros(F.col("ts"))
    placed = grid.withColumn("_us", at - F.pmod(at, steps))
    off = placed.where(F.col("_us") != at).select("anchor_tf", "ts", "_us").distinct()
    partly = (
        off.join(cells, ["anchor_tf", "_us"])
        .where((F.col("_from") <= micros(F.col("ts"))) & (micros(F.col("ts")) < F.col("_to")))
        .select("anchor_tf", "ts", "impact")
    )
    whole = off.join(covered_cells(calendar, tfs), ["anchor_tf", "_us"]).select("anchor_tf", "ts", "impact")
    inside = partly.unionByName(whole).groupBy("anchor_tf", "ts").agg(F.max("impact").cast("int").alias("macro_blackout_max_impact"))
    return grid.join(slots.unionByName(inside), ["anchor_tf", "ts"], "left").withColumns(
        {
            "macro_is_blackout": F.col("macro_blackout_max_impact").isNotNull(),
            "macro_blackout_max_impact": F.coalesce("macro_blackout_max_impact", F.lit(0)),
        }
    )


def covered_cells(calendar: DataFrame, tfs) -> DataFrame:
    """Grid cells that an interval covers whole, with the largest impact."""
    out = None
    for tf in tfs:
        step = tf_micros(F.lit(tf))
        start, end = micros(F.col("blackout_start_ts")), micros(F.col("blackout_end_ts"))
        first = start + F.pmod(-start, step)
        cells = calendar.where(first + step <= end).select("impact", F.explode(F.sequence(first, end - step, step)).alias("_us"))
        one = cells.groupBy("_us").agg(F.max("impact").alias("impact")).select(F.lit(tf).alias("anchor_tf"), "_us", "impact")
        out = one if out is None else out.unionByName(one)
    return out


def macro_regime(macro: DataFrame) -> DataFrame:
    """macro_regime_* from macro_state and impact_level."""
    state = column_or(macro, "macro_state", "string")
    impact = column_or(macro, "impact_level", "double")
    label = (
        F.when(state.isin("red_window", "pre_event", "post_event"), "event_risk")
        .when(state == "unknown", "unknown")
        .otherwise("risk_on")
    )
    return macro.where(F.col("ts").isNotNull()).select(
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        label.alias("macro_regime_id"),
        label.alias("macro_regime_label"),
        F.coalesce(clip(impact / 3.0, 0.0, 1.0), F.lit(0.0)).alias("macro_regime_confidence"),
    )


def blackout_coverage(features: DataFrame) -> DataFrame:
    """Bars, blackout bars and their percentage."""
    flagged = F.coalesce(F.sum(F.col("macro_is_blackout").cast("long")), F.lit(0))
    total = F.count(F.lit(1))
    return features.agg(
        total.alias("bars"),
        flagged.alias("blackout_bars"),
        F.when(total > 0, flagged / total * 100.0).otherwise(0.0).alias("blackout_pct"),
    )


def trades_in_blackout(trades: DataFrame, features: DataFrame) -> DataFrame:
    """Trades with the flags of their entry bar; no bar means false and 0."""
    flags = features.select(
        "instrument",
        "anchor_tf",
        F.col("ts").alias("entry_ts"),
        "macro_is_blackout",
        "macro_blackout_max_impact",
    )
    kept = trades.drop("macro_is_blackout", "macro_blackout_max_impact")
    return kept.join(flags, ["instrument", "anchor_tf", "entry_ts"], "left").withColumns(
        {
            "macro_is_blackout": F.coalesce("macro_is_blackout", F.lit(False)),
            "macro_blackout_max_impact": F.coalesce("macro_blackout_max_impact", F.lit(0)),
        }
    )
