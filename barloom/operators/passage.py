"""First passages: the first bar beyond a level, by the extremes of time cells.

Bars of a series are numbered once a day and packed into cells of ten minutes; a day is the list of its cells with
their extremes. A question (a trade, a level) meets one day row, the cell it starts in and the cell it ends in, so
that joined rows are in proportion to the questions, however many bars follow.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timegrid import micros

CELL_US = 600_000_000
SERIES = ["instrument", "tf_entry", "_day"]


def cell_of(ts: Column, cell_us: int = CELL_US) -> Column:
    return F.floor(micros(ts) / cell_us)


def bar_cells(candles: DataFrame, cell_us: int = CELL_US) -> tuple[DataFrame, DataFrame]:
    """(cells, days): SERIES, _cell, _bars array<(at, i, high, low)> and SERIES, _cells array<(cell, first, high, low)>, both in order.

    i counts the bars of a day from 0. A cell has one bar a second at most, a day 86 400 / cell seconds cells.
    """
    bars = candles.select(
        "instrument", F.col("tf").alias("tf_entry"), F.to_date("ts").alias("_day"), cell_of(F.col("ts"), cell_us).alias("_cell"), micros(F.col("ts")).alias("at"), "high", "low"
    )
    bars = bars.withColumn("i", F.row_number().over(W.partitionBy(*SERIES).orderBy("at")) - 1)
    packed = F.sort_array(F.collect_list(F.struct("at", "i", "high", "low")))
    cells = bars.groupBy(*SERIES, "_cell").agg(packed.alias("_bars"), F.min("i").alias("first"), F.max("high").alias("high"), F.min("low").alias("low"))
    days = cells.groupBy(*SERIES).agg(F.sort_array(F.collect_list(F.struct(F.col("_cell").alias("cell"), "first", "high", "low"))).alias("_cells"))
    return cells.select(*SERIES, "_cell", "_bars"), days


def first_passages(
    asked: DataFrame,
    candles: DataFrame,
    since: Column,
    gain: Callable[[Column, Column], Column],
    levels: dict[str, float],
    extremes: dict[str, Callable[[Column, Column], Column]],
    cell_us: int = CELL_US,
) -> DataFrame:
    """asked (instrument, tf_entry, …) with, over the bars of the day of `since` from `since` on:
    for each of levels, how many bars pass before the first whose gain(high, low) reaches it;
    for each of extremes, the largest value of its function of (high, low).

    The functions must not fall as a bar's high rises, or not rise with its low, whichever of the two they read;
    then a cell's extremes reach a level just when one of its bars does. Nulls count for nothing.
    """
    cells, days = bar_cells(candles, cell_us)
    numbers = "array<double>"

    def over(rows: Column, f) -> Column:
        return F.coalesce(F.transform(rows, lambda b: f(b["high"], b["low"]).cast("double")), F.array().cast(numbers))

    def first_beyond(rows: str, level: float) -> Column:
        return F.get(F.filter(rows, lambda b: gain(b["high"], b["low"]) >= level), F.lit(0))

    df = asked.withColumns({"_day": F.to_date(since), "_cell": cell_of(since, cell_us), "_since": micros(since)})
    df = df.join(days, SERIES, "left").join(cells, [*SERIES, "_cell"], "left")
    df = df.withColumns(
        {"_near": F.filter("_bars", lambda b: b["at"] >= F.col("_since")), "_later": F.filter("_cells", lambda c: c["cell"] > F.col("_cell"))}
    )
    found = {"_start": F.coalesce(F.get("_near", F.lit(0))["i"], F.get("_later", F.lit(0))["first"])}
    for name, f in extremes.items():
        found[name] = F.array_max(F.concat(over(F.col("_near"), f), over(F.col("_later"), f)))
    for name, level in levels.items():
        found[f"_i_{name}"] = first_beyond("_near", level)["i"]
        found[f"_at_{name}"] = first_beyond("_later", level)["cell"]
    df = df.withColumns(found).drop("_bars", "_near", "_later", "_cells")
    for name, level in levels.items():
        # one found at once asks for its own cell again: nulls would all meet in one task
        df = df.withColumn("_hit", F.when(F.col(f"_i_{name}").isNull(), F.col(f"_at_{name}"))).withColumn("_ask", F.coalesce("_hit", "_cell"))
        df = df.join(cells.withColumnRenamed("_cell", "_ask"), [*SERIES, "_ask"], "left")
        place = F.coalesce(F.col(f"_i_{name}"), F.when(F.col("_hit").isNotNull(), first_beyond("_bars", level)["i"]))
        df = df.withColumn(name, (place - F.col("_start")).cast("long")).drop("_hit", "_ask", "_bars")
    return df.select(*asked.columns, *levels, *extremes)
