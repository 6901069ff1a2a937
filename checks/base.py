"""Registry, derived domain tables, and the SQL building blocks of the oracles."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.bars import ticks_to_bars, to_bars
from barloom.session import prepare

YEAR = ("instrument", "anchor_tf", "yr")


@dataclass
class Check:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}


class Data:
    """Domain tables derived from the supplied ones (see FIXTURES.md)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder.rstrip("/")
        context = spark.sparkContext
        if spark.conf.get("spark.checkpoint.dir", None) is None and context.getCheckpointDir() is None:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="checks-"))  # one machine, no folder named

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def ticks(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self.table("events").select(
            F.col("event_type").alias("instrument"),
            "ts",
            F.col("value").alias("price"),
            (1 + k % 5).cast("double").alias("size"),
            F.when(k < 50, "buy").otherwise("sell").alias("side"),
            "event_id",
        )

    def candles(self, tf: str = "M15") -> DataFrame:
        return ticks_to_bars(self.ticks(), tf, "event_id")

    def bars(self, tf: str = "M15") -> DataFrame:
        return to_bars(self.candles(tf))

    def daily_candles(self) -> DataFrame:
        """D1 candles of brands from line items; ids inside a day break ties."""
        items = self.table("lineitem").join(
            self.table("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")
        )
        ticks = items.select(
            F.col("p_brand").alias("instrument"),
            F.col("l_shipdate").alias("ts"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            F.col("l_quantity").alias("size"),
            # Order number, line number and price in cents: one number that orders a day.
            (
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100_000_000
                + F.round(F.col("l_extendedprice") * 100).cast("long") % 100_000_000
            ).alias("line_id"),
        )
        return ticks_to_bars(ticks, "D1", "line_id")

    def daily(self) -> DataFrame:
        """Daily bars; a calendar year of one series is the bounded group."""
        return to_bars(self.daily_candles()).withColumn("yr", F.year("ts"))

    def calendar(self) -> DataFrame:
        """All events as calendar entries: impact by type and value, and a blackout of 60, 30 or 15 minutes to either side, none at impact 0."""
        value = F.col("value")
        impact = F.when(
            F.col("event_type") == "error", F.when(value > 160, 3).when(value > 120, 2).when(value > 90, 1).otherwise(0)
        ).otherwise(F.when(value > 260, 2).when(value > 210, 1).otherwise(0))
        events = self.table("events").withColumn("impact", impact.cast("int"))
        gap = F.make_dt_interval(mins=F.when(F.col("impact") == 3, 60).when(F.col("impact") == 2, 30).when(F.col("impact") == 1, 15).otherwise(0))
        return events.select(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("ts").alias("event_ts"),
            (F.col("ts") - gap).alias("blackout_start_ts"),
            (F.col("ts") + gap).alias("blackout_end_ts"),
            F.lit("usd ").alias("currency"),
            "impact",
        )

    def universe(self, bars: DataFrame) -> DataFrame:
        """Instrument → cluster by name: one cluster per first letter group."""
        return bars.select("instrument").distinct().withColumn("cluster_id", F.lit("all"))


# Where a cell is cut: beside the middle, since decimal data falls exactly on it and
# two engines would then round the noise of the last bit either way.
CUT = 0.50013


def canon(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded the way ``query`` rounds them in SQL; the rest as it is."""
    scale = 10.0**digits
    return df.select(
        *[
            (F.floor(F.col(f"`{n}`") * scale + CUT) / scale).alias(n) if t == "double" else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )


def check(key: str, sql: str | None = None, digits: int = 6):
    """Register fn(Data) → DataFrame under a survey id, with its oracle."""

    def keep(fn):
        if key in CHECKS:
            raise ValueError(f"{key} is registered twice")
        CHECKS[key] = Check(lambda spark, folder: canon(fn(Data(spark, folder)), digits), sql)
        return fn

    return keep


# --- SQL side -------------------------------------------------------------------------

TICKS = """ticks AS (
  SELECT event_type AS instrument, ts, value AS price, CAST(1 + k % 5 AS DOUBLE) AS size,
         CASE WHEN k < 50 THEN 'buy' ELSE 'sell' END AS side, event_id
  FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events))"""


def bars_cte(name: str, tf: str, minutes: int) -> str:
    return f"""{name} AS (
  SELECT instrument, '{tf}' AS anchor_tf, bar AS ts, CAST(bar AS DATE) AS dt,
         first(price ORDER BY ts, event_id) AS open, max(price) AS high, min(price) AS low,
         last(price ORDER BY ts, event_id) AS close, sum(size) AS volume
  FROM (SELECT *, time_bucket(INTERVAL {minutes} MINUTE, ts) AS bar FROM ticks)
  GROUP BY instrument, bar)"""


M15 = TICKS + ", " + bars_cte("bars", "M15", 15)
H1 = TICKS + ", " + bars_cte("bars", "H1", 60)
D1 = """items AS (
  SELECT p_brand AS instrument, l_shipdate AS ts, l_extendedprice / l_quantity AS price, l_quantity AS size,
         (l_orderkey * 10 + l_linenumber) * 100000000
           + CAST(round(l_extendedprice * 100) AS BIGINT) % 100000000 AS line_id
  FROM lineitem JOIN part ON l_partkey = p_partkey),
bars AS (
  SELECT instrument, 'D1' AS anchor_tf, date_trunc('day', ts)::TIMESTAMP AS ts, CAST(ts AS DATE) AS dt,
         year(ts)::INTEGER AS yr,
         first(price ORDER BY line_id) AS open, max(price) AS high, min(price) AS low,
         last(price ORDER BY line_id) AS close, sum(size) AS volume
  FROM items GROUP BY ALL)""".replace("GROUP BY ALL", "GROUP BY instrument, date_trunc('day', ts), CAST(ts AS DATE), year(ts)")
CALENDAR = """calendar AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_ts, impact,
         ts - to_minutes(width) AS blackout_start_ts, ts + to_minutes(width) AS blackout_end_ts
  FROM (SELECT *, CASE impact WHEN 3 THEN 60 WHEN 2 THEN 30 WHEN 1 THEN 15 ELSE 0 END AS width
        FROM (SELECT *, CASE WHEN event_type = 'error' THEN CASE WHEN value > 160 THEN 3 WHEN value > 120 THEN 2 WHEN value > 90 THEN 1 ELSE 0 END
                             WHEN value > 260 THEN 2 WHEN value > 210 THEN 1 ELSE 0 END AS impact FROM events)))"""

BY_DAY = "instrument, anchor_tf, dt"
BY_YEAR = "instrument, anchor_tf, yr"
BY_ALL = "instrument, anchor_tf"


def rounded(x: str, digits: int = 6) -> str:
    return f"floor(CAST({x} AS DOUBLE) * 1e{digits}::DOUBLE + {CUT}::DOUBLE) / 1e{digits}::DOUBLE"


def query(ctes: str, body: str, doubles: str = "", digits: int = 6) -> str:
    """WITH ctes body, the named double columns rounded as canon does."""
    if doubles:
        swap = ", ".join(f"{rounded(c, digits)} AS {c}" for c in doubles.split())
        body = f"SELECT * REPLACE ({swap}) FROM ({body})"
    return f"WITH RECURSIVE {ctes} {body}" if ctes else body


def over(n: int, by: str, order: str = "ts", skip: int = 0) -> str:
    end = f"{skip} PRECEDING" if skip else "CURRENT ROW"
    return f"(PARTITION BY {by} ORDER BY {order} ROWS BETWEEN {n - 1 + skip} PRECEDING AND {end})"


def rolled(agg: str, x: str, n: int, by: str, m: int | None = None, order: str = "ts") -> str:
    w = over(n, by, order)
    m = n if m is None else m
    if agg == "stddev_samp":
        m = max(2, m)
    return f"(CASE WHEN count({x}) OVER {w} >= {m} THEN {agg}({x}) OVER {w} END)"


def mean(x, n, by, m=None):
    return rolled("avg", x, n, by, m)


def std(x, n, by, m=None):
    return rolled("stddev_samp", x, n, by, m)


def total(x, n, by, m=None):
    return rolled("sum", x, n, by, m)


def lag(x, by, n=1, order="ts"):
    fn = "lag" if n > 0 else "lead"
    return f"{fn}({x}, {abs(n)}) OVER (PARTITION BY {by} ORDER BY {order})"


def div(num: str, den: str, default: str = "0.0") -> str:
    return f"(CASE WHEN ({den}) IS NULL OR ({den}) = 0 THEN {default} ELSE ({num}) / ({den}) END)"


def true_range(by: str) -> str:
    prev = lag("close", by)
    return f"greatest(high - low, abs(high - {prev}), abs(low - {prev}))"
