"""State machines over the ordered rows of a bounded group, as column expressions.

A group is one row with the array of its bars; ``scan`` carries a small state over it and gives one result for each
bar, which is exploded once. Results are gathered in chunks, so that the cost of a growing list stays that of a chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Results gathered in one list before it is put away.
CHUNK = 64


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def updated(state: Column, names: Sequence[str], when: Column, changes: Mapping[str, Column]) -> Column:
    """The state with some fields changed where the condition holds (null: no)."""
    return F.when(when, F.struct(*[changes.get(n, state[n]).alias(n) for n in names])).otherwise(state)


def scan(rows: Column, start: Column, state: str, result: str, step: Callable[[Column, Column], Column]) -> Column:
    """Array of results, one for each of rows; step(state, row) gives struct(state, result). state and result are struct types; rows is not empty."""
    inner, outer = f"struct<state:{state},out:array<{result}>>", f"struct<state:{state},out:array<array<{result}>>>"

    def one(acc: Column, row: Column) -> Column:
        return let(step(acc["state"], row), lambda x: F.struct(x["state"].alias("state"), F.concat(acc["out"], F.array(x["result"])).alias("out")).cast(inner))

    def chunk(acc: Column, part: Column) -> Column:
        begin = F.struct(acc["state"].alias("state"), F.array().cast(f"array<{result}>").alias("out")).cast(inner)
        return let(F.aggregate(part, begin, one), lambda x: F.struct(x["state"].alias("state"), F.concat(acc["out"], F.array(x["out"])).alias("out")).cast(outer))

    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / CHUNK).cast("int")), lambda k: F.slice(rows, k * CHUNK + 1, F.lit(CHUNK)))
    begin = F.struct(start.alias("state"), F.array().cast(f"array<array<{result}>>").alias("out")).cast(outer)
    return F.flatten(F.aggregate(parts, begin, chunk)["out"])


def scanned(df: DataFrame, by: Sequence[str], order: str, start: Column, state: str, result: str, step: Callable[[Column, Column], Column]) -> DataFrame:
    """df with the fields of step's results on each row: groups of ``by``, which must be bounded, in the order of ``order``."""
    by = list(by)
    rest = [c for c in df.columns if c not in by]
    bars = F.sort_array(F.collect_list(F.struct(*dict.fromkeys([order, *rest]))))
    packed = df.groupBy(*by).agg(bars.alias("_bars"))
    both = F.arrays_zip(F.col("_bars").alias("bar"), scan(F.col("_bars"), start, state, result, step).alias("found"))
    rows = packed.select(*by, F.explode(both).alias("_row_"))
    return rows.select(*by, *[F.col("_row_.bar")[c].alias(c) for c in rest], "_row_.found.*")
