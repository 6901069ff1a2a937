"""Order statistics over the last n rows, from a sorted buffer that each row enters and leaves once."""

from __future__ import annotations

import bisect
import math
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from .rolling import DAY


def nearest_ranks(values: Sequence[float | None], n: int, asked: Sequence[tuple[float, int]]) -> list[list[float | None]]:
    """For each (q, m): at every row the element nearest to rank q * (count - 1) of the last n rows' values, null below m of them. NaN counts as null."""
    held: list[float] = []
    found: list[list[float | None]] = [[] for _ in asked]
    for k, value in enumerate(values):
        if k >= n and values[k - n] is not None:
            del held[bisect.bisect_left(held, values[k - n])]
        if value is not None:
            bisect.insort(held, value)
        count = len(held)
        for (q, m), out in zip(asked, found):
            out.append(held[min(count - 1, math.floor(q * (count - 1) + 0.5))] if count and count >= m else None)
    return found


def sliding_quantiles(
    df: DataFrame, asked: Mapping[str, tuple[Column, float, int, int | None]], by: Sequence[str] = DAY, order: Sequence[str] = ("ts",)
) -> DataFrame:
    """df with quantile columns: out → (x, q, n, m), the element nearest to rank q * (count - 1) of the last n rows, at a cost of log n a row; quantiles of one (x, n) share a buffer.

    ``by`` groups must be bounded: each is one Arrow table.
    """
    inputs: dict[tuple[str, int], list[str]] = {}
    columns = {}
    for out, (x, _, n, _) in asked.items():
        columns.setdefault(str(x), (f"_x{len(columns)}", x))
        inputs.setdefault((str(x), n), []).append(out)
    df = df.withColumns({name: x.cast("double") for name, x in columns.values()})
    drop = [name for name, _ in columns.values()]
    rest = [c for c in df.columns if c not in drop]
    schema = T.StructType([*df.select(*rest).schema.fields, *[T.StructField(out, T.DoubleType()) for out in asked]])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in order])
        found = {}
        for (x, n), outs in inputs.items():
            values = [None if v is None or v != v else v for v in table[columns_by_name[x]].to_pylist()]
            wanted = [(asked_by_name[o][0], n if asked_by_name[o][1] is None else asked_by_name[o][1]) for o in outs]
            found |= dict(zip(outs, nearest_ranks(values, n, wanted)))
        table = table.drop_columns(drop)
        for out in asked_by_name:
            table = table.append_column(out, pa.array(found[out], pa.float64()))
        return table

    columns_by_name = {x: name for x, (name, _) in columns.items()}
    asked_by_name = {out: (q, m) for out, (_, q, _, m) in asked.items()}
    return df.groupBy(*by).applyInArrow(run, schema)
