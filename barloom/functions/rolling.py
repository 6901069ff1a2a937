"""Aggregates over the last n rows of an ordered series.

A frame always counts rows, skips nulls, and gives null until it holds at least
``m`` non-null values. All windows that share ``by`` and ``order`` share one
exchange and one sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY = ("instrument", "anchor_tf", "dt")


class Rows:
    def __init__(self, by: Sequence[str] = DAY, order: Sequence[str] = ("ts",)):
        self.spec = W.partitionBy(*by).orderBy(*order)
        self.whole = W.partitionBy(*by)

    def last(self, n: int, skip: int = 0):
        """Frame of n rows ending ``skip`` rows before the current one."""
        return self.spec.rowsBetween(-(n - 1) - skip, -skip)

    def next(self, n: int):
        return self.spec.rowsBetween(1, n)

    def around(self, left: int, right: int):
        return self.spec.rowsBetween(-left, right)

    @property
    def so_far(self):
        return self.spec.rowsBetween(W.unboundedPreceding, 0)

    @property
    def before(self):
        return self.spec.rowsBetween(W.unboundedPreceding, -1)

    def _rolled(self, agg, x: Column, n: int, m: int | None, skip: int = 0) -> Column:
        frame = self.last(n, skip)
        return F.when(F.count(x).over(frame) >= (n if m is None else m), agg(x).over(frame))

    def mean(self, x: Column, n: int, m: int | None = None) -> Column:
        return self._rolled(F.avg, x, n, m)

    def std(self, x: Column, n: int, m: int | None = None) -> Column:
        """Sample standard deviation."""
        return self._rolled(F.stddev_samp, x, n, max(2, n if m is None else m))

    def sum(self, x: Column, n: int, m: int | None = None) -> Column:
        return self._rolled(F.sum, x, n, m)

    def max(self, x: Column, n: int, m: int | None = None, skip: int = 0) -> Column:
        return self._rolled(F.max, x, n, m, skip)

    def min(self, x: Column, n: int, m: int | None = None, skip: int = 0) -> Column:
        return self._rolled(F.min, x, n, m, skip)

    def count(self, x: Column, n: int) -> Column:
        return F.count(x).over(self.last(n))

    def shift(self, x: Column, n: int = 1) -> Column:
        """n > 0 looks back, n < 0 looks forward."""
        if n == 0:
            return x
        return F.lag(x, n).over(self.spec) if n > 0 else F.lead(x, -n).over(self.spec)

    def diff(self, x: Column) -> Column:
        return x - self.shift(x)

    def pct_change(self, x: Column) -> Column:
        prev = self.shift(x)
        return F.when(prev != 0, x / prev - 1)

    def forward_fill(self, x: Column) -> Column:
        return F.last(x, ignorenulls=True).over(self.so_far)

    def row(self) -> Column:
        """Zero-based row number."""
        return F.row_number().over(self.spec) - 1

    def true_range(self, high="high", low="low", close="close") -> Column:
        prev = self.shift(F.col(close))
        return F.greatest(
            F.col(high) - F.col(low),
            F.abs(F.col(high) - prev),
            F.abs(F.col(low) - prev),
        )


def long_frames(
    df: DataFrame,
    frames: Mapping[str, tuple[str, Column, int, int | None]],
    by: Sequence[str] = DAY,
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """Means and deviations over the last n rows at a cost that doesn't depend on n.

    frames: out → ("mean" or "std", x, n, m), as Rows.mean and Rows.std. Rows are cut
    into blocks of n; a frame is the end of one block and the start of the next, so
    that running counts, means and variances from both sides are merged and nothing
    is ever subtracted. ``by`` groups must be bounded, as for any window.
    """
    spec = W.partitionBy(*by).orderBy(*order)
    sizes = sorted({n for _, _, n, _ in frames.values()})
    df = df.withColumn("_at", F.row_number().over(spec) - 1).withColumns({f"_at{n}": F.floor(F.col("_at") / n) for n in sizes})
    inputs = {}  # each (x, n) once
    for kind, x, n, _ in frames.values():
        name, held = inputs.setdefault((str(x), n), (f"_w{len(inputs)}", [x, False]))
        held[1] |= kind == "std"
    first, columns = {}, {}
    for (_, n), (name, (x, deviations)) in inputs.items():
        inside = W.partitionBy(*by, f"_at{n}")
        for side, order_by in (("a", [F.col(c) for c in order]), ("b", [F.col(c).desc() for c in order])):
            frame = inside.orderBy(*order_by).rowsBetween(W.unboundedPreceding, 0)
            columns |= {f"{name}{side}n": F.count(x).over(frame), f"{name}{side}m": F.avg(x).over(frame)}
            if deviations:  # means as distances from a row's value, so that equal values give exactly that value
                first[f"{name}{side}f"] = F.first(x, ignorenulls=True).over(frame)
                own = F.col(f"{name}{side}f")
                columns |= {f"{name}{side}m": F.avg(x - own).over(frame) + own, f"{name}{side}v": F.var_pop(x).over(frame)}
    df = df.withColumns(first).withColumns(columns)
    earlier = {}
    for (_, n), (name, (_, deviations)) in inputs.items():
        reaches = (F.col("_at") >= n) & (F.col("_at") % n != n - 1)  # else the block's start is all
        for part in "nmv" if deviations else "nm":
            earlier[f"{name}b{part}"] = F.when(reaches, F.lag(f"{name}b{part}", n - 1).over(spec)) if n > 1 else F.lit(None).cast("double")
    df = df.withColumns(earlier)
    out = {}
    for result, (kind, x, n, m) in frames.items():
        name = inputs[str(x), n][0]
        parts = {side + part: F.coalesce(F.col(name + side + part), F.lit(0.0)) for side in "ab" for part in ("nmv" if kind == "std" else "nm")}
        count = parts["an"] + parts["bn"]
        # a side without rows counts for nothing
        parts |= {"am": F.when(parts["an"] > 0, parts["am"]).otherwise(parts["bm"]), "bm": F.when(parts["bn"] > 0, parts["bm"]).otherwise(parts["am"])}
        if kind == "mean":
            value, least = (parts["an"] * parts["am"] + parts["bn"] * parts["bm"]) / count, n if m is None else m
        else:
            gap = parts["am"] - parts["bm"]
            squares = parts["an"] * parts["av"] + parts["bn"] * parts["bv"] + gap * gap * parts["an"] * parts["bn"] / count
            value, least = F.sqrt(squares / (count - 1)), max(2, n if m is None else m)
        out[result] = F.when((count >= least) & (count >= (2 if kind == "std" else 1)), value)
    return df.withColumns(out).drop("_at", *[f"_at{n}" for n in sizes], *first, *columns)


def average_rank(x: Column, by: Sequence[str]) -> Column:
    """Rank with ties averaged; null stays null and takes no rank."""
    ordered = W.partitionBy(*by).orderBy(x.asc_nulls_last())
    ties = F.count(x).over(W.partitionBy(*by, x))
    return F.when(x.isNotNull(), F.rank().over(ordered) + (ties - 1) / F.lit(2.0))


def scaled_rank(x: Column, by: Sequence[str]) -> Column:
    """(average rank - 1) / (rows - 1), 0 for a single row; rows count nulls too."""
    rows = F.count(F.lit(1)).over(W.partitionBy(*by))
    return F.when(rows == 1, F.lit(0.0)).otherwise((average_rank(x, by) - 1) / (rows - 1))
