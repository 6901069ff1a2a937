"""Splitting long series, so that no series has to fit into one task.

``number_rows`` gives row numbers by time slice plus a prefix sum over slice
counts; ``in_blocks`` runs any bounded-frame function per block of rows with
copies of the neighbouring rows (a halo). Both are exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def number_rows(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    slice_by: Column,
    out: str = "_rn",
) -> DataFrame:
    """Zero-based row number per series.

    ``slice_by`` must not decrease along ``order`` and should keep a slice small
    (a day of bars, a minute of ticks): rows are only sorted within a slice. The
    prefix sum runs over one row per slice.
    """
    series = list(series)
    sliced = df.withColumn("_slice", slice_by)
    per_slice = sliced.groupBy(*series, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = W.partitionBy(*series).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_slice.select(
        *series, "_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = W.partitionBy(*series, "_slice").orderBy(*order)
    return (
        sliced.join(offsets, [*series, "_slice"])
        .withColumn(out, F.row_number().over(inside) - 1 + F.col("_offset"))
        .drop("_slice", "_offset")
    )


def number_all(df: DataFrame, order: Sequence[str], out: str, materialise: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Zero-based place of every row in a total order of the whole table.

    Rows are range partitioned by sampled bounds and sorted within partitions, where
    their place is counted; ``materialise`` (``cut_lineage``) fixes which row is where.
    Only a count for each partition goes to the driver, which adds up the partitions
    before; no task sees more than its range.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    fixed = materialise(dealt.withColumns({"_part": F.spark_partition_id(), out: inside}))
    before, offsets = 0, []
    for part, rows in sorted(map(tuple, fixed.groupBy("_part").count().collect())):
        offsets.append((part, before))
        before += rows
    starts = F.broadcast(df.sparkSession.createDataFrame(offsets, "_part int, _start long"))  # one row a partition
    return fixed.join(starts, "_part").withColumn(out, F.col(out) + F.col("_start")).drop("_part", "_start")


def in_blocks(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    fn: Callable[[DataFrame, list[str]], DataFrame],
    back: int,
    ahead: int = 0,
    block_rows: int = 4096,
    slice_by: Column | None = None,
) -> DataFrame:
    """fn(df, by) over a continuous series, evaluated block by block.

    ``back`` and ``ahead`` are how many rows before and after a row fn may read.
    fn must keep the columns of its input; it sees the halo rows, its results
    for them are dropped.
    """
    series = list(series)
    size = max(block_rows, back, ahead)
    if slice_by is None:
        slice_by = F.to_date(order[0])
    numbered = number_rows(df, series, order, slice_by)
    home = F.floor(F.col("_rn") / size).cast("long")
    pos = F.col("_rn") % size
    targets = F.array_compact(
        F.array(
            F.col("_home"),
            F.when(F.col("_pos") >= size - back, F.col("_home") + 1),
            F.when((F.col("_pos") < ahead) & (F.col("_home") > 0), F.col("_home") - 1),
        )
    )
    copies = (
        numbered.withColumns({"_home": home, "_pos": pos})
        .withColumn("_block", F.explode(targets))
        .withColumn("_own", F.col("_block") == F.col("_home"))
        .drop("_home", "_pos", "_rn")
    )
    return fn(copies, [*series, "_block"]).where("_own").drop("_own", "_block")


#: Decay over a block of rows; a carry beyond two blocks weighs its square and is lost in a double.
BLOCK_DECAY = 1e-12


def exponential_means(
    df: DataFrame,
    means: dict[str, tuple[Column, float]],
    by: Sequence[str],
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """Recursive means y0 = x0, yt = a*xt + (1-a)*y(t-1), as an affine scan.

    A mean over a block of rows is an affine map of the mean before it. Blocks are as long
    as rescaled inputs can be summed in a double, so a row is its block's running sum plus
    the carry of the block before, which needs the one before that and no more: a few
    running aggregates for each mean, and no list. ``by`` groups must be bounded (a day of
    bars, or a block of ``in_blocks`` with back = 50/a rows, by which (1-a)**back is below
    double precision). A null input leaves the mean as it was; before the first value it is
    null.
    """
    series = W.partitionBy(*by).orderBy(*order)
    so_far, earlier = series.rowsBetween(W.unboundedPreceding, 0), series.rowsBetween(W.unboundedPreceding, -1)
    counts, names = {}, {}
    for x, _ in means.values():  # rows are numbered by the values met so far, once for each input
        if str(x) not in names:
            names[str(x)] = f"_i{len(names)}"
            counts[names[str(x)]] = F.count(x).over(so_far) - 1
    df = df.withColumns(counts)
    places, local, ends, carries, final = {}, {}, {}, {}, {}
    for m, (out, (x, a)) in enumerate(means.items()):
        if a >= 1:
            local[f"_l{m}"], final[out] = F.last(x, ignorenulls=True).over(so_far), F.col(f"_l{m}")
            continue
        q, n = 1.0 - a, F.col(names[str(x)])
        size = max(1, int(math.log(BLOCK_DECAY) / math.log(q)))
        places |= {f"_b{m}": F.floor(n / size), f"_k{m}": F.pmod(n, F.lit(size))}
        k = F.col(f"_k{m}")
        scaled = F.when(n == 0, x).otherwise(x * a) * F.pow(F.lit(q), -k)
        inner = W.partitionBy(*by, f"_b{m}").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        local[f"_l{m}"] = F.when(n >= 0, F.pow(F.lit(q), k) * F.sum(scaled).over(inner))
        end = (k == size - 1) & x.isNotNull()
        ends[f"_p{m}"] = F.last(F.when(end, F.col(f"_l{m}")), ignorenulls=True).over(earlier)
        both = F.col(f"_l{m}") + q**size * F.coalesce(f"_p{m}", F.lit(0.0))
        carries[f"_c{m}"] = F.last(F.when(end, both), ignorenulls=True).over(earlier)
        final[out] = F.when(x.isNotNull(), F.col(f"_l{m}") + F.pow(F.lit(q), k + 1) * F.coalesce(f"_c{m}", F.lit(0.0)))
    kept = {out: F.last(F.col(out), ignorenulls=True).over(so_far) for out, (_, a) in means.items() if a < 1}
    for stage in (places, local, ends, carries, final, kept):
        df = df.withColumns(stage)
    return df.drop(*counts, *places, *local, *ends, *carries)
