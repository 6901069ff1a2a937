"""Rolling statistics between the instruments of one cluster, by tiles of pairs.

All pairs of a cluster have to be looked at, but pair rows never leave a task. Instruments are dealt to tiles by a
hash of their name, and a cell of the triangular grid of tiles (a panel of bars, tile a, tile b) is one group: each
pair is met in one cell only, so that more tiles mean smaller groups and the same work. A cell keeps the sums of a
sliding window for all its pairs and hands on, for each instrument and time, the best partners it has seen; those
partial results are merged by instrument and time.

Window sums are taken without subtraction: blocks of one window's length, each window being the end of one block and
the start of the next. Pairs whose variance is tiny beside their mean square are summed anew, centred.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import settings
from .blocks import in_blocks

PANEL = ("cluster_id", "anchor_tf", "dt")
KEYS = ("cluster_id", "anchor_tf")

TOPK = {"window": 50, "min_periods": 25, "topk": 5, "min_abs": 0.5}
PRIMARY = {"window": 500, "min_periods": 166, "method": "max_abs_corr", "min_corr": 0.5, "beta_ddof": 1}

#: Window sums held at a time; variance over mean square from which sums are taken as they are.
CELLS, TRUSTED = 1 << 20, 1e-9


class Panel:
    """Times × instruments of one group, instruments in name order; rows without an instrument only state a time. Of repeated keys the largest return counts."""

    def __init__(self, table: pa.Table):
        ts = table["ts"].cast(pa.int64()).to_numpy()
        names = table["instrument"].to_numpy()
        ret = table["ret"].cast(pa.float64()).to_numpy()
        self.cell = tuple(table[c][0].as_py() for c in ("_a", "_b"))
        stamped = np.unique(ts, return_index=True)
        self.times = stamped[0]
        self.own = table["_own"].to_numpy()[stamped[1]]
        there = np.array([n is not None for n in names], bool)
        self.names = sorted(set(names[there]))
        tile = dict(zip(names[there], table["_tile"].to_numpy()[there]))
        self.tile = np.array([tile[n] for n in self.names], int)
        self.values = np.full((len(self.times), len(self.names)), np.nan)
        order = np.argsort(np.nan_to_num(ret[there], nan=-np.inf), kind="stable")
        column = {n: k for k, n in enumerate(self.names)}
        self.values[np.searchsorted(self.times, ts[there])[order], [column[n] for n in names[there][order]]] = ret[there][order]


def window_sums(terms: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    """Sums over the last len(before) rows at each row of a block, given the block before it (None: nothing)."""
    sums = np.cumsum(terms, axis=0)
    if before is not None:
        ends = np.cumsum(before[::-1], axis=0)[::-1]
        sums[: len(before) - 1] += ends[1 : len(sums) + 1]
    return sums


def joint_moments(part: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, ...]:
    """n, cov, var of the first, var of the second over the jointly finite samples of two columns, centred."""
    both = np.isfinite(part) & np.isfinite(other)
    n = both.sum()
    x, y = part[both], other[both]
    x, y = x - x[0] if n else x, y - y[0] if n else y  # a constant series becomes exactly zero
    x, y = x - x.mean() if n else x, y - y.mean() if n else y
    return n, (x @ y) / max(n, 1), (x @ x) / max(n, 1), (y @ y) / max(n, 1)


def pair_windows(left: np.ndarray, right: np.ndarray, window: int) -> Iterator[tuple[slice, tuple[np.ndarray, ...]]]:
    """(rows, (n, cov, var of left, var of right)) block by block of times; each of shape rows × left × right."""
    seen = [np.isfinite(v) for v in (left, right)]
    x, y = (np.where(m, v, 0.0) for m, v in zip(seen, (left, right)))
    p, q = (m.astype(float) for m in seen)
    whole = all((m == m[:, :1]).all() for m in seen) and (seen[0][:, :1] == seen[1][:, :1]).all() if left.size and right.size else False
    outer = lambda a, b: a[:, :, None] * b[:, None, :]
    wide = lambda a: a[:, :, None] + np.zeros((1, 1, right.shape[1]))
    tall = lambda a: a[:, None, :] + np.zeros((1, left.shape[1], 1))
    if whole:  # all columns lack the same rows: only products need a sum for each pair
        kinds = [(p, None), (x, None), (x * x, None), (None, y), (None, y * y), (x, y)]
    else:
        kinds = [(p, q), (x, q), (x * x, q), (p, y), (p, y * y), (x, y)]

    def terms(kind: tuple, rows: slice) -> np.ndarray:
        a, b = kind
        return b[rows] if a is None else a[rows] if b is None else outer(a[rows], b[rows])

    before: list = [None] * len(kinds)
    for start in range(0, len(left), window):
        rows = slice(start, min(start + window, len(left)))
        now = [terms(k, rows) for k in kinds]
        n, sx, sxx, sy, syy, sxy = (window_sums(t, b) for t, b in zip(now, before))
        before = now
        if whole:
            n, sx, sxx, sy, syy = wide(n), wide(sx), wide(sxx), tall(sy), tall(syy)
        safe = np.maximum(n, 1.0)
        mx, my = sx / safe, sy / safe
        square_x, square_y = sxx / safe, syy / safe
        var_x, var_y, cov = square_x - mx * mx, square_y - my * my, sxy / safe - mx * my
        odd = ((var_x <= TRUSTED * square_x) & (square_x > 0)) | ((var_y <= TRUSTED * square_y) & (square_y > 0))
        for i, j, k in zip(*np.nonzero(odd)):
            first = max(0, start + i + 1 - window)
            _, cov[i, j, k], var_x[i, j, k], var_y[i, j, k] = joint_moments(left[first : start + i + 1, j], right[first : start + i + 1, k])
        yield rows, (n, cov, np.maximum(var_x, 0.0), np.maximum(var_y, 0.0))


def correlation(moments: tuple[np.ndarray, ...], least: int) -> np.ndarray:
    """cov / deviations; NaN below `least` joint samples or where a variance is zero."""
    n, cov, var_x, var_y = moments
    with np.errstate(divide="ignore", invalid="ignore"):
        corr = cov / np.sqrt(var_x * var_y)
    return np.where((n >= max(2, least)) & (var_x > 0) & (var_y > 0), corr, np.nan)


def cell_pairs(panel: Panel, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, slice, tuple[np.ndarray, ...]]]:
    """(columns, other columns, rows, moments) covering each pair of the cell once: between its two tiles, or inside its only one."""
    size = max(1, int((CELLS / window) ** 0.5))
    mine, others = (np.flatnonzero(panel.tile == t) for t in panel.cell)
    mine, others = ([x[k : k + size] for k in range(0, len(x), size)] for x in (mine, others))
    if panel.cell[0] == panel.cell[1]:
        grid = [(a, b) for k, a in enumerate(mine) for b in mine[k:]]
    else:
        grid = [(a, b) for a in mine for b in others]
    for a, b in grid:
        for rows, moments in pair_windows(panel.values[:, a], panel.values[:, b], window):
            if a is b:  # nothing with itself
                moments = (np.where(np.eye(len(a), dtype=bool), 0.0, moments[0]), *moments[1:])
            yield a, b, rows, moments


def _both_ways(a, b, rows, moments):
    """The block as seen from its columns, and from the others unless they are the same."""
    n, cov, var_x, var_y = moments
    yield a, b, moments
    if a is not b:
        yield b, a, tuple(m.transpose(0, 2, 1) for m in (n, cov, var_y, var_x))


def _own_rows(panel: Panel) -> tuple[np.ndarray, np.ndarray]:
    """Time and column numbers of the rows to give out."""
    own = np.flatnonzero(panel.own)
    return np.repeat(own, len(panel.names)), np.tile(np.arange(len(panel.names)), len(own))


def _named(panel: Panel, time: np.ndarray, column: np.ndarray) -> dict:
    return {"instrument": pa.array(panel.names, pa.string()).take(pa.array(column)), "ts": pa.array(panel.times[time]).cast(pa.timestamp("us"))}


def _topk_cell(table: pa.Table, c: Mapping) -> pa.Table:
    """Best partners of the cell's instruments at each time."""
    panel = Panel(table)
    size = c["topk"]
    shape = (len(panel.times), len(panel.names), size)
    best, who = np.full(shape, np.nan), np.full(shape, len(panel.names))
    for a, b, rows, moments in cell_pairs(panel, c["window"]):
        for cols, others, m in _both_ways(a, b, rows, moments):
            corr = correlation(m, c["min_periods"])
            corr[~(np.abs(corr) >= c["min_abs"])] = np.nan
            at = np.ix_(np.arange(rows.start, rows.stop), cols)
            value = np.concatenate([best[at], corr], axis=2)
            index = np.concatenate([who[at], np.broadcast_to(others, corr.shape)], axis=2)
            order = np.lexsort((index, np.nan_to_num(-np.abs(value), nan=np.inf)), axis=2)[:, :, :size]
            best[at], who[at] = np.take_along_axis(value, order, 2), np.take_along_axis(index, order, 2)
    time, column = _own_rows(panel)
    value, index = best[time, column], who[time, column]
    kept = ~np.isnan(value)
    offsets = pa.array(np.concatenate([[0], np.cumsum(kept.sum(axis=1))]), pa.int32())
    peers = pa.array(panel.names, pa.string()).take(pa.array(index[kept]))
    lists = {"peers": pa.ListArray.from_arrays(offsets, peers), "corrs": pa.ListArray.from_arrays(offsets, pa.array(value[kept]))}
    return pa.table({**_named(panel, time, column), **lists})


def _best_cell(panel: Panel, c: Mapping) -> tuple[np.ndarray, ...]:
    """Times × instruments: rating (-inf: none), partner, corr and beta of the best partner in the cell."""
    shape = panel.values.shape
    rating, who, best_corr, best_beta = np.full(shape, -np.inf), np.full(shape, -1), np.full(shape, np.nan), np.full(shape, np.nan)
    for a, b, rows, moments in cell_pairs(panel, c["window"]):
        for cols, others, m in _both_ways(a, b, rows, moments):
            n, cov, var_x, var_y = m
            corr = correlation(m, c["min_periods"])
            with np.errstate(divide="ignore", invalid="ignore"):
                beta = cov * (n / np.maximum(n - c["beta_ddof"], 1.0)) / var_y
                rate = -(var_x - 2 * beta * cov + beta * beta * var_y) if c["method"] == "min_resid_var" else np.abs(corr)
            rate = np.where(np.isnan(corr), -np.inf, rate)
            k = rate.argmax(axis=2)[:, :, None]
            top, index = np.take_along_axis(rate, k, 2)[:, :, 0], others[k[:, :, 0]]
            at = np.ix_(np.arange(rows.start, rows.stop), cols)
            better = (top > rating[at]) | ((top == rating[at]) & (index < who[at]) & np.isfinite(top))
            for held, new in ((rating, top), (who, index), (best_corr, np.take_along_axis(corr, k, 2)[:, :, 0]), (best_beta, np.take_along_axis(beta, k, 2)[:, :, 0])):
                held[at] = np.where(better, new, held[at])
    return rating, who, best_corr, best_beta


def residual_stats(x: np.ndarray, y: np.ndarray, rows: np.ndarray, beta: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(half-life, last residual, its z-score) of x - beta y over the joint samples of the window that ends at each of `rows`; NaN where undefined."""
    both = np.isfinite(x) & np.isfinite(y)
    upto = np.concatenate([[0], np.cumsum(both)])
    joint_x, joint_y = x[both], y[both]
    out = np.full((3, len(rows)), np.nan)
    step = max(1, CELLS // window)
    for k in range(0, len(rows), step):
        some, slope = rows[k : k + step], beta[k : k + step, None]
        first, last = upto[np.maximum(some + 1 - window, 0)], upto[some + 1]
        size = last - first
        at = first[:, None] + np.arange(size.max(initial=0))
        inside, leads = at < last[:, None], at < last[:, None] - 1
        at = np.minimum(at, len(joint_x) - 1)
        resid = joint_x[at] - slope * joint_y[at]

        def centred(values, mask):
            count = np.maximum(mask.sum(axis=1), 1)
            mean = np.where(mask, values, 0.0).sum(axis=1) / count
            return np.where(mask, values - mean[:, None], 0.0), mean, count

        off, mean, count = centred(resid, inside)
        spread = np.sqrt((off * off).sum(axis=1) / count)
        final = resid[np.arange(len(some)), np.maximum(size - 1, 0)]
        before, _, _ = centred(resid[:, :-1], leads[:, :-1])
        after, _, _ = centred(resid[:, 1:], leads[:, :-1])
        with np.errstate(divide="ignore", invalid="ignore"):
            z = (final - mean) / spread
            phi = (before * after).sum(axis=1) / np.sqrt((before * before).sum(axis=1) * (after * after).sum(axis=1))
            life = np.rint(-np.log(2) / np.log(phi))
        moved = (before != 0).any(axis=1) & (after != 0).any(axis=1)
        out[0, k : k + step] = np.where((size >= 3) & moved & (phi > 0) & (phi < 1), life, np.nan)
        out[1, k : k + step] = final
        out[2, k : k + step] = np.where((size >= 3) & (spread > 0) & np.isfinite(x[some]), z, np.nan)
    return tuple(out)


def _with_residuals(panel: Panel, time, column, who, beta, window: int) -> dict:
    """half_life, residual, residual_z of rows (time, column) with a partner (who >= 0)."""
    out = np.full((3, len(time)), np.nan)
    pair = np.where(who >= 0, column * len(panel.names) + who, -1)
    order = np.argsort(pair, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(pair[order])) + 1):
        if len(rows) and pair[rows[0]] >= 0:
            j, k = divmod(int(pair[rows[0]]), len(panel.names))
            out[:, rows] = residual_stats(panel.values[:, j], panel.values[:, k], time[rows], beta[rows], window)
    return {n: _nullable(v) for n, v in zip(("half_life", "residual", "residual_z"), out)}


def _nullable(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.float64(), mask=np.isnan(values))


def _primary_panel(table: pa.Table, c: Mapping) -> pa.Table:
    """All of a panel in one cell: the partner and its residuals at once."""
    panel = Panel(table)
    rating, who, corr, beta = _best_cell(panel, c)
    time, column = _own_rows(panel)
    at = (time, column)
    good = np.isfinite(rating[at]) & (np.abs(corr[at]) >= c["min_corr"])
    who, corr, beta = np.where(good, who[at], -1), np.where(good, corr[at], np.nan), np.where(good, beta[at], np.nan)
    peer = pa.array(panel.names, pa.string()).take(pa.array(who, mask=who < 0))
    return pa.table({**_named(panel, time, column), "peer": peer, "corr": _nullable(corr), "beta": _nullable(beta), **_with_residuals(panel, time, column, who, beta, c["window"])})


def _rated_cell(table: pa.Table, c: Mapping) -> pa.Table:
    """A cell's best partner of each instrument and time; null where it has none."""
    panel = Panel(table)
    rating, who, corr, beta = _best_cell(panel, c)
    time, column = _own_rows(panel)
    at = (time, column)
    none = ~np.isfinite(rating[at])
    peer = pa.array(panel.names, pa.string()).take(pa.array(who[at], mask=none))
    return pa.table({**_named(panel, time, column), "loss": pa.array(-rating[at], mask=none), "peer": peer, "corr": _nullable(corr[at]), "beta": _nullable(beta[at])})


def _residual_cell(chosen: pa.Table, series: pa.Table, c: Mapping) -> pa.Table:
    """Residuals of chosen partners within a cell."""
    panel = Panel(series)
    column = {n: k for k, n in enumerate(panel.names)}
    time = np.searchsorted(panel.times, chosen["ts"].cast(pa.int64()).to_numpy())
    own, who = (np.array([column[n] for n in chosen[x].to_pylist()], int) for x in ("instrument", "peer"))
    found = _with_residuals(panel, time, own, who, chosen["beta"].to_numpy(), c["window"])
    return pa.table({n: chosen[n] for n in ("instrument", "ts", "peer", "corr", "beta")} | found)


def _cells(returns: DataFrame, panel: Sequence[str], tiles: int) -> DataFrame:
    """Rows of returns in every cell of their tile, and a row without an instrument for each time of a panel in each cell, so that a cell counts the panel's bars."""
    if "_own" not in returns.columns:
        returns = returns.withColumn("_own", F.lit(True))
    group = list(dict.fromkeys([*KEYS, *panel]))
    rows = returns.select(*group, "instrument", "ts", F.col("ret").cast("double").alias("ret"), "_own")
    if tiles == 1:
        return rows.withColumns({"_tile": F.lit(0), "_a": F.lit(0), "_b": F.lit(0)})
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    rows = rows.withColumn("_tile", _tile(F.col("instrument"), tiles)).withColumn("_a", other)
    rows = rows.withColumns({"_a": F.least("_a", "_tile"), "_b": F.greatest("_a", "_tile")})
    times = returns.groupBy(*group, "ts").agg(F.max("_own").alias("_own")).withColumn("_a", other)
    times = times.withColumn("_b", F.explode(F.sequence(F.col("_a"), F.lit(tiles - 1))))
    return rows.unionByName(times, allowMissingColumns=True)


def _tile(name, tiles: int):
    return F.pmod(F.xxhash64(name), F.lit(tiles)).cast("int")


def _per_cell(cells: DataFrame, panel: Sequence[str], fn, schema: str) -> DataFrame:
    """fn per cell; key columns are put back on the rows."""
    group = list(dict.fromkeys([*KEYS, *panel]))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        return _keyed(fn(table), key)

    return cells.groupBy(*group, "_a", "_b").applyInArrow(run, schema + ", cluster_id string, anchor_tf string")


def _keyed(out: pa.Table, key: tuple) -> pa.Table:
    for name, k in zip(KEYS, key):
        out = out.append_column(name, pa.repeat(k, len(out)).cast(pa.string()))
    return out


def top_peers(returns: DataFrame, cfg: Mapping | None = None, panel: Sequence[str] = PANEL, tiles: int = 1) -> DataFrame:
    """Peers of each (instrument, ts) by |correlation| over the last bars of the panel.

    returns: cluster_id, anchor_tf, dt, instrument, ts, ret. Gives arrays peers
    and corrs, strongest first, ties by name.
    """
    c = settings(TOPK, cfg)
    found = _per_cell(
        _cells(returns, panel, tiles),
        panel,
        lambda table: _topk_cell(table, c),
        "instrument string, ts timestamp_ntz, peers array<string>, corrs array<double>",
    )
    if tiles == 1:
        return found
    ranked = F.transform(F.arrays_zip("peers", "corrs"), lambda p: F.struct((-F.abs(p["corrs"])).alias("loss"), p["peers"].alias("peer"), p["corrs"].alias("corr")))
    merged = found.withColumn("_top", ranked).groupBy("instrument", "ts", *KEYS).agg(F.slice(F.sort_array(F.flatten(F.collect_list("_top"))), 1, c["topk"]).alias("_top"))
    return merged.select("instrument", "ts", F.col("_top.peer").alias("peers"), F.col("_top.corr").alias("corrs"), *KEYS)


def primary_peer(returns: DataFrame, cfg: Mapping | None = None, panel: Sequence[str] = PANEL, tiles: int = 1) -> DataFrame:
    """Best peer with hedge ratio, residual, residual z-score and its half-life.

    With the default beta_ddof the hedge ratio is the sample covariance over the
    population variance; 0 gives the usual least-squares slope. With several tiles
    the best of each cell are merged, and residuals are taken for the chosen pairs alone.
    """
    c = settings(PRIMARY, cfg)
    cells = _cells(returns, panel, tiles)
    schema = "instrument string, ts timestamp_ntz, peer string, corr double, beta double, half_life double, residual double, residual_z double"
    life = F.col("half_life").cast("long")
    if tiles == 1:
        return _per_cell(cells, panel, lambda table: _primary_panel(table, c), schema).withColumn("half_life", life)
    group = list(dict.fromkeys([*KEYS, *panel]))
    rated = _per_cell(cells, panel, lambda table: _rated_cell(table, c), "instrument string, ts timestamp_ntz, loss double, peer string, corr double, beta double")
    best = rated.groupBy("instrument", "ts", *KEYS).agg(F.min(F.when(F.col("loss").isNotNull(), F.struct("loss", "peer", "corr", "beta"))).alias("_best"))
    good = best.select("instrument", "ts", *KEYS, "_best.peer", "_best.corr", "_best.beta").where(F.abs("corr") >= c["min_corr"])
    places = returns.select(*group, "instrument", "ts", *(["_own"] if "_own" in returns.columns else [])).where("_own" if "_own" in returns.columns else F.lit(True))
    homes = places.select(*group, "ts").distinct()
    own, other = (_tile(F.col(n), tiles) for n in ("instrument", "peer"))
    chosen = good.join(homes, [*KEYS, "ts"]).withColumns({"_a": F.least(own, other), "_b": F.greatest(own, other)})

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _keyed(_residual_cell(left, right, c), key) if len(left) else _none(schema)

    pairs = chosen.groupBy(*group, "_a", "_b").cogroup(cells.groupBy(*group, "_a", "_b")).applyInArrow(run, schema + ", cluster_id string, anchor_tf string")
    keys = ["instrument", "ts", *KEYS]
    return best.select(*keys).join(pairs, keys, "left").withColumn("half_life", life)


def _none(schema: str) -> pa.Table:
    kinds = {"string": pa.string(), "double": pa.float64(), "timestamp_ntz": pa.timestamp("us")}
    fields = [f.split() for f in (schema + ", cluster_id string, anchor_tf string").split(", ")]
    return pa.table({n: pa.array([], kinds[k]) for n, k in fields})


def in_panel_blocks(returns: DataFrame, fn, window: int, block_bars: int = 512) -> DataFrame:
    """fn(returns, panel) for a continuous history: blocks of bar times with a halo.

    Blocks are counted over the distinct times of a cluster, so that "the last w
    bars" means the same bars for every instrument.
    """
    keys = ["cluster_id", "anchor_tf"]
    stamps = returns.select(*keys, "ts").distinct()

    def with_returns(times: DataFrame, by: list[str]) -> DataFrame:
        panels = times.join(returns, [*keys, "ts"])
        found = fn(panels, by)
        return times.where("_own").join(found, [*keys, "ts"])

    return in_blocks(stamps, keys, ["ts"], with_returns, back=window, block_rows=block_bars)


def neighbours_json(peers, corrs):
    """JSON list of {peer, corr, lag} with lag 0; null when there is no peer."""
    pairs = F.zip_with(
        peers, corrs, lambda p, r: F.struct(p.alias("peer"), r.alias("corr"), F.lit(0).alias("lag"))
    )
    return F.when(F.size(peers) > 0, F.to_json(pairs))
