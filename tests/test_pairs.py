"""Pair tiles: the same rows for any number of tiles, against sums per window, and the work they take."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barloom.operators import peers
from barloom.operators.peers import Panel, cell_pairs, joint_moments, pair_windows, primary_peer, top_peers

SHAPE = "cluster_id string, anchor_tf string, dt string, instrument string, ts timestamp_ntz, ret double"


def series(seed, names=9, bars=70):
    """Returns with gaps, a flat stretch, a constant stretch, twins and instruments that lack bars."""
    rng = np.random.default_rng(seed)
    market = rng.normal(size=bars)
    values = {f"i{k}": market * (k % 3 - 1) + rng.normal(size=bars) * 0.3 for k in range(names)}
    values["twin"] = values["i2"].copy()
    values["flat"] = np.where(np.arange(bars) < 40, 0.0, market)
    values["steady"] = np.where(np.arange(bars) < 40, 1e-3, -market)
    for k, name in enumerate(values):
        values[name][rng.random(bars) < 0.05 * (k % 4)] = np.nan
    return values


def rows_of(values, panel="c1", day="d", skip=()):
    stamp = np.datetime64("2025-01-01T00:00:00", "us")
    return [
        (panel, "M5", day, n, (stamp + np.timedelta64(5 * t, "m")).item(), None if math.isnan(v) else float(v))
        for n, x in values.items() for t, v in enumerate(x) if (n, t) not in skip
    ]


def brute_top(values, c):
    names, out = sorted(values), {}
    for t in range(len(values[names[0]])):
        for j in names:
            near = []
            for k in names:
                if k != j:
                    s = slice(max(0, t + 1 - c["window"]), t + 1)
                    n, cov, vx, vy = joint_moments(values[j][s], values[k][s])
                    if n >= max(2, c["min_periods"]) and vx > 0 and vy > 0 and abs(cov / math.sqrt(vx * vy)) >= c["min_abs"]:
                        near.append((-round(abs(cov / math.sqrt(vx * vy)), 9), k, cov / math.sqrt(vx * vy)))
            out[j, t] = [(k, round(r, 9)) for _, k, r in sorted(near)[: c["topk"]]]
    return out


@pytest.fixture(scope="module")
def frame(spark):
    values = series(1)
    return spark.createDataFrame(rows_of(values) + rows_of(series(2), "c2"), SHAPE).repartition(5), values


@pytest.mark.parametrize("tiles", [1, 2, 4, 30])
def test_top_peers_for_any_tiles(frame, tiles):
    c = {"window": 20, "min_periods": 8, "topk": 3, "min_abs": 0.2}
    found = top_peers(frame[0], c, tiles=tiles).where("cluster_id = 'c1'").collect()
    first = min(r.ts for r in found)
    got = {(r.instrument, int((r.ts - first).total_seconds() // 300)): [(p, round(x, 9)) for p, x in zip(r.peers, r.corrs)] for r in found}
    assert got == brute_top(frame[1], c) and len(found) == len(got)


@pytest.mark.parametrize("method, ddof", [("max_abs_corr", 1), ("min_resid_var", 0)])
def test_primary_peer_for_any_tiles(frame, method, ddof):
    c = {"window": 25, "min_periods": 10, "min_corr": 0.1, "method": method, "beta_ddof": ddof}

    def run(tiles):
        keys = ("cluster_id", "instrument", "ts", "peer", "half_life")
        rows = primary_peer(frame[0], c, tiles=tiles).collect()
        return sorted((*(str(r[k]) for k in keys), *("" if r[k] is None else f"{r[k]:.7g}" for k in ("corr", "beta", "residual", "residual_z"))) for r in rows)

    one = run(1)
    assert one == run(3) == run(20)
    assert sum(r[3] != "None" for r in one) > 500


def test_residuals_by_hand(frame):
    c = {"window": 25, "min_periods": 10, "min_corr": 0.1}
    values, checked = frame[1], 0
    rows = primary_peer(frame[0], c).where("cluster_id = 'c1' AND peer IS NOT NULL").collect()
    first = min(r.ts for r in frame[0].select(F.min("ts").alias("ts")).collect())
    for r in rows:
        t = int((r.ts - first).total_seconds() // 300)
        s = slice(max(0, t - 24), t + 1)
        x, y = values[r.instrument][s], values[r.peer][s]
        both = np.isfinite(x) & np.isfinite(y)
        resid = x[both] - r.beta * y[both]
        assert r.residual == pytest.approx(resid[-1], abs=1e-12)
        if r.residual_z is not None and resid[:-1].std() > 1e-12 and resid[1:].std() > 1e-12:
            assert r.residual_z == pytest.approx((resid[-1] - resid.mean()) / resid.std(), rel=1e-6)
            phi = np.corrcoef(resid[:-1], resid[1:])[0, 1]
            if abs(phi) < 1e-9 or math.isnan(phi):  # a sign by rounding alone
                continue
            assert (r.half_life is None) == (not 0 < phi < 1)
            if r.half_life is not None and abs(math.log(2) / -math.log(phi) % 1 - 0.5) > 1e-6:
                assert r.half_life == round(-math.log(2) / math.log(phi))
            checked += 1
    assert checked > 300


def test_windows_of_any_length_without_drift():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(97, 3)) * 10.0 ** rng.integers(-6, 6, (97, 1)), rng.normal(size=(97, 2))
    y[rng.random(y.shape) < 0.2] = np.nan
    for gaps in (False, True):
        right = y if gaps else np.nan_to_num(y)
        for w in (2, 7, 30, 97, 200):
            for rows, (n, cov, vx, vy) in pair_windows(x, right, w):
                for i in range(n.shape[0]):
                    t = rows.start + i
                    for j in range(3):
                        for k in range(2):
                            m = joint_moments(x[max(0, t + 1 - w) : t + 1, j], right[max(0, t + 1 - w) : t + 1, k])
                            assert n[i, j, k] == m[0]
                            np.testing.assert_allclose([cov[i, j, k], vx[i, j, k], vy[i, j, k]], m[1:], rtol=1e-6, atol=1e-9 * max(m[2], m[3], 1e-12))


@pytest.mark.parametrize("tiles", [1, 2, 5])
def test_work_is_the_same_for_any_tiles(tiles, monkeypatch):
    """Each pair is met in one cell: pair windows over all cells don't grow with their number."""
    monkeypatch.setattr(peers, "CELLS", 20 * 9)  # sub-blocks of three columns
    names, bars, done = [f"n{k:02d}" for k in range(20)], 40, set()
    for a in range(tiles):
        for b in range(a, tiles):
            own = [n for n in names if hash(n) % tiles in (a, b)]
            rows = [(n, t, float(t), True, hash(n) % tiles, a, b) for n in own for t in range(bars)]
            if not rows:
                continue
            table = pa.table(dict(zip(("instrument", "ts", "ret", "_own", "_tile", "_a", "_b"), zip(*rows))))
            panel = Panel(table)
            met = {}
            for left, right, part, _ in cell_pairs(panel, 20):
                for j in left:
                    for k in right:
                        if j != k and (left is not right or j < k):
                            pair = frozenset((panel.names[j], panel.names[k]))
                            met[pair] = met.get(pair, 0) + part.stop - part.start
            assert not done & met.keys() and all(v == bars for v in met.values())
            done |= met.keys()
    assert len(done) == 20 * 19 // 2


def test_repeated_keys_and_empty(spark):
    rows = rows_of(series(3, names=4, bars=30))
    df = spark.createDataFrame(rows + rows[::3], SHAPE)
    c = {"window": 10, "min_periods": 4, "topk": 2, "min_abs": 0.1}
    for tiles in (1, 3):
        alike = [sorted(map(str, top_peers(x, c, tiles=tiles).collect())) for x in (df, spark.createDataFrame(rows, SHAPE))]
        assert alike[0] == alike[1]
        assert top_peers(df.limit(0), c, tiles=tiles).collect() == [] and primary_peer(df.limit(0), {"window": 10, "min_periods": 4}, tiles=tiles).collect() == []


@pytest.mark.parametrize("n, m", [(1, 1), (4, None), (4, 2), (9, 5), (60, 3), (200, 2)])
def test_long_frames_as_plain_ones(spark, n, m):
    from barloom.functions.rolling import Rows, long_frames

    df = spark.createDataFrame(rows_of(series(6, names=3, bars=61)), SHAPE).withColumn("ret", F.col("ret") + 1e6)
    by = ("instrument", "dt")
    out = long_frames(df, {"mean": ("mean", F.col("ret"), n, m), "std": ("std", F.col("ret"), n, m)}, by)
    rows = Rows(by)
    out = out.select("mean", "std", rows.mean(F.col("ret"), n, m).alias("mean_"), rows.std(F.col("ret"), n, m).alias("std_"))
    for r in out.collect():
        for got, want in ((r["mean"], r["mean_"]), (r["std"], r["std_"])):
            assert (got is None) == (want is None) and (got is None or got == pytest.approx(want, rel=1e-9, abs=1e-12))
