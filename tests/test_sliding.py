"""Sliding order statistics and numbering over the whole table."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from barloom.functions.sliding import nearest_ranks, sliding_quantiles
from barloom.operators.blocks import number_all
from barloom.session import cut_lineage


def brute(values, n, q, m):
    out = []
    for k in range(len(values)):
        held = sorted(v for v in values[max(0, k - n + 1) : k + 1] if v is not None)
        out.append(held[int(q * (len(held) - 1) + 0.5)] if held and len(held) >= m else None)
    return out


@pytest.mark.parametrize("n", [1, 2, 9, 200])
def test_ranks_as_sorted_lists(n):
    rng = random.Random(n)
    values = [None if rng.random() < 0.2 else rng.choice([1.0, 2.0, rng.random()]) for _ in range(300)]
    for q, m in ((0.0, 1), (0.33, 4), (0.5, 2), (1.0, n)):
        assert nearest_ranks(values, n, [(q, m)])[0] == brute(values, n, q, m)


def test_quantiles_of_groups(spark):
    rng = random.Random(1)
    rows = [(g, k, None if rng.random() < 0.1 else rng.gauss(0, 1)) for g in "abc" for k in range(120)]
    df = spark.createDataFrame(rows, "g string, ts int, x double").repartition(5)
    asked = {"lo": (F.col("x"), 0.2, 20, 5), "hi": (F.col("x"), 0.8, 20, None), "neg": (-F.col("x"), 0.5, 7, 1)}
    out = sliding_quantiles(df, asked, ["g"])
    assert out.columns == ["g", "ts", "x", "lo", "hi", "neg"]
    got = sorted(map(tuple, out.collect()), key=lambda r: (r[0], r[1]))
    for g in "abc":
        own = [r for r in got if r[0] == g]
        x = [r[2] for r in own]
        assert [r[3] for r in own] == brute(x, 20, 0.2, 5)
        assert [r[4] for r in own] == brute(x, 20, 0.8, 20)
        assert [r[5] for r in own] == brute([None if v is None else -v for v in x], 7, 0.5, 1)


def test_places_in_a_total_order(spark):
    df = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(977)).alias("a"), "id").repartition(7)
    out = number_all(df, ["a", "id"], "n", cut_lineage)
    assert [r.n for r in out.orderBy("a", "id").collect()] == list(range(5000))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan.replace("BroadcastExchange", "")
    assert number_all(df.limit(0), ["a", "id"], "n", cut_lineage).count() == 0
