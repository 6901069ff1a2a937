import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm.hard_negatives import Best, blocks_of, hard_negatives, pack_planes, scores, subset_sums, unpack_planes
from barloom.llm.queries import SQL, op12_hard_negatives

SHAPE = "vec_id long, embedding array<double>, label int"


def brute(rows, every=100):
    valid = {(i, tuple(math.floor(256 * x) for x in v), k) for i, v, k in rows if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    last = lambda i: (i is None, i or 0)
    out = []
    for a in valid:
        if a[0] is None or a[0] % every:
            continue
        others = sorted(((-dot(a[1], b[1]), last(b[0]), b) for b in valid if b != a), key=lambda x: x[:2])
        for ps, _, p in [x for x in others if x[2][2] == a[2]][:5]:
            found = [x for x in others if x[2][2] != a[2] and 80 * -ps <= 100 * -x[0] <= 100 * -ps][:5]
            out += [(a[0], p[0], k + 1, n[0], -ps, -ns) for k, (ns, _, n) in enumerate(found)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(seed, n=700, wide=11, labels=4, scale=1.0):
    rng = random.Random(seed)
    vec = lambda: [rng.choice([-0.5, 0.25, rng.gauss(0, 1)]) * scale for _ in range(wide)]
    hot = vec()
    rows = [(k, hot if k % 3 == 0 else vec(), rng.randrange(labels) if k % 5 else 1) for k in range(n)]
    rows += [(n, None, 1), (n + 1, vec(), None), (n + 2, [None] + vec()[1:], 1), (n + 3, [math.nan] + vec()[1:], 1), (n + 4, [math.inf] + vec()[1:], 1)]
    rows += [(None, hot, 1), (None, hot, 2), rows[7], rows[7], rows[100], (100, vec(), 1), (-200, vec(), 2), (900, [], 1), (901, vec()[:3], 1), (1000, [1.0], 3)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, chunk", [(1, 4), (2, 1 << 14)])
def test_brute(spark, monkeypatch, seed, chunk):
    rows = made(seed)
    df = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 as id", "2 as score", "3 as slot", "4 as planes").repartition(4)
    assert rows_of(hard_negatives(df, F.col("vec_id") % 100 == 0, chunk_rows=chunk)) == brute(rows)


def test_many_labels_and_large_components(spark):
    rows = made(3, n=300, labels=200, scale=3e4)
    assert rows_of(hard_negatives(spark.createDataFrame(rows, SHAPE), F.col("vec_id") % 10 == 0)) == brute(rows, 10)
    with pytest.raises(ValueError):
        hard_negatives(spark.createDataFrame([(0, [1e30, 1.0], 1)], SHAPE), F.col("vec_id") % 10 == 0)


def test_empty(spark):
    ask = F.col("vec_id") % 100 == 0
    assert rows_of(hard_negatives(spark.createDataFrame([], SHAPE), ask)) == []
    assert rows_of(hard_negatives(spark.createDataFrame([(1, [1.0], 1)], SHAPE), ask)) == []
    assert rows_of(hard_negatives(spark.createDataFrame([(100, [1.0], 1)], SHAPE), ask)) == []
    assert rows_of(hard_negatives(spark.createDataFrame([(100, [], 1), (1, [], 1), (2, [], 2)], SHAPE), ask)) == [(100, 1, 1, 2, 0, 0)]


@pytest.mark.parametrize("most, wide", [(1, 8), (100, 64), (40_000, 20), (1 << 24, 9)])
def test_scores_are_exact(most, wide):
    rng = np.random.default_rng(most)
    a, c = rng.integers(-most, most, (7, wide)), rng.integers(-most, most, (50, wide))
    bits = most.bit_length() + 1
    planes = pack_planes(c, bits)
    assert (unpack_planes(planes)[:, :wide] == c).all()
    assert (scores(subset_sums(np.pad(a, ((0, 0), (0, -wide % 8)))), planes) == c @ a.T).all()


def test_blocks_cover():
    for labels in (np.zeros(1300), np.arange(700), np.repeat(np.arange(9), 100), np.zeros(0)):
        got = blocks_of(labels)
        assert [k for b in got for k in range(b.start, b.stop)] == list(range(len(labels))) and all(b.stop - b.start <= 512 + 64 for b in got)


def test_best_keeps_ties_by_id():
    best = Best(2, 2)
    best.add(np.array([1, 1, 0]), np.array([5, 5, 1]), np.array([9, 3, 4]))
    best.add(np.array([1]), np.array([5]), np.array([12]))
    assert best.id[1].tolist() == [3, 9] and best.score[0].tolist()[0] == 1


def test_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = con.execute(SQL["op12_hard_negatives"])
    got = op12_hard_negatives(spark, folder)
    assert got.columns == [c[0] for c in want.description]
    rows = rows_of(got)
    assert rows == sorted(want.fetchall(), key=str) and rows
