import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barloom.llm.language_model import PRIOR, score_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), 0]


def brute(docs):
    one, two, begun = Counter(), Counter(), 0
    for _, text, trains in docs:
        if trains:
            t = tokens(text)
            one.update(t)
            two.update(zip([None, *t], t))
            begun += 1
    n, v = sum(one.values()), len(one)
    out = []
    for i, text, _ in docs:
        t = tokens(text)
        p = [(one[w] + 1) / (n + v + 1) for w in t]
        base = sum(map(math.log10, p))
        score = 0.0
        for u, w, q in zip([None, *t], t, p):
            c = begun if u is None else one[u]
            score += math.log10((two[u, w] + PRIOR * q) / (c + PRIOR))
        out.append((i, len(t), sum(one[w] > 0 for w in t), n, pytest.approx(base, rel=1e-9), pytest.approx(score, rel=1e-9)))
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def test_brute(spark):
    rng = random.Random(7)
    docs = [(k, " ".join(rng.choice(["the", "The", "of", "Éa", "b\tc", f"r{rng.randrange(200)}"]) for _ in range(rng.randrange(40))), k % 3 != 0) for k in range(200)]
    docs += [(300, None, True), (301, "", False), (302, "zz zz", False), (None, "the of", True), (303, "Q " * 5000, True)]
    d = spark.createDataFrame(docs, "doc_id long, text string, learn boolean").selectExpr("*", "1 as shard", "'x' as trains").repartition(3)
    want = sorted(brute(docs), key=lambda r: (r[0] is not None, r[0] or 0))
    assert rows(score_texts(d, F.col("learn"))) == want
    assert rows(score_texts(d, F.col("learn"), 900, 1500)) == want
    assert score_texts(d.limit(0), F.col("learn")).count() == 0


def test_no_training(spark):
    d = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert rows(score_texts(d, F.lit(None).cast("boolean"))) == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]


def test_query(spark):
    from barloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 7 != 2) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = {r.doc_id: r for r in QUERIES["op4_language_model"](spark, folder).collect()}
    for want, (_, _, trains) in zip(brute(docs), docs):
        r = got[want[0]]
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == want and r.held_out != trains
