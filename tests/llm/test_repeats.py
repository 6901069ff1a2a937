import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from barloom.llm.passages import remove_passages
from barloom.llm.substrings import common_prefixes, refine, remove_substrings, repeated_starts, sort_suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_bytes(docs, size):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[k : k + size] for t in texts for k in range(len(t) - size + 1))
    out = []
    for (i, _), t in zip(docs, texts):
        gone = bytearray(len(t))
        for k in range(len(t) - size + 1):
            if seen[t[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        spans = len(re.findall(b"\1+", gone))
        out.append((i, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


def brute_words(docs, size):
    low = float("-inf")
    texts = [(low if i is None else i, WORD.findall(t or "")) for i, t in docs]
    first = {}
    for i, w in texts:
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, (i, k)), (i, k))
    out = []
    for (i, _), (own, w) in zip(docs, texts):
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < (own, k):
                gone[k : k + size] = [True] * size
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


def corpus(rng, n, words):
    bag = [f"w{k}" for k in range(words)] + ["Éa", "日本"]
    text = lambda m: " ".join(rng.choice(bag) for _ in range(m))
    shared = [text(rng.randrange(3, 60)) for _ in range(8)]
    docs = []
    for k in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.3 else text(rng.randrange(12)) for _ in range(rng.randrange(6))]
        docs.append((k, " ".join(parts)))
    docs += [(900, docs[0][1]), (901, docs[0][1]), (5, docs[5][1]), (6, docs[6][1] + " w1"), (902, None), (903, ""), (904, "a " * 700), (905, "a " * 701), (None, shared[0] * 2), (906, text(4000))]
    rng.shuffle(docs)
    return docs


def rows(df):
    return sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("words", [2, 400])
def test_bytes(spark, words):
    docs = corpus(random.Random(words), 120, words)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as shard", "2 as bucket").repartition(3)
    for size, seed in ((200, 40), (24, 5)):
        want = brute_bytes(docs, size)
        assert rows(remove_substrings(d, size, seed)) == want
        assert rows(remove_substrings(d, size, seed, 3000, 20000)) == want
    assert remove_substrings(d.limit(0)).count() == 0


@pytest.mark.parametrize("words", [2, 400])
def test_words(spark, words):
    docs = corpus(random.Random(words + 1), 120, words)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as shard", "2 as at").repartition(3)
    for size, seed in ((20, 6), (7, 3)):
        want = brute_words(docs, size)
        assert rows(remove_passages(d, size, seed)) == want
        assert rows(remove_passages(d, size, seed, 3000, 20000)) == want
    assert remove_passages(d.limit(0)).count() == 0


def test_suffixes():
    rng = np.random.default_rng(2)
    data = np.concatenate([rng.integers(97, 99, 3000), np.tile(rng.integers(97, 120, 250), 4)]).astype(np.uint8)
    raw = data.tobytes()
    slots = sort_suffixes(data, 200)
    assert [raw[s : s + 200] for s in slots] == sorted(raw[s : s + 200] for s in range(len(raw)))
    prior, common = common_prefixes(data, np.arange(len(data), 0, -1), slots, 200)
    for i in range(0, len(raw), 7):
        if prior[i] >= 0:
            a, b = raw[i : i + 200], raw[prior[i] : prior[i] + 200]
            n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[i] == n


@pytest.mark.parametrize("length", [1, 3, 5, 8, 10, 23])
def test_candidates(length):
    rng = np.random.default_rng(length)
    for size in (0, 1, 40, 300):
        data = rng.integers(97, 100, size).astype(np.uint8)
        bounds = np.concatenate([[0], np.sort(rng.integers(0, size + 1, 3)), [size]])
        places = {}
        for a, b in zip(bounds[:-1], bounds[1:]):
            for i in range(a, b - length + 1):
                places.setdefault(data[i : i + length].tobytes(), []).append(i)
        again = {i for p in places.values() if len(p) > 1 for i in p}
        assert set(np.flatnonzero(repeated_starts(data, bounds, length))) == again
        whole = {}
        for i in range(size - length + 1):
            whole.setdefault(data[i : i + length].tobytes(), []).append(i)
        assert {i for p in whole.values() if len(p) > 1 for i in p} <= set(refine(data, length)[1])


def test_queries(spark):
    from barloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    sha = lambda x: hashlib.sha256(x).hexdigest()
    assert rows(QUERIES["op5_suffix_array"](spark, folder)) == sorted(((*r[:4], sha(r[4])) for r in brute_bytes(docs, 200)), key=str)
    assert rows(QUERIES["op10_passages"](spark, folder)) == sorted(((*r[:3], sha(r[3].encode())) for r in brute_words(docs, 20)), key=str)


def hot_line(rng, n):
    """Texts that share one line, each in other surroundings, some of which recur; and equal rows of one id."""
    text = lambda m: " ".join(f"v{rng.randrange(5000)}" for _ in range(m))
    line, other = text(12), [text(4) for _ in range(30)]
    around = lambda: rng.choice(other) if rng.random() < 0.1 else text(4)
    docs = [(k, f"{text(5)} {around()} {line} {around()} {text(5)}") for k in range(n)]
    docs += [(None, docs[0][1])] * 40 + [(7, docs[9][1])] * 3 + [(8, docs[9][1] + " x")]
    rng.shuffle(docs)
    return docs


def test_anchor_of_many_kinds_spreads(spark):
    """No bucket compares the texts around a line that all documents share; the removals stay exact."""
    import pyarrow as pa

    from barloom.llm.anchors import repeated_windows
    from barloom.llm.substrings import byte_symbols

    docs = hot_line(random.Random(4), 1500)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)

    def bounded(values, bounds, docs, starts):
        if len(values) > 30_000:
            raise ValueError("one bucket got the texts of a whole key")
        return repeated_starts(values, bounds, 24)

    def finish(table, r, v):
        return pa.table({"doc_id": table.column("doc_id")})

    assert repeated_windows(d, byte_symbols, bounded, finish, "doc_id long", 24, 5, "u1", 6000, 6000).count() == len(docs)
    assert rows(remove_substrings(d, 24, 5, 6000, 20000)) == brute_bytes(docs, 24)
    assert rows(remove_passages(d, 7, 3, 6000, 20000)) == brute_words(docs, 7)


def test_equal_rows_spread(spark):
    import pyarrow as pa

    from barloom.llm.anchors import repeated_windows
    from barloom.llm.substrings import byte_symbols

    d = spark.createDataFrame([(None, "one text of a few words " * 4)] * 600, "doc_id long, text string").repartition(3)

    def finish(table, r, v):
        return pa.table({"rows": pa.array([table.num_rows])})

    got = repeated_windows(d, byte_symbols, lambda v, b, d, s: repeated_starts(v, b, 24), finish, "rows long", 24, 5, "u1", 6000, 6000).collect()
    assert sum(r.rows for r in got) == 600 and max(r.rows for r in got) < 300


def test_few_suffixes_take_few_steps(monkeypatch):
    """Prefixes of a thousand suffixes are measured side by side, not in a handful of long lanes; the results are those of plain comparison."""
    import barloom.llm.substrings as m

    class Counting:
        steps = 0

        def __getattr__(self, name):
            Counting.steps += name == "frexp"
            return getattr(np, name)

    rng = np.random.default_rng(2)
    line = rng.integers(97, 123, 300).astype(np.uint8)
    data = np.concatenate([np.concatenate([rng.integers(97, 123, 100).astype(np.uint8), line]) for _ in range(12)])
    bounds = np.arange(0, len(data) + 1, 400)
    seen = {}
    for row in range(12):
        for k in range(row * 400, row * 400 + 201):
            seen.setdefault(data[k : k + 200].tobytes(), []).append(k)
    want = np.zeros(len(data), bool)
    want[[k for places in seen.values() if len(places) > 1 for k in places]] = True
    monkeypatch.setattr(m, "np", Counting())
    assert (m.repeated_starts(data, bounds, 200) == want).all() and want.sum() >= 12 * 101
    assert Counting.steps < 400, Counting.steps
