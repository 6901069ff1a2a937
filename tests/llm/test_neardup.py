import random
import re

from barloom.llm.neardup import near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, weighted):
    w, seen = WORD.findall(text or ""), {}
    runs = [tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))] if w else []
    for k, r in enumerate(runs):  # copies of a run are numbered
        seen[r] = seen.get(r, 0) + 1
        runs[k] = (r, seen[r] if weighted else 0)
    return set(runs)


def brute(docs, weighted=True):
    sets = [shingles(t, weighted) for _, t in docs]
    parent = list(range(len(docs)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(docs)):
        for j in range(i):
            same = (docs[i][1] or "") == (docs[j][1] or "")
            if same or sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, least.get(root(k))) for k, (i, _) in enumerate(docs)), key=str)


def test_brute(spark):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(300)]
    docs, n = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(30, 120))]
        for _ in range(rng.randrange(1, 12)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            base = copy if rng.random() < 0.5 else base  # chains, where the ends differ
            docs.append((n, " ".join(copy)))
            n += 1
    docs += [(900, None), (901, ""), (902, "a b"), (903, "a  b"), (904, "a b c"), (None, docs[0][1]), (None, "alone"), (905, docs[3][1]), (905, docs[3][1]), (906, "x " * 9000)]
    rng.shuffle(docs)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as id", "2 as class", "3 as digest").repartition(3)
    got = sorted(((r.doc_id, r.class_id) for r in near_duplicates(d).collect()), key=str)
    assert got == brute(docs)
    assert near_duplicates(d.limit(0)).count() == 0


def test_large_group_of_mixed_distance(spark):
    """Copies at all distances from one text, so that many bucket mates lie just within or beyond the bound."""
    rng = random.Random(8)
    base, docs = [f"t{k}" for k in range(150)], []
    for n in range(220):
        copy = list(base)
        for _ in range(rng.randrange(0, 9)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(400)}"
        docs.append((n, " ".join(copy)))
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.class_id) for r in got.collect()), key=str) == brute(docs)


def copies(rng, n, words=60, most=3):
    """Texts that differ from one base, which is not among them, in 1 to `most` words."""
    base = [f"t{k}" for k in range(words)]
    out = []
    for k in range(n):
        copy = list(base)
        for at in rng.sample(range(words), rng.randrange(1, most + 1)):
            copy[at] = f"e{rng.randrange(50 * n)}"
        out.append((k, " ".join(copy)))
    return out


def test_crowds_go_to_narrower_buckets(spark, monkeypatch):
    import barloom.llm.neardup as m

    docs = copies(random.Random(4), 160) + [(1000 + i, t + " tail of one kind") for i, t in copies(random.Random(5), 60, most=6)]
    want = brute(docs)
    for crowd in (0, 4):
        monkeypatch.setattr(m, "CROWD", crowd)
        got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
        assert sorted(((r.doc_id, r.class_id) for r in got.collect()), key=str) == want


def test_difference_keys_meet_wherever_sets_are_alike():
    import numpy as np

    from barloom.llm.neardup import difference_keys

    rng, met = random.Random(6), 0
    for _ in range(400):
        lead = set(rng.sample(range(1000), rng.randrange(3, 70)))
        x = {e for e in lead if rng.random() > 0.2} | set(rng.sample(range(1000, 1100), rng.randrange(0, 14)))
        y = {e for e in x if rng.random() > 0.06} | set(rng.sample(range(1100, 1200), rng.randrange(0, 4))) | set(rng.sample(sorted(lead), rng.randrange(0, 3)))
        like = lambda a, b: len(a & b) >= 0.8 * len(a | b)
        if x and y and like(x, y) and not (like(x, lead) and like(y, lead)):
            common = np.array(rng.sample(sorted(lead | x), 3), np.uint64)
            a, b = (set(difference_keys(np.array(sorted(s), np.uint64), np.array(sorted(lead), np.uint64), common, 7, 0.8).tolist()) for s in (x, y))
            assert a & b
            met += 1
    assert met > 60


def test_pairs_grow_in_proportion(spark, monkeypatch):
    """Pairs that are compared for twice and four times the near copies of one text."""
    import barloom.llm.neardup as m

    counts, real = [], m.compared

    def counting(pairs, sets):
        counts.append(pairs.count())
        return real(pairs, sets)

    monkeypatch.setattr(m, "compared", counting)
    monkeypatch.setattr(m, "CROWD", 4)
    made = []
    for n in (300, 600, 1200):
        counts.clear()
        near_duplicates(spark.createDataFrame(copies(random.Random(9), n), "doc_id long, text string").repartition(4)).count()
        made.append(sum(counts))
    # a text meets the leaders of its bands, at most BANDS, and few others, however large the group
    assert all(pairs < (m.BANDS + m.CROWD) * n for pairs, n in zip(made, (300, 600, 1200))), made
    assert made[2] < 2.8 * made[1], made


def test_links_are_followed_once_and_rounds_carry_their_crowds(spark, monkeypatch):
    """No link between classes is followed again by a later contraction, and narrower buckets read the sets of their crowds alone."""
    import barloom.llm.neardup as m

    followed, carried, real, narrow = [], [], m.components, m.narrower

    def components(*args):
        followed.append({tuple(sorted(link)) for link in args[-1].collect()})
        return real(*args)

    def narrower(crowds, sets, similarity):
        members = {i for r in crowds.select("id", "lead").collect() for i in r}
        carried.append(({r.id for r in sets.select("id").collect()}, members))
        return narrow(crowds, sets, similarity)

    monkeypatch.setattr(m, "components", components)
    monkeypatch.setattr(m, "narrower", narrower)
    monkeypatch.setattr(m, "CROWD", 2)
    docs = copies(random.Random(4), 80, words=150, most=4)
    for k in range(10):  # pairs that form no crowd
        docs += [(500 + k, " ".join(f"p{k}_{j}" for j in range(40))), (600 + k, " ".join(f"p{k}_{j}" for j in range(41)))]
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert sorted(((r.doc_id, r.class_id) for r in got.collect()), key=str) == brute(docs)
    assert len(followed) > 1 and sum(map(len, followed)) == len(set().union(*followed))
    assert carried and all(sets == members for sets, members in carried)


def test_narrower_buckets_hold_pairs_to_compare(spark, monkeypatch):
    """Rows of narrower buckets: a crowd whose texts differ from its leader in unlike numbers of elements makes few, as most keys bring together one side alone."""
    import barloom.llm.neardup as m

    made, real = [], m.placed

    def placed(buckets, *args):
        made.append(buckets.groupBy("bucket").pivot("side", [-1, 0, 1]).count().fillna(0).collect() if "side" in buckets.columns else None)
        made.append(buckets.count())
        return real(buckets, *args)

    monkeypatch.setattr(m, "placed", placed)
    monkeypatch.setattr(m, "CROWD", 4)
    rng, docs = random.Random(14), []
    base = [f"t{k}" for k in range(60)]
    for k in range(240):
        copy = list(base)
        for at in rng.sample(range(60), 2 + k % 5):
            copy[at] = f"e{k}_{at}"
        docs.append((k, " ".join(copy)))
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert sorted(((r.doc_id, r.class_id) for r in got.collect()), key=str) == brute(docs)
    rows, later = made[1::2], made[2::2]
    assert len(rows) > 1 and sum(rows[1:]) < 240, rows
    for buckets in later:
        assert all(r["0"] > 1 or r["-1"] and r["1"] for r in buckets)


def test_sided_keys_meet_across():
    """Similar sets share a key in which both are of one class, or one is of the lower and one of the higher."""
    import numpy as np

    from barloom.llm.neardup import sided_keys

    rng, met = random.Random(15), 0
    for _ in range(400):
        lead = set(rng.sample(range(1000), rng.randrange(3, 70)))
        x = {e for e in lead if rng.random() > 0.2} | set(rng.sample(range(1000, 1100), rng.randrange(0, 14)))
        y = {e for e in x if rng.random() > 0.06} | set(rng.sample(range(1100, 1200), rng.randrange(0, 4)))
        like = lambda a, b: len(a & b) >= 0.8 * len(a | b)
        if x and y and like(x, y) and not (like(x, lead) and like(y, lead)):
            common = np.array(rng.sample(sorted(lead | x), 3), np.uint64)
            one, two = (dict(zip(*map(np.ndarray.tolist, sided_keys(np.array(sorted(s), np.uint64), np.array(sorted(lead), np.uint64), common, 7, 0.8)))) for s in (x, y))
            assert any(one[k] + two[k] == 0 for k in one.keys() & two.keys())
            met += 1
    assert met > 60


def test_unweighted(spark):
    docs = copies(random.Random(7), 40) + [(500, "a b c d e " * 30), (501, "a b c d e " * 10)]
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), weighted=False)
    assert sorted(((r.doc_id, r.class_id) for r in got.collect()), key=str) == brute(docs, weighted=False)


def test_weighted(spark):
    docs = [(1, "a b c d e " * 30), (2, "a b c d e " * 29), (3, "a b c d e " * 10)]
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), weighted=True)
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 1), (3, 3)]


def test_query(spark):
    from barloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op6_minhash"](spark, folder).collect()), key=str) == brute(docs)


def test_texts_of_one_id_stay_apart(spark):
    rng = random.Random(12)
    text = lambda: " ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(50)) for _ in range(60))
    docs = []
    for k in range(20):
        base = text()
        docs += [(1, base), (100 + k, base + " more"), (None, base + " else")]  # twenty unlike texts of id 1
    docs += [(None, text())] * 2
    rng.shuffle(docs)
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert sorted(((r.doc_id, r.class_id) for r in got.collect()), key=str) == brute(docs)


def test_stage_keeps_texts_of_one_id(spark):
    import corpus_pipeline as p

    rng = random.Random(13)
    a, b, c, d = (" ".join(f"w{rng.randrange(900)}" for _ in range(60)) for _ in range(4))
    docs = [(1, a), (1, b), (1, b), (2, b + " x"), (3, c), (None, c), (None, d), (None, c + " x"), (4, a + " y")]
    kept = p.near_dups(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(2), "")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, a), (1, b), (3, c), (None, d)], key=str)
