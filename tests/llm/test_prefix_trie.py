import hashlib
import random
import zlib

import duckdb
import pytest

from barloom.llm.prefix_trie import CELL, choose_splitters, common, conversation_trie, reduced, shard_nodes, skeleton_of
from barloom.llm.queries import SQL, op13_prefix_trie

SHAPE = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    return out


def brute(rows):
    paths = rebuilt(rows)
    nodes = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    kids = {p: sum(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes) for p in nodes}
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in members if paths[c] == p)))
        out.append((
            min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), kids[p], sum(not kids[q] for q in below),
            sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in below if q), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(seed, conversations=120):
    rng, rows = random.Random(seed), []
    for c in range(conversations):
        shared = rng.choice([[], ["hé", "a"], ["hé", "a", "b", "c"], ["hé", "a", "b", "d"]])
        texts = shared + [rng.choice("abc") for _ in range(rng.randrange(5))]
        rows += [(c, k, rng.choice(["user", "user", None]) if k > 3 else "user", t) for k, t in enumerate(texts)]
    rows += [(c, k, "user", t) for c in range(1000, 1060) for k, t in enumerate("xyzxyzxyzxyz")]  # copies
    rows += [(2000, None, "user", "null turn"), (2000, 1, "user", None), (2000, 1, "user", "tie"), (2000, 1, "user", "tie"), (2001, 3, None, None), (None, 1, "user", "none")]
    rows += [(2002, k, "user", "long " * 20000) for k in range(3)] + [(2005, k, "user", str(k % 2)) for k in range(300)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 400}, {"shard_bytes": 60}, {"shard_bytes": 60, "splitter_bytes": 400}])
def test_brute(spark, sizes):
    rows = made(len(sizes))
    df = spark.createDataFrame(rows, SHAPE).selectExpr("*", "1 as path", "2 as least", "3 as shard", "4 as head").repartition(5)
    assert rows_of(conversation_trie(df, **sizes)) == brute(rows)


def test_empty_and_single(spark):
    assert rows_of(conversation_trie(spark.createDataFrame([], SHAPE))) == []
    assert rows_of(conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], SHAPE))) == []
    for c in range(12):  # by h, some keep no turn: the root alone
        assert rows_of(conversation_trie(spark.createDataFrame([(c, 0, "a", "b")], SHAPE))) == brute([(c, 0, "a", "b")])


def test_hot_path_is_chunked(spark, monkeypatch):
    monkeypatch.setattr("barloom.llm.prefix_trie.CHUNK", 7)
    rows = [(c, k, "user", "same") for c in range(0, 900, 3) for k in range(10)]
    assert rows_of(conversation_trie(spark.createDataFrame(rows, SHAPE).repartition(6))) == brute(rows)


def test_same_rows_for_any_splitters():
    rng = random.Random(3)
    cell = {t: bytes([t]) * (CELL - 4) + t.to_bytes(4) for t in range(4)}
    for _ in range(60):
        paths = sorted({b"".join(cell[rng.randrange(4)] for _ in range(rng.randrange(7))) for _ in range(rng.randrange(1, 60))})
        rows = [(p, k * 7 % len(paths), 1 + k % 3, str(k)) for k, p in enumerate(paths)]

        def run(splitters):
            along, nodes = skeleton_of(splitters)
            done, parts = [], {}
            for k in range(len(splitters) + 1):
                low, high = splitters[k - 1] if k else None, splitters[k] if k < len(splitters) else None
                own = [r for r in rows if (low is None or r[0] >= low) and (high is None or r[0] < high)]
                for r in shard_nodes(own, list(zip(splitters, along))[max(0, k - 1) : k + 1]):
                    if r[-1]:
                        v, old = r[8], parts.get(r[8])
                        new = (r[0], *r[3:8])
                        parts[v] = new if old is None else (min(old[0], new[0]), *(a + b for a, b in zip(old[1:5], new[1:5])), old[5] or new[5])
                    else:
                        done.append(r)
            top = {r[0]: r[1:] for r in reduced(parts, nodes)}
            done = [(*r[:2], r[2] if r[2] is not None else top[r[8]][0], *r[3:8]) for r in done]
            return sorted([*done, *top.values()], key=str)

        assert run(choose_splitters(rng.choices(paths, k=9), 6)) == run([]) == run(choose_splitters(paths, 40))


def test_splitters():
    a, b = b"a" * CELL, b"b" * CELL
    assert common(a + b, a + a) == 1 and common(a, a + b) == 1 and common(b"", a) == 0
    assert choose_splitters([a, a + a, a + b, b], 1) == [a] or len(choose_splitters([a, a + a, a + b, b], 1)) <= 1
    cuts = choose_splitters([a + bytes([k]) * CELL * 5 for k in range(50)], 50, most=200)
    assert sum(map(len, cuts)) <= 200 and cuts == sorted(set(cuts))


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    got = op13_prefix_trie(spark, folder)
    want = con.execute(SQL["op13_prefix_trie"])
    assert got.columns == [c[0] for c in want.description]
    assert rows_of(got) == sorted(want.fetchall(), key=str)
    rows = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert rows_of(got) == brute(rows)
