"""Prefix trie of conversations by splitters and a skeleton.

A conversation is a path: 20 bytes a turn, the MD5 of role and text and the text's UTF-8 length, so that paths
compare and split as bytes while texts never leave the scan. Equal paths collapse to one row first. Paths are range
partitioned by sampled splitter paths. A node whose subtree crosses a splitter is a prefix of that splitter, so the
trie of the splitters (the skeleton, broadcast, bounded by SPLITTER_BYTES) holds every node that several shards
share; each sorted shard finishes all other nodes by itself and sends one partial aggregate for each skeleton node it
touches, and those are reduced.

What one task holds: a shard of distinct paths, and one conversation's turns as 20-byte cells. Rows without a conv_id
belong to no conversation. Null role or text is empty. Turns of one conversation with the same number (null first)
are in the order of their digests; equal rows count as turns each. Very long texts only pass through MD5. An empty
table has no node. Other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import kept_table

#: Bytes of one turn in a path: 16 of MD5, 4 of length.
CELL = 20
#: Path bytes a shard should hold, bytes of all splitters at most, sampled paths for each shard, bytes of a sampled path at most.
SHARD_BYTES, SPLITTER_BYTES, SAMPLES, LONGEST = 1 << 20, 8 << 20, 8, 1 << 16
#: Ids that are joined to one text at most before they are hashed.
CHUNK = 1 << 14
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def conversation_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path) of every conversation: its turns by number, null first, as cells."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    cell = F.concat(digest, F.lpad(F.hex(F.octet_length(text)), 8, "0"))
    cells = F.sort_array(F.collect_list(F.struct(F.col("turn"), cell.alias("cell"))))
    by_id = turns.where(F.col("conv_id").isNotNull()).groupBy(F.col("conv_id").cast("long").alias("conv_id"))
    return by_id.agg(F.unhex(F.array_join(F.transform(cells, lambda x: x["cell"]), "")).alias("path"))


def branched(paths: DataFrame, every: int, turns: Column, most: int) -> DataFrame:
    """(conv_id, path): the first `turns` (at most `most`) turns of conversation conv_id - conv_id % every, none if that is absent, then the own turns after the first `turns`."""
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = paths.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.substring("path", 1, CELL * most).alias("head"))
    size = turns.cast("int") * CELL
    head = F.substr(F.coalesce("head", F.lit(b"")), F.lit(1), size)
    return paths.join(heads, base == F.col("base"), "left").select("conv_id", F.concat(head, F.substr("path", size + 1)).alias("path"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (path, conv_id) → one row for each path and CHUNK of its ids."""
    rows = ((p, i) for b in batches for p, i in zip(b["path"].to_pylist(), b["conv_id"].to_pylist()))
    out, held = [], 0
    for path, same in groupby(rows, key=lambda r: r[0]):
        ids: list[int] = []
        for _, i in same:
            ids.append(i)
            if len(ids) == CHUNK:
                out.append((path, ids[0], len(ids), ",".join(map(str, ids))))
                ids, held = [], held + 16 * CHUNK
        if ids:
            out.append((path, ids[0], len(ids), ",".join(map(str, ids))))
        held += len(path) + 16 * len(ids) + 64
        if held > 4 << 20:
            yield _batch(out, _CHUNK)
            out, held = [], 0
    if out:
        yield _batch(out, _CHUNK)


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks → (path, least, n, ends_sha256): a path's chunks pass one after the other through its hash."""
    rows = (r for b in batches for r in zip(*(b[c].to_pylist() for c in ("path", "least", "n", "ids"))))
    out, held = [], 0
    for path, same in groupby(rows, key=lambda r: r[0]):
        least, n, sha = None, 0, hashlib.sha256()
        for _, first, count, ids in same:
            sha.update((ids if least is None else "," + ids).encode())
            least, n = first if least is None else least, n + count
        out.append((path, least, n, sha.hexdigest()))
        held += len(path) + 128
        if held > 4 << 20:
            yield _batch(out, _CLASS)
            out, held = [], 0
    if out:
        yield _batch(out, _CLASS)


_CHUNK = pa.schema([("path", pa.binary()), ("least", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])
_CLASS = pa.schema([("path", pa.binary()), ("least", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])
_ROW = [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n", pa.int64()), ("kids", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()), ("skeleton", pa.int64()), ("part", pa.bool_())]
_SHARD = pa.schema(_ROW)
_SQL = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary", pa.bool_(): "boolean", pa.int32(): "int"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_SQL[f.type]}" for f in schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([] for _ in schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def path_classes(paths: DataFrame) -> DataFrame:
    """(path, least, n, ends) for every distinct path: smallest conv_id, how many, and the digest of all conv_ids in order.

    Ids are range partitioned and joined to chunks before a path's rows meet, so that a path of very many copies
    sends a few long rows; its hash takes them one after the other and holds one at a time.
    """
    dealt = paths.repartitionByRange("conv_id").sortWithinPartitions("path", "conv_id")
    chunks = dealt.select("path", "conv_id").mapInArrow(_chunks, _ddl(_CHUNK))
    return chunks.repartition("path").sortWithinPartitions("path", "least").mapInArrow(_classes, _ddl(_CLASS))


def common(a: bytes, b: bytes) -> int:
    """Whole cells that a and b begin with alike."""
    low, high = 0, min(len(a), len(b)) // CELL
    if a[: high * CELL] == b[: high * CELL]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[: mid * CELL] == b[: mid * CELL] else (low, mid)
    return low


def choose_splitters(sample: list[bytes], shards: int, most: int = SPLITTER_BYTES) -> list[bytes]:
    """At most shards - 1 splitters at even steps of the sample's bytes, each cut to the first turn that parts it from the path before; thinned while they exceed `most` bytes."""
    sample = sorted(sample)
    total, seen, found = sum(len(p) + CELL for p in sample), 0, []
    for before, path in zip([b"", *sample], sample):
        if path != before and seen * shards >= total * (len(found) + 1):
            found.append(path[: (common(before, path) + 1) * CELL])
        seen += len(path) + CELL
    found = sorted(set(found))
    while sum(map(len, found)) > most:
        found = found[1::2]
    return found


def skeleton_of(splitters: list[bytes]) -> tuple[list[tuple[int, ...]], list[tuple[int, int, int]]]:
    """Node numbers along each splitter, root first, and (parent, depth, bytes of the last text) of each node; parents have smaller numbers."""
    nodes, along = [(-1, 0, 0)], []
    before, own = b"", (0,)
    for path in splitters:
        own = own[: common(before, path) + 1]
        for k in range(len(own), len(path) // CELL + 1):
            nodes.append((own[-1], k, int.from_bytes(path[k * CELL - 4 : k * CELL])))
            own += (len(nodes) - 1,)
        along.append(own)
        before = path
    return along, nodes


def shard_nodes(rows: list[tuple[bytes, int, int, str]], sides: list[tuple[bytes, tuple[int, ...]]]) -> list[tuple]:
    """Nodes of one shard's sorted (path, least, n, ends): those outside the skeleton finished, then a partial for each deepest skeleton node. sides: the splitters at the shard's borders with their node numbers."""
    conv, depth, up, n, kids, leaves, saved, ends, size, skeleton = [], [], [], [], [], [], [], [], [], []
    parts: dict[int, list] = {}
    stack: list[int] = []  # open nodes; the first has depth `top` + 1

    def close(to: int) -> None:
        while len(stack) > to:
            v = stack.pop()
            leaves[v] += not kids[v]
            saved[v] += (n[v] - 1) * size[v]
            if stack:
                u = stack[-1]
                n[u] += n[v]
                conv[u] = min(conv[u], conv[v])
                kids[u] += 1
                leaves[u] += leaves[v]
                saved[u] += saved[v]
            else:
                p = parts[skeleton[v]]
                p[:5] = min(p[0], conv[v]), p[1] + n[v], p[2] + 1, p[3] + leaves[v], p[4] + saved[v]

    before, top = b"", 0
    for path, least, count, digest in rows:
        found = [(common(path, s), along) for s, along in sides]
        shared, along = max(found, key=lambda x: x[0], default=(0, (0,)))
        same = common(before, path)
        close(max(0, same - top) if shared == top else 0)
        top = shared
        p = parts.setdefault(along[top], [least, 0, 0, 0, 0, None])
        total = len(path) // CELL
        for d in range(top + len(stack) + 1, total + 1):
            up.append(stack[-1] if stack else -1)
            skeleton.append(None if stack else along[top])
            stack.append(len(conv))
            conv.append(least), depth.append(d), n.append(0), kids.append(0), leaves.append(0), saved.append(0), ends.append(None)
            size.append(int.from_bytes(path[d * CELL - 4 : d * CELL]))
        if total > top:
            n[stack[-1]] += count
            conv[stack[-1]] = min(conv[stack[-1]], least)
            ends[stack[-1]] = digest
        else:
            p[0], p[1], p[5] = min(p[0], least), p[1] + count, digest
        before = path
    close(0)
    done = [(conv[v], depth[v], conv[up[v]] if up[v] >= 0 else None, n[v], kids[v], leaves[v], saved[v], ends[v], skeleton[v], False) for v in range(len(conv))]
    return done + [(p[0], None, None, *p[1:], v, True) for v, p in parts.items()]


def reduced(parts: dict[int, tuple], nodes: list[tuple[int, int, int]]) -> list[tuple]:
    """Rows of the skeleton's nodes (number, then NODE) from the partials of all shards: children before parents, as parents have smaller numbers."""
    held = {v: [least, n, kids, leaves, saved, ends] for v, (least, n, kids, leaves, saved, ends) in parts.items()}
    for v in range(len(nodes) - 1, -1, -1):
        if v not in held:
            continue
        own, (parent, _, size) = held[v], nodes[v]
        own[3] += not own[2]
        own[4] += (own[1] - 1) * size
        if parent >= 0:
            u = held.setdefault(parent, [own[0], 0, 0, 0, 0, None])
            u[:5] = min(u[0], own[0]), u[1] + own[1], u[2] + 1, u[3] + own[3], u[4] + own[4]
    return [(v, h[0], nodes[v][1], held[nodes[v][0]][0] if v else None, *h[1:5], h[5]) for v, h in sorted(held.items())]


def prefix_trie(paths: DataFrame, shard_bytes: int = SHARD_BYTES, splitter_bytes: int = SPLITTER_BYTES) -> DataFrame:
    """One row for every node of the trie of (conv_id, path), NODE: conv_ids distinct, paths as conversation_paths makes them.

    The driver sees a sample of about SAMPLES paths a shard, cut to LONGEST bytes, and the skeleton; both are bounded
    by splitter_bytes, beyond which shards grow instead.
    """
    spark = paths.sparkSession
    classes = kept_table(path_classes(paths), "paths")
    count, total = classes.agg(F.count(F.lit(1)), F.sum(F.length("path") + CELL)).first()
    if not count:
        return spark.createDataFrame([], NODE)
    shards = max(1, min(-(-total // shard_bytes), splitter_bytes * count // total))
    share = min(1 << 30, (SAMPLES * shards << 30) // count)
    sample = classes.where(F.pmod(F.xxhash64("path"), F.lit(1 << 30)) < share).select(F.substring("path", 1, LONGEST // CELL * CELL)) if shards > 1 else None
    splitters = choose_splitters([bytes(r[0]) for r in sample.toLocalIterator()], shards, splitter_bytes) if sample else []
    along, nodes = skeleton_of(splitters)
    sent = spark.sparkContext.broadcast((splitters, along))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = sent.value[0]
        for b in batches:
            yield b.append_column("shard", pa.array([bisect.bisect_right(cuts, p) for p in b["path"].to_pylist()], pa.int32()))

    def finish(key: tuple, table: pa.Table) -> pa.Table:
        cuts, numbers = sent.value
        near = slice(max(0, key[0].as_py() - 1), key[0].as_py() + 1)
        rows = sorted(zip(*(table[c].to_pylist() for c in ("path", "least", "n", "ends"))))
        return pa.Table.from_batches([_batch(shard_nodes(rows, list(zip(cuts[near], numbers[near]))), _SHARD)])

    with_shard = classes.mapInArrow(dealt, _ddl(_CLASS) + ", shard int")
    found = kept_table(with_shard.groupBy("shard").applyInArrow(finish, _ddl(_SHARD)), "nodes")
    sums = found.where("part").groupBy("skeleton").agg(F.min("conv_id"), *(F.sum(c) for c in ("n", "kids", "leaves", "saved")), F.max("ends"))
    skeleton = reduced({r[0]: r[1:] for r in sums.collect()}, nodes)
    top = spark.createDataFrame(skeleton, "skeleton long, " + NODE)
    # bounded by the splitters' cells
    parents = F.broadcast(top.select("skeleton", F.col("conv_id").alias("above")))
    rest = found.where(~F.col("part")).join(parents, "skeleton", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )
    return rest.unionByName(top.drop("skeleton")).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))


def conversation_trie(turns: DataFrame, every: int = 5, most: int = 8, **sizes: int) -> DataFrame:
    """The trie of all rebuilt conversations: the first h turns of conv_id - conv_id % every, then the own turns after the first h, h = crc32(conv_id) % (most + 1)."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    return prefix_trie(branched(kept_table(conversation_paths(turns), "conversations"), every, h, most), **sizes)
