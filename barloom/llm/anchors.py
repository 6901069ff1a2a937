"""Which windows of fixed length occur elsewhere in a corpus, found by content-chosen anchors.

Every window of ``length`` symbols has an anchor: the place in it where a run of ``seed``
symbols has the lowest hash. Equal windows have their anchors at the same offset. Windows
of a text that share an anchor are consecutive and form its run; so a text has about one
run for half a window. Runs meet by their anchor's hash in one bucket, whatever shard they
come from: runs that are equal as a whole meet by the hash of the whole, and each shard
tells once for each anchor how many kinds of runs share it. Where these differ, one of each
kind sends its symbols to be compared exactly. An anchor of more than HOT kinds (a line that
stands in many texts, each time in other surroundings) sends the hashes of its windows
instead, each once a shard, which spread over all buckets. So no bucket gets more of one
anchor, run or window than one entry a shard, or HOT kinds.

Everything that passes between shards and buckets is packed in a few binary columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import by_shard, shards_for, text_bytes
from .text import GOLDEN, mix, run_windows, spread

BASE = 0x9E3779B97F4A7C15 | 1
POSITION = 24
#: Kinds of runs of one anchor that are compared in one bucket.
HOT = 1000
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i up to n."""
    if len(_powers[0]) <= n:
        for side, base in enumerate((BASE, pow(BASE, -1, 2**64))):
            step = np.full(n + 1, base % 2**64, np.uint64)
            step[0] = 1
            _powers[side] = np.multiply.accumulate(step)
    return _powers[0], _powers[1]


def packed(bucket: np.ndarray, fixed: dict, **columns: tuple[np.ndarray, np.ndarray | None]) -> pa.Table:
    """One row a bucket; each column's values of a bucket as bytes, in the order given.

    columns: (values, how many belong to each entry of bucket; None: one).
    """
    top = int(bucket.max()) + 1 if len(bucket) else 0
    some = np.flatnonzero(np.bincount(bucket, minlength=top))
    out = {"bucket": pa.array(some.astype(np.int32))}
    out |= {k: pa.array(np.full(len(some), v, np.int32)) for k, v in fixed.items()}
    order = np.argsort(bucket, kind="stable")
    for name, (values, counts) in columns.items():
        if counts is None:
            sizes, values = np.bincount(bucket, minlength=top), values[order]
        else:
            sizes = np.bincount(bucket, counts, minlength=top).astype(np.int64)
            values = values[spread((np.cumsum(counts) - counts)[order], counts[order])]
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        out[name] = pa.array([values[cuts[b] : cuts[b + 1]].tobytes() for b in some], pa.binary())
    return pa.table(out)


def unpacked(rows: pa.Table, **kinds: str) -> list[list[np.ndarray]]:
    """The named columns of each row as arrays."""
    return [[np.frombuffer(v.as_buffer(), kind) for v in rows.column(name)] for name, kind in kinds.items()]


class Dealt:
    """Entries dealt to buckets: which one has a number within a bucket. The order is that of packed."""

    def __init__(self, bucket: np.ndarray, buckets: int):
        self.order = np.argsort(bucket, kind="stable")
        self.begin = np.searchsorted(bucket[self.order], np.arange(buckets))

    def of(self, bucket: int, numbers: np.ndarray) -> np.ndarray:
        return self.order[self.begin[bucket] + numbers.astype(np.int64)]


def dealt_by(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(hashes) % np.uint64(buckets)).astype(np.int64)


class Runs:
    """Anchored runs of the windows of some rows of symbol codes (64-bit), and their records.

    A record stands for all runs of the shard with one anchor key and one content; records
    are ordered by bucket, key and content, so that each pass finds the same numbers.
    """

    def __init__(self, codes: np.ndarray, first: np.ndarray, ids: np.ndarray, length: int, seed: int, buckets: int):
        n, self.first, self.ids, self.length = len(codes), first, ids, length
        starts, rows = run_windows(first, length)
        if not len(starts):
            self.low = self.high = self.row = self.record = self.heads = np.zeros(0, np.int64)
            self.key = self.content = np.zeros(0, np.uint64)
            self.bucket = self.number = np.zeros(0, np.int64)
            self.many = self.key_first = self.key_of = np.zeros(0, np.int64)
            return
        up, down = powers(n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * up[:n], out=total[1:])

        def span(a, b):
            return mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64) * GOLDEN)

        self.span = span
        m, width, low_bits = n - seed + 1, length - seed + 1, np.uint64((1 << POSITION) - 1)
        hashes = mix((total[seed:] - total[:m]) * down[:m] + np.uint64(seed * int(GOLDEN) % 2**64))  # span of each run, by slices
        value = np.full(-(-m // width) * width + width, np.iinfo(np.uint64).max, np.uint64)
        np.bitwise_or(hashes & ~low_bits, np.arange(m, dtype=np.uint64) & low_bits, out=value[:m])
        blocks = value.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        behind = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        most = len(value) - width + 1
        least = np.minimum(ahead[:most], behind[width - 1 :])[starts].view(np.int64)
        anchor = starts + ((least - starts) & ((1 << POSITION) - 1))
        cut = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
        self.low, self.row = starts[cut], rows[cut]
        self.high = starts[np.append(cut[1:], len(starts)) - 1]
        anchor = anchor[cut]
        key = hashes[anchor]
        content = mix(span(self.low, self.high + length) ^ mix((anchor - self.low).astype(np.uint64)))
        bucket = dealt_by(key, buckets)
        order = np.lexsort((self.start(), ids[self.row], content, key, bucket))
        new = np.ones(len(order), bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (content[order][1:] != content[order][:-1])
        self.record = np.empty(len(order), np.int64)
        self.record[order] = np.cumsum(new) - 1
        self.heads = order[new]  # the first run of each record, by doc_id and start
        self.key, self.content, self.bucket = key[self.heads], content[self.heads], bucket[self.heads]
        self.many = np.bincount(self.record)
        begin = np.searchsorted(self.bucket, np.arange(buckets))
        self.number = np.arange(len(self.heads)) - begin[self.bucket]  # within its bucket
        self._begin = begin
        new_key = np.ones(len(self.key), bool)
        new_key[1:] = self.key[1:] != self.key[:-1]
        self.key_first, self.key_of = np.flatnonzero(new_key), np.cumsum(new_key) - 1

    def start(self) -> np.ndarray:
        return self.low - self.first[self.row]

    def of(self, bucket: int, numbers: np.ndarray) -> np.ndarray:
        return self._begin[bucket] + numbers.astype(np.int64)


class Windows:
    """All windows of the first runs of some records, and their distinct hashes, each with its first (doc, place)."""

    def __init__(self, r: Runs, records: np.ndarray, buckets: int):
        head = r.heads[records]
        count = r.high[head] - r.low[head] + 1
        at = spread(r.low[head], count)
        self.record, head = np.repeat(records, count), np.repeat(head, count)
        self.offset = at - r.low[head]
        self.doc, self.place = r.ids[r.row[head]], at - r.first[r.row[head]]
        hashes = r.span(at, at + r.length)
        order = np.lexsort((self.place, self.doc, hashes))
        new = np.ones(len(order), bool)
        new[1:] = hashes[order][1:] != hashes[order][:-1]
        self.kind = np.empty(len(order), np.int64)
        self.kind[order] = np.cumsum(new) - 1
        self.first = order[new]
        self.hashes, self.many = hashes[self.first], np.bincount(self.kind)
        self.bucket = dealt_by(self.hashes, buckets)
        self.dealt = Dealt(self.bucket, buckets)


# Whole runs are offered to buckets from 0 on, keys to as many after them. Symbols go to buckets from 0 on, window
# hashes (with what numbers, docs, starts and sizes hold for symbols: hashes, first places, counts) to as many after them.
OFFERED = "bucket int, shard int, keys binary, contents binary, docs binary, starts binary, many binary"
SETTLED = "shard int, bucket int, numbers binary, marks binary, docs binary, starts binary"
SENT = "bucket int, shard int, numbers binary, docs binary, starts binary, sizes binary, symbols binary"
COMPARED = "shard int, bucket int, numbers binary, low binary, high binary, docs binary, starts binary"
NOTHING = np.zeros(0, np.uint8)


def nothing(n: int) -> tuple[np.ndarray, np.ndarray]:
    """A column for packed that is empty for n entries."""
    return NOTHING, np.zeros(n, np.int64)


def offered(shard: int, r: Runs, buckets: int) -> pa.Table:
    whole = {"keys": r.key, "contents": r.content, "docs": r.ids[r.row[r.heads]], "starts": r.start()[r.heads].astype("<u4"), "many": np.minimum(r.many, 2).astype("<u4")}
    wholes = packed(dealt_by(r.content, buckets), {"shard": shard}, **{k: (v, None) for k, v in whole.items()})
    key, n = r.key[r.key_first], len(r.key_first)
    kinds = np.bincount(r.key_of, minlength=n).astype("<u4")
    keys = packed(dealt_by(key, buckets) + buckets, {"shard": shard}, keys=(key, None), contents=(r.content[r.key_first], None), docs=nothing(n), starts=nothing(n), many=(kinds, None))
    return pa.concat_tables([wholes, keys])


def firsts(*columns: np.ndarray) -> np.ndarray:
    """Which entries of sorted columns differ from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def answered(rows: pa.Table, names: list[str], sizes: np.ndarray, some: np.ndarray, *columns: tuple[str, np.ndarray | None]) -> pa.Table:
    """For each of rows, which hold sizes entries: the numbers of those that some marks, and their columns (kind, values; None: nothing)."""
    cuts, out = np.concatenate([[0], np.cumsum(sizes)]), []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = np.flatnonzero(some[a:b])
        out.append([own.astype("<u4").tobytes(), *(b"" if v is None else v[a:b][own].astype(k).tobytes() for k, v in columns)])
    parts = [pa.array([o[j] for o in out], pa.binary()) for j in range(len(columns) + 1)]
    return pa.table([rows.column("shard"), rows.column("bucket"), *parts], names=names)


def settled(rows: pa.Table, buckets: int) -> pa.Table:
    """Of whole runs in a bucket: which occur more than once, with the first place. Of keys: which have several kinds of runs, and whether more than HOT."""
    parts = unpacked(rows, keys="<u8", contents="<u8", docs="<i8", starts="<u4", many="<u4")
    sizes = np.array([len(p) for p in parts[0]])
    key, content, doc, start, many = (np.concatenate(p) for p in parts)
    names = ["shard", "bucket", "numbers", "marks", "docs", "starts"]
    if rows.column("bucket")[0].as_py() >= buckets:
        order = np.argsort(key, kind="stable")
        new = firsts(key[order])
        group, other = np.cumsum(new) - 1, content[order]
        several = np.bincount(group, (many[order] > 1) | (other != other[new][group])) > 0
        hot = np.bincount(group, many[order]) > HOT
        marks, some = np.empty(len(key), bool), np.empty(len(key), bool)
        marks[order], some[order] = hot[group], several[group]
        return answered(rows, names, sizes, some, ("u1", marks), ("<i8", None), ("<u4", None))
    order = np.lexsort((start, doc, content, key))
    new = firsts(key[order], content[order])
    kind = np.cumsum(new) - 1
    repeats, owner = np.empty(len(key), bool), np.empty(len(key), np.int64)
    repeats[order] = np.bincount(kind, many[order])[kind] > 1
    owner[order] = order[new][kind]
    return answered(rows, names, sizes, repeats, ("u1", None), ("<i8", doc[owner]), ("<u4", start[owner]))


def settled_windows(rows: pa.Table, later: bool) -> pa.Table:
    """Which window hashes of a bucket occur more than once; with later, also their first places."""
    parts = unpacked(rows, numbers="<u8", docs="<i8", starts="<u4", sizes="<u4")
    lengths = np.array([len(p) for p in parts[0]])
    hashes, doc, start, many = (np.concatenate(p) for p in parts)
    order = np.lexsort((start, doc, hashes)) if later else np.argsort(hashes, kind="stable")
    new = firsts(hashes[order])
    kind = np.cumsum(new) - 1
    repeats, owner = np.empty(len(hashes), bool), np.empty(len(hashes), np.int64)
    repeats[order] = np.bincount(kind, many[order])[kind] > 1
    owner[order] = order[new][kind]
    names = ["shard", "bucket", "numbers", "low", "high", "docs", "starts"]
    places = (doc[owner], start[owner]) if later else (None, None)
    return answered(rows, names, lengths, repeats, ("<u4", None), ("<u4", None), ("<i8", places[0]), ("<u4", places[1]))


@dataclass
class Verdict:
    """For a shard: records that repeat with their first place (doc, start), records that send their symbols or (hot) their windows' hashes, and runs of windows found equal elsewhere.

    The latter hold for the first run of a record and for those that tie with it.
    """

    record: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    sends: np.ndarray
    hot: np.ndarray
    late_record: np.ndarray
    low: np.ndarray
    high: np.ndarray


def late_windows(r: Runs, v: Verdict) -> tuple[np.ndarray, np.ndarray]:
    """First and last windows of the runs found equal elsewhere, in all places that they hold for."""
    head = r.heads[r.record]
    ties = np.flatnonzero((r.ids[r.row] == r.ids[r.row[head]]) & (r.start() == r.start()[head])) if len(head) else head
    ties = ties[np.argsort(r.record[ties], kind="stable")]
    cuts = np.searchsorted(r.record[ties], np.arange(len(r.heads) + 1))
    counts = np.diff(cuts)[v.late_record]
    base = r.low[ties[spread(cuts[:-1][v.late_record], counts)]]
    return base + np.repeat(v.low.astype(np.int64), counts), base + np.repeat(v.high.astype(np.int64), counts)


def verdict_of(r: Runs, answers: pa.Table, offers: int, buckets: int, later: bool) -> Verdict:
    bucket = np.asarray(answers.column("bucket").combine_chunks()) if answers.num_rows else np.zeros(0, np.int64)
    late = np.asarray(answers.column("late").combine_chunks()) if answers.num_rows else np.zeros(0, bool)

    def gather(some: np.ndarray, base: int, of: Callable, **kinds):
        rows = answers.filter(pa.array(some)) if answers.num_rows else answers
        parts = unpacked(rows, **kinds)
        numbers = [of(b - base, n) for b, n in zip(rows.column("bucket").to_pylist(), parts[0], strict=True)]
        empty = np.zeros(0, np.int64)
        return [np.concatenate(p) if p else empty for p in [numbers, *parts[1:]]]

    wholes, keys = Dealt(dealt_by(r.content, offers), offers), Dealt(dealt_by(r.key[r.key_first], offers), offers)
    record, doc, start = gather(~late & (bucket < offers), 0, wholes.of, numbers="<u4", docs="<i8", starts="<u4")
    key, hot = gather(~late & (bucket >= offers), offers, keys.of, numbers="<u4", marks="u1")
    state = np.zeros(len(r.key_first), np.uint8)
    state[key] = 1 + hot
    sends = state[r.key_of]
    head = r.heads[record]
    sends[record[(r.ids[r.row[head]] != doc) | (r.start()[head] != start)]] = 0  # another run of the kind is first; rows of one id can tie
    sent, hashed = np.flatnonzero(sends == 1), np.flatnonzero(sends == 2)
    late_record, low, high = gather(late & (bucket < buckets), 0, r.of, numbers="<u4", low="<u4", high="<u4")
    apart = late & (bucket >= buckets)
    if len(hashed) and apart.any():
        w = Windows(r, hashed, buckets)
        kind, first_doc, first_start = gather(apart, buckets, w.dealt.of, numbers="<u4", docs="<i8", starts="<u4")
        found = np.zeros(len(w.hashes), bool)
        found[kind] = True
        again = found[w.kind]
        if later:
            docs, places = np.zeros(len(w.hashes), np.int64), np.zeros(len(w.hashes), np.int64)
            docs[kind], places[kind] = first_doc, first_start
            again &= (w.doc != docs[w.kind]) | (w.place != places[w.kind])
        late_record = np.concatenate([late_record, w.record[again]])
        low, high = (np.concatenate([x, w.offset[again]]) for x in (low, high))
    return Verdict(record, doc, start, sent, hashed, late_record, low, high)


def repeated_windows(
    docs: DataFrame,
    symbols: Callable[[pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]],
    compare: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray],
    finish: Callable[[pa.Table, Runs, Verdict], pa.Table],
    schema: str,
    length: int,
    seed: int,
    kind: str,
    shard_bytes: int,
    bucket_bytes: int,
    later: bool = False,
) -> DataFrame:
    """finish(rows of a shard, their runs, verdict) for every shard of docs (doc_id, text).

    symbols(rows) gives symbols (numpy ``kind``), their 64-bit codes and the row bounds.
    compare(symbols, bounds, docs, starts) tells, for texts of one bucket, which of their
    windows are repeats: with later, those that have an equal one at a lower (doc, place),
    else all that have an equal one. The text is shuffled once and read from that exchange
    three times. Rows are dealt to shards by their number too, so that equal ones spread;
    docs should come from files, which are read again in the same order.
    """
    total = text_bytes(docs)
    shards, buckets, offers = (shards_for(total, n) for n in (shard_bytes, bucket_bytes, 2 * bucket_bytes))
    salted = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("row"))
    grouped = by_shard(salted, shards, "row").groupBy("shard")

    def runs(table: pa.Table):
        values, codes, first = symbols(table)
        ids = np.asarray(table.column("doc_id").combine_chunks().fill_null(np.iinfo(np.int64).min))
        return values, Runs(codes, first, ids, length, seed, buckets)

    def offer(table: pa.Table) -> pa.Table:
        return offered(table.column("shard")[0].as_py(), runs(table)[1], offers)

    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        values, r = runs(table)
        v = verdict_of(r, answers, offers, buckets, later)
        shard = {"shard": table.column("shard")[0].as_py()}
        head = r.heads[v.sends]
        low, size = r.low[head], r.high[head] + length - r.low[head]
        whole = packed(
            r.bucket[v.sends],
            shard,
            numbers=(r.number[v.sends].astype("<u4"), None),
            docs=(r.ids[r.row[head]], None),
            starts=(r.start()[head].astype("<u4"), None),
            sizes=(size.astype("<u4"), None),
            symbols=(values[spread(low, size)], size),
        )
        if not len(v.hot):
            return whole
        w = Windows(r, v.hot, buckets)
        n = len(w.hashes)
        apart = packed(
            w.bucket + buckets,
            shard,
            numbers=(w.hashes, None),
            docs=(w.doc[w.first], None) if later else nothing(n),
            starts=(w.place[w.first].astype("<u4"), None) if later else nothing(n),
            sizes=(np.minimum(w.many, 2).astype("<u4"), None),
            symbols=nothing(n),
        )
        return pa.concat_tables([whole, apart])

    def settle(rows: pa.Table) -> pa.Table:
        if rows.column("bucket")[0].as_py() >= buckets:
            return settled_windows(rows, later)
        parts = unpacked(rows, numbers="<u4", docs="<i8", starts="<u4", sizes="<u4", symbols=kind)
        sizes = np.array([len(p) for p in parts[0]])
        number, doc, start, size, values = (np.concatenate(p) for p in parts)
        bounds = np.concatenate([[0], np.cumsum(size.astype(np.int64))])
        flags = compare(values, bounds, doc, start)
        edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
        low, high = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0) - 1
        text = np.searchsorted(bounds, low, side="right") - 1
        owner = np.repeat(np.arange(len(sizes)), sizes)[text]
        out, cuts = [], np.searchsorted(owner, np.arange(len(sizes) + 1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = slice(a, b)
            t = text[own]
            out.append([v.astype("<u4").tobytes() for v in (number[t], low[own] - bounds[t], high[own] - bounds[t])])
        columns = [pa.array([o[j] for o in out], pa.binary()) for j in range(3)]
        empty = pa.array([b""] * len(out), pa.binary())
        return pa.table([rows.column("shard"), rows.column("bucket"), *columns, empty, empty], names=["shard", "bucket", "numbers", "low", "high", "docs", "starts"])

    def end(table: pa.Table, answers: pa.Table) -> pa.Table:
        _, r = runs(table)
        return finish(table, r, verdict_of(r, answers, offers, buckets, later))

    def first_answers(rows: pa.Table) -> pa.Table:
        return settled(rows, offers)

    first = grouped.applyInArrow(offer, OFFERED).groupBy("bucket").applyInArrow(first_answers, SETTLED)
    none = F.lit(None).cast("binary")
    early = first.select(F.col("shard").alias("at"), "bucket", F.lit(False).alias("late"), "numbers", "marks", "docs", "starts", none.alias("low"), none.alias("high"))
    sent = grouped.cogroup(early.groupBy("at")).applyInArrow(send, SENT)
    second = sent.groupBy("bucket").applyInArrow(settle, COMPARED)
    late = second.select(F.col("shard").alias("at"), "bucket", F.lit(True).alias("late"), "numbers", none.alias("marks"), "docs", "starts", "low", "high")
    return grouped.cogroup(early.unionByName(late).groupBy("at")).applyInArrow(end, schema)
