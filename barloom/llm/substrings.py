"""Repeated substrings by per-shard suffix arrays.

A shard's suffixes are sorted by Larsson-Sadakane refinement: groups of suffixes equal in
their first h bytes are split by the group of the suffix h bytes on, which doubles h, and
only groups that aren't split yet are sorted again. Kasai's algorithm gives the common
prefix of neighbours, run in many lanes of the text at once. Across shards, anchored runs
that shards have in common are merged: their sorted hashes first, then, where runs differ,
the suffix array of the runs themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .anchors import Runs, Verdict, late_windows, repeated_windows
from .text import buffer_of, covered, mix, per_row, spread

LENGTH, SEED = 200, 40
SHARD_BYTES, BUCKET_BYTES = 1 << 20, 3 << 20
BREAK = 0xFF  # no byte of UTF-8
CODES = mix(np.arange(1, 257, dtype=np.uint64))
#: Suffixes of a lane at most and at least, and lanes that should go side by side.
LANE, SHORT, LANES = 256, 8, 2048
PACK = 21


def sort_suffixes(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffix numbers in order of at least their first ``depth`` bytes (past the end: lowest)."""
    return refine(data, depth)[0]


def refine(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of sort_suffixes, and the suffixes that may share ``depth`` bytes with another one, ascending.

    The latter were still grouped at the greatest h of at most ``depth``; all others have no
    common prefix of that length with any suffix.
    """
    n = len(data)
    shared = np.arange(n)
    group = np.zeros(n, np.int64)
    key = np.zeros(n, np.uint64)
    reach = 5
    for k in range(reach):
        key <<= np.uint64(8)
        if n > k:
            key[: n - k] |= data[k:].astype(np.uint64)
    order = np.argsort(key, kind="stable") if n > 1 << PACK else (np.sort((key << np.uint64(PACK)) | np.arange(n, dtype=np.uint64)) & np.uint64((1 << PACK) - 1)).astype(np.int64)
    new = np.ones(n, bool)
    new[1:] = key[order][1:] != key[order][:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    group[order] = head
    slots = order.copy()
    alone = new & np.append(new[1:], True)
    live = order[~alone]
    while len(live) and reach < depth:
        shared = live
        ahead = live + reach
        second = np.zeros(len(live), np.int64)
        inside = ahead < n
        second[inside] = group[ahead[inside]] + 1
        g = group[live]
        if n < 1 << PACK:
            both = np.sort((g.astype(np.uint64) << np.uint64(2 * PACK)) | (second.astype(np.uint64) << np.uint64(PACK)) | live.astype(np.uint64))
            live = (both & np.uint64((1 << PACK) - 1)).astype(np.int64)
            both >>= np.uint64(PACK)
            g = (both >> np.uint64(PACK)).astype(np.int64)
            fresh = np.ones(len(live), bool)
            fresh[1:] = both[1:] != both[:-1]
        else:
            by = np.lexsort((second, g))
            live, g, second = live[by], g[by], second[by]
            fresh = np.ones(len(live), bool)
            fresh[1:] = (g[1:] != g[:-1]) | (second[1:] != second[:-1])
        at = np.arange(len(live))
        top = np.ones(len(live), bool)
        top[1:] = g[1:] != g[:-1]
        place = g + at - np.maximum.accumulate(np.where(top, at, 0))
        slots[place] = live
        group[live] = place[np.maximum.accumulate(np.where(fresh, at, 0))]
        live = live[~(fresh & np.append(fresh[1:], True))]
        reach *= 2
    if reach == depth or (len(live) == 0 and reach < depth):
        shared = live
    return slots, np.sort(shared)


def common_prefixes(data: np.ndarray, rest: np.ndarray, slots: np.ndarray, most: int, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix of some (ascending; None: all), the one before it in slots (-1: none) and their common prefix, at most ``most`` and within rest.

    Kasai: if j stands before i with a common prefix of h, and j + 1 before i + 1, then what
    stands just before i + 1 shares at least h - 1 with it. Suffixes equal over the sorted
    depth may stand the other way round; then, and where i + 1 isn't asked for, the prefix is
    measured from its start. Lanes of up to LANE suffixes go on side by side, eight bytes a
    step; few suffixes go in shorter lanes, as a step costs the same for few lanes as for many.
    """
    n = len(data)
    some = np.arange(n) if some is None else some
    rank = np.empty(n + 1, np.int64)
    rank[slots] = np.arange(n)
    rank[n] = n
    prior = np.where(rank[some] > 0, slots[rank[some] - 1], -1)
    out = np.zeros(len(some), np.int64)
    next_to = np.zeros(len(some), bool)
    next_to[1:] = some[1:] == some[:-1] + 1
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    loads = np.ndarray(shape=(n + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    wide = min(LANE, max(SHORT, len(some) // LANES))
    lanes = np.arange(0, len(some), wide)
    have = np.zeros(len(lanes), np.int64)
    last = np.full(len(lanes), -1, np.int64)
    for step in range(wide):
        at = lanes + step
        if len(at) and at[-1] >= len(some):
            at = at[at < len(some)]
        i, j = some[at], prior[at]
        limit = np.where(j >= 0, np.minimum(np.minimum(rest[i], rest[j]), most), 0)
        last = last[: len(at)]
        follows = next_to[at] & (last >= 0) & (rank[last + 1] < rank[i])
        h = np.minimum(np.where(follows, np.maximum(have[: len(at)] - 1, 0), 0), limit)
        live = np.flatnonzero(h < limit)
        while len(live):
            a, b = i[live] + h[live], j[live] + h[live]
            differ = loads[a] ^ loads[b]
            low = differ & (~differ + np.uint64(1))
            same = np.where(differ == 0, 8, (np.frexp(low.astype(np.float64))[1] - 1) >> 3)
            h[live] = np.minimum(h[live] + same, limit[live])
            live = live[(same == 8) & (h[live] < limit[live])]
        have, last = h, j
        out[at] = h
    return prior, out


def repeated_starts(data: np.ndarray, bounds: np.ndarray, length: int) -> np.ndarray:
    """At which places of the rows' bytes a string of ``length`` starts that starts elsewhere in them too."""
    size = np.diff(bounds)
    n = len(data)
    wide = n + len(size)
    shift = spread(bounds[:-1] + np.arange(len(size)), size)  # a break after each row
    broken = np.full(wide, BREAK, np.uint8)
    broken[shift] = data
    rest = np.zeros(wide, np.int64)
    rest[shift] = np.repeat(bounds[1:], size) - np.arange(n)
    slots, some = refine(broken, length)
    some = some[rest[some] >= length]
    prior, common = common_prefixes(broken, rest, slots, length, some)
    again = common >= length
    flags = np.zeros(wide, bool)
    flags[some[again]] = True
    flags[prior[again]] = True
    return flags[shift]


def shard_repeats(data: np.ndarray, r: Runs, length: int) -> np.ndarray:
    """Places of a shard's bytes where a string of ``length`` starts that starts in another run of the shard too, of another content.

    Equal strings have equal anchors, so only stretches whose anchor several kinds of runs
    share in the shard have their suffixes sorted, one run of each kind; runs of one kind
    are found by their hash.
    """
    shared = np.bincount(r.key_of, minlength=len(r.key_first)) > 1
    head = r.heads[shared[r.key_of]] if len(r.key_first) else r.heads
    size = r.high[head] + length - r.low[head]
    at = spread(r.low[head], size)
    bounds = np.concatenate([[0], np.cumsum(size)])
    return at[repeated_starts(data[at], bounds, length)] if len(at) else at


def byte_symbols(table: pa.Table):
    data, bounds = buffer_of(table.column("text"))
    return data, CODES[data], bounds


def remove_substrings(docs: DataFrame, length: int = LENGTH, seed: int = SEED, shard_bytes: int = SHARD_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of docs (doc_id, text): n_bytes, n_removed, n_spans, kept (binary).

    Removed is every byte covered by a string of ``length`` bytes that starts anywhere else
    in the rows' texts too, the same row included; spans are maximal removed runs. Null is
    empty; strings don't cross rows; equal rows, also of one id, are each other's repeats;
    other columns are ignored. kept may cut a character where a repeat does.
    """

    def compare(values, bounds, docs, starts):
        return repeated_starts(values, bounds, length)

    def finish(table: pa.Table, r: Runs, v: Verdict) -> pa.Table:
        data, bounds = buffer_of(table.column("text"))
        own = shard_repeats(data, r, length)
        repeats = np.zeros(len(r.heads), bool)
        repeats[v.record] = True
        runs = np.flatnonzero(repeats[r.record])
        low, high = r.low[runs], r.high[runs]
        late = late_windows(r, v)
        low, high = np.concatenate([low, late[0]]), np.concatenate([high, late[1]])
        gone = covered(np.concatenate([own, low]), np.concatenate([own + length, high + length]), len(data))
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        first = bounds[:-1][np.diff(bounds) > 0]
        opens[first] = gone[first]
        kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_bytes": pa.array(np.diff(bounds)),
                "n_removed": pa.array(per_row(gone, bounds)),
                "n_spans": pa.array(per_row(opens, bounds)),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return repeated_windows(docs, byte_symbols, compare, finish, schema, length, seed, "u1", shard_bytes, bucket_bytes)
