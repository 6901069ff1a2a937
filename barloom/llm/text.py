"""Words and their hashes from whole Arrow text columns, in numpy: a few passes over the bytes of a block."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8 << 20


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


#: All bytes but space and 0x09-0x0D; UTF-8 continuation bytes are word bytes.
NOT_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))
#: Digits, lower-case ASCII letters and everything beyond ASCII.
ALNUM = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def pieces(column, limit: int = SLICE_BYTES):
    """(first row, last row + 1) runs of a text column of about ``limit`` bytes; one long text is a run by itself."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0)).astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start = stop


def buffer_of(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows one after the other, and the row bounds in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.large_binary())
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


@dataclass
class Words:
    """Words of a run of rows: byte spans, and for each row the number of its first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(data: np.ndarray, bounds: np.ndarray, member: np.ndarray) -> Words:
    """Maximal runs of member bytes that don't cross a row bound."""
    inside = member[data]
    edge = np.empty(len(data) + 1, dtype=bool)  # a word may begin at i (or end before i)
    edge[0] = edge[-1] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    edge[bounds] = True
    starts = np.flatnonzero(edge[:-1] & inside)
    ends = np.flatnonzero(edge[1:] & inside) + 1
    return Words(data, starts, ends, np.searchsorted(starts, bounds))


# Multipliers of the splitmix64 finaliser.
M1, M2, GOLDEN = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scrambling; works on a copy."""
    x = x ^ (x >> np.uint64(30))
    x *= M1
    x ^= x >> np.uint64(27)
    x *= M2
    x ^= x >> np.uint64(31)
    return x


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes a step; longer spans take more steps."""
    n = len(starts)
    length = (ends - starts).astype(np.int64)
    h = mix(length.astype(np.uint64) * GOLDEN)
    if not n:
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    loads = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
    live, done = np.arange(n), 0
    while len(live):
        rest = length[live] - done
        h[live] = mix((h[live] ^ (loads[starts[live] + done] & masks[np.clip(rest, 0, 8)])) + GOLDEN)
        done += 8
        live = live[rest > 8]
    return h


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values (order counts); shorter input gives none."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size * int(GOLDEN) % 2**64, np.uint64)
    for k in range(size):
        out = mix(out ^ h[k : k + n]) + GOLDEN
    return out


def run_windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start numbers of all windows of ``size`` items that stay in one row, and their rows."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    return spread(first[:-1], counts), rows


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... counts[i] of them, one run after the other."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    shift = np.asarray(starts, np.int64) - (np.cumsum(counts) - counts)
    return np.arange(total, dtype=np.int64) + np.repeat(shift, counts)


def per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set between each two bounds."""
    total = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=total[1:])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(np.int64)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in any span [start, end)."""
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0
