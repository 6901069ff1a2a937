"""Repeated passages by phrase automata.

Anchored runs of word windows that recur anywhere in the corpus are confirmed first. Each
shard compiles the confirmed runs that it holds into Aho-Corasick automata, a bounded
number of patterns each, with a letter for each word, and streams all its documents
through them; what they find anywhere but at a run's first place is removed.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .anchors import Runs, Verdict, late_windows, repeated_windows
from .text import NOT_SPACE, buffer_of, covered, hash_spans, per_row, run_windows, spread, window_hashes, words_of

LENGTH, SEED = 20, 6
SHARD_BYTES, BUCKET_BYTES = 4 << 20, 16 << 20
#: Words in the patterns of one automaton; more patterns make more automata.
PATTERN_WORDS = 500_000


def word_symbols(table: pa.Table):
    w = words_of(*buffer_of(table.column("text")), NOT_SPACE)
    h = hash_spans(w.data, w.starts, w.ends)
    return h, h, w.first


def later_windows(values: np.ndarray, bounds: np.ndarray, docs: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which windows of the rows have an equal one at a lower (doc, place); starts: where each row begins in its doc."""
    flags = np.zeros(len(values), bool)
    at, row = run_windows(bounds, length)
    if not len(at):
        return flags
    keys = window_hashes(values, length)[at]
    place = starts[row].astype(np.int64) + at - bounds[row]
    order = np.lexsort((place, docs[row], keys))
    keys, doc, place = keys[order], docs[row][order], place[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    flags[at[order]] = (doc != doc[head]) | (place != place[head])
    return flags


def letters(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and a code point for each; surrogates are left out."""
    known = np.unique(values)
    points = np.arange(len(known), dtype=np.uint32) + np.uint32(16)
    points[points >= 0xD800] += 0x800
    return known, points


def found(words: np.ndarray, first: np.ndarray, low: np.ndarray, size: np.ndarray):
    """(pattern, start) of every occurrence of the runs [low, low + size) of words in all rows.

    Patterns are dealt to automata in order, PATTERN_WORDS words each.
    """
    shard = np.cumsum(size) // PATTERN_WORDS
    for a in range(int(shard[-1]) + 1 if len(shard) else 0):
        own = np.flatnonzero(shard == a)
        if not len(own):
            continue
        inside = words[spread(low[own], size[own])]
        known, points = letters(inside)
        if len(known) > 1_000_000:
            raise ValueError("a pattern has more distinct words than there are letters")
        at = np.minimum(np.searchsorted(known, words), len(known) - 1)
        spelled = np.where(known[at] == words, points[at], np.uint32(1))
        text = np.full(len(words) + len(first) - 1, 2, np.uint32)  # 2 ends a row, 1 is any other word
        shift = spread(first[:-1] + np.arange(len(first) - 1), np.diff(first))
        text[shift] = spelled
        automaton = ahocorasick.Automaton()
        for k, b, n in zip(own.tolist(), low[own].tolist(), size[own].tolist(), strict=True):
            automaton.add_word(spelled[b : b + n].tobytes().decode("utf-32-le"), (k, n))
        automaton.make_automaton()
        hits = [(k, end - n + 1) for end, (k, n) in automaton.iter(text.tobytes().decode("utf-32-le"))]
        if hits:
            pattern, start = np.array(hits, np.int64).T
            row = np.searchsorted(first + np.arange(len(first)), start, side="right") - 1
            yield pattern, start - row


def remove_passages(docs: DataFrame, length: int = LENGTH, seed: int = SEED, shard_bytes: int = SHARD_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of docs (doc_id, text): n_words, n_removed, kept.

    Words are runs without white space. Removed is every word covered by a window of
    ``length`` words that also starts earlier: in a smaller doc_id (null is smallest), or
    the same and an earlier word. kept joins the other words by single spaces. Null texts
    have no words; rows that repeat an id start nothing earlier than each other; other
    columns are ignored.
    """

    def compare(values, bounds, docs, starts):
        return later_windows(values, bounds, docs, starts, length)

    def finish(table: pa.Table, r: Runs, v: Verdict) -> pa.Table:
        data, bounds = buffer_of(table.column("text"))
        w = words_of(data, bounds, NOT_SPACE)
        words = hash_spans(data, w.starts, w.ends)
        head = r.heads[v.record]
        low, size = r.low[head], r.high[head] + length - r.low[head]
        doc, start = v.doc, v.start.astype(np.int64)
        late = late_windows(r, v)
        spans = [(late[0], late[1] + length)]
        for pattern, at in found(words, w.first, low, size):
            row = np.searchsorted(w.first, at, side="right") - 1
            own, place = r.ids[row], at - w.first[row]
            later = (own > doc[pattern]) | ((own == doc[pattern]) & (place > start[pattern]))
            spans.append((at[later], at[later] + size[pattern][later]))
        gone = covered(np.concatenate([a for a, _ in spans]), np.concatenate([b for _, b in spans]), len(words))
        counts = np.diff(w.first)
        left = per_row(~gone, w.first)
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_words": pa.array(counts.astype(np.int64)),
                "n_removed": pa.array(counts.astype(np.int64) - left),
                "kept": joined(data, w.starts[~gone], w.ends[~gone], left),
            }
        )

    return repeated_windows(docs, word_symbols, compare, finish, "doc_id long, n_words long, n_removed long, kept string", length, seed, "<u8", shard_bytes, bucket_bytes, later=True)


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Texts of counts words each, joined by single spaces."""
    size = ends - starts + 1  # a word and the space after it
    total = np.concatenate([[0], np.cumsum(size)])
    buffer = np.full(int(total[-1]), 0x20, np.uint8)
    buffer[spread(total[:-1], size - 1)] = data[spread(starts, size - 1)]
    cuts = total[np.concatenate([[0], np.cumsum(counts)])].tolist()
    raw = buffer.tobytes()
    return pa.array([raw[a : b - 1] if b > a else b"" for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()).cast(pa.string())
