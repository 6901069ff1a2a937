"""Quality rules: text statistics, and an isolation forest on them.

The forest isolates a document by random splits of rule statistics; a short mean path
marks it as anomalous. Trees are grown on the driver from a bounded sample; statistics,
scores and the calibration of the threshold take every document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import kept_table
from .text import NOT_SPACE, buffer_of, byte_set, covered, hash_spans, mix, per_row, pieces, run_windows, window_hashes, words_of

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
STARTS_CHAR = ~byte_set((0x80, 0xBF))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 5
SLICE = 2 << 20


def equal_earlier(keys: list[np.ndarray]) -> np.ndarray:
    """Which entries equal an earlier one in all keys."""
    order = np.lexsort(keys)
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in keys:
        same &= k[order][1:] == k[order][:-1]
    out = np.zeros(len(order), bool)
    out[order[1:]] = same
    return out


def repeated_lines(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same row, by row."""
    n = len(bounds) - 1
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([bounds[:-1], breaks + 1]))
    row = np.searchsorted(bounds, starts, side="right") - 1
    ends = np.append(starts[1:], len(data))
    at_break = np.zeros(len(data) + 1, bool)
    at_break[breaks + 1] = True
    ends = ends - at_break[ends]
    word = np.zeros(len(data) + 1, np.int32)
    np.cumsum(NOT_SPACE[data], out=word[1:])
    some = (starts < ends) & (row < n)
    some[some] = word[ends[some]] > word[starts[some]]
    starts, ends, row = starts[some], ends[some], row[some]
    if not len(starts):
        return np.zeros(n, np.int64)
    # Only lines that agree in row, length and edge bytes with another are hashed whole.
    edges = hash_spans(data, starts, np.minimum(ends, starts + 16)) ^ (hash_spans(data, np.maximum(ends - 16, starts), ends) * np.uint64(3))
    key = mix(edges ^ mix((ends - starts).astype(np.uint64))) ^ row.astype(np.uint64)
    order = np.argsort(key)
    twin = np.zeros(len(key), bool)
    same = key[order][1:] == key[order][:-1]
    twin[order[1:]] |= same
    twin[order[:-1]] |= same
    starts, ends, row = starts[twin], ends[twin], row[twin]
    again = equal_earlier([hash_spans(data, starts, ends), row])
    return np.bincount(row[again], minlength=n)


def repeated_words(data: np.ndarray, w, window: int = WINDOW) -> np.ndarray:
    """Words that lie in a run of ``window`` words found twice or more in their row, by row."""
    n = len(w.first) - 1
    at, row = run_windows(w.first, window)
    if not len(at):
        return np.zeros(n, np.int64)
    keys = mix(window_hashes(hash_spans(data, w.starts, w.ends), window)[at] ^ mix(row.astype(np.uint64)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return per_row(covered(at[twice], at[twice] + window, len(w.starts)), w.first)


def counts_of(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows of COUNTS for each text."""
    w = words_of(data, bounds, NOT_SPACE)
    chars = per_row(NOT_SPACE[data] & STARTS_CHAR[data], bounds)
    return np.stack([np.diff(w.first), chars, per_row(SYMBOLS[data], bounds), repeated_lines(data, bounds), repeated_words(data, w)], axis=1)


def text_counts(docs: DataFrame) -> DataFrame:
    """(doc_id and COUNTS, long) of every row; null and empty texts count 0 everywhere. No shuffle.

    Words are runs without white space (0x09-0x0D, space); word_chars their code points;
    n_symbols characters of #*$%&|<>; n_dup_lines lines with a word that equal an earlier
    one; n_repeat_words words in runs of five that the text has twice or more.
    """

    def run(batches):
        for batch in batches:
            for a, b in pieces(batch.column(1), SLICE):
                c = counts_of(*buffer_of(batch.column(1).slice(a, b - a)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *[pa.array(c[:, k]) for k in range(len(COUNTS))]], names=["doc_id", *COUNTS])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def failed():
    """The plain rules: fewer than ten words, or over a fifth of them in repeated runs."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def traits(counts: np.ndarray) -> np.ndarray:
    """What the forest splits on: length, characters a word, and shares of symbols, repeated lines and words."""
    words, chars, symbols, lines, repeats = counts.T.astype(np.float64)
    some = np.maximum(words, 1)
    return np.stack([np.log1p(words), chars / some, np.log1p(100 * symbols / np.maximum(chars, 1)), np.log1p(lines), repeats / some], axis=1)


def path_rest(n: np.ndarray) -> np.ndarray:
    """Mean path of an unsuccessful search among n points, for leaves that hold several."""
    n = np.asarray(n, np.float64)
    big = np.maximum(n, 3)
    return np.where(n > 2, 2 * (np.log(big - 1) + np.euler_gamma) - 2 * (big - 1) / big, np.where(n == 2, 1.0, 0.0))


class Forest:
    """Isolation trees as flat arrays: node k splits column[k] at cut[k] into nodes 2k + 1 and 2k + 2."""

    def __init__(self, rows: np.ndarray, trees: int, sample: int, seed: int):
        rng = np.random.default_rng(seed)
        self.size = min(sample, len(rows))
        self.depth = max(1, int(np.ceil(np.log2(max(self.size, 2)))))
        self.nodes = 2 ** (self.depth + 1) - 1
        self.column = np.full((trees, self.nodes), -1, np.int64)
        self.cut = np.zeros((trees, self.nodes))
        self.path = np.zeros((trees, self.nodes))
        for t in range(trees):
            self._grow(t, 0, 0, rows[rng.choice(len(rows), self.size, replace=False)], rng)

    def _grow(self, tree: int, node: int, depth: int, rows: np.ndarray, rng) -> None:
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(1), np.zeros(1))
        wide = np.flatnonzero(high > low)
        if depth == self.depth or len(rows) < 2 or not len(wide):
            self.path[tree, node] = depth + path_rest(len(rows))
            return
        c = rng.choice(wide)
        cut = rng.uniform(low[c], high[c])
        self.column[tree, node], self.cut[tree, node] = c, cut
        below = rows[:, c] < cut
        self._grow(tree, 2 * node + 1, depth + 1, rows[below], rng)
        self._grow(tree, 2 * node + 2, depth + 1, rows[~below], rng)

    def anomaly(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; the shorter the mean path, the higher."""
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for column, cut, path in zip(self.column, self.cut, self.path, strict=True):
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                c = column[at]
                at = np.where(c < 0, at, 2 * at + 2 - (rows[every, c] < cut[at]))
            total += path[at]
        return 2.0 ** (-total / len(self.path) / max(float(path_rest(self.size)), 1e-9))


def anomalies(counts: DataFrame, trees: int = 100, sample: int = 256, seed: int = 17) -> DataFrame:
    """counts (of text_counts) with anomaly, from a forest on a sample of at most trees × sample rows that pass the plain rules.

    The sample is the rows of lowest id hash. Without such rows every anomaly is 0.5.
    """
    order = F.xxhash64("doc_id", *COUNTS)
    passing = counts.where(~failed())
    total, rows = passing.count(), np.zeros((0, len(COUNTS)), np.int64)
    most, share = min(trees * sample, total), 2 * trees * sample / max(total, 1)
    while len(rows) < most:  # only rows of low hash go to the driver, not a sample of every partition
        low = passing if share >= 1 else passing.where(order < int(share * 2.0**64) - 2**63)
        rows = low.orderBy(order, "doc_id").limit(trees * sample).select(*COUNTS).toPandas().to_numpy(np.int64)
        share *= 4
    forest = counts.sparkSession.sparkContext.broadcast(Forest(traits(rows), trees, sample, seed)) if len(rows) else None

    def run(batches):
        for batch in batches:
            table = np.stack([np.asarray(batch.column(c)) for c in COUNTS], axis=1)
            scores = forest.value.anomaly(traits(table)) if forest and len(table) else np.full(len(table), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, "anomaly"])

    return counts.select("doc_id", *COUNTS).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", anomaly double")


def calibrated(scored: DataFrame, labels: DataFrame, spare: float = 0.01, bins: int = 1000) -> float:
    """The anomaly above which documents are dropped, from all labelled rows.

    Of the thresholds that drop at most the share ``spare`` of the rows labelled 1, the one
    that tells the labels apart best; 1.0 (nothing is dropped) without labels of both kinds.
    """
    marked = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counted = (
        scored.where(~failed())
        .join(marked, "doc_id")
        .groupBy(F.least(F.floor(F.col("anomaly") * bins), F.lit(bins - 1)).cast("int").alias("bin"), (F.col("quality") > 0).alias("good"))
        .count()
        .collect()
    )
    table = np.zeros((2, bins + 1))
    for r in counted:
        table[int(r.good), r.bin] += r["count"]
    if not table[0].sum() or not table[1].sum():
        return 1.0
    above = table[:, ::-1].cumsum(axis=1)[:, ::-1] / table.sum(axis=1, keepdims=True)
    gain = np.where(above[1] <= spare, above[0] - above[1], -1)
    best = int(np.argmax(gain))
    return best / bins if gain[best] > 0 else 1.0


def judge(docs: DataFrame, labels: DataFrame, trees: int = 100, sample: int = 256, spare: float = 0.01) -> DataFrame:
    """Every row of docs (doc_id, text): COUNTS, anomaly, base_failed and kept.

    kept is false where the plain rules fail or the anomaly reaches the calibrated
    threshold. Null and empty texts fail the plain rules; equal rows are judged alike;
    extra columns of either table are ignored; labels may be empty or hold nulls.
    """
    scored = kept_table(anomalies(kept_table(text_counts(docs), "counts"), trees, sample), "scored")
    limit = calibrated(scored, labels, spare)
    return scored.withColumn("base_failed", failed()).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < limit))
