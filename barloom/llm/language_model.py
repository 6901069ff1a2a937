"""Language-model scores by a weighted backoff automaton of word pairs.

States are the root and one for each known word (what was read last). A state has an arc
for each pair of the training text that begins with its word, weighted with the smoothed
log-probability, and a failure arc to the root, weighted with the mass left over; the root
has an arc for every known word and one for all others. One pass from left to right
carries the state of each text and adds up the weights.

Counts cover all training texts and are never gathered in one place: a shard of texts asks
for its own words and pairs, packed by hash bucket, and gets their global counts back. Of
the pairs it asks only for those whose words both train and both stand in other shards
too; other pairs have no counts to give or to get.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import shards_for, text_bytes
from .text import GOLDEN, LOWER, NOT_SPACE, buffer_of, hash_spans, mix, words_of

SHARD_BYTES, BUCKET_BYTES = 9 << 20, 12 << 20
#: Weight of the lower order, as a number of observations.
PRIOR = 200.0
END, START = np.uint64(1), np.uint64(2)
ASKED = "bucket int, shard int, keys binary, counts binary"


class Texts:
    """Token hashes of a shard: each text's words, then END; and which texts train."""

    def __init__(self, table: pa.Table):
        data, bounds = buffer_of(table.column("text"))
        data = LOWER[data]
        w = words_of(data, bounds, NOT_SPACE)
        self.length = np.diff(w.first) + 1
        self.first = np.concatenate([[0], np.cumsum(self.length)])
        self.tokens = np.full(self.first[-1], END, np.uint64)
        inner = np.ones(len(self.tokens), bool)
        inner[self.first[1:] - 1] = False
        self.tokens[inner] = hash_spans(data, w.starts, w.ends)
        self.before = np.full(len(self.tokens), START, np.uint64)
        self.before[1:] = self.tokens[:-1]
        self.before[self.first[:-1]] = START
        trains = np.asarray(table.column("trains").combine_chunks())
        self.trains = np.repeat(trains.astype(bool), self.length)
        self.texts = int(trains.sum())
        self.words, self.word = np.unique(self.tokens, return_inverse=True)
        self.own = np.bincount(self.word[self.trains], minlength=len(self.words))


def narrow(counts: np.ndarray) -> bytes:
    """Counts as unsigned integers of 1, 2, 4 or 8 bytes, as the largest needs."""
    top = int(counts.max()) if len(counts) else 0
    return counts.astype(next(k for k in ("u1", "<u2", "<u4", "<u8") if top <= np.iinfo(k).max)).tobytes()


def widened(buffer, n: int) -> np.ndarray:
    return np.frombuffer(buffer, {0: "u1", 1: "u1", 2: "<u2", 4: "<u4", 8: "<u8"}[len(buffer) // max(n, 1)]).astype(np.int64)


def packed(shard: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.Table:
    """One row a bucket, keys ascending in each."""
    bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
    some = np.flatnonzero(np.diff(cuts))
    keys, counts = keys[order], counts[order]
    return pa.table(
        {
            "bucket": pa.array(some.astype(np.int32)),
            "shard": pa.array(np.full(len(some), shard, np.int32)),
            "keys": pa.array([keys[cuts[b] : cuts[b + 1]].tobytes() for b in some], pa.binary()),
            "counts": pa.array([narrow(counts[cuts[b] : cuts[b + 1]]) for b in some], pa.binary()),
        }
    )


def unpacked(rows: pa.Table, keys: np.ndarray, buckets: int) -> np.ndarray:
    """What ``summed`` returned for the keys that ``packed`` sent."""
    bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    out = np.zeros(len(keys), np.int64)
    cuts = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
    for b, counts in zip(rows.column("bucket").to_pylist(), rows.column("counts"), strict=True):
        out[order[cuts[b] : cuts[b + 1]]] = widened(counts.as_buffer(), cuts[b + 1] - cuts[b])
    return out


def summed(asked: DataFrame) -> DataFrame:
    """Answers (shard, bucket, counts) in the order asked: global counts times two, plus one if other shards asked too.

    n and v of a bucket stand in its first row.
    """

    def run(rows: pa.Table) -> pa.Table:
        parts = [np.frombuffer(k.as_buffer(), "<u8") for k in rows.column("keys")]
        counts = np.concatenate([widened(c.as_buffer(), len(p)) for c, p in zip(rows.column("counts"), parts, strict=True)])
        keys, at = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(at, counts, minlength=len(keys)).astype(np.int64)
        shared = np.bincount(at, minlength=len(keys)) > 1
        back, cuts = (total * 2 + shared)[at], np.cumsum([0, *map(len, parts)])
        plain = keys != START
        zeros = [0] * (len(parts) - 1)
        return pa.table(
            {
                "shard": rows.column("shard"),
                "bucket": rows.column("bucket"),
                "counts": pa.array([narrow(back[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
                "n": pa.array([int(total[plain].sum()), *zeros], pa.int64()),
                "v": pa.array([int((total[plain] > 0).sum()), *zeros], pa.int64()),
            }
        )

    return asked.groupBy("bucket").applyInArrow(run, "shard int, bucket int, counts binary, n long, v long")


class Automaton:
    """The part of the model that a shard's texts can walk on. State 0 is the root; state s stands for history s - 1."""

    def __init__(self, history_counts: np.ndarray, word_weights: np.ndarray, arc_keys: np.ndarray, arc_weights: np.ndarray):
        self.states = len(history_counts) + 1
        self.failure = np.concatenate([[0.0], np.log10(PRIOR / (history_counts + PRIOR))])
        self.root, self.arcs, self.weights = word_weights, arc_keys, arc_weights

    def walk(self, first: np.ndarray, length: np.ndarray, words: np.ndarray, follow: np.ndarray, start: int) -> np.ndarray:
        """Summed weights of each text; all texts take one step at a time, the longest first."""
        order = np.argsort(-length, kind="stable")
        state = np.full(len(order), start, np.int64)
        total = np.zeros(len(order))
        live = len(order)
        size, begin = length[order], first[:-1][order]
        for step in range(int(size[0]) if len(size) else 0):
            while live and size[live - 1] <= step:
                live -= 1
            word = words[begin[:live] + step]
            key = state[:live] * len(self.root) + word
            at = np.minimum(np.searchsorted(self.arcs, key), max(len(self.arcs) - 1, 0))
            arc = self.arcs[at] == key if len(self.arcs) else np.zeros(live, bool)
            fail = self.failure[state[:live]] + self.root[word]
            total[:live] += np.where(arc, self.weights[at], fail) if len(self.arcs) else fail
            state[:live] = follow[word]
        out = np.empty(len(order))
        out[order] = total
        return out


def score_texts(docs: DataFrame, trains, shard_bytes: int = SHARD_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of docs (doc_id, text): n_tokens, n_known, train_tokens, base_score, score.

    trains is a boolean column of docs: whether a row is learned from (null: no). Words
    are ASCII-lower-cased runs without white space, then one END; null and empty texts are
    an END alone. base_score is the add-one unigram log10 probability, score that of the
    automaton: P(w | u) = (c(uw) + PRIOR P(w)) / (c(u) + PRIOR), P the add-one unigram.
    Without training rows both are the unigram's over N = V = 0. Repeated rows count
    each; other columns are ignored.
    """
    total = text_bytes(docs)
    shards, buckets = shards_for(total, shard_bytes), shards_for(total, bucket_bytes)
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int")
    spread = docs.select(shard.alias("shard"), F.col("doc_id").cast("long"), "text", F.coalesce(trains, F.lit(False)).alias("trains"))

    def ask_words(table: pa.Table) -> pa.Table:
        t = Texts(table)
        return packed(table.column("shard")[0].as_py(), np.append(t.words, START), np.append(t.own, t.texts), buckets)

    def pairs_of(t: Texts, answer: np.ndarray):
        """Distinct pairs: key, a place of each, the pair of each token, history word, own training counts, which to ask for."""
        keys, at, pair = np.unique(mix(t.before * GOLDEN) ^ t.tokens, return_index=True, return_inverse=True)
        own = np.bincount(pair[t.trains], minlength=len(keys))
        away = (answer > 1) & (answer % 2 == 1)  # trains, and stands in other shards
        history = np.where(t.before[at] == START, len(t.words), np.searchsorted(t.words, t.before[at]))
        asks = away[t.word[at]] & away[history]
        return keys, at, pair, history, own, asks

    def ask_pairs(table: pa.Table, answers: pa.Table) -> pa.Table:
        t = Texts(table)
        keys, _, _, _, own, asks = pairs_of(t, unpacked(answers, np.append(t.words, START), buckets))
        return packed(table.column("shard")[0].as_py(), keys[asks], own[asks], buckets)

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        t = Texts(table)
        paired = np.asarray(answers.column("pairs").combine_chunks())
        words, more = answers.filter(pa.array(~paired)), answers.filter(pa.array(paired))
        answer = unpacked(words, np.append(t.words, START), buckets)
        c, begun = answer[:-1] // 2, answer[-1] // 2
        n, v = words.column("total_n")[0].as_py(), words.column("total_v")[0].as_py()
        keys, at, pair, history, own, asks = pairs_of(t, answer)
        both = own.astype(np.int64)
        both[asks] = unpacked(more, keys[asks], buckets) // 2
        unigram = (c + 1.0) / (n + v + 1.0)
        seen = np.append(c, begun)
        arc = both > 0
        chance = (both + PRIOR * unigram[t.word[at]]) / (seen[history] + PRIOR)
        codes = (history + 1) * len(t.words) + t.word[at]
        order = np.argsort(codes[arc])
        automaton = Automaton(seen, np.log10(unigram), codes[arc][order], np.log10(chance[arc][order]))
        follow = np.where(c > 0, np.arange(len(c)) + 1, 0)
        base = np.add.reduceat(np.log10(unigram)[t.word], t.first[:-1])
        known = np.add.reduceat((c > 0)[t.word].astype(np.int64), t.first[:-1])
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_tokens": pa.array(t.length.astype(np.int64)),
                "n_known": pa.array(known),
                "train_tokens": pa.array(np.full(len(t.length), n, np.int64)),
                "base_score": pa.array(base),
                "score": pa.array(automaton.walk(t.first, t.length, t.word, follow, len(t.words) + 1 if begun else 0)),
            }
        )

    grouped = spread.groupBy("shard")
    words = summed(grouped.applyInArrow(ask_words, ASKED))
    totals = words.agg(F.struct(F.sum("n").alias("n"), F.sum("v").alias("v")).alias("t")).scalar()
    word_answers = words.select(F.col("shard").alias("at"), "bucket", "counts")
    pair_answers = summed(grouped.cogroup(word_answers.groupBy("at")).applyInArrow(ask_pairs, ASKED)).select(F.col("shard").alias("at"), "bucket", "counts")
    both = word_answers.withColumn("pairs", F.lit(False)).unionByName(pair_answers.withColumn("pairs", F.lit(True)))
    both = both.withColumn("t", totals).select("at", "bucket", "counts", "pairs", F.col("t.n").alias("total_n"), F.col("t.v").alias("total_v"))
    return grouped.cogroup(both.groupBy("at")).applyInArrow(score, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
