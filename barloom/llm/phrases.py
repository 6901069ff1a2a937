"""Benchmark decontamination by a distributed positional inverted index.

Documents are indexed in shards of some megabytes where they lie: for each term of a
shard one posting list of ascending places, and one layout row that tells which places
belong to which document. Documents of a shard are set apart by a gap, so that no phrase
reaches over a bound. A phrase is looked up only in shards that hold its rarest term;
there the lists are intersected from the rarest term on, each shifted by its offset.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import kept_table, trimmed
from .text import ALNUM, LOWER, buffer_of, covered, pieces, spread, words_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
INDEX = "shard long, term string, n long, places binary, ids array<long>, words array<long>"
#: Up to so many terms the query's vocabulary goes to the tasks that build the index; beyond, all terms are indexed.
VOCABULARY_TERMS = 100_000
GAP = 64


def lowered(text):
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrases_of(items: DataFrame, window: int) -> DataFrame:
    """(words, items): each distinct run of ``window`` words, and the sorted ids of the items that have it.

    An item of fewer words, but not none, is one run; ids are strings.
    """
    words = F.regexp_extract_all(lowered(F.coalesce("text", F.lit(""))), F.lit(WORD), F.lit(0))
    listed = items.select(F.col("item_id").cast("string").alias("item"), words.alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - (window - 1)))
    runs = listed.select("item", F.explode(F.transform(starts, lambda i: F.slice("all", i, window))).alias("words"))
    return runs.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))


def positional_index(docs: DataFrame, vocabulary: list[str] | None = None, gap: int = GAP) -> DataFrame:
    """Postings of docs (doc_id, text), sharded as the rows lie; no shuffle.

    Rows with a term: n places of it in the shard (ascending, little-endian unsigned
    32-bit). The row without one is the shard's layout: ids and word counts of its
    documents in order, with ``gap`` places after each. With a vocabulary only its terms
    are posted, layouts stay whole. Null texts have no words; rows with equal ids stay
    apart. Write the result before use: shard numbers are dealt as tasks read.
    """
    terms = None if vocabulary is None else pa.array(vocabulary, pa.large_binary())

    def run(batches):
        shard = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1)
            for a, b in pieces(texts):
                shard += 1
                data, bounds = buffer_of(texts.slice(a, b - a))
                data = LOWER[data]
                w = words_of(data, bounds, ALNUM)
                counts = np.diff(w.first)
                places = spread(np.cumsum(counts + gap) - counts - gap, counts).astype("<u4")
                letters = np.zeros(len(w.starts) + 1, np.int64)
                np.cumsum(w.ends - w.starts, out=letters[1:])
                words = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(w.starts), [None, pa.py_buffer(letters), pa.py_buffer(data[ALNUM[data]])]
                )
                if terms is None:
                    coded = words.dictionary_encode()
                    known, codes = coded.dictionary, np.asarray(coded.indices)
                else:
                    known, codes = terms, np.asarray(pc.fill_null(pc.index_in(words, value_set=terms), -1))
                    hit = codes >= 0
                    codes, places = codes[hit], places[hit]
                order = np.argsort(codes.astype(np.uint16), kind="stable") if len(known) < 1 << 16 else np.argsort(codes, kind="stable")
                codes, places = codes[order], places[order]
                cuts = np.flatnonzero(np.diff(codes, prepend=-1))
                ends = np.append(cuts[1:], len(codes))
                lists = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(cuts), [None, pa.py_buffer(np.append(cuts, len(codes)).astype(np.int64) * 4), pa.py_buffer(places)]
                ).cast(pa.binary())
                n = len(cuts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n + 1, shard, np.int64)),
                        pa.concat_arrays([known.take(pa.array(codes[cuts])).cast(pa.binary()).cast(pa.string()), pa.nulls(1, pa.string())]),
                        pa.array(np.append(ends - cuts, len(w.starts)).astype(np.int64)),
                        pa.concat_arrays([lists, pa.nulls(1, pa.binary())]),
                        pa.concat_arrays([pa.nulls(n, pa.list_(pa.int64())), pa.array([batch.column(0).slice(a, b - a).to_pylist()], pa.list_(pa.int64()))]),
                        pa.concat_arrays([pa.nulls(n, pa.list_(pa.int64())), pa.array([counts.tolist()], pa.list_(pa.int64()))]),
                    ],
                    names=["shard", "term", "n", "places", "ids", "words"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(run), INDEX)


def occurrences(lists: dict[str, np.ndarray], phrase: list[str], slack: int = 0) -> np.ndarray:
    """Places where the phrase starts: lists intersected from the rarest term, shifted by offsets.

    With slack, every other term may stand up to so many places off (proximity).
    """
    if any(t not in lists for t in phrase):
        return np.zeros(0, np.int64)
    order = sorted(range(len(phrase)), key=lambda k: len(lists[phrase[k]]))
    starts = lists[phrase[order[0]]].astype(np.int64) - order[0]
    starts = starts[starts >= 0]
    for k in order[1:]:
        if not len(starts):
            break
        places = lists[phrase[k]]
        at = np.searchsorted(places, starts + k - slack)
        near = places[np.minimum(at, len(places) - 1)].astype(np.int64)
        starts = starts[(at < len(places)) & (near <= starts + k + slack) & (near >= starts + k - slack)]
    return starts


def search(index: DataFrame, phrases: DataFrame, slack: int = 0, gap: int = GAP) -> DataFrame:
    """One row for each indexed document: doc_id, n_words, n_hit words inside occurrences, sorted items that occur.

    phrases is (words, items) of distinct phrases no longer than gap - slack. The work of
    a shard is its postings and the phrases whose rarest term it holds, so a big phrase
    set is dealt with in such blocks.
    """
    postings = index.where(F.col("term").isNotNull())
    weights = postings.groupBy("term").agg(F.sum("n").alias("total"))
    keyed = phrases.withColumn("phrase", F.xxhash64(F.concat_ws(" ", "words")))
    terms = keyed.select("phrase", "words", "items", F.explode(F.array_distinct("words")).alias("term"))
    rarest = (
        terms.join(weights, "term")
        .groupBy("words", "items")
        .agg(F.min_by("term", "total").alias("term"), F.count(F.lit(1)).alias("found"))
        .where(F.col("found") == F.size(F.array_distinct("words")))
    )
    routed = postings.select(F.col("shard").alias("at"), "term").join(rarest, "term").select("at", F.col("words").alias("phrase"), F.col("items").alias("owners"))

    def run(posted: pa.Table, asked: pa.Table) -> pa.Table:
        terms, layout = posted.column("term").to_pylist(), 0
        lists = {}
        for k, t in enumerate(terms):
            if t is None:
                layout = k
            else:
                lists[t] = np.frombuffer(posted.column("places")[k].as_buffer(), "<u4")
        ids, words = posted.column("ids")[layout].as_py(), np.array(posted.column("words")[layout].as_py(), np.int64)
        begin = np.cumsum(words + gap) - words - gap
        width = int(begin[-1] + words[-1] + gap) if len(words) else 0
        spans, found = [], [set() for _ in ids]
        for phrase, items in zip(asked.column("phrase").to_pylist(), asked.column("owners").to_pylist(), strict=True):
            starts = occurrences(lists, phrase, slack)
            if len(starts):
                spans.append((starts, starts + len(phrase) + slack))
                for doc in np.unique(np.searchsorted(begin, starts, side="right") - 1).tolist():
                    found[doc].update(items)
        hits = np.zeros(width + 1, np.int64)
        if spans:
            hits[1:] = np.cumsum(covered(np.concatenate([a for a, _ in spans]), np.minimum(np.concatenate([b for _, b in spans]), width), width))
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_words": pa.array(words),
                "n_hit": pa.array(hits[np.minimum(begin + words, width)] - hits[begin] if len(words) else words, pa.int64()),
                "items": pa.array([sorted(f) for f in found], pa.list_(pa.string())),
            }
        )

    return index.groupBy("shard").cogroup(routed.groupBy("at")).applyInArrow(run, "doc_id long, n_words long, n_hit long, items array<string>")


def find_phrases(docs: DataFrame, items: DataFrame, window: int = 10, slack: int = 0) -> DataFrame:
    """Which words of docs (doc_id, text) lie inside any run of ``window`` words of items (item_id, text).

    Words are ASCII-lower-cased runs of digits, letters and non-ASCII characters. One row
    per row of docs, also for null and empty texts (no words) and repeated ids; with no
    items every n_hit is 0. Other columns of both tables are ignored.
    """
    phrases = kept_table(phrases_of(items, window), "phrases")
    some = phrases.select(F.explode("words").alias("term")).distinct().limit(VOCABULARY_TERMS + 1).collect()
    vocabulary = [r.term for r in some] if len(some) <= VOCABULARY_TERMS else None
    return search(kept_table(positional_index(docs, vocabulary), "postings"), phrases, slack)
