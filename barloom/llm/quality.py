"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

Terms are triples of neighbouring character classes (letters, case, digits, each common
mark) and bands of repetition. A weighted term vector is projected to the leading
singular directions of a bounded labelled sample; every document is compared with all
labelled vectors in blocks, and its nearest ones vote with their cosine as weight.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import extended, trimmed
from .rules import counts_of
from .text import NOT_SPACE, buffer_of, hash_spans, per_row, pieces, words_of

CLASS = np.zeros(256, np.int64)
CLASS[0x61:0x7B] = CLASS[0x80:] = 1
CLASS[0x41:0x5B] = 2
CLASS[0x30:0x3A] = 3
CLASS[[9, 11, 12, 13, 32]] = 4
CLASS[10] = 5
for _k, _mark in enumerate(b".,;:!?'\"()-_/|#*$%&<>=@+[]"):
    CLASS[_mark] = min(6 + _k, 31)
TRIPLES, BANDS = 32**3, 16
TERMS = TRIPLES + 4 * BANDS
SLICE = 1 << 20


def term_counts(data: np.ndarray, bounds: np.ndarray):
    """For each text the numbers of its terms, ascending, and their log-scaled counts."""
    c = CLASS[data]
    triples = (c[:-2] << 10) | (c[1:-1] << 5) | c[2:] if len(c) > 2 else np.zeros(0, np.int64)
    counts = counts_of(data, bounds)
    words = np.maximum(counts[:, 0], 1)
    w = words_of(data, bounds, NOT_SPACE)
    h, again = hash_spans(data, w.starts, w.ends), np.zeros(len(w.starts), bool)
    again[1:] = h[1:] == h[:-1]
    again[w.first[:-1][w.first[:-1] < len(again)]] = False
    bands = np.stack([counts[:, 3] / np.maximum(words / 10, 1), counts[:, 4] / words, per_row(again, w.first) / words, np.log2(words) / 16], axis=1)
    bands = np.minimum((bands * BANDS).astype(np.int64), BANDS - 1) + TRIPLES + BANDS * np.arange(4)
    for k in range(len(bounds) - 1):
        n = np.bincount(triples[bounds[k] : max(bounds[k], bounds[k + 1] - 2)], minlength=TRIPLES)
        at = np.flatnonzero(n)
        if not counts[k, 0]:
            yield np.zeros(0, np.int64), np.zeros(0, np.float32)
            continue
        yield np.concatenate([at, bands[k]]), np.concatenate([1 + np.log(n[at]), [2.0, 2.0, 2.0, 1.0]]).astype(np.float32)


@dataclass
class Model:
    """Term weights times singular directions (a row a term), labelled unit vectors and their labels."""

    place: np.ndarray
    project: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    power: float

    @classmethod
    def fit(cls, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int, terms: int, neighbours: int, power: float, seed: int) -> Model:
        df = np.zeros(TERMS)
        for at, _ in rows:
            df[at] += 1
        used = np.sort(np.argsort(-df, kind="stable")[: min(terms, int((df > 1).sum()))])
        place = np.full(TERMS, -1, np.int64)
        place[used] = np.arange(len(used))
        idf = np.log(1 + len(rows) / np.maximum(df[used], 1)).astype(np.float32)
        x = np.zeros((len(rows), len(used)), np.float32)
        for k, (at, value) in enumerate(rows):
            p = place[at]
            x[k, p[p >= 0]] = value[p >= 0] * idf[p[p >= 0]]
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        rng = np.random.default_rng(seed)
        width = min(rank + 16, *x.shape)
        span = x @ rng.standard_normal((x.shape[1], width)).astype(np.float32)
        for _ in range(3):  # power steps of the randomised range finder
            span = x @ (x.T @ np.linalg.qr(span)[0])
        q = np.linalg.qr(span)[0]
        directions = np.linalg.svd(q.T @ x, full_matrices=False)[2][: min(rank, width)].T
        vectors = x @ directions
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        return cls(place, np.ascontiguousarray(directions * idf[:, None]), vectors.astype(np.float32), labels.astype(np.float32), neighbours, power)

    def scores(self, rows) -> np.ndarray:
        latent = []
        for at, value in rows:
            p = self.place[at]
            latent.append(value[p >= 0] @ self.project[p[p >= 0]])
        prior = float(self.labels.mean())
        x = np.array(latent, np.float32).reshape(len(latent), self.project.shape[1])
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        out = np.full(len(x), prior)
        k = min(self.neighbours, len(self.labels))
        for a in range(0, len(x), 256):
            cosine = x[a : a + 256] @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** self.power
            total = weight.sum(axis=1)
            vote = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
            out[a : a + 256] = np.where(total > 1e-12, vote, prior)
        return np.clip(out, 0, 1)


def fit_quality(
    docs: DataFrame, labels: DataFrame, sample: int = 4000, rank: int = 48, terms: int = 4096, neighbours: int = 15, power: float = 4.0, seed: int = 11
) -> Model | None:
    """A model from at most ``sample`` labelled rows (those of lowest id hash); None without any.

    labels (doc_id, quality) are those to learn from; null ones are ignored, and of several
    for one id the lowest counts. Only the sampled texts' term counts reach the driver.
    """
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("mark"))
    chosen = F.broadcast(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    found = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "mark", "text")

    def run(batches):
        for batch in batches:
            for a, b in pieces(batch.column(2), SLICE):
                rows = list(term_counts(*buffer_of(batch.column(2).slice(a, b - a))))
                columns = [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)]
                columns += [pa.array([r[k].tolist() for r in rows], kind) for k, kind in enumerate((pa.list_(pa.int64()), pa.list_(pa.float32())))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "at", "value"])

    rows = found.mapInArrow(trimmed(run), "doc_id long, mark int, at array<long>, value array<float>").orderBy(F.xxhash64("doc_id", "at")).limit(sample).toArrow()
    if not rows.num_rows:
        return None
    pairs = [(np.array(a, np.int64), np.array(v, np.float32)) for a, v in zip(rows.column("at").to_pylist(), rows.column("value").to_pylist(), strict=True)]
    return Model.fit(pairs, np.asarray(rows.column("mark")), rank, terms, neighbours, power, seed)


def score_quality(docs: DataFrame, model: Model | None, text: str = "text", out: str = "score") -> DataFrame:
    """docs with a score from 0 to 1, higher where label 1 is likelier. No shuffle.

    A text without words, or without any similar labelled one, gets the share of label 1
    in the sample; without a model all get 0.5. All columns and repeated rows stay; a
    column named as the output is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    source, place = docs.select(*[f"`{c}`" for c in kept]), kept.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model) if model else None

    def run(batches):
        for batch in batches:
            for a, b in pieces(batch.column(place), SLICE):
                part = batch.slice(a, b - a)
                scores = shared.value.scores(term_counts(*buffer_of(part.column(place)))) if shared else np.full(b - a, 0.5)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], names=[*batch.schema.names, out])

    return source.mapInArrow(trimmed(run), extended(source.schema, **{out: "double"}))
