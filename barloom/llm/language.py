"""Language identification by hyperdimensional profiles.

Each letter has a random vector of ±1. An n-gram's vector binds (multiplies) its letters'
vectors, each permuted (rolled) by its place; a text bundles (adds) those of its n-grams.
A language's prototype bundles its training texts, and a text gets the language whose
prototype has the largest cosine with it.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import buffer_of, pieces

DIMENSIONS, GRAM, SEED = 1024, 3, 2024
SLICE = 2 << 20
CACHE = 20_000
#: Prototypes are sent to all tasks; more languages than this raise.
LANGUAGES = 1000


@lru_cache(1)
def letter_codes() -> np.ndarray:
    """Code point → its lower-case code point if it is a letter, else 0."""
    out = np.zeros(0x110000, np.int32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


@lru_cache(4096)
def letter_vector(code: int) -> np.ndarray:
    return np.random.default_rng((SEED, code)).integers(0, 2, DIMENSIONS, np.int8) * np.int8(2) - np.int8(1)


GRAMS: dict[tuple[int, ...], np.ndarray] = {}


def gram_vector(codes: tuple[int, ...]) -> np.ndarray:
    found = GRAMS.get(codes)
    if found is None:
        if len(GRAMS) >= CACHE:
            GRAMS.clear()
        found = np.ones(DIMENSIONS, np.int8)
        for place, code in enumerate(reversed(codes)):
            found = found * np.roll(letter_vector(code), place)
        GRAMS[codes] = found
    return found


def gram_counts(data: np.ndarray, bounds: np.ndarray):
    """Distinct n-grams as rows of code points, and (text, gram, count) of their occurrences, ordered by text.

    Letters are lower-cased; a run of other characters is one 0. n-grams with a 0 inside
    are left out: they span words.
    """
    n = len(bounds) - 1
    joined = np.insert(data, bounds[1:], 10)  # a text's end is no letter
    begins = (joined & 0xC0) != 0x80
    codes = letter_codes()[np.frombuffer(joined.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")]
    ends = np.cumsum(begins)[bounds[1:] + np.arange(n)] if n else bounds[1:]
    row = np.repeat(np.arange(n), np.diff(ends, prepend=0))
    codes, row = np.concatenate([[0], codes]), np.concatenate([[0], row])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    codes, row = codes[keep], row[keep]
    present = np.zeros(0x110000, np.int64)
    present[codes] = 1
    alphabet = np.flatnonzero(present)
    present[alphabet] = np.arange(len(alphabet))
    small, k = present[codes], len(alphabet)
    m = len(small) - GRAM + 1
    if m <= 0 or k < 2:
        return np.zeros((0, GRAM), np.int64), *(np.zeros(0, np.int64),) * 3
    key = np.zeros(m, np.int64)
    inner = np.ones(m, bool)
    for place in range(GRAM):
        key = key * k + small[place : place + m]
        if 0 < place < GRAM - 1:
            inner &= codes[place : place + m] != 0
    key = (row[1 : 1 + m] * k**GRAM + key)[inner]  # the middle letter's text
    key, counts = np.unique(key, return_counts=True)
    grams, at = np.unique(key % k**GRAM, return_inverse=True)
    spelled = np.stack([alphabet[grams // k ** (GRAM - 1 - place) % k] for place in range(GRAM)], axis=1) if len(grams) else np.zeros((0, GRAM), np.int64)
    return spelled, key // k**GRAM, at, counts


def vectors_of(spelled: np.ndarray) -> np.ndarray:
    return np.array([gram_vector(tuple(g)) for g in spelled.tolist()], np.float32).reshape(len(spelled), DIMENSIONS)


def fit_languages(docs: DataFrame) -> dict[str, np.ndarray]:
    """Unit prototype of each non-null lang of docs (text, lang), over all its texts.

    A text adds its n-grams' shares, so long ones don't outweigh. Tasks bundle their own
    texts; only sums of DIMENSIONS numbers a language are shuffled. Texts without letters
    add nothing.
    """

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for a, b in pieces(batch.column(0), SLICE):
                spelled, text, gram, count = gram_counts(*buffer_of(batch.column(0).slice(a, b - a)))
                if not len(text):
                    continue
                vectors = vectors_of(spelled)
                share = count / np.bincount(text, count)[text]
                for lang in set(langs[a:b]):
                    own = (langs[a:b] == lang)[text]
                    sums[lang] = sums.get(lang, 0) + np.bincount(gram[own], share[own], minlength=len(spelled)).astype(np.float32) @ vectors
        for lang, total in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang], "total": [np.asarray(total, np.float64).tolist()]}, schema=pa.schema({"lang": pa.string(), "total": pa.list_(pa.float64())}))

    rows = docs.where(F.col("lang").isNotNull()).select("text", F.col("lang").cast("string").alias("lang"))
    sums = rows.mapInArrow(run, "lang string, total array<double>").select("lang", F.posexplode("total").alias("place", "part"))
    found = sums.groupBy("lang", "place").agg(F.sum("part").alias("part")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "part"))).alias("total"))
    out = {r.lang: np.array([p.part for p in r.total]) for r in found.orderBy("lang").limit(LANGUAGES + 1).collect()}
    if len(out) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    return {lang: v / max(np.linalg.norm(v), 1e-9) for lang, v in out.items()}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of docs (doc_id, text); score is the cosine, 0 to 1. No shuffle.

    Null texts, and texts without a letter, are ``und`` with score 0, as are all without
    prototypes. Of equal cosines the first language by name wins.
    """
    langs = sorted(prototypes)
    shared = docs.sparkSession.sparkContext.broadcast(np.array([prototypes[x] for x in langs], np.float32).reshape(len(langs), DIMENSIONS))

    def run(batches):
        for batch in batches:
            for a, b in pieces(batch.column(1), SLICE):
                pred, score = ["und"] * (b - a), np.zeros(b - a)
                spelled, text, gram, count = gram_counts(*buffer_of(batch.column(1).slice(a, b - a)))
                if len(text) and langs:
                    vectors, count = vectors_of(spelled), count.astype(np.float32)
                    rows, cuts = np.unique(text, return_index=True)
                    for k, p, q in zip(rows.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(text)], strict=True):
                        bundle = count[p:q] @ vectors[gram[p:q]]
                        cosine = shared.value @ bundle / max(float(np.linalg.norm(bundle)), 1e-9)
                        best = int(np.argmax(cosine))
                        pred[k], score[k] = langs[best], min(max(float(cosine[best]), 0.0), 1.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(pred), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
