"""Byte-level BPE: encoding by a priority queue of merge ranks, decoding by vocabulary strings.

A pre-token's bytes form a doubly linked list of symbols. A heap holds (rank, place) of
every adjacent pair that the vocabulary can merge; the lowest is taken first, entries
whose pair has changed meanwhile are skipped, and a merge adds the pairs that it makes.
"""

from __future__ import annotations

import json
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .frames import extended, trimmed
from .text import pieces

# The public pre-tokenization pattern of this vocabulary, white space as in Unicode.
SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"
    r"|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+"
)
CACHE = 100_000
SLICE = 1 << 20


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Merges, strings and special tokens of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        ids = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.first = [0] * 256
        for letter, byte in letters.items():
            self.first[byte] = ids[letter]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in ids.items():
            self.strings[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        ids = [self.first[b] for b in word]
        n = len(ids)
        if n < 2:
            return ids
        merges, heap = self.merges, []
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for k in range(n - 1):
            found = merges.get((ids[k], ids[k + 1]))
            if found:
                heap.append((found[0], k, found[1]))
        heapify(heap)
        while heap:
            rank, k, new = heappop(heap)
            right = after[k]
            if ids[k] < 0 or right >= n:
                continue
            found = merges.get((ids[k], ids[right]))
            if not found or found[0] != rank:
                continue  # stale: a neighbour was merged away meanwhile
            ids[k], ids[right] = new, -1
            end = after[k] = after[right]
            if end < n:
                before[end] = k
                found = merges.get((new, ids[end]))
                if found:
                    heappush(heap, (found[0], k, found[1]))
            left = before[k]
            if left >= 0:
                found = merges.get((ids[left], new))
                if found:
                    heappush(heap, (found[0], left, found[1]))
        return [i for i in ids if i >= 0]


class Encoder(dict):
    """Text → ids as little-endian unsigned 32-bit integers. As a dict it keeps the pre-tokens seen lately."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.old, self.tokens = vocabulary, {}, regex.compile(PATTERN).findall

    def __missing__(self, token: str) -> bytes:
        found = self.old.get(token)
        if found is None:
            found = array("I", self.vocabulary.merge(token.encode())).tobytes()
        if len(token) > 64:
            return found
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        self[token] = found
        return found

    def encode(self, text: str) -> bytes:
        v = self.vocabulary
        if v.cut is None or not any(s in text for s in v.special):
            return b"".join(map(self.__getitem__, self.tokens(text)))
        parts = []
        for part in v.cut.split(text):
            if part in v.special:
                parts.append(array("I", [v.special[part]]).tobytes())
            else:
                parts += map(self.__getitem__, self.tokens(part))
        return b"".join(parts)


def decode_ids(vocabulary: Vocabulary, ids: bytes) -> str:
    parts = map(vocabulary.strings.__getitem__, np.frombuffer(ids, "<u4").tolist())
    return b"".join(parts).decode("utf-8", errors="replace")


def encode_documents(docs: DataFrame, path: str, text: str = "text", out: tuple[str, str] = ("ids", "n_tokens")) -> DataFrame:
    """docs with ids (binary: little-endian unsigned 32-bit) and their number.

    Null and empty texts have no ids. Special strings in a text become their ids. All
    columns of docs stay, repeated rows too; columns named as the outputs are replaced.
    path is a tokenizer file that every executor can read. A very long pre-token costs
    n log n. No shuffle.
    """
    kept = [c for c in docs.columns if c.lower() not in {o.lower() for o in out}]
    source = docs.select(*[f"`{c}`" for c in kept])
    place = kept.index(text)

    def run(batches):
        encoder = Encoder(Vocabulary(path))
        for batch in batches:
            for a, b in pieces(batch.column(place), SLICE):
                part = batch.slice(a, b - a)
                coded = [encoder.encode(t) if t else b"" for t in part.column(place).to_pylist()]
                counts = pa.array([len(c) // 4 for c in coded], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(coded, pa.binary()), counts], names=[*batch.schema.names, *out])

    return source.mapInArrow(trimmed(run), extended(source.schema, **{out[0]: "binary", out[1]: "long"}))


def decode_documents(coded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """coded with the text of its ids (null ids: empty). Bytes that aren't UTF-8 become U+FFFD."""
    kept = [c for c in coded.columns if c.lower() != out.lower()]
    source = coded.select(*[f"`{c}`" for c in kept])
    place = kept.index(ids)

    def run(batches):
        vocabulary = Vocabulary(path)
        for batch in batches:
            for a, b in pieces(batch.column(place), 4 * SLICE):
                part = batch.slice(a, b - a)
                texts = [decode_ids(vocabulary, i.as_py()) if i.is_valid else "" for i in part.column(place)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return source.mapInArrow(trimmed(run), extended(source.schema, **{out: "string"}))
