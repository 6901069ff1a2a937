"""Hard negatives by Four-Russians scoring.

Components become integers. Every row is kept as packed bit planes: for each plane of two's complement, one byte for
eight dimensions. Anchors are taken in chunks of at most CHUNK rows; a task that holds a chunk precomputes, for each
group of eight dimensions, the sums of all 256 subsets of the anchor's components. A candidate's byte then picks its
subset's sum, groups are added, and planes are shifted and added from the highest down: the exact inner product.

All anchors meet all rows, in blocks: chunks are broadcast one after the other (bounded by CHUNK whatever the data)
and the packed rows are read in place, so that only the best of each task and slot are shuffled. Two passes: over rows
of an anchor's label for its positives, over the rest for the negatives within the bounds that these set.

Rows alike in id, label and components count as one. Rows with a null label, a null vector or a component that is
null or not finite take no part. Shorter vectors count as padded with zeros; an empty vector scores 0. A null id is
never an anchor and comes after all others among equal scores, as would the largest long. Products that could pass 55
bits raise ValueError. Other columns are not read. An empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import kept_table, shared_dir

#: Anchors a broadcast holds at most (on average, when dealt by chance, 7/8 of it).
CHUNK = 1 << 14
#: Anchors scored at a time, candidates at a time, rows of packed candidates in a file.
ANCHORS, SLICE, FILE_ROWS = 512, 1024, 1 << 20
#: Smallest score; stands for "none yet".
NONE = -(1 << 62)
#: Stands for a null id: after all others.
LAST = (1 << 63) - 1

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def pack_planes(q: np.ndarray, bits: int) -> np.ndarray:
    """(rows, dimensions) integers → (rows, bits, groups) bytes: plane k holds bit k of two's complement, eight dimensions a byte."""
    q = np.pad(q, ((0, 0), (0, -q.shape[1] % 8)))
    return np.stack([np.packbits((q >> k & 1).astype(np.uint8), axis=1, bitorder="little") for k in range(bits)], axis=1)


def unpack_planes(planes: np.ndarray) -> np.ndarray:
    """pack_planes undone, as int64."""
    bits = planes.shape[1]
    q = np.zeros((planes.shape[0], planes.shape[2] * 8), np.int64)
    for k in range(bits):
        plane = np.unpackbits(planes[:, k], axis=1, bitorder="little").astype(np.int64)
        q += (-plane if k == bits - 1 else plane) << k
    return q


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for every group of eight dimensions the sum of each subset of an anchor's components."""
    most = int(np.abs(anchors).sum(axis=1).max(initial=0))
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
    groups = anchors.T.reshape(-1, 8, len(anchors)).astype(kind)
    sums = np.zeros((len(groups), 256, len(anchors)), kind)
    for j in range(8):
        sums[:, 1 << j : 2 << j] = sums[:, : 1 << j] + groups[:, None, j]
    return sums


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidates, anchors): inner products from the subset sums, indexed by the candidates' bytes."""
    bits, groups = planes.shape[1:]
    wide = sums.dtype.itemsize * 8 + bits
    total = np.zeros((len(planes), sums.shape[2]), np.int32 if wide <= 31 else np.int64)
    plane, one = np.empty((2, *total.shape), sums.dtype)
    for k in range(bits - 1, -1, -1):
        plane[:] = 0
        for g in range(groups):
            np.take(sums[g], planes[:, k, g], axis=0, out=one, mode="clip")
            plane += one
        if k == bits - 1:
            total -= plane
        else:
            total <<= 1
            total += plane
    return total


class Best:
    """For each slot the first `size` (score, id), higher scores first, then smaller ids; rows must come with ascending ids."""

    def __init__(self, slots: int, size: int):
        self.score = np.full((slots, size), NONE, np.int64)
        self.id = np.full((slots, size), LAST, np.int64)

    def least(self, slots: np.ndarray) -> np.ndarray:
        """A new row must score more than this."""
        return self.score[slots, -1]

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        size = self.score.shape[1]
        who = np.unique(slot)
        slot = np.concatenate([np.repeat(who, size), slot])
        score = np.concatenate([self.score[who].ravel(), score])
        ids = np.concatenate([self.id[who].ravel(), ids])
        order = np.lexsort((ids, -score, slot))
        slot = slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kept = rank < size
        at = order[kept]
        self.score[slot[kept], rank[kept]] = score[at]
        self.id[slot[kept], rank[kept]] = ids[at]

    def batches(self) -> Iterator[pa.RecordBatch]:
        slot, rank = np.nonzero(self.score != NONE)
        for k in range(0, len(slot), 1 << 16):
            s, r = slot[k : k + (1 << 16)], rank[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.int64()), pa.array(self.score[s, r]), pa.array(self.id[s, r])], names=["slot", "score", "id"])


def _rows(batch: pa.RecordBatch, bits: int, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, planes) of packed rows."""
    planes = np.frombuffer(b"".join(batch["planes"].to_pylist()), np.uint8).reshape(batch.num_rows, bits, groups)
    return batch["id"].to_numpy(zero_copy_only=False), batch["label"].to_numpy(zero_copy_only=False), planes


def blocks_of(labels: np.ndarray) -> list[slice]:
    """Blocks of anchors sorted by label: at most ANCHORS long, ended with a label once they hold an eighth of that."""
    found, start = [], 0
    for end in [*(np.flatnonzero(np.diff(labels)) + 1), len(labels)]:
        while end - start > ANCHORS:
            found.append(slice(start, start + ANCHORS))
            start += ANCHORS
        if end - start >= ANCHORS // 8:
            found.append(slice(start, end))
            start = end
    return [*found, slice(start, len(labels))] if start < len(labels) else found


def scored(batch: pa.RecordBatch, chunk: dict, same: bool) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(block of anchors, scores of slices of rows, whether the pair is of the asked kind, ids of the rows)."""
    bits, groups = chunk["shape"]
    ids, labels, planes = _rows(batch, bits, groups)
    for block in chunk["blocks"]:
        own = chunk["label"][block]
        first, last = own[0], own[-1]
        fit = np.flatnonzero(np.isin(labels, own) if same else (labels != first) | (first != last))
        sums = subset_sums(chunk["q"][block].astype(np.int64)) if len(fit) else None
        for k in range(0, len(fit), SLICE):
            rows = fit[k : k + SLICE]
            kind = (labels[rows, None] == own) == same
            yield block, scores(sums, planes[rows]), kind, ids[rows]


def find_positives(batches: Iterator[pa.RecordBatch], chunk: dict, size: int) -> Iterator[pa.RecordBatch]:
    """Slot: the anchor's place in the chunk. The first `size` rows of its label, itself included."""
    best = Best(len(chunk["id"]), size)
    for batch in batches:
        for block, score, kind, ids in scored(batch, chunk, True):
            slots = np.arange(block.start, block.stop)
            row, col = np.nonzero(kind & (score > best.least(slots)))
            best.add(slots[col], score[row, col].astype(np.int64), ids[row])
    yield from best.batches()


def find_negatives(batches: Iterator[pa.RecordBatch], chunk: dict, size: int) -> Iterator[pa.RecordBatch]:
    """Slot: place of the anchor × positives + the positive's place. The first `size` rows of other labels between chunk["low"] and chunk["high"] (anchors × positives, NONE: no such positive)."""
    low, high = chunk["low"], chunk["high"]
    wide = low.shape[1]
    best = Best(low.size, size)
    for batch in batches:
        for block, score, kind, ids in scored(batch, chunk, False):
            slots = np.arange(block.start, block.stop)[:, None] * wide + np.arange(wide)
            least = np.maximum(low[block], best.least(slots) + 1)  # anchors of the block × positives
            least[high[block] == NONE] = LAST
            row, col = np.nonzero(kind & (score <= high[block].max(axis=1)) & (score >= least.min(axis=1)))
            value = score[row, col].astype(np.int64)
            for j in range(wide):
                hit = (value <= high[block][col, j]) & (value >= least[col, j])
                best.add(slots[col[hit], j], value[hit], ids[row[hit]])
    yield from best.batches()


def packed_rows(vectors: DataFrame, id: str, vector: str, label: str, scale: int) -> tuple[DataFrame, int, tuple[int, int]]:
    """((id, label, planes) of all distinct valid rows, written; their number; (planes, groups))."""
    x = F.col(vector)
    valid = F.col(label).isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    rows = vectors.where(F.coalesce(valid, F.lit(False))).select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("q"))
    reach = F.aggregate(x, F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v.cast("double") * scale)))
    n, wide, most = vectors.where(F.coalesce(valid, F.lit(False))).agg(F.count(F.lit(1)), F.max(F.size(x)), F.max(reach)).first()
    wide, most = wide or 0, most or 0.0
    if wide * (most + 1) ** 2 >= 1 << 55:
        raise ValueError("inner products of these vectors pass 55 bits")
    bits, groups = int(most).bit_length() + 1, -(-wide // 8) or 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b["q"]
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            q = np.zeros((b.num_rows, wide), np.int64)
            q[np.arange(wide) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            planes = pack_planes(q, bits) if wide else np.zeros((b.num_rows, bits, groups), np.uint8)
            yield pa.RecordBatch.from_arrays([b["id"], b["label"], pa.array([p.tobytes() for p in planes], pa.binary())], names=["id", "label", "planes"])

    spark = vectors.sparkSession
    files = max(2 * spark.sparkContext.defaultParallelism, -(-n // FILE_ROWS))
    packed = rows.mapInArrow(pack, "id long, label long, planes binary").repartition(files, "id", "label", "planes").distinct()
    return kept_table(packed.withColumn("id", F.coalesce("id", F.lit(LAST))), "planes"), n, (bits, groups)


def hard_negatives(vectors: DataFrame, anchor: Column, id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
                   positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, chunk_rows: int = CHUNK) -> DataFrame:
    """RESULT for every anchor (rows where the condition `anchor` on the column `id` holds) and each of its first `positives` rows of its label:
    the first `negatives` rows of other labels with low × positive score <= 100 × score <= high × positive score, scores being inner products of floor(scale × component)."""
    spark = vectors.sparkSession
    packed, _, shape = packed_rows(vectors, id, vector, label, scale)
    chosen = packed.where(F.col("id") != LAST).withColumnRenamed("id", id).where(anchor).withColumnRenamed(id, "id")
    count = chosen.count()
    chunks = -(-count * 8 // (7 * chunk_rows))
    chosen = kept_table(chosen.withColumn("chunk", F.floor(F.rand(7) * chunks).cast("int")), "anchors")
    inside = packed.sortWithinPartitions("id")
    folder, paths = f"{shared_dir(spark)}/negatives-{uuid.uuid4().hex}", []
    for k in range(chunks):
        part = chosen.where(F.col("chunk") == k).select("id", "label", "planes").toArrow().sort_by([("label", "ascending"), ("id", "ascending")])
        if not part.num_rows:
            continue
        ids, labels, planes = _rows(part.combine_chunks().to_batches()[0], *shape)
        q = unpack_planes(planes)
        chunk = {"id": ids, "label": labels, "q": q.astype(np.int16) if np.abs(q).max(initial=0) < 1 << 15 else q, "blocks": blocks_of(labels), "shape": shape}
        own = _first(inside, chunk, find_positives, positives + 1).toArrow()
        found = _without_self(own, ids, (q * q).sum(axis=1), positives)
        chunk["high"] = found[0]
        # floors: low × high <= 100 × score, score × 100 <= high × high score
        chunk["low"] = np.where(found[0] == NONE, 0, -(-low * found[0] // 100))
        chunk["high"] = np.where(found[0] == NONE, NONE, high * found[0] // 100)
        a, j = np.nonzero(found[0] != NONE)
        if not len(a):
            continue
        others = pa.array(found[1][a, j], mask=found[1][a, j] == LAST)
        slots = pa.table({"slot": a * positives + j, "anchor_id": ids[a], "positive_id": others, "positive_score": found[0][a, j]})
        pairs = F.broadcast(spark.createDataFrame(slots))  # at most chunk × positives rows
        result = _first(inside, chunk, find_negatives, negatives).join(pairs, "slot").select(
            "anchor_id", "positive_id", "rank", F.when(F.col("id") != LAST, F.col("id")).alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        paths.append(f"{folder}/{k}")
        result.write.parquet(paths[-1])
    return spark.read.schema(RESULT).parquet(*paths) if paths else spark.createDataFrame([], RESULT)


def _first(rows: DataFrame, chunk: dict, find, size: int) -> DataFrame:
    """(slot, score, id, rank): the first `size` of each slot over all tasks."""
    sent = rows.sparkSession.sparkContext.broadcast(chunk)
    found = rows.mapInArrow(lambda batches: find(batches, sent.value, size), "slot long, score long, id long")
    return found.selectExpr("*", "row_number() OVER (PARTITION BY slot ORDER BY score DESC, id) AS rank").where(F.col("rank") <= size)


def _without_self(rows: pa.Table, ids: np.ndarray, own: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids), anchors × size, of an anchor's other rows: one row with its id and its own score is itself."""
    slot, score, found, rank = (rows[c].to_numpy().astype(np.int64) for c in ("slot", "score", "id", "rank"))
    score_at, id_at = np.full((len(ids), size + 1), NONE, np.int64), np.full((len(ids), size + 1), LAST, np.int64)
    score_at[slot, rank - 1], id_at[slot, rank - 1] = score, found
    self_at = (score_at == own[:, None]) & (id_at == ids[:, None])
    gone = np.where(self_at.any(axis=1), self_at.argmax(axis=1), size)
    kept = np.arange(size + 1) != gone[:, None]
    return score_at[kept].reshape(-1, size), id_at[kept].reshape(-1, size)
