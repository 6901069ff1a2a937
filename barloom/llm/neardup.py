"""Near-duplicate classes by DartMinHash.

A weighted set owns a region of height x for each element of weight x. Darts are thrown
at the plane (weight × rank) of each element as a Poisson process that depends on the
element's hash alone, so equal elements get equal darts in all documents. Those inside
the region and below a rank that holds k (ln k + 2) of them in expectation are dealt to k
coordinates; the earliest of each is the signature, and two signatures agree in a
coordinate with the probability of the weighted Jaccard similarity. The weight of a run of
words is how often it stands in the text; for exact tests its copies are numbered, so that
a weighted set is a plain set of (run, copy).

Bands of the signature put documents into buckets. In each bucket all are compared with
its leader, the member whose bands meet most others, exactly; links contract to classes.
Members that the leader doesn't place are few in most buckets: they are compared with the
others that two exact bounds leave open, the triangle inequality and the bits in which
parity maps of the two sets differ. In a bucket with more than CROWD of them, no product is
formed: two similar sets of which one isn't similar to the leader must have differences
to the leader in common, so members are dealt to narrower buckets by the first of their
rarest differences (as many as the least overlap leaves), and these buckets go the same way.
Members whose numbers of differences are of unlike classes have two sides in such a bucket;
only pairs across are open, so a bucket with one side alone is none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import kept_table, trimmed
from .text import GOLDEN, NOT_SPACE, buffer_of, hash_spans, mix, pieces, spread, window_hashes, words_of

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 5
SLICE = 1 << 20
#: Texts whose darts are thrown at once: short ones get as many as long ones.
THROWN = 256
#: Longs of a parity map.
MAP = 16
#: Unplaced members of a bucket that are compared with all others, rounds of narrower buckets for more.
CROWD, ROUNDS = 64, 3
#: An element in which one of so many members of a crowd differs is common to it.
COMMON = 64
#: Ends of links for each file of labels: small ones aren't written in as many files as there are shuffle partitions.
LABELS = 1 << 15
#: Rows of a bucket, and pairs of sets, for each task: small tables don't go through as many tasks as there are shuffle partitions.
TASK, PAIRS = 1 << 13, 1 << 10
# Cumulated Poisson(1) probabilities, as 64-bit thresholds.
_CDF = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 16)]))
POISSON = np.minimum(_CDF * 2.0**64, float(2**64 - 2048)).astype(np.uint64)


def in_tasks(df: DataFrame, rows: int, each: int = TASK) -> DataFrame:
    """df in no more tasks than rows ask for, those that it reads or makes, whichever are more; never in more than it has."""
    return df.coalesce(max(1, rows // each))


def digest_of():
    return F.md5(F.coalesce("text", F.lit("")).cast("binary"))


def shingles(data: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """Hashes of the runs of ``size`` words of each text; a text of fewer words, but not none, is one run."""
    w = words_of(data, bounds, NOT_SPACE)
    h = hash_spans(data, w.starts, w.ends)
    runs, out = window_hashes(h, size), []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        out.append(runs[a : b - size + 1] if b - a >= size else window_hashes(h[a:b], max(b - a, 1)))
    return out


def throw(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, sets: int, k: int) -> np.ndarray:
    """(sets × k) fingerprints of the earliest darts; every set needs a positive total weight."""
    total = np.bincount(owner, weights, minlength=sets)
    limit = k * (np.log(k) + 2) / np.maximum(total, 1e-12)
    out = np.zeros((sets, k), np.uint64)
    todo = np.arange(sets)
    while len(todo):
        live = np.isin(owner, todo) if len(todo) < sets else np.ones(len(owner), bool)
        first = np.full(sets * k, np.iinfo(np.uint64).max, np.uint64)
        print_ = np.zeros(sets * k, np.uint64)
        e, w, own = elements[live], weights[live], owner[live]
        high, wide = np.ceil(limit[own]).astype(np.int64), np.ceil(w).astype(np.int64)
        cells = high * wide
        at = np.repeat(np.arange(len(e)), cells)
        cell = spread(np.zeros(len(cells), np.int64), cells)
        rank, level = cell % high[at], cell // high[at]
        seed = mix(e[at] ^ mix((rank.astype(np.uint64) << np.uint64(32)) | level.astype(np.uint64)))
        darts = np.searchsorted(POISSON, seed, side="right")
        pick = np.repeat(np.arange(len(seed)), darts)
        number = spread(np.zeros(len(darts), np.int64), darts) + 1
        dart = mix(seed[pick] + number.astype(np.uint64) * GOLDEN)
        other = mix(dart + GOLDEN)
        at, rank, level = at[pick], rank[pick], level[pick]
        exact = (rank.astype(np.uint64) << np.uint64(32)) | (dart >> np.uint64(32))
        inside = (exact < limit[own[at]] * 2.0**32) & (level + (other >> np.uint64(32)) / 2.0**32 < w[at])
        place = own[at] * k + (other & np.uint64(0xFFFFFFFF)).astype(np.int64) % k
        place, exact, dart = place[inside], exact[inside], dart[inside]
        np.minimum.at(first, place, exact)
        won = exact == first[place]
        print_[place[won]] = dart[won]
        full = (first.reshape(sets, k) != np.iinfo(np.uint64).max).all(axis=1)
        ready = todo[full[todo]]
        out[ready] = print_.reshape(sets, k)[ready]
        todo = todo[~full[todo]]
        limit[todo] *= 2  # the same darts and as many beyond
    return out


def sketches(docs: DataFrame, words: int, bands: int, rows: int, weighted: bool) -> DataFrame:
    """(doc_id, digest, n, bands) of each row: total weight of its shingle set, and a hash of each band of its signature. No shuffle."""
    k = bands * rows

    def run(batches):
        for batch in batches:
            for a, b in pieces(batch.column(2), SLICE):
                sets = [np.unique(s, return_counts=True) for s in shingles(*buffer_of(batch.column(2).slice(a, b - a)), words)]
                sizes = np.array([len(s) for s, _ in sets])
                totals = np.array([int(c.sum()) if weighted else len(c) for _, c in sets], np.int64)
                some = np.flatnonzero(sizes)
                hashes: list = [[] for _ in sets]
                if len(some):
                    weights = np.concatenate([sets[j][1] for j in some]).astype(np.float64)
                    elements = np.concatenate([sets[j][0] for j in some])
                    weights = weights if weighted else np.ones_like(weights)
                    cuts, parts = np.concatenate([[0], np.cumsum(sizes[some])]), []
                    for p in range(0, len(some), THROWN):
                        own = sizes[some[p : p + THROWN]]
                        span = slice(cuts[p], cuts[p + len(own)])
                        parts.append(throw(elements[span], weights[span], np.repeat(np.arange(len(own)), own), len(own), k))
                    signature = np.concatenate(parts)
                    banded = signature.reshape(len(some), bands, rows)
                    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(some), bands))
                    for r in range(rows):
                        key = mix(key ^ banded[:, :, r]) + GOLDEN
                    for j, v in zip(some.tolist(), key.view(np.int64).tolist(), strict=True):
                        hashes[j] = v
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(totals), pa.array(hashes, pa.list_(pa.int64()))],
                    names=["doc_id", "digest", "n", "bands"],
                )

    source = docs.select(F.col("doc_id").cast("long"), digest_of().alias("digest"), "text")
    return source.mapInArrow(trimmed(run), "doc_id long, digest string, n long, bands array<long>")


def shingle_sets(docs: DataFrame, words: int, weighted: bool) -> DataFrame:
    """(id, members: ascending distinct hashes of shingles, or of shingles and copy numbers, packed; n: how many; map: for each of 64 × MAP bits whether an odd number of members falls on it)."""

    def run(batches):
        for batch in batches:
            for a, b in pieces(batch.column(1), SLICE):
                packed, maps = [], []
                for s in shingles(*buffer_of(batch.column(1).slice(a, b - a)), words):
                    members, counts = np.unique(s, return_counts=True)
                    if weighted:  # the first copy of a run is the run itself
                        copy = spread(np.zeros(len(counts), np.int64), counts)
                        members = np.unique(np.where(copy == 0, np.repeat(members, counts), mix(np.repeat(members, counts) + copy.astype(np.uint64) * GOLDEN)))
                    packed.append(members.tobytes())
                    odd = np.bincount((mix(members) % np.uint64(64 * MAP)).astype(np.int64), minlength=64 * MAP) & 1
                    maps.append(np.packbits(odd.astype(bool)).view(np.int64).tolist())
                columns = [batch.column(0).slice(a, b - a), pa.array(packed, pa.binary()), pa.array(maps, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "members", "map"])

    sets = docs.select("doc_id", "text").mapInArrow(trimmed(run), "id long, members binary, map array<long>")
    return sets.withColumn("n", (F.octet_length("members") / 8).cast("long"))


def near_maps(n, map_, other_n, other_map, similarity: float):
    """Whether parity maps allow sets of n and other_n elements to be that similar; never false for two that are."""
    differ = sum(F.bit_count(map_[k].bitwiseXOR(other_map[k])) for k in range(MAP))
    return differ <= (1 - similarity) / (1 + similarity) * (n + other_n) + 1e-6


def _set(x: pa.Scalar) -> np.ndarray:
    x = x.as_buffer()
    return np.frombuffer(x, "<u8", len(x) // 8)


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b) with their exact similarity."""
    left = sets.select(F.col("id").alias("a"), F.col("members").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("right"))

    def run(batches):
        for batch in batches:
            out = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                one, two = _set(x), _set(y)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                out.append(shared / (len(one) + len(two) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["a", "b", "similarity"])

    pairs = kept_table(pairs.select("a", "b"), "pairs")
    both = in_tasks(pairs.join(left, "a").join(right, "b"), max(pairs.count(), sets.count()), PAIRS)
    return both.select("a", "b", "left", "right").mapInArrow(trimmed(run), "a long, b long, similarity double")


def differences(own: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """What only one of two sets has."""
    return np.setxor1d(own, lead, assume_unique=True)


def difference_keys(own: np.ndarray, lead: np.ndarray, common: np.ndarray, lead_id: int, similarity: float) -> np.ndarray:
    """Keys of which a set shares one with every set at least that similar, where one of the two isn't so similar to the lead."""
    return sided_keys(own, lead, common, lead_id, similarity)[0]


def sided_keys(own: np.ndarray, lead: np.ndarray, common: np.ndarray, lead_id: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """difference_keys, and the side that the set has in each: 0 if the key is for sets of its own class, else -1 for the lower of two classes and 1 for the higher.

    With D the difference of a set to the lead, two similar sets x and y differ in at most d = (1 - s) / (1 + s) (|x| + |y|)
    elements, and share at least (|Dx| + |Dy| - d) / 2 of their differences, always one. So they share one of the first
    |Dx| - that + 1 of x and as many of y, in any order of all elements; here those that many differ in (common, the most
    frequent last) come last. The sizes of D are dealt to classes, and a key holds those of both sides,
    so sets of one side of a key meet by the keys of their own class.
    """
    first = differences(own, lead)
    u, n, c = len(first), len(own), (1 - similarity) / (1 + similarity)
    if not u:
        return np.zeros(0, np.int64), np.zeros(0, np.int8)
    place = {e: k + 1 for k, e in enumerate(common.tolist())}
    late = np.array([place.get(e, 0) for e in first.tolist()], np.int64)
    first = first[np.lexsort((mix(first), late))]
    wide = max(1, int(c * len(lead) / 2))
    most = c * (n + n / similarity) + 1e-6
    out, sides, mine = [], [], u // wide
    for k in range(int(max(0, u - most)) // wide, int(u + most) // wide + 1):
        v, upto = k * wide, k * wide + wide - 1
        apart = c * (n + min(n / similarity, len(lead) + upto)) + 1e-6
        shared = max(1, int(np.ceil((u + v - apart) / 2)))
        if shared <= u:
            pair = mix(np.array([min(k, mine) << 32 | max(k, mine)], np.uint64))
            out.append(mix(first[: u - shared + 1] ^ mix(pair + np.uint64(lead_id & (1 << 63) - 1))))
            sides.append(np.full(len(out[-1]), (mine > k) - (mine < k), np.int8))
    keys, at = np.unique(np.concatenate(out), return_index=True)  # those of its own class at least
    return keys.view(np.int64), np.concatenate(sides)[at]


def narrower(crowds: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(bucket, id, n, class, side) by difference keys of crowds (lead, id, class). Elements are common to a crowd if one in COMMON of its members differs in them, so there are few of them."""
    left = sets.select("id", F.col("members").alias("own"))
    right = sets.select(F.col("id").alias("lead"), F.col("members").alias("other"))

    def split(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                found = [differences(_set(x), _set(y)) for x, y in zip(*(batch.column(k).slice(start, 512) for k in (2, 3)), strict=True)]
                lead = np.repeat(batch.column(0).slice(start, 512).to_numpy(), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays([pa.array(lead), pa.array(np.concatenate(found).view(np.int64))], names=["lead", "element"])

    def keyed(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                keys, sides, sizes = [], [], []
                rows = batch.slice(start, 512)
                for lead, x, y, rare in zip(*(rows.column(k) for k in (0, 2, 3, 4)), strict=True):
                    common = np.array(rare.as_py() or [], np.int64).view(np.uint64)
                    key, side = sided_keys(_set(x), _set(y), common, lead.as_py(), similarity)
                    keys.append(key)
                    sides.append(side)
                    sizes.append(len(_set(x)))
                times = [len(k) for k in keys]
                again = [np.repeat(c, times) for c in (rows.column(1).to_numpy(), np.array(sizes, np.int64), rows.column(5).to_numpy())]
                columns = [np.concatenate(keys), *again, np.concatenate(sides)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "id", "n", "class", "side"])

    both = crowds.join(left, "id").join(right, "lead").select("lead", "id", "own", "other", "class")
    both = kept_table(in_tasks(both, crowds.count(), 256), "crowds")
    often = both.mapInArrow(trimmed(split), "lead long, element long").groupBy("lead", "element").agg(F.count(F.lit(1)).alias("times"))
    size = both.groupBy("lead").agg(F.count(F.lit(1)).alias("members"))
    often = often.where(F.col("times") > 1).join(size, "lead").where(F.col("times") * COMMON >= F.col("members"))
    common = often.groupBy("lead").agg(F.sort_array(F.collect_list(F.struct("times", "element")))["element"].alias("common"))
    keys = both.join(common, "lead", "left").select("lead", "id", "own", "other", "common", "class")
    return keys.mapInArrow(trimmed(keyed), "bucket long, id long, n long, class long, side byte").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, class): each end of links (a, b) with the least node that links connect it to.

    Each round takes the least label among neighbours, then the label of that label, so
    chains halve; labels go to the shared folder each round.
    """
    ends = links.select("a", "b").union(links.select("b", "a")).distinct()
    linked = kept_table(in_tasks(ends, links.count()), "links")
    files = max(1, linked.count() // LABELS)
    labels = linked.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("class"))
    labels = kept_table(labels.coalesce(files), "labels")
    while True:
        near = linked.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("class").alias("near"))
        lower = labels.join(near.withColumnRenamed("a", "id"), "id").select("id", "class", F.least("class", "near").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("class").alias("low2"))
        after = lower.join(jump, "low").select("id", F.least("low", "low2").alias("class"), (F.least("low", "low2") < F.col("class")).alias("moved"))
        after = kept_table(after.coalesce(files), "labels")
        labels = after.select("id", "class")
        if not after.where("moved").take(1):
            return labels


def contracted(classes: DataFrame, more: DataFrame) -> DataFrame:
    """Classes (id, class: its least id) after more links (a, b). Only these are followed, as links between classes: what earlier ones connect has one class already."""
    links, texts = more.count(), classes.count()
    if not links:
        return classes
    between = more.join(classes.select(F.col("id").alias("a"), F.col("class").alias("x")), "a").join(classes.select(F.col("id").alias("b"), F.col("class").alias("y")), "b")
    between = between.where(F.col("x") != F.col("y")).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    between = kept_table(in_tasks(between, max(links, texts)), "between")
    labels = components(between).select(F.col("id").alias("class"), F.col("class").alias("least_class"))
    after = classes.join(labels, "class", "left").select("id", F.coalesce("least_class", "class").alias("class"))
    return kept_table(in_tasks(after, texts), "classes")


def _met(buckets: DataFrame) -> DataFrame:
    """buckets of several members, not all of one side, with size (members) and less (those of the smaller side, or all without sides)."""
    own = Window.partitionBy("bucket")
    low, high = (F.count(F.when(F.col("side") == k, 1)).over(own) for k in (-1, 1))
    sized = buckets.withColumn("size", F.count(F.lit(1)).over(own))
    if "side" not in buckets.columns:
        return sized.where(F.col("size") > 1).withColumn("side", F.lit(0).cast("byte")).withColumn("less", F.col("size"))
    less = F.when(F.col("side") == 0, F.col("size")).otherwise(F.least(low, high))
    return sized.withColumn("less", less).where((F.col("size") > 1) & (F.col("less") > 0))


def placed(buckets: DataFrame, sets: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of buckets (bucket, id, n, class, side, size, less): links (a, b) of members to their bucket's leader; members with lead, lead_n, lead_class; distances (id, lead, d, tied) to leaders that were taken."""
    rows = buckets.count()
    scored = buckets.withColumn("score", F.sum("size").over(Window.partitionBy("id")))
    lead = F.max(F.struct("score", (-F.col("id")).alias("minus"), "n", "class")).over(Window.partitionBy("bucket"))
    members = scored.withColumn("l", lead).select(
        "bucket", "id", "n", "class", "side", "less", (-F.col("l.minus")).alias("lead"), F.col("l.n").alias("lead_n"), F.col("l.class").alias("lead_class")
    )
    members = kept_table(in_tasks(members, rows), "members")
    asked = members.where((F.col("class") != F.col("lead_class")) & alike(F.col("n"), F.col("lead_n"), similarity))
    pairs = in_tasks(asked.select(F.col("id").alias("a"), F.col("lead").alias("b")).distinct(), rows)
    measured = kept_table(compared(pairs, sets), "measured")
    tied = F.col("similarity") >= similarity
    d = measured.select(F.col("a").alias("id"), F.col("b").alias("lead"), (1 - F.col("similarity")).alias("d"), tied.alias("tied"))
    return measured.where(tied).select("a", "b"), members, d


def alike(n, m, similarity: float):
    """Whether sizes allow that similarity."""
    return F.least(n, m) >= similarity * F.greatest(n, m)


def unplaced(members: DataFrame, distances: DataFrame, sets: DataFrame, classes: DataFrame, similarity: float, narrow: bool) -> tuple[DataFrame, DataFrame | None]:
    """What leaders left open: (pairs (a, b) still to be compared; with narrow, (lead, id) of the buckets with a crowd of unplaced members, None without any)."""
    rows = members.count()
    bound = 1 - F.least("n", "lead_n") / F.greatest("n", "lead_n")
    own = Window.partitionBy("bucket")  # the leader is a member of its bucket
    met = members.join(distances, ["id", "lead"], "left")
    loose = (F.col("id") != F.col("lead")) & (F.col("class") != F.col("lead_class")) & ~F.coalesce("tied", F.lit(False))
    met = met.withColumn("loose", F.max(loose).over(own)).where("loose").drop("class", "lead_class")  # the others hold one class
    classed = met.join(sets.select("id", "map").join(classes, "id"), "id")
    classed = classed.withColumn("lead_class", F.max(F.when(F.col("id") == F.col("lead"), F.col("class"))).over(own))
    out = F.col("class") != F.col("lead_class")
    mixed = classed.withColumn("out", F.count(F.when(out, 1)).over(own)).where(F.col("out") > 0)
    open_ = mixed.where(F.col("id") != F.col("lead")).select(
        "bucket", "id", "lead", "n", "map", "class", "lead_class", "side", F.coalesce("d", bound).alias("low"), F.coalesce("d", F.lit(1.0)).alias("high"), F.least("out", "less").alias("crowd")
    )
    open_ = kept_table(in_tasks(open_, rows), "open")
    here = open_.where(F.col("crowd") <= CROWD) if narrow else open_
    x = here.where(out).select("bucket", *[F.col(c).alias(f"{c}_x") for c in ("id", "n", "map", "class", "side", "low", "high")])
    far = 1 - similarity + 1e-9
    near = (
        x.join(here, "bucket")
        .where((F.col("class_x") != F.col("class")) & alike(F.col("n_x"), F.col("n"), similarity))
        .where((F.col("side") == 0) | (F.col("side_x") != F.col("side")))
        .where(~out | (F.col("id_x") < F.col("id")))
        .where((F.col("low") - F.col("high_x") <= far) & (F.col("low_x") - F.col("high") <= far))
        .where(near_maps(F.col("n_x"), F.col("map_x"), F.col("n"), F.col("map"), similarity))
        .select(F.col("id_x").alias("a"), F.col("id").alias("b"))
        .distinct()
    )
    crowds = open_.where(F.col("crowd") > CROWD).select("lead", "id").distinct()
    return in_tasks(near, rows), crowds if narrow and crowds.take(1) else None


def text_classes(
    docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, weighted: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest) of every row of docs, and (digest, least, class_id, leads) of every distinct text.

    Texts are nodes by a row number of theirs, so texts that share a doc_id stay apart and
    those without one are linked too. least is the least doc_id of the text's rows (null:
    none has one), class_id that of its class; one text of each class, with that id if
    there is one, leads.
    """
    sketch = kept_table(sketches(docs, words, bands, rows, weighted).withColumn("row", F.monotonically_increasing_id()), "sketches")
    texts = sketch.groupBy("digest").agg(F.min("row").alias("id"), F.min("doc_id").alias("least"))
    texts = kept_table(in_tasks(texts, sketch.count()), "texts")
    one = sketch.join(texts.select(F.col("id").alias("row")), "row", "left_semi").select(F.col("row").alias("doc_id"), "n", "bands")
    banded = one.where(F.size("bands") > 0).select(F.col("doc_id").alias("id"), "n", F.posexplode("bands").alias("band", "key"))
    buckets = kept_table(_met(banded.select(F.xxhash64("band", "key").alias("bucket"), "id", "n", F.col("id").alias("class"))), "buckets")
    wanted = texts.join(buckets.select("id").distinct(), "id").select("id", F.col("digest").alias("own"), "least")
    chosen = docs.select(F.col("doc_id").cast("long"), digest_of().alias("digest"), "text").join(
        wanted, (F.col("digest") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("least"))
    ).select(F.col("id").alias("doc_id"), "text").dropDuplicates(["doc_id"])
    sets = kept_table(shingle_sets(in_tasks(chosen, buckets.count()), words, weighted), "sets")
    classes = sets.select("id", F.col("id").alias("class"))  # texts without a bucket keep their own
    for round_ in range(ROUNDS + 1):
        found, rest, distances = placed(buckets, sets, similarity)
        classes = contracted(classes, found)
        near, crowds = unplaced(rest, distances, sets, classes, similarity, narrow=round_ < ROUNDS)
        late = kept_table(compared(near, sets).where(F.col("similarity") >= similarity).select("a", "b"), "late")
        classes = contracted(classes, late)
        if crowds is None:
            break
        crowds = kept_table(in_tasks(crowds.join(classes, "id"), rest.count()), "crowds")
        wanted = sets.join(crowds.select("id").union(crowds.select("lead")).distinct(), "id", "left_semi")
        sets = kept_table(in_tasks(wanted, sets.count(), PAIRS), "sets")  # all that later rounds compare
        buckets = kept_table(_met(narrower(crowds, sets, similarity)), "buckets")
    named = texts.join(classes, "id", "left").withColumn("class", F.coalesce("class", "id"))
    lead = named.groupBy("class").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "id")).alias("lead"))
    return sketch.select("doc_id", "digest"), named.join(lead, "class").select(
        "digest", "least", F.col("lead.least").alias("class_id"), (F.col("id") == F.col("lead.id")).alias("leads")
    )


def near_duplicates(
    docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, weighted: bool = True
) -> DataFrame:
    """(doc_id, class_id) of every row of docs (doc_id, text).

    Two texts are linked where the weighted Jaccard similarity of their runs of ``words``
    words, weights being how often a run stands in the text, is at least ``similarity``
    (weighted=False: each run once); a class is what links connect, named by its least doc_id. With the defaults a linked pair shares a bucket
    with probability over 0.99999. Equal texts are always linked, and collapsed before
    anything else; texts without words (null, empty) equal only their like. Texts are told
    apart by their digests: several texts of one doc_id each have their own class, and a
    row without doc_id takes the class of its text, null where no text of it has an id.
    Other columns are ignored.
    """
    sketch, named = text_classes(docs, words, similarity, bands, rows, weighted)
    return sketch.join(named.select("digest", "class_id"), "digest").select("doc_id", "class_id")
