"""Size-aware heavy-light join of documents by Jaccard similarity of their five-word shingles.

Sets are split at a size boundary. For *small* sets every subset of the size that two partners must share is enumerated:
sets that meet in a subset are linked, nothing is left to verify. For *large* sets inverted lists are scanned: a set
enters the lists of its rarest shingles only, so many that two similar sets must meet in one, and pairs found there are
verified. The boundary is the one of least estimated cost, from the sizes of all sets and the average list length.

Documents with equal sets are one class, and lists with equal entries one list. Within a list every set is first paired
with one hub only; after these pairs are verified, lists whose sets are not yet all connected are paired in full, but only
across components. That gives the components of all links without pairing a group of copies with itself.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewake.llm import bloom
from tradewake.llm.frames import column, discard, lists, store
from tradewake.llm.graph import components
from tradewake.llm.words import SHINGLE, WordHashes, mixed, shingle_set

#: Counters of shingles. They only set the order in which a set's shingles enter lists, so collisions cost time, not links.
BUCKETS, BLOCK = 1 << 20, 1 << 14
#: Lists that may be longer than this are dealt out over SALTS tasks.
HEAVY, SALTS = 4096, 64
#: Classes whose sets are verified against one another at once.
SLOT = 128
#: Rows that a task hands over at once.
CHUNK = 1 << 17
_OTHER = np.uint64(0xA0761D6478BD642F)


class Join(NamedTuple):
    members: DataFrame  #: (id, n_shingles, class_id), a row for each document; class_id is null without words
    links: DataFrame  #: (a, b) classes connected by verified links; their components are those of all links


def class_of(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that name a set."""
    return int(mixed(shingles).sum(dtype=np.uint64)), int(mixed(shingles ^ _OTHER).sum(dtype=np.uint64))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def need(a: int, b: int, percent: int) -> int:
    """Shingles that sets of a and b shingles must share."""
    return -(-percent * (a + b) // (100 + percent))


def subset_sizes(n: int, boundary: int, percent: int) -> list[int]:
    """Sizes of the subsets that a set of n enumerates to meet every partner of at most ``boundary``."""
    partners = range(-(-percent * n // 100), min(boundary, 100 * n // percent) + 1)
    return sorted({c for m in partners if (c := need(n, m, percent)) <= min(n, m)})


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def best_boundary(sizes: dict[int, int], list_length: float, percent: int, most: int = 16) -> int:
    """The boundary of least cost: subsets enumerated below it, list entries times the average list length above it."""

    def cost(x: int) -> float:
        keys = sum(k * sum(math.comb(n, c) for c in subset_sizes(n, x, percent)) for n, k in sizes.items() if 0 < n <= x)
        return keys + sum(k * prefix_size(n, percent) * (1 + list_length) for n, k in sizes.items() if n > x)

    return min(range(most + 1), key=cost)


@lru_cache(maxsize=512)
def _choices(n: int, c: int) -> np.ndarray:
    return np.array(list(combinations(range(n), c)), np.int64).reshape(-1, c)


def _subset_keys(shingles: np.ndarray, c: int) -> np.ndarray:
    picked = shingles[_choices(len(shingles), c)]
    out = np.full(len(picked), c, np.uint64)
    for k in range(c):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + picked[:, k])
    return out


def _summaries(size: int):
    def run(batches):
        known, counts = WordHashes(), np.zeros(BUCKETS, np.int64)
        names = ["id", "n", "class_id", "check", "block", "counts"]
        for batch in batches:
            sets = [shingle_set(t, known, size) for t in batch.column(1).to_pylist()]
            if sets and (flat := np.concatenate(sets)).size:
                counts += np.bincount((flat & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
            marks = [tuple(map(_signed, class_of(s))) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([m[0] for m in marks], pa.int64()),
                pa.array([m[1] for m in marks], pa.int64()), pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.list_(pa.int64())),
            ], names=names)
        if counts.any():
            n = BUCKETS // BLOCK
            gone = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [gone, gone, gone, gone, pa.array(range(n), pa.int32()), lists(list(counts.reshape(n, BLOCK)), pa.int64())], names=names)

    return run


def _added(batches):
    """Sums of the counters by block, in as much memory as there are counters."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            total[block] = total.get(block, 0) + counts.values.to_numpy()
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), lists(list(total.values()), pa.int64())], names=["block", "counts"])


def _levels(sketch: DataFrame) -> tuple[np.ndarray, float]:
    """Per bucket the rounded-up log of its count (1 MiB for any input), and the average list length."""
    counts = np.zeros(BUCKETS, np.float64)
    for row in sketch.select("block", "counts").repartition("block").mapInArrow(_added, "block int, counts array<long>").toLocalIterator():
        counts[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = row["counts"]
    total = counts.sum()
    length = max(1.0, ((counts**2).sum() - total**2 / BUCKETS) / total) if total else 1.0
    return np.minimum(np.ceil(4 * np.log2(counts + 1)), 255).astype(np.uint8), float(length)


def _postings(shared, boundary: int, percent: int, size: int):
    """Rows (small, token, salt, n, class_id, place): subset keys of small sets, with the subset's size as place; list
    entries of the rarest shingles of the others, with their position."""
    heavy = math.ceil(4 * math.log2(HEAVY))
    low = -(-percent * (boundary + 1) // 100)
    names = ["small", "token", "salt", "n", "class_id", "place"]

    def run(batches):
        levels, known, seen = shared.value, WordHashes(), set()
        parts, held = [], 0

        def flush():
            cols = [np.concatenate([p[k] for p in parts]) for k in range(6)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)

        for batch in batches:
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, known, size)
                n = len(s)
                if not n:
                    continue
                name = _signed(class_of(s)[0])
                if name in seen:  # a copy has the same entries
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(name)
                got = []
                if n <= boundary:
                    for c in subset_sizes(n, boundary, percent):
                        keys = _subset_keys(s, c)
                        got.append((True, keys, np.zeros(len(keys), np.int32), np.full(len(keys), c, np.int32)))
                if n >= low:
                    level = levels[(s & np.uint64(BUCKETS - 1)).astype(np.int64)]
                    first = np.lexsort((s, level))[: prefix_size(n, percent)]
                    salt = np.where(level[first] >= heavy, 1 + (name & (SALTS - 1)), 0).astype(np.int32)
                    got.append((False, s[first], salt, np.arange(len(first), dtype=np.int32)))
                for small, keys, salt, place in got:
                    k = len(keys)
                    parts.append((np.full(k, small), keys.view(np.int64), salt, np.full(k, n, np.int32), np.full(k, name, np.int64), place))
                    held += k
                if held >= CHUNK:
                    yield flush()
                    parts, held = [], 0
        if parts:
            yield flush()

    return run


def _scan(batches):
    """Entries sorted by (token, salt, small, class_id) -> each entry once, without lists of a single class (but with all
    entries that are salted). Holds one entry between batches."""
    names = ["small", "token", "salt", "n", "class_id", "place"]
    held, starts_held = None, True

    def emit(cols, keep):
        return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in cols], names=names)

    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]
        if not len(cols[0]):
            continue
        if held:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
        small, token, salt, _, name, _ = cols
        starts = np.ones(len(token), bool)
        starts[1:] = (token[1:] != token[:-1]) | (salt[1:] != salt[:-1]) | (small[1:] != small[:-1])
        same = np.zeros(len(token), bool)
        same[1:] = ~starts[1:] & (name[1:] == name[:-1])
        starts[0] = starts_held if held else True
        cols, starts = [c[~same] for c in cols], starts[~same]
        keep = np.ones(len(starts), bool)
        keep[:-1] = ~(starts[:-1] & starts[1:]) | (cols[2][:-1] > 0)
        keep[-1] = False
        if keep.any():
            yield emit(cols, keep)
        held, starts_held = [c[-1:] for c in cols], bool(starts[-1])
    if held and (not starts_held or held[2][0] > 0):
        yield emit(held, np.ones(1, bool))


def _sets(spark: SparkSession, texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(class_id, id, set) of texts that have a wanted id; a Bloom filter of fixed size lets few others through."""
    bits = spark.sparkContext.broadcast(bloom.build(wanted))

    def run(batches):
        known = WordHashes()
        for batch in batches:
            ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.flatnonzero(bloom.held(bits.value, ids)) if len(ids) else []
            found = [(ids[i], s) for i in at if len(s := shingle_set(batch.column(1)[int(i)].as_py(), known, size))]
            for k in range(0, len(found), 500):
                part = found[k : k + 500]
                yield pa.RecordBatch.from_arrays([
                    pa.array([_signed(class_of(s)[0]) for _, s in part], pa.int64()), pa.array([i for i, _ in part], pa.int64()),
                    lists([s.view(np.int64) for _, s in part], pa.int64()),
                ], names=["class_id", "id", "set"])

    return texts.mapInArrow(run, "class_id long, id long, set array<long>")


def _similar(percent: int):
    """Rows of a key side by side, sets (class_id, set) before pairs (class_id, other) -> similar pairs (a, b).

    Pairs that links of the same key already connect are left out. Holds the sets of one key, SLOT of either side.
    """

    def run(batches):
        key, sets, root, out = None, {}, {}, []

        def find(x):
            while root.get(x, x) != x:
                x = root[x]
            return x

        for batch in batches:
            values = batch.column(4).values.to_numpy(zero_copy_only=False)
            offsets = batch.column(4).offsets.to_numpy()
            rows = zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), batch.column(2).to_pylist(), batch.column(3).to_pylist())
            for k, (at, name, other) in enumerate(rows):
                if at != key:
                    key, sets, root = at, {}, {}
                if other is None:
                    sets[name] = values[offsets[k] : offsets[k + 1]].copy()
                    continue
                a, b = find(name), find(other)
                if a != b:
                    x, y = sets[name], sets[other]
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * shared >= percent * (len(x) + len(y) - shared):
                        root[max(a, b)] = min(a, b)
                        out.append((name, other))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])
                out = []

    return run


def _slots(entries: DataFrame) -> DataFrame:
    """(class_id, slot): classes with the same usual hub dealt out over slots of about SLOT classes."""
    home = entries.groupBy("class_id").agg(F.mode("hub", True).alias("home"))
    many = home.groupBy("home").agg(F.ceil(F.count("*") / SLOT).alias("slots"))
    return home.join(many, "home").select("class_id", F.xxhash64("home", F.pmod(F.xxhash64("class_id"), F.col("slots"))).alias("slot"))


def _meeting(percent: int):
    """Rows of a key side by side, list entries of classes (n, tokens, weights) before pairs (class_id, other) -> the pairs that meet in enough lists.

    If two sets share ``need`` shingles, the first of them, need - ceil(percent * larger / 100) + 1, are among the rarest
    shingles of both, so the two must meet in that many lists. A list stands for as many as have its entries. Holds the entries of one key.
    """

    def run(batches):
        key, held = None, {}
        for batch in batches:
            k1, k2, name, other, size = (batch.column(k).to_pylist() for k in range(5))
            tokens, weights = (batch.column(k).values.to_numpy(zero_copy_only=False) for k in (5, 6))
            at_t, at_w = (batch.column(k).offsets.to_numpy() for k in (5, 6))
            out = []
            for k in range(batch.num_rows):
                if (k1[k], k2[k]) != key:
                    key, held = (k1[k], k2[k]), {}
                if other[k] is None:
                    held[name[k]] = size[k], tokens[at_t[k] : at_t[k + 1]].copy(), weights[at_w[k] : at_w[k + 1]].copy()
                    continue
                (n, x, weight), (m, y, _) = held[name[k]], held[other[k]]
                met = weight[np.intersect1d(x, y, assume_unique=True, return_indices=True)[1]].sum()
                if met >= need(n, m, percent) - -(-percent * max(n, m) // 100) + 1:
                    out.append((*key, name[k], other[k]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["k1", "k2", "a", "b"])

    return run


def _by_key(left: DataFrame, right: DataFrame) -> DataFrame:
    """What classes bring to a key, then the key's pairs."""
    rows = left.unionByName(right, allowMissingColumns=True).select(left.columns)
    return rows.repartition("k1", "k2").sortWithinPartitions("k1", "k2", F.col("other").asc_nulls_first(), "class_id")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select("k1", "k2", F.col("a").alias("class_id")).union(pairs.select("k1", "k2", "b")).distinct()


def _verified(spark, texts, classes, large: DataFrame, slots: DataFrame, pairs: DataFrame, percent: int, size: int) -> DataFrame:
    """Links among the pairs (a, b) of classes, decided on whole sets, that connect all similar pairs.

    List entries, and after them the sets of pairs that meet in enough lists, go once to each pair of slots in which
    a class has a pair, not once to each pair; a pair stays one row throughout.
    """
    slot, none = slots.toDF("class_id", "slot"), F.lit(None).cast("long").alias("other")
    keyed = pairs.join(slot.toDF("a", "sa"), "a").join(slot.toDF("b", "sb"), "b")
    keyed = store(keyed.select(F.least("sa", "sb").alias("k1"), F.greatest("sa", "sb").alias("k2"), "a", "b"), "join-pairs")
    as_rows = lambda df: df.select("k1", "k2", F.col("a").alias("class_id"), F.col("b").alias("other"))
    own = large.groupBy("class_id").agg(F.max("n").cast("long").alias("n"), F.collect_list(F.struct("token", "weight")).alias("e"))
    entries = _ends(keyed).join(own, "class_id").select("k1", "k2", "class_id", none, "n", F.col("e.token").alias("tokens"), F.col("e.weight").alias("weights"))
    meeting = _by_key(entries, as_rows(keyed)).mapInArrow(_meeting(percent), "k1 long, k2 long, a long, b long")
    every, keyed = keyed, store(meeting, "join-meeting")
    discard(every)
    ends = store(_ends(keyed).join(classes.select("class_id", "id"), "class_id"), "join-ends")
    sets = _sets(spark, texts, ends.select("id").distinct(), size)
    left = ends.join(sets, ["class_id", "id"]).select("k1", "k2", "class_id", none, "set")
    links = store(_by_key(left, as_rows(keyed)).mapInArrow(_similar(percent), "a long, b long"), "join-links")
    discard(keyed, ends)
    return links


def _may_link(n, place, m, other, boundary: int, percent: int) -> F.Column:
    """Length and position bounds for two entries of one list, and one of the two sets is large."""
    n, place, m, other = map(F.col, (n, place, m, other))
    both = n.cast("long") + m
    return (
        (F.greatest(n, m) > boundary) & (100 * F.least(n, m) >= percent * F.greatest(n, m))
        & ((100 + percent) * F.least(n - place, m - other) >= percent * both)
    )


def _distinct_lists(entries: DataFrame) -> DataFrame:
    """(token, class_id, n, place, weight, share) without lists that hold the same classes as the list of a rarer shingle, since
    two sets are paired in the list of the rarest shingle they share. weight: how many lists hold these classes. share: the part of a set's shingles in any list.

    A set with few shingles of its own, such as the original of edited copies, has the largest share: it is the hub that
    most of a list is similar to.
    """
    share = entries.groupBy("class_id").agg((F.count("*") / F.max("n")).alias("share"))
    ends = entries.groupBy("token").agg(
        F.count("*").alias("k"), F.bit_xor(F.xxhash64("class_id")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(1), "class_id")).alias("h2"),
        F.min(F.struct("class_id", "place")).alias("one"))
    kept = ends.where("k > 1").groupBy("k", "h1", "h2").agg(F.min(F.struct("one.place", "token")).alias("first"), F.count("*").alias("weight")).select("first.token", "weight")
    return entries.join(kept, "token").join(share, "class_id").select("token", "class_id", "n", "place", "weight", "share")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, size: int = SHINGLE) -> Join:
    """Links documents when 100 * shared shingles >= percent * all shingles of the two.

    Ids are integers. Texts without words, nulls among them, belong to no class and are linked with nothing. Equal texts
    and rows that are repeated share a class. Rows with a null id are members of their class, but a class that has no
    other id is linked with nothing. An empty table gives empty results.

    Two sets of one class differ only if a 64-bit hash collides. Bounded by construction: the counters, the Bloom filter,
    one text per step in Python, HEAVY entries of a list in a task (longer ones are salted).
    """
    spark = docs.sparkSession
    texts = docs.select(column(id_col).cast("long").alias("id"), column(text_col).alias("text"))
    summary = store(texts.mapInArrow(_summaries(size), "id long, n long, class_id long, check long, block int, counts array<long>"), "join-summary")
    rows = summary.where("block IS NULL").select("id", "n", "class_id")
    classes = store(rows.where("class_id IS NOT NULL AND id IS NOT NULL").groupBy("class_id").agg(F.min("id").alias("id"), F.first("n").alias("n")), "join-classes")
    levels, list_length = _levels(summary.where("block IS NOT NULL"))
    sizes = {r["n"]: r["count"] for r in classes.where("n <= 32").groupBy("n").count().collect()}
    boundary = best_boundary(sizes, list_length, percent)

    entries = texts.where("id IS NOT NULL").mapInArrow(
        _postings(spark.sparkContext.broadcast(levels), boundary, percent, size),
        "small boolean, token long, salt int, n int, class_id long, place int")
    schema = "small boolean, token long, salt int, n int, class_id long, place int"
    found = entries.repartition("token", "salt").sortWithinPartitions("token", "salt", "small", "class_id").mapInArrow(_scan, schema)
    found = store(found.drop("salt"), "join-lists")

    # small sets: all that meet in a subset are linked with the smallest, or with none
    small = found.where("small")
    least = small.groupBy("token").agg(F.min(F.struct("n", "class_id")).alias("least"))
    links = (
        small.join(least, "token").where("class_id != least.class_id")
        .where((100 + percent) * F.col("place") >= percent * (F.col("n") + F.col("least.n"))).selectExpr("least.class_id AS a", "class_id AS b").distinct()
    )

    entries = store(_distinct_lists(found.where("NOT small")), "join-large")
    large = entries
    top = large.groupBy("token").agg(F.max(F.struct("share", "class_id", "n", "place")).alias("top"))
    top = top.selectExpr("token", "top.class_id AS hub", "top.n AS hub_n", "top.place AS hub_place")
    large = store(large.drop("share").join(top, "token"), "join-hubs")
    discard(entries)
    slots = store(_slots(large), "join-slots")
    pairs = (
        large.where("class_id != hub").where(_may_link("n", "place", "hub_n", "hub_place", boundary, percent))
        .selectExpr("least(class_id, hub) AS a", "greatest(class_id, hub) AS b").distinct()
    )
    links = store(links.union(_verified(spark, texts, classes, large, slots, pairs, percent, size)), "join-star-links")
    discard(found)

    label = store(components(links), "join-first")
    placed = large.select("token", "class_id", "n", "place", "hub").join(label.toDF("class_id", "label"), "class_id", "left")
    placed = store(placed.withColumn("label", F.coalesce("label", "class_id")), "join-placed")
    mixed_lists = placed.groupBy("token").agg(F.count("*").alias("k"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("k > 2 AND lo != hi")
    x = store(placed.join(mixed_lists.select("token"), "token").where("class_id != hub"), "join-open")
    discard(placed)
    y = x.selectExpr("token", "class_id AS c2", "n AS n2", "place AS p2", "label AS l2")
    across = (
        x.join(y, "token").where("class_id < c2 AND label != l2")
        .where(_may_link("n", "place", "n2", "p2", boundary, percent)).selectExpr("class_id AS a", "c2 AS b").distinct()
    )
    # the components so far stand for the links that made them
    links = store(label.where("node != component").toDF("a", "b").union(_verified(spark, texts, classes, large, slots, across, percent, size)), "join-all-links")
    discard(large, slots, x, label)
    return Join(rows.select("id", F.col("n").alias("n_shingles"), "class_id"), links)


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, size: int = SHINGLE) -> DataFrame:
    """(id, n_shingles, component_id), a row for each document: the smallest id reachable over the links of ``ngram_join``.

    Documents without words, and rows with a null id, have their own id. Edge cases as in ``ngram_join``.
    """
    members, links = ngram_join(docs, id_col, text_col, percent, size)
    label = components(links)
    labelled = members.join(label.toDF("class_id", "label"), "class_id", "left").withColumn("label", F.coalesce("label", "class_id"))
    labelled = store(labelled, "join-labels")
    least = store(labelled.where("label IS NOT NULL").groupBy("label").agg(F.min("id").alias("least")), "join-least")
    return labelled.join(least, "label", "left").select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("least", "id")).alias("component_id"))
