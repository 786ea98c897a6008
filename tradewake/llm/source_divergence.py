"""Divergence of the word use of sources from one another and from their language, by a recount over perfect hashes.

A first pass finds the terms that enough documents of a language hold, exactly, by a shuffle of counts. The most frequent of
them become shards of minimal perfect hashes with their terms stored by slot. The shards are broadcast; their number of
slots and bytes is bounded. The second pass looks every term up, compares it with the stored one, and increments a dense
array of slots for each (language, source) group. Kept terms beyond the bound are counted by a shuffle. All arithmetic is on integers.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewake.llm import bloom
from tradewake.llm.byte_bpe import pieces_of
from tradewake.llm.frames import column, gathered, store
from tradewake.llm.perfect_hash import PerfectHash
from tradewake.llm.words import mixed

#: Slots and bytes of a term that are broadcast at most; terms of a shard; terms and sources of a block of pairs.
SLOTS, TERM_BYTES, SHARD, BLOCK, TILE = 1 << 19, 64, 1 << 15, 1 << 12, 128
#: Distinct terms that a task counts, dense slots it holds, and bytes of text it handles at a time.
DISTINCT, DENSE, CHUNK = 200_000, 3 << 22, 1 << 22
#: ASCII letters lower-cased, other ASCII to spaces.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
PARTIAL = "lang string, source string, term string, n long, head boolean"


def terms(text: str) -> list[bytes]:
    """Runs of ASCII letters and characters beyond ASCII, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2 ** bits powers, modulo 2 ** 64, of an odd number and of its inverse."""
    base = 0x9E3779B97F4A7C15
    out = []
    for x in (base, pow(base, -1, 1 << 64)):
        row = np.full(1 << bits, x, np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


def tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, hash) of the words of a text of bytes in which spaces separate words; equal words have equal hashes."""
    edge = np.diff((data != 32).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(max(18, len(data).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(data * power[: len(data)])))
    return starts, ends - starts, (sums[ends] - sums[starts]) * inverse[starts]


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


def hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """The key of each word in its language."""
    return mixed(tokens(np.frombuffer(b" ".join(words), np.uint8))[2] + _seed(lang))


def _hashed(batches):
    for batch in batches:
        out = np.zeros(batch.num_rows, np.uint64)
        langs = np.array(batch.column("lang").to_pylist(), object)
        words = np.array([t.encode() for t in batch.column("term").to_pylist()], object)
        for lang in set(langs.tolist()):
            own = np.flatnonzero(langs == lang)
            out[own] = hashes(lang, words[own].tolist())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out.view(np.int64))], names=[*batch.schema.names, "h"])


def _holders(batches):
    """(lang, term, number of documents) of a task, in parts."""
    counts: dict[str, Counter] = defaultdict(Counter)

    def flush():
        for lang, got in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(got), pa.string()), pa.array(list(got), pa.binary()).cast(pa.string()), pa.array(list(got.values()), pa.int64())], names=["lang", "term", "n"]
            )
        counts.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            counts[lang].update(set(terms(text.as_py())))
            if len(counts[lang]) > DISTINCT or len(counts) > 1000:
                yield from flush()
        if sum(map(len, counts.values())) > DISTINCT:
            yield from flush()
    yield from flush()


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, docs, h): the terms that at least ``min_docs`` rows of a language hold."""
    found = docs.select("lang", "text").mapInArrow(_holders, "lang string, term string, n long")
    kept = found.groupBy("lang", "term").agg(F.sum("n").alias("docs")).where(F.col("docs") >= min_docs)
    return store(kept.mapInArrow(_hashed, "lang string, term string, docs long, h long"), "divergence-terms")


def _shard(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.drop_duplicates("h", keep=False)
    keys = frame["h"].to_numpy(np.int64).view(np.uint64)
    made = PerfectHash(keys)
    order = np.argsort(made.slots(keys))
    langs, of = np.unique(frame["lang"].to_numpy(object)[order].astype(str), return_inverse=True) if len(frame) else ([], np.zeros(0))
    words = [t.encode() for t in frame["term"].to_numpy(object)[order]]
    return pd.DataFrame([{
        "bits": [b.tobytes() for b in made.bits], "langs": list(langs), "lang_of": of.astype("<i4").tobytes(),
        "sizes": np.array(list(map(len, words)), "<i4").tobytes(), "flat": b"".join(words),
    }])


class Shards:
    """Perfect hashes with stored terms; a slot's ``local`` number counts the slots of its language from 0.

    The levels of all shards lie in common arrays, so that keys of all shards are looked up together.
    """

    def __init__(self, rows: list):
        made = [PerfectHash(bits=[np.frombuffer(b, np.uint64) for b in r["bits"]]) for r in rows]
        self.shards, levels = np.uint64(len(made)), max([1, *(len(m.bits) for m in made)])
        self.words, self.offset = np.zeros((levels, len(made)), np.int64), np.zeros((levels, len(made)), np.int64)
        sizes = [np.frombuffer(r["sizes"], "<i4").astype(np.int64) for r in rows]
        base = np.cumsum([0, *map(len, sizes)])
        bits, before, n = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        for k, m in enumerate(made):
            for level, (b, ranks) in enumerate(zip(m.bits, m.before)):
                self.words[level, k], self.offset[level, k] = len(b), n
                bits.append(b)
                before.append(ranks + base[k])
                n += len(b)
        self.bits, self.before = np.concatenate(bits), np.concatenate(before)
        every = np.concatenate([np.zeros(0, np.int64), *sizes])
        ends = np.cumsum(every)
        self.starts, self.sizes, self.flat = ends - every, every, np.frombuffer(b"".join(bytes(r["flat"]) for r in rows), np.uint8)
        number = {lang: k for k, lang in enumerate(sorted({lang for r in rows for lang in r["langs"]}))}
        of = [np.array([number[x] for x in r["langs"]], np.int64)[np.frombuffer(r["lang_of"], "<i4")] for r in rows if r["langs"]]
        self.lang_of = np.concatenate([np.zeros(0, np.int64), *of])
        by_lang = np.argsort(self.lang_of, kind="stable")
        many = np.bincount(self.lang_of, minlength=len(number))
        self.local = np.empty(len(by_lang), np.int64)
        self.local[by_lang] = np.arange(len(by_lang)) - np.repeat(np.cumsum(many) - many, many)
        self.slots_of = {lang: by_lang[self.lang_of[by_lang] == k] for lang, k in number.items()}
        self.number = number

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key in its shard; any slot or -1 for a key that was not built in."""
        out, todo, shard = np.full(len(keys), -1, np.int64), np.arange(len(keys)), (keys % self.shards).astype(np.int64)
        for level, (words, offset) in enumerate(zip(self.words, self.offset)):
            here = words[shard]
            if not here.all():
                todo, shard, here = todo[here > 0], shard[here > 0], here[here > 0]
            at = PerfectHash.places(keys[todo], level, here)
            word, bit = offset[shard] + (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            held = self.bits[word]
            hit = (held >> bit & np.uint64(1)).astype(bool)
            below = held[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[todo[hit]] = self.before[word[hit]] + np.bitwise_count(below)
            todo, shard = todo[~hit], shard[~hit]
        return out

    def terms(self, slots: np.ndarray) -> pa.Array:
        ends = np.concatenate(([0], np.cumsum(self.sizes[slots]))).astype(np.int32)
        return pa.StringArray.from_buffers(len(slots), pa.py_buffer(ends), pa.py_buffer(gathered(self.flat, self.starts[slots], self.sizes[slots])))

    def _same(self, slots: np.ndarray, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the stored term of each slot has the bytes ``flat[start:start + size]``."""
        out = self.sizes[slots] == sizes
        at = np.flatnonzero(out)
        size = sizes[at]
        differs = gathered(self.flat, self.starts[slots[at]], size) != gathered(flat, starts[at], size)
        out[at[np.repeat(np.arange(len(at)), size)[differs]]] = False
        return out

    def find(self, lang: str, keys: np.ndarray, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Local numbers of the words ``flat[start:start + size]`` with their keys, -1 for those that are not stored."""
        out, own = np.full(len(keys), -1, np.int64), self.number.get(lang)
        if own is None:
            return out
        slot = self.slots(keys)
        at = np.flatnonzero(slot >= 0)
        at = at[self.lang_of[slot[at]] == own]
        same = at[self._same(slot[at], flat, starts[at], sizes[at])]
        out[same] = self.local[slot[same]]
        return out


def recount(docs: DataFrame, shards, bits) -> DataFrame:
    """(lang, source, term, n, head): occurrences of the stored terms, and (head false) of those that may be kept beyond them."""

    name = uuid.uuid4().hex

    def run(batches):
        held, filled = loaded(name, shards), bits.value.any()
        dense: dict[tuple, np.ndarray] = {}
        counted = 0  # what a slot can hold at most is handed over before it is full
        other: dict[tuple, Counter] = defaultdict(Counter)

        def rows(key, words, counts, head):
            lang, source = (pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(words), np.int8)), [k]).cast(pa.string()) for k in key)
            cols = [lang, source, words, pa.array(counts, pa.int64()), pa.array(np.full(len(words), head))]
            return pa.RecordBatch.from_arrays(cols, names=["lang", "source", "term", "n", "head"])

        def flush():
            for key, counts in dense.items():
                at = np.flatnonzero(counts)
                yield rows(key, held.terms(held.slots_of[key[0]][at]), counts[at], True)
            for key, counts in other.items():
                yield rows(key, pa.array(list(counts), pa.binary()).cast(pa.string()), list(counts.values()), False)
            dense.clear()
            other.clear()

        for batch in batches:
            for part in pieces_of(batch, pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), CHUNK):
                texts = defaultdict(list)
                for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text"))):
                    texts[lang, source].append(text.encode("utf-8", "surrogatepass").translate(_LETTERS))
                for key, own in texts.items():
                    data = np.frombuffer(b" ".join(own), np.uint8)
                    starts, sizes, hashed = tokens(data)
                    keys = mixed(hashed + _seed(key[0]))
                    slots = held.find(key[0], keys, data, starts, sizes)
                    if (slots >= 0).any():
                        if key not in dense:
                            dense[key] = np.zeros(len(held.slots_of[key[0]]), np.int32)
                        np.add.at(dense[key], slots[slots >= 0], 1)
                        counted += len(slots)
                    if filled:
                        rest = np.flatnonzero(slots < 0)
                        rest = rest[bloom.held(bits.value, keys[rest].view(np.int64))]
                        raw = data.tobytes()
                        other[key].update(raw[a : a + n] for a, n in zip(starts[rest].tolist(), sizes[rest].tolist()))
                    if sum(map(len, dense.values())) > DENSE or sum(map(len, other.values())) > DISTINCT or counted > 1 << 30:
                        yield from flush()
                        counted = 0
        yield from flush()

    return docs.select("lang", "source", "text").mapInArrow(run, PARTIAL)


@lru_cache(maxsize=1)
def loaded(name: str, shards) -> Shards:
    """The shards of a broadcast variable, unpacked once in each Python worker."""
    return Shards(shards.value)


def _count_terms(docs: DataFrame, kept: DataFrame, slots: int) -> DataFrame:
    """(lang, source, term, n) with n > 0, of all kept terms."""
    spark = docs.sparkSession
    short = F.octet_length("term") + F.octet_length("lang") <= TERM_BYTES
    band = F.when(short, F.floor(F.log2("docs") * 8)).otherwise(-1)
    sizes = kept.groupBy(band.alias("band")).count().where("band >= 0").orderBy(F.desc("band")).collect()  # at most 64 * 8 rows
    total, lowest = 0, 1 << 20
    for r in sizes:
        if total + r["count"] > slots:
            break
        total, lowest = total + r["count"], r["band"]
    head = kept.where(band >= lowest)
    # keys are unsigned: the remainder is taken digit by digit in base 2 ** 32
    n = max(1, -(-total // SHARD))
    high, low = F.shiftrightunsigned("h", 32), F.col("h").bitwiseAND((1 << 32) - 1)
    shard = ((high % n) * ((1 << 32) % n) + low) % n
    made = head.select("lang", "term", "h", shard.cast("int").alias("shard")).groupBy("shard").applyInPandas(
        lambda key, frame: _shard(frame).assign(shard=key[0]), "shard int, bits array<binary>, langs array<string>, lang_of binary, sizes binary, flat binary"
    ).collect()  # at most SLOTS terms of TERM_BYTES
    empty = {"bits": [], "langs": [], "lang_of": b"", "sizes": b"", "flat": b""}
    by_shard = {r["shard"]: r.asDict() for r in made}
    ordered = spark.sparkContext.broadcast([by_shard.get(k, empty) for k in range(n)])
    # beyond the shards: rarer or longer terms, and those whose 64 bits are not their own
    twice = head.groupBy("h").agg(F.count("*").alias("k")).where("k > 1").select("h")
    rest = kept.where(band < lowest).select("h").unionByName(twice)
    bits = spark.sparkContext.broadcast(bloom.build(rest))
    seen = store(
        recount(docs, ordered, bits).groupBy("lang", "source", "term", "head").agg(F.sum("n").alias("n")), "divergence-counts"
    )
    beyond = seen.where("NOT head").join(kept.select("lang", "term"), ["lang", "term"], "left_semi")
    return seen.where("head").unionByName(beyond).drop("head")


def _div(a: F.Column, b: F.Column) -> F.Column:
    return F.call_function("div", a, b)


def share(n: F.Column, total: F.Column, kept: F.Column) -> F.Column:
    """1 + floor(1e9 * (n + 1) / (total + kept)), 1 where nothing is kept; by long division in base 1000, so that no product leaves 64 bits."""
    by = F.when(kept > 0, total + kept).otherwise(n + 2)
    digits, rest = F.lit(0).cast("long"), n + 1
    for _ in range(3):
        digits, rest = digits * 1000 + _div(rest * 1000, by), (rest * 1000) % by
    return 1 + F.when(kept > 0, digits).otherwise(0)


def _pair_block(frame: pd.DataFrame) -> pd.DataFrame:
    """Sums of (p - q)^2 // q over the terms of a block, for each ordered pair of sources whose tiles are the block's two."""
    heads = frame[frame["term"].isna()]
    names, tile, base = heads["source"].tolist(), heads["tile"].to_numpy(), heads["p"].to_numpy(np.int64)
    row = {name: k for k, name in enumerate(names)}
    cells = frame[frame["term"].notna()]
    col, words = pd.factorize(cells["term"])
    p = np.repeat(base[:, None], len(words), axis=1)
    p[[row[s] for s in cells["source"]], col] = cells["p"].to_numpy(np.int64)
    low, high, lang = int(frame["low"].iloc[0]), int(frame["high"].iloc[0]), frame["lang"].iloc[0]
    out = []
    for a in range(len(names)):
        others = np.flatnonzero((tile == high) if tile[a] == low else (tile == low))
        others = others[others != a]
        gap = p[a] - p[others]
        out += [(lang, names[a], names[b], v) for b, v in zip(others.tolist(), (gap * gap // p[others]).sum(axis=1).tolist())]
    return pd.DataFrame(out, columns=["lang", "source", "item", "value"])


def _pairs(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for all ordered pairs of sources of a language.

    Rows of counts go to blocks of about BLOCK terms and, for a language with many sources, to pairs of tiles of about TILE
    sources. A block fills in what a source does not have, so work follows the result and the counts, never pairs of rows.
    """
    tiles = lambda df: (
        df.withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")))
        .withColumn("mate", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .withColumns({"low": F.least("tile", "mate"), "high": F.greatest("tile", "mate")})
    )
    names = ["lang", "block", "low", "high", "tile", "source", "term", "p"]
    cells = tiles(counts.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))).select(*names)
    heads = tiles(groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    heads = heads.withColumns({"term": F.lit(None).cast("string"), "p": F.col("p0")}).select(*names)
    blocks = cells.unionByName(heads).groupBy("lang", "block", "low", "high")
    parts = blocks.applyInPandas(_pair_block, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 3, top: int = 200, slots: int = SLOTS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) group that occurs.

    A language keeps the V terms (``terms``) that at least ``min_docs`` of its rows hold. Each kept term has the share
    p = 1 + floor(1e9 * (count + 1) / (N + V)) in a group, N being the group's occurrences of kept terms, and likewise q in
    another group or the language. The divergence is floor((p - q)^2 / q). Part ``pair``: against each other source of the
    language, summed over all kept terms. Part ``term``: of each kept term that the group holds more often than its
    language (p > q), the ``top`` first. Ranks go by value, then by the item's bytes.

    Nulls count as ''. Repeated rows count each. A group or language without kept terms has pairs of value 0 and no terms;
    a language of one source has no pairs. An empty table gives an empty result. Columns go by their parameters; others are
    not read. Memory of a task is bounded by the module's constants and the longest text.
    """
    docs = docs.select(*[F.coalesce(column(c).cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang_col), ("source", source_col), ("text", text_col))])
    kept = kept_terms(docs, min_docs)
    counts = store(_count_terms(docs, kept, slots), "divergence-groups")
    lang_terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "v"])
    sums = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count("*").alias("sources"))
    groups = store(
        groups.join(sums, "lang").select(
            "lang", "source", "total", "v", "lang_total", share(F.lit(0).cast("long"), F.col("total"), F.col("v")).alias("p0"),
            F.greatest(F.lit(1), F.ceil(F.col("v") / BLOCK)).cast("long").alias("blocks"), F.ceil(F.col("sources") / TILE).cast("long").alias("tiles"),
        ), "divergence-sources"
    )
    held = counts.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))
    gap = F.col("p") - F.col("q")
    terms_part = (
        held.join(lang_terms, ["lang", "term"]).withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("v"))).where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _div(gap * gap, F.col("q")).alias("value"))
    )
    pairs = _pairs(held.select("lang", "source", "term", "p", "blocks", "tiles"), groups)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    names = ["lang", "source", "part", "item", "value", "rank"]
    return ranked(pairs.withColumn("part", F.lit("pair"))).select(*names).unionByName(ranked(terms_part).where(F.col("rank") <= top).select(*names))
