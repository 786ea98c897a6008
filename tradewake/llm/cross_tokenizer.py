"""Alignment of two tokenizers over the same text, and how common each link of an id pair is in the corpus.

Side A is byte-level BPE on the text after a space, side B a piece model on the text, which adds that space itself. Both
give tokens of bytes. Cumulative byte ends of A and B go into dictionaries from end to index; the keys that both hold,
sorted, cut both id lists into groups. In every group the tokens whose bytes overlap are linked.

Counts of id pairs are gathered by blocks of documents: a block numbers its distinct pairs once, documents keep the numbers,
the pairs of all blocks are counted by a shuffle, and every block gets back the counts of its own pairs only.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tradewake.llm.byte_bpe import pieces_of, read_ranks
from tradewake.llm.frames import lists, store

#: Bytes of text that a task aligns at a time, and links of a block of documents.
CHUNK, BLOCK = 1 << 20, 1 << 21
ALIGNED = {"n_a": LongType(), "n_b": LongType(), "n_groups": LongType(), "groups": StringType(), "links": ArrayType(LongType())}


class Sides:
    """Both tokenizers: ids of texts, and by id the bytes and the decimal text before each separator."""

    def __init__(self, a_name: str, b_name: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        ranks = read_ranks(public_tokenizers.path(a_name))
        self.a = tiktoken.Encoding(a_name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b_name))
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.a_bytes[rank] = token
        self.b_bytes = [piece_bytes(self.b.id_to_piece(k)) for k in range(self.b.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_texts = np.array([f"{k}{mark}" for k in range(len(self.a_bytes)) for mark in ",|"], object)
        self.b_texts = np.array([f"{k}{mark}" for k in range(len(self.b_bytes)) for mark in ",;"], object)

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(A ids, B ids) of each text; none of either where the text is empty or its bytes do not come back from both."""
        out = []
        nothing = np.zeros(0, np.int64)
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            whole = (" " + text).encode()
            a = self.a.encode_ordinary(" " + text) if text else []
            same = text and b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b))
            out.append((np.array(a, np.int64), np.array(b, np.int64)) if same else (nothing, nothing))
        return out


def piece_bytes(piece: str) -> bytes:
    byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()


@lru_cache(maxsize=1)
def sides(a_name: str, b_name: str) -> Sides:
    return Sides(a_name, b_name)


def cut(a_ends: list[int], b_ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each group its end in the A tokens and its end in the B tokens (ends rise strictly; the last ones agree)."""
    a_at, b_at = dict(zip(a_ends, range(1, len(a_ends) + 1))), dict(zip(b_ends, range(1, len(b_ends) + 1)))
    common = sorted(a_at.keys() & b_at.keys())
    n = len(common)
    return np.fromiter(map(a_at.__getitem__, common), np.int64, n), np.fromiter(map(b_at.__getitem__, common), np.int64, n)


def linked(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (A, B) of the overlapping tokens of all slices: one link for each stretch between neighbouring ends of either."""
    ends = np.concatenate((a_ends, b_ends))
    ends.sort(kind="stable")  # two rising runs
    ends = ends[np.diff(ends, prepend=-1) > 0]
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


def aligned_texts(texts: list[str], both: Sides) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], list[np.ndarray]]:
    """n_a, n_b, n_groups, groups as text and links of each text. Texts are laid one after another, so ends never repeat."""
    ids = both.ids(texts)
    n_a, n_b = (np.array([len(x[k]) for x in ids], np.int64) for k in (0, 1))
    if not n_a.sum():
        return n_a, n_b, n_a, [""] * len(ids), [np.zeros(0, np.int64)] * len(ids)
    a, b = (np.concatenate([x[k] for x in ids]) for k in (0, 1))
    a_ends, b_ends = np.cumsum(both.a_sizes[a]), np.cumsum(both.b_sizes[b])
    a_cut, b_cut = cut(a_ends.tolist(), b_ends.tolist())
    # the tokens in the order A and B of the first group, A and B of the second, ..., each with the mark that follows it
    a_many, b_many = np.diff(a_cut, prepend=0), np.diff(b_cut, prepend=0)
    a_place, b_place = np.arange(len(a)) + np.repeat(b_cut - b_many, a_many), np.arange(len(b)) + np.repeat(a_cut, b_many)
    a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_last[a_cut - 1] = 1
    b_last[b_cut - 1] = 1
    words = np.empty(len(a) + len(b), object)
    words[a_place], words[b_place] = both.a_texts[2 * a + a_last], both.b_texts[2 * b + b_last]
    ends = np.cumsum(n_a + n_b)
    groups = ["".join(words[i - n : i].tolist())[:-1] for i, n in zip(ends.tolist(), (n_a + n_b).tolist())]
    n_groups = np.diff(np.searchsorted(a_cut, np.cumsum(n_a), side="right"), prepend=0)
    a_of, b_of = linked(a_ends, b_ends)
    links = a[a_of] << 32 | b[b_of]
    per_text = np.searchsorted(a_of, np.cumsum(n_a))
    return n_a, n_b, n_groups, groups, np.split(links, per_text[:-1])


def _aligner(schema: StructType, text_col: str, a_name: str, b_name: str, digest: Callable[[str], str] | None):
    def run(batches):
        both = sides(a_name, b_name)
        for batch in batches:
            sizes = pc.binary_length(batch.column(text_col)).fill_null(0).to_numpy(zero_copy_only=False)
            for part in pieces_of(batch, sizes, CHUNK):
                n_a, n_b, n_groups, groups, links = aligned_texts([t or "" for t in part.column(text_col).to_pylist()], both)
                new = [*(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)), pa.array(list(map(digest, groups)) if digest else groups, pa.string()), lists(links, pa.int64())]
                old = [part.column(f.name) for f in schema.fields[: -len(ALIGNED)]]
                yield pa.RecordBatch.from_arrays(old + new, names=schema.names)

    return run


def _aligned_schema(docs: DataFrame, text_col: str) -> StructType:
    gone = {text_col.lower(), *ALIGNED}
    return StructType([f for f in docs.schema.fields if f.name.lower() not in gone] + [StructField(k, t) for k, t in ALIGNED.items()])


def align(docs: DataFrame, text_col: str = "text", a_name: str = "byte_bpe_50k.tiktoken", b_name: str = "piece_bpe_32k.model") -> DataFrame:
    """``docs`` with n_a, n_b (tokens), n_groups, groups and links in place of the text and of columns so named.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``: decimal A and B ids of each group in order. ``links`` has A id << 32 | B id for
    every pair of tokens whose bytes overlap, in order. A null or empty text, or one whose bytes do not come back from
    both sides, has no tokens: zeros, '' and no links. Special tokens are plain text. Rows are aligned where they are read;
    repeated rows get the same result, an empty table an empty one. A task's memory follows its longest text.
    """
    schema = _aligned_schema(docs, text_col)
    return docs.mapInArrow(_aligner(schema, text_col, a_name, b_name, None), schema)


def _numbered(links_col: str, schema: StructType, most: int):
    """Blocks: rows of documents with numbers in place of links, then one row with the block's pairs and their holders."""

    def run(batches):
        own = [f.name for f in schema.fields[:-5]]
        block, held, n = TaskContext.get().partitionId() << 32, [], 0

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            col = table.column(links_col)
            many = pc.fill_null(pc.list_value_length(col), 0).to_numpy().astype(np.int64)
            number, pairs = pd.factorize(pc.list_flatten(col).to_numpy())
            doc = np.repeat(np.arange(len(many)), many)
            key, times = np.unique(doc * max(1, len(pairs)) + number, return_counts=True)
            doc, number = key // max(1, len(pairs)), key % max(1, len(pairs))
            first = np.diff(doc, prepend=-1) > 0
            steps = np.where(first, number, np.diff(number, prepend=0))
            edges = np.searchsorted(doc, np.arange(1, len(many)))
            same = pa.array([block] * len(many), pa.int64())
            split = lambda x: lists(np.split(x, edges), pa.int32())
            new = [same, split(steps), split(times), pa.nulls(len(many), pa.list_(pa.int64())), pa.nulls(len(many), pa.list_(pa.int64()))]
            yield from pa.Table.from_arrays([table.column(c) for c in own] + new, names=schema.names).to_batches()
            holders = np.bincount(number, minlength=len(pairs)).astype(np.int64)
            void = [pa.nulls(1, table.schema.field(c).type) for c in own] + [same[:1]] + [pa.nulls(1, pa.list_(pa.int32()))] * 2
            yield pa.RecordBatch.from_arrays(void + [lists([pairs], pa.int64()), lists([holders], pa.int64())], names=schema.names)

        for batch in batches:
            counts = pc.list_value_length(batch.column(links_col)).fill_null(0).to_numpy(zero_copy_only=False)
            for part in pieces_of(batch, counts, most // 4):
                held.append(part)
                n += int(pc.sum(pc.list_value_length(part.column(links_col))).as_py() or 0) + part.num_rows
                if n >= most:
                    yield from flush()
                    block, held, n = block + 1, [], 0
        if held:
            yield from flush()

    return run


ADDED = {"n_links": LongType(), "n_best": LongType(), "count_sum": LongType()}
INNER = {"_block": LongType(), "_steps": ArrayType(IntegerType()), "_times": ArrayType(IntegerType()), "_pairs": ArrayType(LongType()), "_holders": ArrayType(LongType())}


def _numbered_schema(schema: StructType, links_col: str) -> StructType:
    own = [StructField(f.name, f.dataType) for f in schema.fields if f.name.lower() not in {links_col.lower(), *ADDED}]
    return StructType(own + [StructField(k, t) for k, t in INNER.items()])


def support(aligned: DataFrame, links_col: str = "links", block: int = BLOCK) -> DataFrame:
    """``aligned`` without its links, with n_links, n_best and count_sum.

    A pair's count is the number of rows of the whole table that hold it. ``n_best`` counts the links whose pair has the
    highest count of all pairs with its A id, ties included; ``count_sum`` adds up the counts of all links, repeated ones
    each time. Rows without links (empty or null) have zeros. Each row counts as a document, repeated ones too. Columns
    named n_links, n_best or count_sum are replaced.
    """
    schema = _numbered_schema(aligned.schema, links_col)
    return _scored(aligned.mapInArrow(_numbered(links_col, schema, block), schema))


def alignment(docs: DataFrame, text_col: str = "text", a_name: str = "byte_bpe_50k.tiktoken", b_name: str = "piece_bpe_32k.model",
              digest: Callable[[str], str] | None = None, block: int = BLOCK) -> DataFrame:
    """``support(align(docs))`` in one pass over the texts: links go into their block where they are found.

    ``digest`` is applied to every ``groups`` text, which is several times as long as the text itself, before anything is stored.
    """
    aligned = _aligned_schema(docs, text_col)
    schema = _numbered_schema(aligned, "links")
    align_, number = _aligner(aligned, text_col, a_name, b_name, digest), _numbered("links", schema, block)
    return _scored(docs.mapInArrow(lambda batches: number(align_(batches)), schema))


def _scored(numbered: DataFrame) -> DataFrame:
    """Counts the pairs of all blocks and sums them up for the rows of each block."""
    own = numbered.schema.fields[: -len(INNER)]
    numbered = store(numbered, "alignment-blocks")
    pairs = (
        numbered.where("_pairs IS NOT NULL").select("_block", F.posexplode(F.arrays_zip("_pairs", "_holders")).alias("_at", "_one"))
        .select("_block", "_at", F.col("_one._pairs").alias("_pair"), F.col("_one._holders").alias("_n"))
    )
    counts = pairs.groupBy("_pair").agg(F.sum("_n").alias("_count")).withColumn("_a", F.shiftright("_pair", 32))
    counts = store(counts, "alignment-counts")
    best = counts.groupBy("_a").agg(F.max("_count").alias("_most"))
    marked = counts.join(best, "_a").select("_pair", "_count", (F.col("_count") == F.col("_most")).alias("_best"))
    slices = pairs.select("_block", "_at", "_pair").join(marked, "_pair").select(F.col("_block").alias("_of"), "_at", "_count", "_best")
    schema = StructType(own + [StructField(k, t) for k, t in ADDED.items()])

    def score(docs: pa.Table, part: pa.Table) -> pa.Table:
        at = part.column("_at").to_numpy()
        count, top = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        count[at], top[at] = part.column("_count").to_numpy(), part.column("_best").to_numpy()
        many = pc.list_value_length(docs.column("_steps")).to_numpy().astype(np.int64)
        steps, times = (pc.list_flatten(docs.column(c)).to_numpy().astype(np.int64) for c in ("_steps", "_times"))
        ends = np.cumsum(many)
        run = np.concatenate(([0], np.cumsum(steps)))
        number = run[1:] - np.repeat(run[ends - many], many)
        total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[np.concatenate(([0], ends))])
        new = [total(times), total(times * top[number]), total(times * count[number])]
        return pa.Table.from_arrays([docs.column(f.name) for f in own] + [pa.array(x, pa.int64()) for x in new], names=schema.names)

    docs = numbered.where("_pairs IS NULL").drop("_pairs", "_holders")
    return docs.groupBy("_block").cogroup(slices.groupBy("_of")).applyInArrow(score, schema)
