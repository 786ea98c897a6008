"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by the power of two below their number of shingles. An item's signature is its k smallest
shingle hashes (bottom-k MinHash); k is fixed for a partition by its largest size, such that a document holding the
required share of an item must hold at least one hash of the signature. As in containment MinHash, the short side is
sketched and its signature is looked up in the whole shingle set of the long side. Documents found that way are verified
by the exact count of the item's shingles that they hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.llm import bloom
from tradewake.llm.frames import column, store
from tradewake.llm.words import SHINGLE, WordHashes, sequence_hashes, words


def partition_of(n: int) -> int:
    """Items of 2**p .. 2**(p + 1) - 1 shingles are in partition p."""
    return n.bit_length() - 1


def signature_size(partition: int, percent: int) -> int:
    """Smallest hashes to keep so that ``percent`` of any item in the partition cannot miss all of them."""
    most = 2 ** (partition + 1) - 1
    return most - -(-percent * most // 100) + 1


def _signatures(percent: int, size: int):
    def run(batches):
        known = WordHashes()
        names = ["item_id", "width", "token", "n", "in_signature"]
        for batch in batches:
            parts = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                width = min(size, len(words(text)))
                s = np.unique(sequence_hashes(text, known, size))
                n = len(s)
                if n:
                    signed = np.arange(n) < signature_size(partition_of(n), percent)
                    parts.append((np.full(n, item, np.int64), np.full(n, width, np.int32), s.view(np.int64), np.full(n, n, np.int64), signed))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=names)

    return run


def _matches(signatures, tokens, widths: list[int]):
    """(row, id, token): for documents that may hold a hash of a signature, the hashes that may belong to an item."""

    def run(batches):
        known, row = WordHashes(), TaskContext.get().partitionId() << 36
        for batch in batches:
            parts = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row += 1
                n = len(words(text))
                runs = [sequence_hashes(text, known, w) for w in widths if w <= n]
                if not runs:
                    continue
                s = np.unique(np.concatenate(runs))
                if bloom.held(signatures.value, s).any():
                    s = s[bloom.held(tokens.value, s)]
                    parts.append((np.full(len(s), row, np.int64), np.full(len(s), doc, np.int64), s.view(np.int64)))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names=["row", "id", "token"])

    return run


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", percent: int = 75, size: int = SHINGLE) -> DataFrame:
    """(id, item_id, shared, n_shingles): documents that hold at least ``percent`` of an item's distinct shingles.

    An item of fewer than ``size`` words is one shingle, its whole sequence, found where its words follow one another.
    Null and empty texts hold nothing and are held by nothing; rows with a null id are left out; repeated rows give one
    row. An empty table on either side gives an empty result. Ids are integers.

    Only two Bloom filters of fixed size are broadcast, whatever the number of items; what they let through is joined by
    hash, which adaptive execution can split. Every document is searched as a whole; no partial match is missed.
    """
    spark = docs.sparkSession
    source = items.where(column(item_col).isNotNull()).select(column(item_col).cast("long").alias("item_id"), column(item_text_col).alias("text"))
    index = store(
        source.mapInArrow(_signatures(percent, size), "item_id long, width int, token long, n long, in_signature boolean")
        .distinct(), "item-signatures")
    widths = sorted(r["width"] for r in index.select("width").distinct().collect())  # at most ``size`` values
    signatures = spark.sparkContext.broadcast(bloom.build(index.where("in_signature").select("token")))
    tokens = spark.sparkContext.broadcast(bloom.build(index.select("token")))
    texts = docs.where(column(id_col).isNotNull()).select(column(id_col).cast("long").alias("id"), column(text_col).alias("text"))
    found = texts.mapInArrow(_matches(signatures, tokens, widths), "row long, id long, token long")
    return (
        found.join(index, "token")
        .groupBy("row", "id", "item_id", "n").agg(F.count("*").alias("shared"), F.max("in_signature").alias("candidate"))
        .where(F.col("candidate") & (100 * F.col("shared") >= percent * F.col("n")))
        .groupBy("id", "item_id", F.col("n").alias("n_shingles")).agg(F.max("shared").alias("shared"))
        .select("id", "item_id", "shared", "n_shingles")
    )


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **search) -> DataFrame:
    """The documents in which ``find_items`` finds no item, rows with a null id among them, with all their columns."""
    hits = find_items(docs, items, id_col, text_col, **search).select(F.col("id").alias("_hit")).distinct()
    return docs.join(hits, column(id_col).cast("long") == F.col("_hit"), "left_anti")
