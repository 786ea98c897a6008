"""Shards by extendible hashing: a directory by the first bits of a hash, in which only oversized buckets split further.

A row's hash has 60 bits: 40 of its key and 20 of its place in the table, so that rows of one hot key can be split too. A
bucket is a hash prefix; it stays whole if its rows fit the limit or it holds one row, else it splits on the next bit.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.llm.frames import column, store

BITS, KEY_DIGITS, ROW_BITS = 60, 10, 20
#: Bits by which the cells that are counted first are finer than an average shard, and by which oversized cells are refined.
FINER = 6


def _prefix(bits) -> F.Column:
    return F.expr(f"shiftright(_h, cast({BITS} - {bits} as int))")


def _cells(rows: DataFrame, limit: int) -> DataFrame:
    """(row columns.., cell_depth): each row with a depth at which its cell fits; cells that do not are refined."""
    total = rows.agg(F.sum("_bytes")).first()[0] or 0
    bits, out = min(BITS, max(0, math.ceil(math.log2(max(total / limit, 1)))) + FINER), None
    while True:
        marked = rows.withColumn("_cell", _prefix(bits))
        large = marked.groupBy("_cell").agg(F.sum("_bytes").alias("b"), F.count("*").alias("n")).where((F.col("b") > limit) & (F.col("n") > 1)).select("_cell")
        large = store(large, "shard-large")
        last = bits == BITS or large.isEmpty()
        done = marked if last else marked.join(large, "_cell", "left_anti")
        done = done.withColumn("_depth", F.lit(bits))
        out = done if out is None else out.unionByName(done)
        if last:
            return store(out, "shard-cells")
        rows = store(marked.join(large, "_cell", "left_semi").drop("_cell"), "shard-split")
        bits = min(BITS, bits + FINER)


def assign(docs: DataFrame, key_col: str = "doc_id", size: F.Column | None = None, limit_bytes: int = 1 << 20) -> DataFrame:
    """``docs`` with shard (the bits of its prefix), depth, shard_bytes and shard_rows; columns of these names are replaced.

    ``size`` is a row's size in bytes, by default that of its text; null counts as 0. A null key hashes as an empty one.
    No shard of two rows or more is over the limit unless all 60 bits of its rows agree; a row larger than the limit is a
    shard of its own. Repeated rows have equal keys but hashes of their own. Empty input gives an empty result.

    Only counts of cells (some 2 ** FINER a shard) are grouped level by level; the directory is never collected.
    """
    size = F.octet_length(F.coalesce(column("text"), F.lit(""))) if size is None else size
    digits = F.substring(F.md5(F.coalesce(column(key_col).cast("string"), F.lit("")).cast("binary")), 1, KEY_DIGITS)
    key = F.conv(digits, 16, 10).cast("long")
    named = [c for c in docs.columns if c not in ("shard", "depth", "shard_bytes", "shard_rows")]
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << ROW_BITS))
    rows = docs.select(*map(column, named), (F.shiftleft(key, ROW_BITS) + place).alias("_h"), F.coalesce(size.cast("long"), F.lit(0)).alias("_bytes"))
    rows = _cells(store(rows, "shard-rows"), limit_bytes)
    cells = rows.groupBy("_cell", "_depth").agg(F.sum("_bytes").alias("bytes"), F.count("*").alias("n"))
    cells = store(cells, "shard-counts")
    up = lambda c, by: F.expr(f"shiftright({c}, cast({by} as int))")
    levels = (
        cells.withColumn("depth", F.explode(F.sequence(F.lit(0), F.col("_depth"))))
        .groupBy("depth", up("_cell", "_depth - depth").alias("prefix")).agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
        .withColumn("whole", (F.col("shard_bytes") <= limit_bytes) | (F.col("shard_rows") == 1) | (F.col("depth") == BITS))
    )
    levels = store(levels, "shard-levels")
    split = levels.where("NOT whole").select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    fits = levels.where("whole").withColumn("parent", up("prefix", "1"))
    leaves = fits.join(split, ["depth", "parent"]).select(*levels.columns).union(fits.where("depth = 0").select(*levels.columns)).drop("whole")
    leaves = store(leaves, "shard-leaves")
    least, most = leaves.agg(F.min("depth"), F.max("depth")).first()
    paths = cells.select("_cell", "_depth", F.explode(F.sequence(F.lit(least or 0), F.least(F.col("_depth"), F.lit(most or 0)))).alias("depth"))
    of = paths.withColumn("prefix", up("_cell", "_depth - depth")).join(leaves, ["depth", "prefix"])
    bits = F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0")))
    of = of.select("_cell", "_depth", bits.alias("shard"), F.col("depth").cast("long"), "shard_bytes", "shard_rows")
    return rows.join(of, ["_cell", "_depth"]).select(*map(column, named), "shard", "depth", "shard_bytes", "shard_rows")


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Writes ``docs`` as Parquet, a folder for each shard: a task holds rows of whole shards, each within the limit."""
    out = assign(docs, **options)
    out.repartition("shard").sortWithinPartitions("shard").write.partitionBy("shard").parquet(path)
