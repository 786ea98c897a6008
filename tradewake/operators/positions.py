"""Ranks, running values and neighbours that survive hot groups.

A plain window function sends a whole group to one task. Here a group is cut
into buckets of its order column; each bucket is a window of its own, and a
short second window over per-bucket aggregates carries values across buckets.
Bucket boundaries are fixed rules on the values, so recomputed tasks agree.

Keys travel as one struct. Structs are equal where all fields are, nulls
included, so groupings, windows and joins on a struct need no rewriting for
nulls and share one partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

AHEAD = W.unboundedPreceding, -1


def matched(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where a null equals a null, with one copy of the keys."""
    right = right.withColumn("_match", F.struct(*keys)).drop(*keys)
    return left.withColumn("_match", F.struct(*keys)).join(right, "_match", how).drop("_match")


def _part(struct: str, names: list[str]) -> Column:
    """The struct of some fields of a struct."""
    return F.struct(*[F.col(struct)[n].alias(n) for n in names])


def histogram(df: DataFrame, groups: list[str], value: str, width: float | None = None, descending: bool = False) -> DataFrame:
    """Per distinct value of each group, both as ``_v``: ``n`` rows, ``before`` rows ahead of it, ``total`` rows.

    Rows are counted per value before the shuffle. Without ``width`` the values of a group are one window, which suits
    scores and other values of few digits. With it, ``width`` is the span of one bucket: a group has range/width buckets and a bucket the
    distinct values inside that span, both small whatever the row count.
    """
    counts = df.groupBy(F.struct(*groups, value).alias("_v")).agg(F.count(F.lit(1)).alias("n")).withColumn("_g", _part("_v", groups))
    direction = (lambda c: c.desc()) if descending else (lambda c: c.asc())
    every = W.partitionBy("_g")
    if width is None:
        before = F.sum("n").over(every.orderBy(direction(F.col("_v")[value])).rowsBetween(*AHEAD))
        return counts.select("_v", "n", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(every).alias("total"))
    counts = counts.withColumn("_cell", F.struct("_g", F.floor(F.col("_v")[value] / F.lit(width)).alias("_bucket")))
    inside = W.partitionBy("_cell").orderBy(direction(F.col("_v")[value])).rowsBetween(*AHEAD)
    inner = counts.select("_cell", "_v", "n", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("_inside"))
    buckets = counts.groupBy("_cell").agg(F.sum("n").alias("_n")).withColumn("_g", F.col("_cell._g"))
    over_buckets = every.orderBy(direction(F.col("_cell._bucket"))).rowsBetween(*AHEAD)
    buckets = buckets.select("_cell", F.coalesce(F.sum("_n").over(over_buckets), F.lit(0)).alias("_offset"), F.sum("_n").over(every).alias("total"))
    return inner.join(buckets, "_cell").select("_v", "n", (F.col("_offset") + F.col("_inside")).alias("before"), "total")


def _placed(df: DataFrame, groups: list[str], value: str, found: DataFrame) -> DataFrame:
    return df.withColumn("_v", F.struct(*groups, value)).join(found, "_v").drop("_v")


def ranked(df: DataFrame, groups: list[str], value: str, width: float | None = None, out: str = "rank") -> DataFrame:
    """Rank by ``value`` descending inside the groups, ties sharing the best rank, nulls behind all values."""
    h = histogram(df, groups, value, width, descending=True)
    return _placed(df, groups, value, h.select("_v", (F.col("before") + 1).alias(out)))


def cumulative_share(df: DataFrame, groups: list[str], value: str, width: float | None = None, out: str = "share") -> DataFrame:
    """Share of the group's rows whose value is not above this one; a null is below all values."""
    h = histogram(df, groups, value, width)
    share = (F.col("before") + F.col("n")).cast("double") / F.col("total").cast("double")
    return _placed(df, groups, value, h.select("_v", share.alias(out)))


def numbered(df: DataFrame, groups: list[str], value: str, tie: str, tie_width: float, out: str = "rank") -> DataFrame:
    """Row number by ``value`` (of few digits) descending, then unique ``tie`` ascending.

    Rows of one group, value and span of ``tie_width`` ties are a cell. Cells are counted, offsets are carried over the cells of a
    value and over the values of a group, and rows are numbered inside their cell only.
    """
    rows = df.withColumn("_cell", F.struct(*groups, value, F.floor(F.col(tie) / F.lit(tie_width)).alias("_bucket")))
    cells = rows.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).withColumn("_v", _part("_cell", [*groups, value]))
    in_value = W.partitionBy("_v").orderBy(F.col("_cell._bucket")).rowsBetween(*AHEAD)
    cells = cells.withColumn("_inside", F.coalesce(F.sum("n").over(in_value), F.lit(0)))
    values = cells.groupBy("_v").agg(F.sum("n").alias("n")).withColumn("_g", _part("_v", groups))
    in_group = W.partitionBy("_g").orderBy(F.col("_v")[value].desc()).rowsBetween(*AHEAD)
    offsets = values.select("_v", F.coalesce(F.sum("n").over(in_group), F.lit(0)).alias("_offset"))
    starts = cells.join(offsets, "_v").select("_cell", (F.col("_offset") + F.col("_inside")).alias("_start"))
    number = F.row_number().over(W.partitionBy("_cell").orderBy(tie))
    return rows.join(starts, "_cell").withColumn(out, F.col("_start") + number).select(*df.columns, out)


def _celled(df: DataFrame, keys: list[str], bucket: Column) -> DataFrame:
    return df.withColumn("_cell", F.struct(F.struct(*keys).alias("_key"), bucket.alias("_bucket")))


def _over_cells() -> W:
    return W.partitionBy("_key").orderBy("_cell._bucket")


def following(
    df: DataFrame, keys: list[str], order: list[str], value: str, out: str, bucket: Column
) -> DataFrame:
    """``value`` of the next row of the same keys in ``order``; null on the last row.

    ``bucket`` must not decrease along ``order`` (a truncated time, say).
    """
    rows = _celled(df, keys, bucket)
    heads = rows.groupBy("_cell").agg(F.min_by(F.struct(value), F.struct(*order)).alias("_head")).withColumn("_key", F.col("_cell._key"))
    edges = heads.select("_cell", F.lead("_head").over(_over_cells()).alias("_edge"))
    rows = rows.withColumn("_next", F.lead(F.struct(value)).over(W.partitionBy("_cell").orderBy(*order)))
    picked = F.coalesce(F.col("_next"), F.col("_edge"))[value]
    return rows.join(edges, "_cell", "left").select(*df.columns, picked.alias(out))


def running_last(
    df: DataFrame, keys: list[str], order: list[str], values: list[str], bucket: Column
) -> DataFrame:
    """Replaces each of ``values`` by its last non-null value up to this row."""
    rows = _celled(df, keys, bucket)
    inside = W.partitionBy("_cell").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    marked = F.struct(*order)
    tails = rows.groupBy("_cell").agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), marked)).alias(f"_tail_{v}") for v in values]
    ).withColumn("_key", F.col("_cell._key"))
    earlier = _over_cells().rowsBetween(*AHEAD)
    carried = tails.select("_cell", *[F.last(f"_tail_{v}", ignorenulls=True).over(earlier).alias(f"_carry_{v}") for v in values])
    for v in values:
        rows = rows.withColumn(f"_in_{v}", F.last(v, ignorenulls=True).over(inside))
    return rows.join(carried, "_cell", "left").select(
        *[
            (F.coalesce(f"_in_{c}", f"_carry_{c}").alias(c) if c in values else F.col(c)) for c in df.columns
        ]
    )


def above_earlier(df: DataFrame, keys: list[str], order: list[str], value: str, bucket: Column) -> DataFrame:
    """Rows whose ``value`` exceeds every earlier value of the same keys."""
    rows = _celled(df, keys, bucket)
    peaks = rows.groupBy("_cell").agg(F.max(value).alias("_peak")).withColumn("_key", F.col("_cell._key"))
    carried = peaks.select("_cell", F.max("_peak").over(_over_cells().rowsBetween(*AHEAD)).alias("_carry"))
    rows = rows.withColumn("_in", F.max(value).over(W.partitionBy("_cell").orderBy(*order).rowsBetween(*AHEAD)))
    best = F.greatest("_in", "_carry")
    return rows.join(carried, "_cell", "left").where(best.isNull() | (F.col(value) > best)).select(*df.columns)


def running_total(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """Running sum for frames already reduced to one row per key and day."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(w))


def first_n(df: DataFrame, groups: list[str], order: list, n: int, out: str = "rn") -> DataFrame:
    """The first n rows per group; the limit is applied before the shuffle."""
    return df.withColumn(out, F.row_number().over(W.partitionBy(*groups).orderBy(*order))).where(F.col(out) <= n)
