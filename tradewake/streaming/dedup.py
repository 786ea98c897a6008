"""Deduplication and first-seen marks, for tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.operators.positions import above_earlier


def exact(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drops repeated full records; give a stream a bounded form with ``within_watermark``."""
    return df.dropDuplicates(columns or df.columns)


def within_watermark(df: DataFrame, keys: list[str], ts: str | None = None, delay: str | None = None) -> DataFrame:
    """Exact dedup on keys; on streams state lives no longer than the watermark delay."""
    if df.isStreaming:
        rows = df.withWatermark(ts, delay) if ts else df
        return rows.dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


def newer_only(df: DataFrame, key: str, order: str, ts: str, span: int = 100_000) -> DataFrame:
    """Rows whose ``ts`` is newer than everything the key brought before, in arrival order."""
    return above_earlier(df, [key], [order], ts, F.floor(F.col(order) / span))


def first_seen(df: DataFrame, key: str, order: list[str], mark: str) -> DataFrame:
    """The first record of each key, marked 1."""
    rest = [c for c in df.columns if c != key]
    lead = [c for c in order if c in rest]
    first = F.min(F.struct(*lead, *[c for c in rest if c not in lead])).alias("_f")
    return df.groupBy(key).agg(first).select(key, *[F.col(f"_f.{c}") for c in rest], F.lit(1).alias(mark))


def repaired_new_flag(df: DataFrame, key: str, flag: str, ts: str, order: list[str]) -> DataFrame:
    """Sets the new-visitor flag to 0 on records whose day is not the key's remembered day.

    The remembered day is that of the key's first record, or the day before it
    when that record did not claim to be new.
    """
    first = df.groupBy(key).agg(F.min(F.struct(*dict.fromkeys([*order, flag, ts]))).alias("_f")).select(
        key, F.when(F.col(f"_f.{flag}") == "1", F.to_date(f"_f.{ts}")).otherwise(F.date_sub(F.to_date(f"_f.{ts}"), 1)).alias("_day")
    )
    stale: Column = (F.col(flag) == "1") & (F.to_date(ts) != F.col("_day"))
    return df.join(first, key).withColumn(flag, F.when(stale, "0").otherwise(F.col(flag))).drop("_day")
