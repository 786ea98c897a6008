"""Event time and watermarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.functions import exprs as X


def bounded(df: DataFrame, field: str, delay: str, text: str = "value", ts: str = "event_time") -> DataFrame:
    """Event time from an epoch field of the JSON text; 1970 when missing or unreadable."""
    ms = F.get_json_object(text, f"$.{field}").try_cast("bigint")
    return df.withColumn(ts, X.from_millis(F.coalesce(ms, F.lit(0)))).withWatermark(ts, delay)


def counted_windows(df: DataFrame, ts: str, width: str, keys: Sequence[str] = (), delay: str = "30 minutes") -> DataFrame:
    """Rows per window and keys so far, for output in update mode; on a stream, a row whose window the watermark has closed is dropped."""
    rows = df.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("window"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.col("window.start").alias("window_start"), *keys, "n")


def late_rows(arrived: DataFrame, counted: DataFrame, n: str = "n") -> DataFrame:
    """How many of the rows that arrived no window counts, as one row: exact, whatever partial aggregates were dropped.

    Rows without an event time belong to no window and count as late.
    """
    taken = counted.agg(F.coalesce(F.sum(n), F.lit(0)).alias("taken"))
    return arrived.agg(F.count(F.lit(1)).alias("rows")).join(taken).select((F.col("rows") - F.col("taken")).alias("late"))
