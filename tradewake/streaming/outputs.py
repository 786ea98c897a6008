"""Micro-batch writers: several outputs, dims by config, wide rows recomputed for touched keys."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewake.operators import cdc as C
from tradewake.operators import routing as R
from tradewake.operators import wide as J
from tradewake.session import discard, store
from tradewake.sources.writers import KeyedTable, in_pieces

BatchWriter = Callable[[DataFrame, int], None]


def split_logs(path: str) -> BatchWriter:
    """Dirty rows and the five log parts of a text batch, each to its own folder.

    The batch is parsed once and kept while it is written; a repeated batch
    overwrites its own folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = R.with_error(R.drop_blank(batch)).persist()
        good = parsed.where(F.col("error").isNull())
        outputs = {
            "dirty": parsed.where(F.col("error").isNotNull()).select(F.col("value").alias("raw"), "error"),
            "err": R.split_err(good).select("err"),
            "start": R.split_start(good).select("rec"),
            "display": R.split_display(good).select("rec.common", "rec.page", "display", "rec.ts"),
            "action": R.split_action(good).select("rec.common", "rec.page", "action"),
            "page": R.split_page(good).select("rec"),
        }
        for name, rows in outputs.items():
            rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        parsed.unpersist()

    return write


def dims_by_config(config: Callable[[SparkSession], DataFrame], table: KeyedTable) -> BatchWriter:
    """Change text to keyed dim rows; the config is read again for every batch, so its changes take effect.

    ``table`` is keyed by sink table and row key, ordered by time and op; deletes stay as markers.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writes = C.route_dims(C.parse(batch), config(batch.sparkSession))
        table.upsert(writes.withColumn("cells", F.sort_array(F.map_entries("cells"))), batch_id)

    return write


def dim_rows(table: DataFrame, sink_table: str) -> DataFrame:
    """Live rows of one dim table."""
    rows = table.where((F.col("sink_table") == sink_table) & (F.col("op") != "d"))
    return rows.select("row_key", F.map_from_entries("cells").alias("cells"))


class WideOrders:
    """Order wide rows kept up to date from six change streams.

    Regular outer joins of streams would hold every row for ever. Instead each
    source is a keyed table in buckets of its order; a batch upserts its rows,
    reads of every table only the buckets of the orders it touched, and upserts
    the wide rows of those orders. More ``buckets`` make a batch of few orders read less.
    """

    KEYS = {
        "detail": ["order_detail_id"],
        "info": ["order_id"],
        "activity": ["order_detail_id"],
        "coupon": ["order_detail_id"],
        "payment": ["order_id"],
        "refund": ["order_id", "refund_id"],
    }

    def __init__(self, path: str, split: Callable[[DataFrame], dict[str, DataFrame]], buckets: int = 64):
        """``split`` turns a batch into the six change logs; every one carries ``order_id`` and ``ts_ms``."""
        self.split = split
        self.states = {n: KeyedTable(f"{path}/{n}", k, ["ts_ms"], "order_id", buckets) for n, k in self.KEYS.items()}
        self.wide = KeyedTable(f"{path}/wide", ["order_detail_id"], ["version"], "order_id", buckets)

    @property
    def tables(self) -> list[KeyedTable]:
        return [*self.states.values(), self.wide]

    def sides(self, touched: DataFrame, batch_id: int, only: list[int] | None = None) -> dict[str, DataFrame]:
        """The rows of the touched orders in each table; of the tables only the buckets of these orders are opened, or those of ``only``."""
        only = self._buckets(touched) if only is None else only
        return {n: t.read(touched.sparkSession, batch_id, only).join(touched, "order_id", "left_semi") for n, t in self.states.items()}

    def _buckets(self, touched: DataFrame) -> list[int]:
        """Numbers of buckets, at most as many as there are."""
        return sorted(r["b"] for r in touched.select(self.wide.bucket_of("order_id").alias("b")).distinct().collect())

    def _wide_rows(self, touched: DataFrame, batch_id: int, only: list[int]) -> DataFrame:
        sides = self.sides(touched, batch_id, only)
        slim = {n: d.drop("order_id") if n in ("activity", "coupon") else d for n, d in sides.items()}
        slim["refund"] = slim["refund"].drop("ts_ms")
        return J.order_wide(*[slim[n] for n in self.KEYS]).withColumn("version", F.lit(batch_id))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """The batch is read again for each of its logs, not kept; buckets are joined some at a time, so that what joins
        write to disk is that of a few buckets."""
        spark = batch.sparkSession
        logs = self.split(batch)
        for name, rows in logs.items():
            self.states[name].upsert(rows, batch_id)
        touched = reduce(DataFrame.unionByName, [rows.select("order_id") for rows in logs.values()]).where("order_id IS NOT NULL").distinct()
        touched = store(touched.withColumn("_bucket", self.wide.bucket_of("order_id")), "touched-orders", ["_bucket"])
        buckets = self._buckets(touched)
        bytes_each = sum(t.stored_bytes(spark, batch_id) for t in self.states.values()) / self.wide.buckets
        pieces = in_pieces(buckets, bytes_each) or [[]]
        self.wide.upsert_pieces(spark, (
            (self._wide_rows(touched.where(F.col("_bucket").isin(only)).drop("_bucket"), batch_id, only), only) for only in pieces), batch_id)
        discard(touched)
