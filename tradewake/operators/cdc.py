"""Change envelopes: parse, clean, route, project, and dimension routing by config."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators.routing import parse_once
from tradewake.sources import schemas as S

# Fixed values: (source table, change kind) -> target table.
ROUTES = {
    ("favor_info", "insert"): "dwd_interaction_favor_add",
    ("coupon_use", "insert"): "dwd_tool_coupon_get",
    ("coupon_use", "update"): "dwd_tool_coupon_use",
    ("order_info", "insert"): "dwd_trade_order_detail",
    ("order_info", "update"): "dwd_trade_order_pay",
    ("refund_payment", "insert"): "dwd_trade_order_refund",
    ("payment_info", "insert"): "dwd_trade_pay_detail",
    ("user_info", "insert"): "dwd_user_register",
}
FALLBACK = "dwd_dynamic_fallback"


def parse(df: DataFrame, text: str = "value") -> DataFrame:
    """Envelope fields beside the input columns; unreadable text is skipped."""
    e = F.from_json(text, S.ENVELOPE, {"mode": "PERMISSIVE"})
    rows = df.withColumn("_e", parse_once(e)).where(F.col("_e.op").isNotNull())
    return rows.select(*df.columns, "_e.op", "_e.before", "_e.after", "_e.source", "_e.ts_ms")


def snapshot_envelope(rows: DataFrame, table: str, ts_ms: Column) -> DataFrame:
    """Table rows as snapshot envelopes: op r, every value a string."""
    image = F.create_map(*[x for c in rows.columns for x in (F.lit(c), F.col(c).cast("string"))])
    return rows.select(
        F.lit("r").alias("op"),
        F.lit(None).cast("map<string,string>").alias("before"),
        F.map_filter(image, lambda _, v: v.isNotNull()).alias("after"),
        F.create_map(F.lit("table"), F.lit(table), F.lit("snapshot"), F.lit("true")).alias("source"),
        ts_ms.alias("ts_ms"),
    )


def clean(df: DataFrame, ops: tuple[str, ...] | None = None) -> DataFrame:
    """Envelopes without ``source``; all ops unless some are named."""
    rows = df if ops is None else df.where(F.col("op").isin(*ops))
    return rows.drop("source", "transaction")


def config_image(df: DataFrame) -> DataFrame:
    """The image that counts: ``before`` for deletes, ``after`` otherwise."""
    return df.withColumn("image", F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")))


def change_kind(op: Column) -> Column:
    return F.when(op.isin("c", "r"), "insert").when(op == "u", "update").when(op == "d", "delete")


def route(df: DataFrame) -> DataFrame:
    """Adds ``sink_table`` by source table and change kind; rows without after-image leave."""
    key = F.concat_ws("/", F.col("source")["table"], change_kind(F.col("op")))
    target = X.lookup(key, {f"{t}/{k}": sink for (t, k), sink in ROUTES.items()})
    return df.where(F.col("after").isNotNull()).withColumn("sink_table", F.coalesce(target, F.lit(FALLBACK)))


# Columns taken from the after-image of three tables, with their target names.
PROJECTIONS = {
    "order_info": {"id": "order_id", "user_id": "user_id", "sku_id": "sku_id", "province_id": "province_id",
                   "total_amount": "total_amount", "create_time": "create_time"},
    "payment_info": {"id": "payment_id", "order_id": "order_id", "user_id": "user_id", "total_amount": "total_amount",
                     "payment_type": "payment_type", "payment_time": "payment_time"},
    "refund_info": {"id": "refund_id", "order_id": "order_id", "user_id": "user_id", "refund_amount": "refund_amount",
                    "refund_type": "refund_type", "refund_time": "refund_time"},
}


def project(df: DataFrame, table: str, processed_at: Column | None = None) -> DataFrame:
    """After-image of one table as flat text columns; pass ``processed_at`` to stamp rows."""
    rows = df.where((F.col("source")["table"] == table) & F.col("after").isNotNull())
    stamp = [] if processed_at is None else [processed_at.alias("processed_at")]
    return rows.select(
        F.col("source")["table"].alias("table"), "op",
        *[F.col("after")[k].alias(v) for k, v in PROJECTIONS[table].items()], *stamp,
    )


def typed(df: DataFrame, texts: dict[str, str], times: dict[str, str], key: str = "id") -> DataFrame:
    """After-image as a typed row: integer key, text fields, epoch ms to timestamps."""
    return df.where(F.col("after").isNotNull()).select(
        F.col("after")[key].try_cast("bigint").alias(key),
        *[F.col("after")[k].alias(v) for k, v in texts.items()],
        *[X.from_millis(F.col("after")[k].try_cast("bigint")).alias(v) for k, v in times.items()],
    )


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key; ties in ``order`` fall to the other columns, so the result is fixed.

    The maximum aggregates before the shuffle: a hot key costs one row per
    task. It also runs on streams in update mode.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*[c if c in keys else f"_best.{c}" for c in df.columns])


# ---- dimension routing ---------------------------------------------------

CONFIG_SCHEMA = "source_table string, sink_table string, sink_columns string, sink_family string, sink_row_key string"


def config_frame(spark: SparkSession, rows: list[tuple[str, str, str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, CONFIG_SCHEMA)


def current_config(changes: DataFrame) -> DataFrame:
    """Newest config per source table from the config change log; deleted entries leave."""
    rows = config_image(changes).select(
        *[F.col("image")[c.split()[0]].alias(c.split()[0]) for c in CONFIG_SCHEMA.split(", ")], "op", "ts_ms"
    )
    newest = latest(rows, ["source_table"], ["ts_ms", "op"])
    return newest.where(F.col("op") != "d").drop("op", "ts_ms")


def route_dims(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Changes of configured tables as keyed dim writes.

    Gives sink table, row key, op and the configured columns as a string map.
    The config has one row per source table; whether it is broadcast is left to
    the optimizer, which knows its size.
    """
    keyed = config_image(changes).withColumn("source_table", F.col("source")["table"])
    wanted = F.transform(F.split("sink_columns", ","), lambda c: F.trim(c))
    return keyed.join(config, "source_table").select(
        "sink_table",
        F.try_element_at(F.col("image"), F.col("sink_row_key")).alias("row_key"),
        "op",
        "ts_ms",
        F.map_filter("image", lambda k, _: F.array_contains(wanted, k)).alias("cells"),
    )


def dim_state(writes: DataFrame, apply_deletes: bool = True) -> DataFrame:
    """Newest cells per sink table and row key. Cells become an entry list so they can be compared."""
    rows = writes if apply_deletes else writes.where(F.col("op") != "d")
    flat = rows.withColumn("cells", F.sort_array(F.map_entries("cells")))
    newest = latest(flat, ["sink_table", "row_key"], ["ts_ms", "op"])
    out = newest.withColumn("cells", F.map_from_entries("cells"))
    return out.where(F.col("op") != "d") if apply_deletes else out


def table_plan(changes: DataFrame) -> DataFrame:
    """CREATE or DROP per sink table, from the newest config change of each."""
    rows = config_image(changes).select(F.col("image")["sink_table"].alias("sink_table"), "op", "ts_ms")
    newest = latest(rows, ["sink_table"], ["ts_ms", "op"])
    return newest.select("sink_table", F.when(F.col("op") == "d", "DROP").otherwise("CREATE").alias("action"))
