"""Table forms of the keyed state jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.operators.positions import running_last

AMOUNTS = ["order_amount", "pay_amount", "refund_amount"]


def partial_details(changes: DataFrame) -> DataFrame:
    """Order, pay and refund messages as partial detail rows.

    The payload is ``data``, else ``after``. Event time falls back per kind:
    orders use create_time, payments and refunds callback_time then create_time,
    all of them the envelope time last.
    """
    p = F.coalesce("data", "after")
    kind = F.col("event_type")
    created, called = p["create_time"].try_cast("bigint"), p["callback_time"].try_cast("bigint")
    own = F.when(kind == "order", created).otherwise(F.coalesce(called, created))
    amount = p["total_amount"].try_cast("double")
    key = F.when(kind == "order", p["id"]).otherwise(p["order_detail_id"])
    rows = changes.select(
        key.alias("order_detail_id"), p["order_id"].alias("order_id"), "seq", "event_type", F.coalesce(own, F.col("ts")).alias("ts"),
        F.when(kind == "order", amount).alias("order_amount"), F.when(kind == "pay", amount).alias("pay_amount"),
        F.when(kind == "refund", amount).alias("refund_amount"),
    )
    return rows.where(F.col("order_detail_id").isNotNull())


def merge_details(parts: DataFrame, span: int = 100_000) -> DataFrame:
    """Every partial row completed with the last known value of each amount of its detail."""
    return running_last(parts, ["order_detail_id"], ["seq"], AMOUNTS, F.floor(F.col("seq") / span))
