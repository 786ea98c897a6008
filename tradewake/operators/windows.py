"""Event-time window statistics; the same functions serve tables and streams.

Distinct users are counted with two groupings (window + user, then window):
exact, allowed on streams in append mode, and free of hot spots, because a
busy key is first spread over its users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.functions import exprs as X


def windowed(
    df: DataFrame,
    ts: str,
    size: str,
    keys: list[str],
    user: str,
    rows: str,
    users: str,
    sums: dict[str, Column | str] | None = None,
) -> DataFrame:
    """Per tumbling window and key: row count, distinct users, sums of columns."""
    sums = sums or {}
    by_user = df.groupBy(F.window(ts, size), *keys, F.col(user).alias("_user")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(X.col(v)).alias(k) for k, v in sums.items()]
    )
    return by_user.groupBy("window", *keys).agg(
        F.sum("_n").alias(rows), F.count("_user").alias(users), *[F.sum(k).alias(k) for k in sums]
    )


def labelled(df: DataFrame) -> DataFrame:
    """Window bounds as text columns ``stt`` and ``edt``."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(X.time_text("window.start").alias("stt"), X.time_text("window.end").alias("edt"), *rest)


TRADE_KEYS = ["sku_id", "category3_id", "tm_id"]


def order_stats(events: DataFrame, size: str = "10 seconds", ts: str = "ts") -> DataFrame:
    rows = events.where(F.col("event_type") == "order")
    out = windowed(rows, ts, size, TRADE_KEYS, "user_id", "order_ct", "order_user_ct", {"order_amount": "order_amount"})
    return out.withColumn("sku_num", F.col("order_ct")).withColumn("order_amount", F.round("order_amount", 2))


def payment_stats(events: DataFrame, size: str = "10 seconds", ts: str = "ts") -> DataFrame:
    rows = events.where(F.col("event_type") == "payment")
    out = windowed(rows, ts, size, TRADE_KEYS, "user_id", "payment_ct", "payment_user_ct", {"payment_amount": "payment_amount"})
    return out.withColumn("payment_amount", F.round("payment_amount", 2))


def refund_stats(events: DataFrame, size: str = "10 seconds", ts: str = "ts") -> DataFrame:
    rows = events.where(F.col("event_type") == "refund")
    out = windowed(rows, ts, size, TRADE_KEYS, "user_id", "refund_ct", "refund_user_ct", {"refund_amount": "refund_amount"})
    return out.withColumn("refund_amount", F.round("refund_amount", 2))


def joined_stats(orders: DataFrame, payments: DataFrame, refunds: DataFrame) -> DataFrame:
    """Order windows with the payment and refund figures of the same window and key."""
    on = ["window", *TRADE_KEYS]
    return orders.join(payments, on, "left").join(refunds, on, "left")


def trade_windows(events: DataFrame, size: str = "10 seconds", ts: str = "ts") -> DataFrame:
    """What ``joined_stats`` gives, from one grouping pair over orders, payments and refunds together: no joins, one read."""
    kinds = ["order", "payment", "refund"]
    of = lambda kind, c: F.when(F.col("event_type") == kind, c)
    by_user = events.where(F.col("event_type").isin(kinds)).groupBy(F.window(ts, size), *TRADE_KEYS, "user_id").agg(
        *[F.count(of(k, F.lit(1))).alias(f"_{k}") for k in kinds], *[F.sum(of(k, F.col(f"{k}_amount"))).alias(f"{k}_amount") for k in kinds])
    counts = [x for k in kinds for x in (F.sum(f"_{k}").alias(f"{k}_ct"), F.count(F.when(F.col(f"_{k}") > 0, F.col("user_id"))).alias(f"{k}_user_ct"),
                                         F.round(F.sum(f"{k}_amount"), 2).alias(f"{k}_amount"))]
    out = by_user.groupBy("window", *TRADE_KEYS).agg(*counts).where("order_ct > 0")
    some = lambda k, c: F.when(F.col(f"{k}_ct") > 0, F.col(c)).alias(c)
    later = [some(k, f"{k}_{what}") for k in kinds[1:] for what in ("ct", "user_ct", "amount")]
    return out.select("window", *TRADE_KEYS, "order_ct", "order_user_ct", "order_amount", F.col("order_ct").alias("sku_num"), *later)


BEHAVIOUR_KEYS = ["vc", "ch", "ar", "is_new"]


def pv_uv(log: DataFrame, size: str = "10 seconds", ts: str = "ts") -> DataFrame:
    return windowed(log, ts, size, BEHAVIOUR_KEYS, "uid", "pv_ct", "uv_ct")


def sessions(log: DataFrame, size: str = "10 seconds", ts: str = "ts") -> DataFrame:
    """Start events and those without a previous page, per window."""
    rows = log.where(F.col("event_type") == "start")
    return rows.groupBy(F.window(ts, size), *BEHAVIOUR_KEYS).agg(
        F.count(F.lit(1)).alias("sv_ct"), F.sum(F.when(F.col("last_page_id").isNull(), 1).otherwise(0)).alias("uj_ct")
    )


def displays_clicks(log: DataFrame, size: str = "10 seconds", ts: str = "ts") -> DataFrame:
    """Displays and distinct displayed items per item, page and channel.

    The item is a grouping key, so its distinct count is 1 where any display occurred.
    """
    rows = log.where(F.col("event_type").isin("display", "click") & F.col("display_item").isNotNull())
    shown = F.when(F.col("event_type") == "display", 1)
    return rows.groupBy(F.window(ts, size), F.col("display_item").alias("sku_id"), "page_id", "ch").agg(
        F.count(shown).alias("disp_ct"), F.coalesce(F.max(shown), F.lit(0)).cast("bigint").alias("disp_sku_num")
    )


def gmv(payments: DataFrame, ts: str, amount: str, user: str, size: str = "5 minutes") -> DataFrame:
    """Amount, payments and distinct payers per window, over all keys."""
    return windowed(payments, ts, size, [], user, "payment_ct", "user_ct", {"gmv": amount})
