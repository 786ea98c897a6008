"""Parse, clean, split and project JSON log records.

All functions are narrow (no shuffle) and run unchanged on streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.sources import schemas as S


def drop_blank(df: DataFrame, text: str = "value") -> DataFrame:
    """Rows whose message is present and not blank."""
    return df.where(X.not_blank(text))


def parse_once(parsed: Column) -> Column:
    """Generates the parsed struct, so that later filters and projections share one parse.

    A plain column would be inlined into every filter pushed below it, and the
    JSON text parsed again for each of them.
    """
    return F.explode(F.array(parsed))


def parse_log(df: DataFrame, text: str = "value") -> DataFrame:
    """Log records with the parsed struct in ``rec``; unreadable lines are skipped."""
    parsed = df.withColumn("rec", parse_once(F.from_json(text, S.APP_LOG, {"mode": "PERMISSIVE"})))
    return parsed.where(F.col("rec.common").isNotNull() & F.col("rec.ts").isNotNull())


def with_error(df: DataFrame, text: str = "value") -> DataFrame:
    """Adds ``rec`` and ``error``: null for clean records."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = df.withColumn("rec", parse_once(F.from_json(text, S.APP_LOG_CHECKED, options)))
    rec = F.col("rec")
    error = F.when(rec.isNull() | rec["_corrupt_record"].isNotNull(), "malformed").when(
        F.to_json(rec) == "{}", "empty"
    )
    return parsed.withColumn("error", error)


def clean(df: DataFrame, text: str = "value") -> DataFrame:
    return with_error(df, text).where(F.col("error").isNull()).drop("error")


def dirty(df: DataFrame, text: str = "value") -> DataFrame:
    return with_error(df, text).where(F.col("error").isNotNull()).select(F.col(text).alias("raw"), "error")


# ---- overlapping split ---------------------------------------------------

PARTS = {"start": "start", "page": "page", "displays": "display", "actions": "action", "err": "error"}


def overlapping(parsed: DataFrame) -> DataFrame:
    """One row per record and part it carries, tagged in ``part``; one pass over the input."""
    tags = F.filter(
        F.array(*[F.when(F.col(f"rec.{field}").isNotNull(), F.lit(tag)) for field, tag in PARTS.items()]),
        lambda tag: tag.isNotNull(),
    )
    return parsed.withColumn("part", F.explode(tags))


def having(parsed: DataFrame, *fields: str) -> DataFrame:
    """Records that carry every one of ``fields``."""
    cond = F.lit(True)
    for field in fields:
        cond = cond & F.col(f"rec.{field}").isNotNull()
    return parsed.where(cond)


# ---- exclusive split -----------------------------------------------------


def split_err(parsed: DataFrame) -> DataFrame:
    """The ``err`` object alone."""
    return parsed.where(F.col("rec.err").isNotNull()).withColumn("err", F.col("rec.err"))


def split_start(parsed: DataFrame) -> DataFrame:
    """Whole start records without ``err``."""
    return parsed.where(F.col("rec.start").isNotNull()).withColumn("rec", F.col("rec").dropFields("err"))


def split_display(parsed: DataFrame) -> DataFrame:
    """One {common, page, display, ts} per display of records that are no start."""
    return displays(parsed.where(F.col("rec.start").isNull()))


def split_action(parsed: DataFrame) -> DataFrame:
    """One {common, page, action} per action of records that are no start."""
    return actions(parsed.where(F.col("rec.start").isNull()))


def split_page(parsed: DataFrame) -> DataFrame:
    """What is left of records that are no start."""
    rest = F.col("rec").dropFields("err", "displays", "actions", "start")
    return parsed.where(F.col("rec.start").isNull()).withColumn("rec", rest)


def displays(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("display", F.explode("rec.displays"))


def actions(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("action", F.explode("rec.actions"))


# ---- flattening ----------------------------------------------------------


# Columns of the flat logs in the two functions below.
def _common() -> list[Column]:
    names = {"ar": "area_code", "ba": "brand", "ch": "channel", "is_new": "is_new", "md": "model", "mid": "mid_id",
             "os": "os", "uid": "user_id", "vc": "version_code"}
    return [F.col(f"rec.common.{k}").alias(v) for k, v in names.items()]


def _page() -> list[Column]:
    names = {"during_time": "during_time", "item": "page_item", "item_type": "page_item_type",
             "last_page_id": "last_page_id", "page_id": "page_id", "source_type": "source_type"}
    return [F.col(f"rec.page.{k}").alias(v) for k, v in names.items()]


def record_day(ms: str = "rec.ts") -> Column:
    return X.day_text(X.from_millis(ms))


def flat_start(parsed: DataFrame) -> DataFrame:
    """Start records as 15 columns and the day."""
    return having(parsed, "start").select(
        *_common(), "rec.start.entry", "rec.start.loading_time", "rec.start.open_ad_id", "rec.start.open_ad_ms",
        "rec.start.open_ad_skip_ms", "rec.ts", record_day().alias("dt"),
    )


def flat_page(parsed: DataFrame) -> DataFrame:
    """Page fields of every record as 17 columns, with the page address, and the day."""
    return parsed.select(
        "rec.common.ar", "rec.common.ba", "rec.common.ch", "rec.common.is_new", "rec.common.md", "rec.common.mid",
        "rec.common.os", "rec.common.uid", "rec.common.vc", "rec.page.page_id", "rec.page.item",
        F.col("rec.page.item_type").alias("page_item_type"), "rec.page.last_page_id", "rec.page.source_type",
        "rec.page.during_time", X.page_url("rec.page.page_id").alias("url"), "rec.ts", record_day().alias("dt"),
    )


def flat_action(parsed: DataFrame) -> DataFrame:
    """Actions as 19 columns and the day."""
    return actions(parsed).select(
        *_common(), *_page(), "action.action_id", "action.item", "action.item_type", "rec.ts", record_day().alias("dt")
    )


def flat_display(parsed: DataFrame) -> DataFrame:
    """Displays as 21 columns and the day."""
    return displays(parsed).select(
        *_common(), *_page(), "rec.ts", "display.display_type", "display.item", "display.item_type", "display.order",
        "display.pos_id", record_day().alias("dt"),
    )


# ---- unifying ------------------------------------------------------------


def unified(parsed: DataFrame, topic_prefix: str = "topic_") -> DataFrame:
    """Records of the log topics as one wide row with topic, partition and offset."""
    rows = parsed.select(
        record_day().alias("dt"),
        F.regexp_replace("topic", f"^{topic_prefix}", "").alias("log_type"),
        F.col("rec.common.mid").alias("mid"),
        F.col("rec.common.uid").alias("uid"),
        F.col("rec.ts").alias("ts"),
        X.from_millis("rec.ts").alias("event_time"),
        "topic", "partition", "offset",
        F.col("rec.common.sid").alias("sid"),
        F.col("rec.page.page_id").alias("page_id"),
        F.col("rec.page.item").alias("item"),
        F.lit(None).cast("string").alias("action_id"),
        F.lit(None).cast("string").alias("display_id"),
        F.col("rec.err.error_code").alias("error_code"),
        F.col("rec.common.os").alias("os"),
        F.col("rec.common.vc").alias("vc"),
        F.col("rec.common.ch").alias("ch"),
        F.col("rec.common.ar").alias("ar"),
    )
    return rows.where(F.col("mid").isNotNull() & F.col("ts").isNotNull())


def behaviour(parsed: DataFrame) -> DataFrame:
    """Start, page, display and action records in one shape.

    ``event_ts`` is the record time, for actions the time of the action itself.
    One pass: each record is exploded into the events it stands for.
    """
    rec = F.col("rec")
    none_display = F.lit(None).cast(S.DISPLAY)
    none_action = F.lit(None).cast(S.ACTION)

    def event(kind, ts, display, action):
        return F.struct(
            F.lit(kind).alias("event_type"), ts.alias("event_ts"), display.alias("display"), action.alias("action")
        )

    whole = F.array(
        F.when(rec["start"].isNotNull(), event("start", rec["ts"], none_display, none_action)).otherwise(
            event("page", rec["ts"], none_display, none_action)
        )
    )
    empty = F.slice(whole, 1, 0)
    shown = F.transform(rec["displays"], lambda d: event("display", rec["ts"], d, none_action))
    acted = F.transform(rec["actions"], lambda a: event("action", a["ts"], none_display, a))
    events = F.when(rec["start"].isNotNull(), whole).otherwise(
        F.concat(whole, F.coalesce(shown, empty), F.coalesce(acted, empty))
    )
    return parsed.withColumn("event", F.explode(events)).select(
        "event.event_type",
        F.col("rec.common.mid").alias("mid"),
        "event.event_ts",
        F.col("rec.common").alias("common"),
        F.col("rec.page").alias("page"),
        "event.display",
        "event.action",
    )


# ---- typed projections ---------------------------------------------------


def cleanse(df: DataFrame, required: tuple[str, ...] = ("event_id", "event_time", "user_id", "device_id")) -> DataFrame:
    """Log rows with the required fields, text time parsed into ``ts``, 5 s watermark."""
    rows = df.dropna(subset=list(required)).withColumn("ts", F.try_to_timestamp(F.col("event_time")))
    return rows.withWatermark("ts", "5 seconds") if df.isStreaming else rows


# The typed tables of the wide event topic and their columns.
WIDE_TABLES = {
    "order_item": ["order_id", "item_id", "sku_id", "shop_id", "qty", "unit_price"],
    "payment": ["payment_id", "order_id", "buyer_id", "pay_amount", "pay_status", "pay_time"],
    "refund": ["refund_id", "order_id", "buyer_id", "refund_amount", "refund_type"],
    "user": ["user_id", "register_time", "gender", "age", "region", "device_type"],
    "item": ["item_id", "sku_id", "shop_id", "category_id", "item_name", "price"],
    "shop": ["shop_id", "shop_name", "seller_id", "category_id", "create_time"],
}


def wide_split(df: DataFrame, event_type: str) -> DataFrame:
    return df.where(F.col("event_type") == event_type).select(*WIDE_TABLES[event_type])


def normalise_amounts(df: DataFrame) -> DataFrame:
    """Text prices as double amounts; the text that could not be read goes to ``cast_error``."""
    order, pay = F.col("order_price"), F.col("pay_amount")
    order_amount, payment_amount = order.try_cast("double"), pay.try_cast("double")
    bad = F.when(order.isNotNull() & order_amount.isNull(), order).when(pay.isNotNull() & payment_amount.isNull(), pay)
    return (
        df.withColumn("order_amount", order_amount)
        .withColumn("payment_amount", payment_amount)
        .withColumn("cast_error", bad)
    )


def require(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all present."""
    return df.dropna(subset=list(keys))


def cart_events(items: DataFrame) -> DataFrame:
    """Cart events from order items; quantity 1..10 follows from the row, so reruns agree."""
    parts = F.concat_ws("|", "user_id", "item_id", "sku_id", "shop_id", "ts")
    return items.select(
        F.lit("cart").alias("event_type"), "user_id", "item_id", "sku_id", "shop_id", "ts",
        (F.conv(F.right(F.md5(parts), F.lit(6)), 16, 10).cast("bigint") % 10 + 1).alias("quantity"),
    )


def behaviour_projection(df: DataFrame) -> DataFrame:
    return df.select("user_id", "item_id", "shop_id", "event_type")


def day_keys(df: DataFrame, first: str, last: str) -> DataFrame:
    """One row per input row and day between two date columns, day as integer yyyyMMdd."""
    return df.withColumn("day_key", F.explode(F.sequence(F.col(first), F.col(last)))).withColumn(
        "day_key", X.date_key("day_key")
    )
