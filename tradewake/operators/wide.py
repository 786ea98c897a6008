"""Wide tables: lookups, trade joins, activity and product dimensions.

No join carries a broadcast hint: dimensions grow with the data, and the
optimizer broadcasts a side only when its measured size is below the
threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators.cdc import latest


def prefixed(dim: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return dim.select(*[F.col(c).alias(c if c in keep else f"{prefix}{c}") for c in dim.columns])


def look_up(df: DataFrame, dim: DataFrame, key: Column | str, dim_key: str, prefix: str = "") -> DataFrame:
    """Left join on a text key; blank or unmatched keys pass through with null dim fields."""
    side = prefixed(dim, prefix).withColumnRenamed(f"{prefix}{dim_key}", "_dim_key")
    value = X.col(key).cast("string")
    # blank keys get values of their own that no dim has, so they do not meet in one task
    plain = [c for c, kind in df.dtypes if "map<" not in kind]
    blank = F.concat(F.lit("\u0000"), F.xxhash64(*plain).cast("string"))
    usable = F.when(F.trim(value) != "", value).otherwise(blank)
    return df.withColumn("_key", usable).join(side, F.col("_key") == F.col("_dim_key").cast("string"), "left").drop(
        "_key", "_dim_key"
    )


def look_up_or_default(df: DataFrame, dim: DataFrame, key: str, dim_key: str, defaults: dict[str, object]) -> DataFrame:
    """Lookup whose misses get placeholder values."""
    out = look_up(df, dim, key, dim_key)
    return out.fillna(defaults)


def order_wide(
    detail: DataFrame, info: DataFrame, activity: DataFrame, coupon: DataFrame, payment: DataFrame, refund: DataFrame
) -> DataFrame:
    """Order detail with header, activity, coupon, payment and newest refund.

    Inputs are change logs; each is first reduced to the newest row per key.
    """
    d = latest(detail, ["order_detail_id"], ["ts_ms"])
    i = latest(info, ["order_id"], ["ts_ms"]).drop("ts_ms")
    a = latest(activity, ["order_detail_id"], ["ts_ms"]).drop("ts_ms")
    c = latest(coupon, ["order_detail_id"], ["ts_ms"]).drop("ts_ms")
    p = latest(payment, ["order_id"], ["ts_ms"]).drop("ts_ms")
    r = latest_refund(refund)
    joined = (
        d.join(a, "order_detail_id", "left")
        .join(c, "order_detail_id", "left")
        .join(i, "order_id", "left")
        .join(p, "order_id", "left")
        .join(r, "order_id", "left")
    )
    return joined.withColumn("event_type", X.trade_event_type("refund_amount", "pay_amount")).withColumnRenamed("ts_ms", "ts")


def latest_refund(refund: DataFrame) -> DataFrame:
    return latest(refund, ["order_id"], ["refund_create_time", "refund_id"])


def item_dimension(sku: DataFrame, spu: DataFrame, category: DataFrame, trademark: DataFrame) -> DataFrame:
    """Items with all that hangs on them, so that facts look an item up once: a layer to be built when the catalog changes."""
    out = look_up(sku, spu, "spu_id", "id", "spu_")
    out = look_up(out, category, "category3_id", "id", "category3_")
    return look_up(out, trademark, "tm_id", "id", "tm_")


def enrich_orders(orders: DataFrame, item: DataFrame, user: DataFrame, province: DataFrame) -> DataFrame:
    """Lookups of item (``item_dimension``), user and province, fields prefixed ``dim_``; the item's own keys come without prefix too."""
    out = look_up(orders, item, "sku_id", "id", "dim_")
    for key in ("spu_id", "category3_id", "tm_id"):
        out = out.withColumn(key, F.col(f"dim_{key}"))
    out = look_up(out, user, "user_id", "id", "dim_user_")
    return look_up(out, province, "province_id", "id", "dim_province_")


def enrich_behaviour(behaviour: DataFrame, sku: DataFrame, user: DataFrame) -> DataFrame:
    """Behaviour events with item and user fields, unprefixed.

    The item key is the displayed item, else the item of the page; the user key comes from ``common``.
    """
    item = F.coalesce(F.col("display.item"), F.col("action.item"), F.col("page.item"))
    keyed = behaviour.withColumn("sku_id", item).withColumn("user_id", F.col("common.uid"))
    return look_up(look_up(keyed, sku, "sku_id", "id"), user, "user_id", "id")


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, before: str, after: str,
                  prefix: str = "info_") -> DataFrame:
    """Left rows with right rows whose time lies within [-before, +after] of theirs.

    On streams the bounds and both watermarks let state expire.
    """
    r = prefixed(right, prefix)
    lt, rt = F.col(left_ts), F.col(f"{prefix}{right_ts}")
    cond = (
        (F.col(key) == F.col(f"{prefix}{key}"))
        & (rt >= lt - F.expr(f"interval {before}"))
        & (rt <= lt + F.expr(f"interval {after}"))
    )
    return left.join(r, cond)


def interval_join_batch(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, before_s: int,
                        after_s: int, prefix: str = "info_") -> DataFrame:
    """The same result for tables, also when one key holds many rows.

    Time is cut into slots one interval wide; a left row meets the slots its
    interval touches (two at most), so a hot key is spread over its slots.
    """
    width = before_s + after_s + 1
    lsec, rsec = F.unix_micros(left_ts), F.unix_micros(right_ts)
    slot = lambda us: F.floor(us / F.lit(width * 1_000_000))
    lo, hi = lsec - before_s * 1_000_000, lsec + after_s * 1_000_000
    spread = left.withColumn("_slot", F.explode(F.sequence(slot(lo), slot(hi))))
    r = prefixed(right.withColumn("_slot", slot(rsec)), prefix, keep=("_slot",))
    lt, rt = F.unix_micros(left_ts), F.unix_micros(f"{prefix}{right_ts}")
    cond = (
        (spread["_slot"] == r["_slot"])
        & (F.col(key) == F.col(f"{prefix}{key}"))
        & (rt >= lt - before_s * 1_000_000)
        & (rt <= lt + after_s * 1_000_000)
    )
    return spread.join(r, cond).drop("_slot")


def activity_sku_wide(link: DataFrame, activity: DataFrame, rule: DataFrame, sku: DataFrame, category: DataFrame,
                      trademark: DataFrame) -> DataFrame:
    """Activity items with their activity, rules (if any), category path and trademark."""
    return (
        link.join(activity, "activity_id")
        .join(sku, "sku_id")
        .join(rule, "activity_id", "left")
        .join(category, "category3_id", "left")
        .join(trademark, "tm_id", "left")
    )


def sensitive_words(comments: DataFrame, words: DataFrame, text: str = "text") -> DataFrame:
    """Violation flag, grade and word, from the last comma-separated word of a text."""
    hits = words.select(F.col("word").alias("_word")).distinct()
    last = X.last_part(text)
    out = comments.withColumn("_last", last).join(hits, F.col("_last") == F.col("_word"), "left")
    found = F.col("_word").isNotNull()
    return (
        out.withColumn("is_violation", found.cast("int"))
        .withColumn("violation_grade", F.when(found, "P0").otherwise(""))
        .withColumn("violation_msg", F.when(found, F.col("_last")).otherwise(""))
        .drop("_last", "_word")
    )


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The target plus the rows whose keys it lacks."""
    return target.unionByName(rows.join(target.select(*keys), keys, "left_anti"))


def search_attribution(page_log: DataFrame, day: str | None = None) -> DataFrame:
    """Item views per keyword searched by the same user on the same day.

    Views and keyword pages are counted per (user, day) first, so a busy user
    meets counts, not rows times rows.
    """
    log = page_log if day is None else page_log.where(F.col("dt") == day)
    views = log.where(F.col("item_type") == "sku_id").groupBy("uid", "dt", F.col("item").alias("sku_id")).agg(
        F.count(F.lit(1)).alias("views")
    )
    words = log.where((F.col("item_type") == "keyword") & (F.col("last_page_id") == "search")).groupBy(
        "uid", "dt", F.col("item").alias("keyword")
    ).agg(F.count(F.lit(1)).alias("searches"))
    return views.join(words, ["uid", "dt"]).groupBy("sku_id", "keyword").agg(
        F.sum(F.col("views") * F.col("searches")).alias("num")
    )
