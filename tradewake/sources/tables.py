"""Warehouse-shaped inputs derived from the star-schema test tables.

Every method is a lazy DataFrame over whole tables; nothing is collected.
Orders keep their real customers, lines and amounts, but their days are folded
onto 2024-01-01 .. 2024-02-29 so that trade and behaviour share a calendar.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.session import freed, fresh_path

AS_OF = "2024-01-31"
FIRST_DAY = "2024-01-01"
FIRST_SECOND = 1_704_067_200
TRADE_DAYS = 60
MONEY = "decimal(18,2)"

PAGES = ["home", "search", "good_list", "good_detail", "cart", "trade", "payment", "comment", "spec", "mine"]
LOG_TYPES = {"signup": "start", "view": "page", "click": "action", "error": "err", "purchase": "payment"}
TERMINALS = ["PC", "Wireless", "App"]
METHODS = ["ALIPAY", "WECHAT", "CCB", "OTHER"]
STAGES = ["DEPOSIT", "FINAL", "ALL"]
SOURCES = ["organic", "ads", "referral", "direct"]
ACTIONS = ["favor_add", "cart_add", "get_coupon"]
DISPLAYS = ["activity", "promotion", "recommend"]


def pick(values: list[str], position) -> F.Column:
    """The element at a 0-based position."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position + 1).cast("int"))


_READS: dict[tuple[str, str], DataFrame] = {}


class Tables:
    """The test tables of one scale-factor folder and the views built on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._stored: dict[str, DataFrame] = {}
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        """The table; its schema is looked up once per application."""
        key = (self.spark.sparkContext.applicationId, self.path(name))
        if key not in _READS:
            _READS[key] = self.spark.read.parquet(self.path(name))
        return _READS[key]

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A layer table written once to the shared folder; later steps read it instead of recomputing it."""
        if name not in self._stored:
            path = fresh_path(self.spark, name)
            with freed(self.spark):
                build().write.option("compression", "zstd").parquet(path)
            self._stored[name] = self.spark.read.parquet(path)
        return self._stored[name]

    def stream(self, name: str, files_per_trigger: int = 1) -> DataFrame:
        """The same table as a file stream."""
        return (
            self.spark.readStream.schema(self.read(name).schema)
            .option("pathGlobFilter", f"{name}.parquet")
            .option("maxFilesPerTrigger", files_per_trigger)
            .parquet(self.folder)
        )

    # ---- behaviour log -------------------------------------------------

    @cached_property
    def log(self) -> DataFrame:
        return log_view(self.read("events"))

    @cached_property
    def log_text(self) -> DataFrame:
        return log_text_view(self.log)

    @cached_property
    def page_log(self) -> DataFrame:
        """Typed page records: everything but start records."""
        return self.log.where(F.col("log_type") != "start")

    # ---- behaviour facts ----------------------------------------------

    @cached_property
    def visit(self) -> DataFrame:
        return self.log.where(F.col("event_type") == "view").select(
            F.col("event_id").alias("log_id"),
            "user_id",
            "session_id",
            "product_id",
            F.floor("value").alias("dwell_seconds"),
            pick(TERMINALS, F.col("event_id") % 3).alias("terminal"),
            F.col("page_id").alias("entry_page"),
            F.col("last_page_id").alias("referrer_page"),
            F.col("os").alias("device_type"),
            F.col("ar").alias("region"),
            F.col("ts").alias("event_time"),
            "dt",
        )

    @cached_property
    def cart(self) -> DataFrame:
        return self.log.where(F.col("event_type") == "click").select(
            F.col("event_id").alias("log_id"),
            "user_id",
            "session_id",
            "product_id",
            (F.col("k") % 5 + 1).alias("quantity"),
            F.when(F.col("k") % 4 == 0, "REMOVE").otherwise("ADD").alias("action_type"),
            F.col("ts").alias("action_time"),
            "dt",
        )

    @cached_property
    def fav(self) -> DataFrame:
        return self.log.where(F.col("event_type") == "signup").select(
            F.col("event_id").alias("log_id"),
            "user_id",
            "product_id",
            F.when(F.col("k") % 5 == 0, "REMOVE").otherwise("ADD").alias("action_type"),
            F.col("ts").alias("fav_time"),
            "dt",
        )

    @cached_property
    def micro(self) -> DataFrame:
        return self.log.where(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("log_id"),
            "user_id",
            "session_id",
            "product_id",
            F.floor("value").alias("duration_sec"),
            pick(TERMINALS, F.col("event_id") % 3).alias("terminal"),
            F.col("ts").alias("event_time"),
            "dt",
        )

    @cached_property
    def search(self) -> DataFrame:
        return self.log.where(F.col("event_type") == "error").select(
            F.col("event_id").alias("log_id"),
            "user_id",
            "session_id",
            F.concat(F.lit("kw"), (F.col("k") % 10).cast("string")).alias("search_keyword"),
            F.col("k").alias("result_count"),
            F.when(F.col("k") % 2 == 0, F.col("product_id")).alias("clicked_product_id"),
            F.col("ts").alias("search_time"),
            "dt",
        )

    @cached_property
    def traffic_source(self) -> DataFrame:
        return self.log.where(F.col("event_type") == "signup").select(
            F.col("event_id").alias("log_id"),
            "session_id",
            "user_id",
            pick(SOURCES, F.col("k") % 4).alias("source_type"),
            F.col("ts").alias("visit_time"),
            "dt",
        )

    @cached_property
    def page_stay(self) -> DataFrame:
        return self.log.where(F.col("event_type") == "view").select(
            F.col("event_id").alias("log_id"),
            "session_id",
            "product_id",
            F.when(F.col("k") % 2 == 0, "PRODUCT_DETAIL").otherwise("LIST").alias("page_type"),
            F.col("ts").alias("entry_time"),
            F.col("value").cast("decimal(10,2)").alias("stay_seconds"),
            F.when(F.col("last_page_id").isNull(), 1).otherwise(0).alias("is_bounce"),
            "dt",
        )

    # ---- trade facts ---------------------------------------------------

    @cached_property
    def order_info(self) -> DataFrame:
        return order_info_view(self.read("orders"))

    @cached_property
    def order_item(self) -> DataFrame:
        """Order line with the header's user, status and times."""
        return line_view(self.line_heads)

    @cached_property
    def line_heads(self) -> DataFrame:
        """Order lines beside their headers, columns as they are in the tables; what follows from them is left to ``line_view``."""
        head = self.order_info.select("order_id", "user_id", "status", "order_time", "pay_time", "dt")
        line = self.read("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").cast("bigint").alias("line_no"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.col("l_extendedprice").cast(MONEY).alias("amount"),
            "l_returnflag",
        )
        return line.join(head, "order_id")

    def share_lines(self) -> None:
        """From now on order lines with their heads are a stored layer, for queries that read them as orders, payments and refunds."""
        heads = self.stored("order_item", lambda: self.line_heads)
        self.__dict__["order_item"] = line_view(heads)

    @cached_property
    def payment(self) -> DataFrame:
        o = F.col("order_id")
        return self.order_item.where(F.col("status").isin("PAID", "REFUNDED")).select(
            F.col("detail_id").alias("payment_id"),
            "order_id",
            "product_id",
            "sku_id",
            "shop_id",
            "user_id",
            "quantity",
            F.col("amount").alias("payment_amount"),
            pick(METHODS, o % 4).alias("payment_method"),
            F.when(o % 2 == 0, 1).otherwise(0).alias("is_presale"),
            pick(STAGES, o % 3).alias("presale_stage"),
            F.when(o % 7 == 0, 1).otherwise(0).alias("is_group_buy"),
            "status",
            F.col("pay_time").alias("payment_time"),
            F.col("dt"),
        )

    @cached_property
    def refund(self) -> DataFrame:
        return self.order_item.where((F.col("status") == "REFUNDED") & (F.col("l_returnflag") == "R")).select(
            F.col("detail_id").alias("refund_id"),
            F.col("detail_id").alias("payment_id"),
            "order_id",
            "product_id",
            "shop_id",
            "user_id",
            F.col("amount").alias("refund_amount"),
            (F.col("order_time") + F.expr("interval 3 days")).alias("refund_time"),
            X.day_text(F.col("order_time") + F.expr("interval 3 days")).alias("dt"),
        )

    @cached_property
    def price_change(self) -> DataFrame:
        cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
        p, i = F.col("p_partkey"), F.col("i")
        new_cents = F.floor(cents * (100 - (p * 7 + i * 3) % 20) / 100)
        day = F.date_add(F.lit(FIRST_DAY).cast("date"), ((p + i * 11) % 30).cast("int"))
        return (
            self.read("part")
            .select("p_partkey", "p_retailprice", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("i"))
            .select(
                (p * 3 + i).alias("change_id"),
                p.alias("product_id"),
                (cents.cast(MONEY) / 100).cast(MONEY).alias("old_price"),
                (new_cents.cast(MONEY) / 100).cast(MONEY).alias("new_price"),
                day.cast("timestamp").alias("change_time"),
                X.day_text(day).alias("dt"),
            )
        )

    @cached_property
    def inventory(self) -> DataFrame:
        return self.read("lineitem").select(
            (F.col("l_partkey") * 10 + F.col("l_linenumber") % 3).alias("sku_id"),
            F.col("l_quantity").cast("bigint").alias("inventory_qty"),
            F.col("l_shipdate").cast("timestamp").alias("snapshot_time"),
            F.col("l_orderkey").alias("snapshot_id"),
        )

    @cached_property
    def coupon(self) -> DataFrame:
        return self.order_info.select(
            F.col("order_id").alias("log_id"),
            (F.col("order_id") % 50).alias("coupon_id"),
            "user_id",
            "order_id",
            F.col("order_time").alias("issue_time"),
            (F.col("pay_time") + F.expr("interval 1 day")).alias("use_time"),
            (F.col("amount") / 100).cast(MONEY).alias("discount_amount"),
        )

    # ---- dimensions ----------------------------------------------------

    @cached_property
    def dim_item(self) -> DataFrame:
        cents = (F.round(F.col("p_retailprice") * 100).cast("bigint") - 90_000) * 3
        return self.read("part").select(
            F.col("p_partkey").alias("item_id"),
            F.col("p_name").alias("item_name"),
            F.col("p_size").cast("bigint").alias("category_id"),
            F.col("p_type").alias("category_name"),
            F.regexp_extract("p_brand", "(\\d+)$", 1).cast("bigint").alias("brand_id"),
            F.col("p_brand").alias("brand_name"),
            (F.col("p_size") % 3).cast("bigint").alias("first_cat_id"),
            (F.col("p_size") % 10).cast("bigint").alias("second_cat_id"),
            F.col("p_size").cast("bigint").alias("third_cat_id"),
            (cents.cast(MONEY) / 100).cast(MONEY).alias("price"),
        )

    @cached_property
    def dim_category(self) -> DataFrame:
        return (
            self.read("part")
            .select(F.col("p_size").cast("bigint").alias("category_id"))
            .distinct()
            .select(
                "category_id",
                F.concat(F.lit("Category "), F.col("category_id").cast("string")).alias("category_name"),
                F.lit(2).alias("level"),
            )
        )

    @cached_property
    def dim_user(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.read("customer").select(
            c.alias("user_id"),
            F.col("c_name").alias("user_name"),
            F.col("c_mktsegment").alias("user_level"),
            F.col("c_nationkey").cast("bigint").alias("province_id"),
            F.when(c % 4 != 0, F.date_add(F.lit("2022-06-01").cast("date"), (c % 900).cast("int"))).alias(
                "last_payment_date"
            ),
        )

    @cached_property
    def dim_shop(self) -> DataFrame:
        return self.read("supplier").select(
            F.col("s_suppkey").alias("shop_id"),
            F.col("s_name").alias("shop_name"),
            F.col("s_nationkey").cast("bigint").alias("province_id"),
        )

    @cached_property
    def dim_province(self) -> DataFrame:
        return self.read("nation").select(
            F.col("n_nationkey").cast("bigint").alias("province_id"),
            F.col("n_name").alias("province_name"),
            F.col("n_regionkey").cast("bigint").alias("region_id"),
        )

    @cached_property
    def dim_region(self) -> DataFrame:
        return self.read("region").select(
            F.col("r_regionkey").cast("bigint").alias("region_id"), F.col("r_name").alias("region_name")
        )

    # ---- change envelopes ----------------------------------------------

    @cached_property
    def cdc_text(self) -> DataFrame:
        """Envelopes of five source tables as JSON text, with the source position."""
        return cdc_view(self)


def log_view(events: DataFrame) -> DataFrame:
    """Typed behaviour log; works on a batch or a streaming ``events`` frame."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    event, user = F.col("event_id"), F.col("user_id")
    base = events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.col("ts").cast("timestamp").alias("ts"),
        k.alias("k"),
    )
    k = F.col("k")
    return base.select(
        "*",
        F.unix_millis("ts").alias("ts_ms"),
        X.day_text("ts").alias("dt"),
        X.lookup(F.col("event_type"), LOG_TYPES).alias("log_type"),
        user.cast("string").alias("uid"),
        F.concat(F.lit("mid_"), user.cast("string")).alias("mid"),
        F.concat(F.lit("s_"), user.cast("string"), F.lit("_"), X.day_text("ts")).alias("session_id"),
        pick(PAGES, k % 10).alias("page_id"),
        F.when(event % 6 != 0, pick(PAGES, F.floor(event / 10) % 10)).alias("last_page_id"),
        (event % 200).alias("product_id"),
        F.when(k % 4 == 0, F.concat(F.lit("kw"), (k % 10).cast("string")))
        .otherwise((event % 200).cast("string"))
        .alias("item"),
        F.when(k % 4 == 0, "keyword").otherwise("sku_id").alias("item_type"),
        F.round(F.col("value") * 1000).cast("bigint").alias("during_time"),
        F.when(k % 11 != 0, F.concat(F.lit("ch"), (k % 5).cast("string"))).alias("ch"),
        F.concat(F.lit("ar"), (user % 25).cast("string")).alias("ar"),
        F.concat(F.lit("v"), (k % 3).cast("string")).alias("vc"),
        (user % 2).cast("string").alias("is_new"),
        F.concat(F.lit("brand"), (user % 7).cast("string")).alias("ba"),
        F.concat(F.lit("md"), (user % 9).cast("string")).alias("md"),
        F.when(user % 3 == 0, "iOS").otherwise("Android").alias("os"),
    )


def display_list(event, k):
    """k % 3 displays of one record."""
    return F.transform(
        F.slice(F.array(F.lit(0), F.lit(1)), F.lit(1), (k % 3).cast("int")),
        lambda i: F.struct(
            pick(DISPLAYS, (k + i) % 3).alias("display_type"),
            ((event * 7 + i * 13) % 200).cast("string").alias("item"),
            F.lit("sku_id").alias("item_type"),
            (i + 1).cast("bigint").alias("order"),
            ((k + i) % 5).cast("bigint").alias("pos_id"),
        ),
    )


def action_list(event, k, ts_ms):
    """One or two actions of one record, 100 ms apart."""
    return F.transform(
        F.slice(F.array(F.lit(0), F.lit(1)), F.lit(1), (k % 2 + 1).cast("int")),
        lambda i: F.struct(
            pick(ACTIONS, (k + i) % 3).alias("action_id"),
            ((event * 11 + i * 17) % 200).cast("string").alias("item"),
            F.lit("sku_id").alias("item_type"),
            (ts_ms + i * 100).cast("bigint").alias("ts"),
        ),
    )


def log_text_view(log: DataFrame, *more: str) -> DataFrame:
    """One JSON line per event; every 97th line is cut short. ``more`` columns of the log come along."""
    kind, k, event = F.col("log_type"), F.col("k"), F.col("event_id")
    common = F.struct("ar", "ba", "ch", "is_new", "md", "mid", "os", "uid", "vc", F.col("session_id").alias("sid"))
    page = F.struct(
        "page_id", "last_page_id", "item", "item_type", "during_time", F.lit("promotion").alias("source_type")
    )
    start = F.struct(
        pick(["icon", "notice", "install"], k % 3).alias("entry"),
        (k * 10).alias("loading_time"),
        (k % 20).cast("string").alias("open_ad_id"),
        (k * 100).alias("open_ad_ms"),
        F.when(k % 2 == 0, k * 50).alias("open_ad_skip_ms"),
    )
    err = F.struct((1000 + k).cast("string").alias("error_code"))
    body = F.struct(
        common.alias("common"),
        F.when(kind != "start", page).alias("page"),
        F.when(kind.isin("page", "err"), display_list(event, k)).alias("displays"),
        F.when(kind.isin("action", "err"), action_list(event, k, F.col("ts_ms"))).alias("actions"),
        F.when(kind == "start", start).alias("start"),
        F.when((kind == "err") | ((kind == "start") & (k % 10 == 0)), err).alias("err"),
        F.col("ts_ms").alias("ts"),
    )
    broken = F.concat(F.lit('{"common": '), event.cast("string"))
    return log.select(
        *more,
        "event_id",
        "ts",
        F.concat(F.lit("topic_"), kind).alias("topic"),
        (event % 4).alias("partition"),
        F.floor(event / 4).alias("offset"),
        "dt",
        F.when(event % 97 == 0, broken).otherwise(F.to_json(body)).alias("value"),
    )


def order_info_view(orders: DataFrame) -> DataFrame:
    o = F.col("o_orderkey")
    day = F.pmod(F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")), F.lit(TRADE_DAYS))
    second = F.lit(FIRST_SECOND) + day.cast("bigint") * 86_400 + (o * 37) % 86_400
    status = F.when(F.col("o_orderstatus") == "F", "PAID").when(F.col("o_orderstatus") == "O", "CREATED").otherwise("REFUNDED")
    order_time = F.timestamp_seconds(second)
    return orders.select(
        o.alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        (F.col("o_custkey") % 25).alias("province_id"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        status.alias("status"),
        order_time.alias("order_time"),
        F.when(status != "CREATED", order_time + F.expr("interval 10 minutes")).alias("pay_time"),
        X.day_text(order_time).alias("dt"),
    )


def line_view(lines: DataFrame) -> DataFrame:
    o, n, p = F.col("order_id"), F.col("line_no"), F.col("product_id")
    return lines.select(
        "order_id", "line_no", (o * 10 + n).alias("detail_id"), "product_id", (p * 10 + n % 3).alias("sku_id"), (p % 10 + 1).alias("shop_id"),
        "quantity", "amount", "l_returnflag", "user_id", "status", "order_time", "pay_time", "dt",
    )


def cdc_view(t: Tables) -> DataFrame:
    def text(c):
        return c.cast("string")

    def envelope(df: DataFrame, table: str, key, ts_ms, fields: dict) -> DataFrame:
        op = pick(["r", "c", "u", "d"], key % 4)
        image = F.struct(*[text(v).alias(k) for k, v in fields.items()])
        return df.select(
            F.lit(table).alias("source_table"),
            key.alias("position"),
            F.to_json(
                F.struct(
                    op.alias("op"),
                    F.when(op.isin("u", "d"), image).alias("before"),
                    F.when(op != "d", image).alias("after"),
                    F.struct(F.lit(table).alias("table"), F.when(op == "r", "true").otherwise("false").alias("snapshot")).alias(
                        "source"
                    ),
                    ts_ms.alias("ts_ms"),
                )
            ).alias("value"),
        )

    c = F.col
    info = t.order_info
    millis = F.unix_millis("order_time")
    pay = info.where(c("status") != "CREATED")
    parts = [
        envelope(
            info, "order_info", c("order_id"), millis,
            {"id": c("order_id"), "user_id": c("user_id"), "sku_id": c("order_id") % 100, "province_id": c("province_id"),
             "total_amount": c("amount"), "order_status": c("status"), "create_time": millis},
        ),
        envelope(
            pay, "payment_info", c("order_id"), F.unix_millis("pay_time"),
            {"id": c("order_id") + 1_000_000, "order_id": c("order_id"), "user_id": c("user_id"), "total_amount": c("amount"),
             "payment_type": c("order_id") % 4 + 1101, "payment_time": F.unix_millis("pay_time")},
        ),
        envelope(
            info.where(c("status") == "REFUNDED"), "refund_info", c("order_id") + 1, F.unix_millis("pay_time"),
            {"id": c("order_id") + 2_000_000, "order_id": c("order_id"), "user_id": c("user_id"),
             "refund_amount": c("amount"), "refund_type": c("order_id") % 3 + 1501, "refund_time": F.unix_millis("pay_time")},
        ),
        envelope(
            t.dim_user, "user_info", c("user_id"), c("user_id") * 1000 + FIRST_SECOND * 1000,
            {"id": c("user_id"), "login_name": c("user_name"), "user_level": c("user_level")},
        ),
        envelope(
            t.dim_item, "sku_info", c("item_id"), c("item_id") * 1000 + FIRST_SECOND * 1000,
            {"id": c("item_id"), "sku_name": c("item_name"), "price": c("price"), "tm_id": c("brand_id"),
             "category3_id": c("category_id")},
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
