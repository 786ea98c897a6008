"""Dimension tables: copies, trees, calendars, distinct lists, versioned rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators.positions import matched
from tradewake.session import store

OPEN_END = "9999-12-31"


def as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns])


def sync_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns of rows whose first column is present."""
    return df.select(*columns).where(F.col(columns[0]).isNotNull())


def distinct_labelled(df: DataFrame, column: str, label: Column, name: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().withColumn(name, label)


def grouped_rows(df: DataFrame, key: str, row_id: str, columns: list[str], chunk: int = 1000) -> DataFrame:
    """Key -> lists of its rows.

    A list holds the rows of one range of ``chunk`` row ids, so a key with many
    rows gives several lists of bounded size and none is cut off.
    """
    return (
        df.withColumn("chunk", F.floor(F.col(row_id) / chunk))
        .groupBy(key, "chunk")
        .agg(F.sort_array(F.collect_list(F.struct(row_id, *[c for c in columns if c != row_id]))).alias("rows"))
    )


def terminals(facts: list[DataFrame]) -> DataFrame:
    """Terminals seen in any of the facts, with name and device type."""
    seen = reduce(DataFrame.unionByName, [f.select("terminal") for f in facts]).distinct()
    # fixed values: labels
    name = F.when(F.col("terminal") == "PC", "电脑端").when(F.col("terminal") == "Wireless", "无线端").when(
        F.col("terminal") == "App", "应用端").otherwise(F.col("terminal"))
    return seen.select("terminal", name.alias("terminal_name"), X.device_type("terminal").alias("device_type"))


def category_tree(product: DataFrame) -> DataFrame:
    """Categories from three id columns: deepest level per id, path as name, parent."""
    a, b, c = (F.col(x).cast("string") for x in ("first_cat_id", "second_cat_id", "third_cat_id"))
    entries = F.array(
        F.struct(F.col("first_cat_id").alias("id"), F.lit(1).alias("level"), a.alias("name"),
                 F.lit(None).cast("bigint").alias("parent_id")),
        F.struct(F.col("second_cat_id").alias("id"), F.lit(2).alias("level"), F.concat(a, F.lit(" > "), b).alias("name"),
                 F.col("first_cat_id").alias("parent_id")),
        F.struct(F.col("third_cat_id").alias("id"), F.lit(3).alias("level"),
                 F.concat(a, F.lit(" > "), b, F.lit(" > "), c).alias("name"), F.col("second_cat_id").alias("parent_id")),
    )
    rows = product.select(F.explode(entries).alias("e")).select("e.*").where(F.col("id").isNotNull())
    per_level = rows.groupBy("id", "level").agg(F.min(F.struct("name", "parent_id")).alias("best"))
    deepest = per_level.groupBy("id").agg(F.max(F.struct("level", "best")).alias("top"))
    return deepest.select(
        F.col("id").alias("category_id"), F.col("top.level").alias("category_level"),
        F.col("top.best.name").alias("category_name"), F.col("top.best.parent_id").alias("parent_id"),
    )


def category_path(c3: DataFrame, c2: DataFrame, c1: DataFrame) -> DataFrame:
    """Third-level categories with the names of their second and first levels."""
    return c3.join(c2, "category2_id", "left").join(c1, "category1_id", "left")


def sku_snowflake(sku: DataFrame, spu: DataFrame, path: DataFrame, keywords: DataFrame, buyers: DataFrame) -> DataFrame:
    """Item with product, category path, a row for each hot keyword, and the number of its buyers.

    Buyers are counted before they meet the keywords: a row for each pair of
    the two would say nothing more. Keywords hang on the category paths.
    """
    counted = buyers.where(F.col("user_id").isNotNull()).groupBy("sku_id", "user_id").agg(F.lit(1).alias("_one"))
    counted = counted.groupBy("sku_id").agg(F.count("*").alias("buyer_count"))
    worded = path.join(keywords, "category1_id", "left")
    out = sku.join(spu, "spu_id", "left").join(worded, "category3_id", "left").join(counted, "sku_id", "left")
    return out.withColumn("buyer_count", X.zero("buyer_count"))


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """All days between two dates, with their parts."""
    day = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return date_parts(spark.range(1).select(day.alias("day")), "day")


def date_parts(df: DataFrame, day: str) -> DataFrame:
    d = F.col(day)
    return (
        df.withColumn("date_key", X.date_key(d))
        .withColumn("day_of_month", F.dayofmonth(d))
        .withColumn("month", F.month(d))
        .withColumn("year", F.year(d))
        .withColumn("week_of_year", F.weekofyear(d))
        .withColumn("quarter", F.quarter(d))
        .withColumn("day_name", F.date_format(d, "EEEE"))
        .withColumn("is_weekend", F.dayofweek(d).isin(1, 7).cast("int"))
    )


# ---- versioned dimensions --------------------------------------------------


def surrogate_keys(df: DataFrame, natural: str, name: str) -> DataFrame:
    """Dense keys 1..n in the order of the natural key, null keys first.

    Rows are dealt out by ranges of the key and stored with their part. Parts
    are numbered side by side and shifted by the rows of the parts before
    them; there are as many parts as shuffle partitions, whatever the rows.
    """
    parts = store(df.repartitionByRange(natural).withColumn("_part", F.spark_partition_id()), "keyed")
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    shift = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(W.partitionBy("_part").orderBy(natural))
    return (
        parts.withColumn("_inside", inside)
        .join(sizes.select("_part", shift.alias("_shift")), "_part")
        .select((F.col("_inside") + F.col("_shift")).alias(name), *df.columns)
    )


def initial_versions(df: DataFrame, natural: str, surrogate: str, as_of: str) -> DataFrame:
    """First load of a versioned dimension: every row current and open-ended."""
    return (
        surrogate_keys(df, natural, surrogate)
        .withColumn("effective_date", F.lit(as_of).cast("date"))
        .withColumn("end_date", F.lit(OPEN_END).cast("date"))
        .withColumn("current_flag", F.lit("Y"))
    )


def next_versions(dim: DataFrame, rows: DataFrame, natural: str, surrogate: str, tracked: list[str], as_of: str) -> DataFrame:
    """The dimension after a later load: changed rows closed and reopened, new ones added."""
    stamp = F.lit(as_of).cast("date")
    old = dim.where(F.col("current_flag") == "Y").select(natural, F.struct(*tracked).alias("_old"))
    marked = matched(rows, old, [natural], "left")
    same = F.col("_old").isNotNull()
    for c in tracked:
        same &= F.col(c).eqNullSafe(F.col("_old")[c])
    changed = store(marked.where(~same).drop("_old"), "changed")
    kept = matched(dim, changed.select(natural).withColumn("_close", F.lit(True)), [natural], "left")
    closes = F.col("_close").isNotNull() & (F.col("current_flag") == "Y")
    kept = (
        kept.withColumn("end_date", F.when(closes, F.date_sub(stamp, 1)).otherwise(F.col("end_date")))
        .withColumn("current_flag", F.when(closes, "N").otherwise(F.col("current_flag")))
        .select(*dim.columns)
    )
    top = dim.select(F.max(surrogate).alias("top")).scalar()
    opened = initial_versions(changed, natural, surrogate, as_of).withColumn(
        surrogate, F.col(surrogate) + F.coalesce(top, F.lit(0))
    )
    return kept.unionByName(opened.select(*dim.columns))
