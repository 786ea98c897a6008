"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.llm.frames import fresh_path, remove

SALTS = 8


def _smallest(edges: DataFrame) -> DataFrame:
    """(a, b) both ways -> (b, smallest neighbour of a or a itself), a hub's neighbours spread over SALTS tasks."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int")).join(salted, ["a", "salt"])


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links between long ids -> (node, component): the smallest id reachable, one row for each node of a link.

    Self links and repeated links are allowed, null ends are ignored, an empty frame gives an empty result. Every step is
    a grouping and a join written to the shared folder; neither links nor nodes pass through the driver. The number of
    steps grows with the logarithm of the longest path.
    """
    spark = edges.sparkSession
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a != b").selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct()
    seen, path = None, None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _smallest(both).where("b > a").selectExpr("least(b, m) AS a", "greatest(b, m) AS b").where("a != b").distinct()
        # small star: from the larger end of each link to its smaller neighbours
        down = large.select(F.col("b").alias("a"), F.col("a").alias("b"))
        small = _smallest(down).where("b != m").selectExpr("m AS a", "b")
        kept = down.groupBy("a").agg(F.min("b").alias("m")).selectExpr("m AS a", "a AS b")
        step = small.union(kept).distinct()
        older, path = path, fresh_path(spark, "components")
        step.write.parquet(path)
        edges = spark.read.schema("a long, b long").parquet(path)
        if older:
            remove(older, spark)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == seen:
            break
        seen = now
    return edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component")).union(edges.select("a", "a").distinct())
