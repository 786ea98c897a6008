"""A training corpus from ``documents``: toxicity, line dedup, near-duplicate join, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All stages but the last return the
columns of ``documents``; n_chars follows the text. Rows with a null doc_id pass the filters, as no row can be told from
another by them; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewake.llm import decontaminate, line_dedup, packing, shingle_join, toxicity
from tradewake.llm.frames import column
from tradewake.llm.queries import TOXIC, table
from tradewake.session import fresh_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    models = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, models, to="_score").where(F.col("_score") < TOXIC).select(*map(column, docs.columns))


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more that three documents hold stay in the one of largest id."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*map(column, docs.columns))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at 75 % shared shingles, the one of smallest id."""
    groups = shingle_join.similar_groups(docs)
    copies = groups.where("id != component_id").select(F.col("id").alias("_copy")).distinct()
    return docs.join(copies, F.col("doc_id") == F.col("_copy"), "left_anti")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than 75 % of the shingles of every benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 ids."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_shared_lines),
    ("near-duplicate join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL cannot express the trained scores of the first stage or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each result is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = fresh_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
