"""Readers: topics, typed JSON, delimited files, raw lines, database queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewake.functions import exprs as X
from tradewake.sources import schemas as S


def topic(spark: SparkSession, servers: str, name: str, start: str = "earliest", max_rows: int | None = None) -> DataFrame:
    """A Kafka topic as a text stream with its position; needs the Kafka connector on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", name)
        .option("startingOffsets", start)
    )
    if max_rows:
        reader = reader.option("maxOffsetsPerTrigger", max_rows)
    return reader.load().select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")


def text_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Files of lines as the same kind of stream."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def first_line(spark: SparkSession, path: str) -> DataFrame:
    """The first line of a file, or of the first file by name of a folder; empty files are passed over.

    Names and lengths are listed without reading the files, and only the first split of the first file is read: the order in which Spark
    takes splits goes by their size and says nothing about the order of lines.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    first = listed.where(F.col("length") > 0).agg(F.min("path")).first()[0]
    if first is None:
        return spark.createDataFrame([], "value string")
    return spark.read.text(first).where(F.col("_metadata.file_block_start") == 0).select("value").limit(1)


def delimited(spark: SparkSession, path: str, schema: str, sep: str = "\t") -> DataFrame:
    return spark.read.csv(path, schema=schema, sep=sep)


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines below ``dt=...`` folders; the day stays text."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.date_format(F.col("dt").cast("date"), "yyyy-MM-dd").alias("dt"))


def database(spark: SparkSession, url: str, query: str, options: dict[str, str] | None = None) -> DataFrame:
    """A query's rows with lowerCamel column names. Pass partitionColumn, bounds and numPartitions to read in parallel."""
    return camel_columns(spark.read.format("jdbc").options(url=url, query=query, **(options or {})).load())


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[X.camel_name(c) for c in df.columns])


def json_paths(df: DataFrame, fields: dict[str, str], text: str = "value") -> DataFrame:
    """Named JSON fields cast to their types; a value that does not fit becomes null."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    rows = df.withColumn("_j", F.explode(F.array(F.from_json(text, schema))))
    return rows.where(F.col("_j").isNotNull()).select(*[F.col(f"_j.`{f}`").try_cast(t).alias(f) for f, t in fields.items()])


def telemetry(df: DataFrame, text: str = "value") -> DataFrame:
    return json_paths(df, S.TELEMETRY, text)
