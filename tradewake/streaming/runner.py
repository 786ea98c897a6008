"""Runs a streaming frame over all available input and returns what it wrote."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from tradewake.session import freed, fresh_path, remove
from tradewake.sources.writers import KeyedTable


def start(df: DataFrame, name: str, mode: str = "append", fmt: str = "parquet", partition_by: Sequence[str] = (),
          path: str | None = None, checkpoint: str | None = None):
    """Starts the query with its output and checkpoint in the shared folder."""
    spark = df.sparkSession
    path = path or fresh_path(spark, name)
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint or f"{path}-checkpoint").trigger(availableNow=True)
    return writer.format(fmt).partitionBy(*partition_by).start(path), path


def to_table(df: DataFrame, name: str, mode: str = "append", fmt: str = "parquet", partition_by: Sequence[str] = ()) -> DataFrame:
    """All available input through a file sink (exactly once), read back."""
    spark = df.sparkSession
    query, path = start(df, name, mode, fmt, partition_by)
    query.awaitTermination()
    reader = spark.read.format(fmt)
    if fmt == "parquet":
        reader = reader.schema(df.schema)
    return reader.load(path)


def each_batch(df: DataFrame, name: str, write: Callable[[DataFrame, int], None], mode: str = "update", checkpoint: str | None = None,
               tables: Sequence[KeyedTable] = (), fold_every: int = 8) -> int:
    """Runs ``write`` on every micro-batch of the available input; returns the last batch id.

    ``tables`` are keyed tables that ``write`` upserts into: at the end of a batch each one with ``fold_every`` deltas is folded.
    """
    spark = df.sparkSession
    checkpoint = checkpoint or fresh_path(spark, f"{name}-checkpoint")

    def run(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        for table in tables:
            table.fold(batch.sparkSession, batch_id, fold_every)

    query = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(run).start()
    query.awaitTermination()
    progress = query.lastProgress
    return progress["batchId"] if progress else -1


def arriving(spark: SparkSession, parts: Sequence[DataFrame], name: str, run: Callable[[DataFrame, str], object], keep: bool = True) -> DataFrame | None:
    """Lets ``parts`` arrive one after another: each is added to a folder, and ``run`` gets the folder as a stream with a
    checkpoint that all of its runs share, so every part is taken as new input. Returns all that has arrived; without
    ``keep``, the files of a part are removed when ``run`` has taken them."""
    path, checkpoint = fresh_path(spark, name), fresh_path(spark, f"{name}-checkpoint")
    schema = StructType([StructField(f.name, f.dataType) for f in parts[0].schema.fields])
    for part in parts:
        with freed(spark):
            part.write.mode("append").option("compression", "zstd").parquet(path)
        run(spark.readStream.schema(schema).parquet(path), checkpoint)
        if not keep:
            for file in spark.read.schema(schema).parquet(path).inputFiles():
                remove(file, spark)
    return spark.read.schema(schema).parquet(path) if keep else None


def dropped_rows(query) -> int:
    """Rows, or partial aggregates of them, that the stateful operators of a query dropped as too late; from its recent progress."""
    return sum(op["numRowsDroppedByWatermark"] for progress in query.recentProgress for op in progress["stateOperators"])
