"""Session settings and the shared folder for checkpoints and tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", app: str = "tradewake", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own settings."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, one below the session's warehouse folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_layers"
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Where set, Spark removes the shuffle files of a run when the run ends; otherwise when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Inside, every run that ends (a write, a count) gives back its shuffle files; the setting is taken back afterwards."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def store(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps neither recompute it nor need its executors or its shuffles."""
    path = fresh_path(df.sparkSession, name)
    with freed(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(df_path: str, spark: SparkSession) -> None:
    """Deletes a layer that this library wrote and no plan reads any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(*layers: DataFrame) -> None:
    """Deletes layers made by ``store`` that no plan still to run reads."""
    for layer in layers:
        for folder in {re.sub(r"/[^/]*=[^/]*(?=/|$)", "", f.rsplit("/", 1)[0]) for f in layer.inputFiles()}:
            remove(folder, layer.sparkSession)
