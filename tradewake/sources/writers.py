"""Writers: tables, partitioned files, upserts, JSON, topics and database sinks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tradewake.functions import exprs as X
from tradewake.operators.cdc import latest
from tradewake.session import freed, fresh_path

ERROR_BUCKET = "error_bucket"


def create_table_as(df: DataFrame, name: str) -> DataFrame:
    """CREATE TABLE AS: writes the rows once to the shared folder and reads them back as a view."""
    out = round_trip(df, fresh_path(df.sparkSession, name))
    out.createOrReplaceTempView(name)
    return out


def round_trip(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> DataFrame:
    df.write.format(fmt).partitionBy(*partition_by).save(path)
    return df.sparkSession.read.format(fmt).load(path)


def by_partition(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of one partition value gathered, so that each value gets few files; large values are split evenly."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replaces only the partitions that occur in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def retained(df: DataFrame, day: str, as_of: str, days: int = 180) -> DataFrame:
    """Rows of the last ``days`` daily partitions; as a partition filter it prunes files."""
    return df.where((F.col(day) > F.date_sub(F.lit(as_of).cast("date"), days)) & (F.col(day) <= F.lit(as_of).cast("date")))


def write_partition(df: DataFrame, path: str, key: str, value: str) -> None:
    """Writes rows without their partition column into the folder of one value, over what was there."""
    df.write.mode("overwrite").parquet(f"{path}/{key}={value}")


def drop_partitions(spark: SparkSession, path: str, key: str, values: Sequence[str]) -> None:
    """Deletes the folders of partition values; a list of values is short, one per day."""
    for value in values:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{key}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def sorted_lines(df: DataFrame, order: str, line: Column, path: str) -> None:
    """Lines of text files in the order of a column across files: ranges first, then sorted inside each."""
    df.select(order, line.alias("value")).repartitionByRange(order).sortWithinPartitions(order).select("value").write.text(path)


def expired_partitions(df: DataFrame, day: str, as_of: str, days: int = 180) -> DataFrame:
    """Partition values a retention job would drop."""
    return df.where(F.col(day) <= F.date_sub(F.lit(as_of).cast("date"), days)).select(day).distinct()


def as_json(df: DataFrame, text: str = "value") -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias(text))


def to_topics(df: DataFrame, topic: Column) -> DataFrame:
    """Rows as JSON with the topic each goes to: the frame a Kafka writer takes."""
    return df.select(topic.alias("topic"), F.to_json(F.struct("*")).alias("value"))


def write_topics(df: DataFrame, servers: str) -> None:
    """Batch write to Kafka; needs the connector."""
    df.write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").option(
        "kafka.enable.idempotence", "true").save()


def day_bucket(epoch: Column | str) -> Column:
    """``day=yyyyMMdd`` of an epoch in seconds or milliseconds; unreadable values share one bucket."""
    day = F.date_format(X.from_epoch_any(epoch), "yyyyMMdd")
    return F.coalesce(F.concat(F.lit("day="), day), F.lit(ERROR_BUCKET))


def jdbc_rows(df: DataFrame, columns: Sequence[str], skip: Sequence[str] = ()) -> DataFrame:
    """Columns in target order without the skipped ones, as positional binding expects."""
    return df.select(*[c for c in columns if c not in skip])


def write_jdbc(df: DataFrame, url: str, table: str, columns: Sequence[str], skip: Sequence[str] = (), batch: int = 5000,
               properties: dict[str, str] | None = None) -> None:
    jdbc_rows(df, columns, skip).write.mode("append").jdbc(url, table, properties={"batchsize": str(batch), **(properties or {})})


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Complete ``_v=<n>`` folders below a folder."""
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    root = jvm(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root)]
    return sorted(int(p.getName().split("=")[1]) for p in found if fs.exists(jvm(p, "_SUCCESS")))


def append_batch(df: DataFrame, path: str, batch: str) -> None:
    """INSERT INTO: adds rows to a table as the folder of their batch; a repeated run of the same batch replaces its own rows only."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def appended(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All appended rows, without the batch they came with."""
    return spark.read.schema(StructType([*schema.fields, StructField("batch", StringType())])).parquet(path).drop("batch")


#: Bytes of stored files that are worked on at once where a table is in buckets.
PIECE = 32 << 20


def in_pieces(buckets: Sequence[int], bytes_each: float) -> list[list[int]]:
    """Buckets in runs of at most PIECE bytes, of one bucket at least."""
    step = max(1, int(PIECE / max(bytes_each, 1)))
    return [list(buckets[k : k + step]) for k in range(0, len(buckets), step)]


class KeyedTable:
    """Newest row per key as a base and one small delta per micro-batch.

    A batch writes only its own newest rows, whatever the size of the table; a
    repeated batch overwrites the same delta, so replays change nothing.
    Readers merge base and deltas; ``fold`` puts the deltas into a new base, a large table bucket by bucket.

    With ``bucket``, a column of every row, base and deltas are partitioned by its
    hash, and ``read`` opens only the partitions asked for.
    """

    def __init__(self, path: str, keys: list[str], order: list[str], bucket: str | None = None, buckets: int = 64):
        self.path, self.keys, self.order, self.bucket, self.buckets = path, keys, order, bucket, buckets
        self.schema: StructType | None = None  # that of the last batch; a first read after a restart takes it from the files

    def bucket_of(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.buckets)).cast("int")

    def _folder(self, kind: str, version: int) -> str:
        return f"{self.path}/_kind={kind}/_v={version}"

    def _write(self, rows: DataFrame, path: str) -> None:
        if self.bucket:
            rows = by_partition(rows.withColumn("_bucket", self.bucket_of(self.bucket)), "_bucket")
        with freed(rows.sparkSession):
            rows.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "static").partitionBy(
                *["_bucket"] * bool(self.bucket)).parquet(path)

    def _write_pieces(self, spark: SparkSession, pieces: Iterable[tuple[DataFrame, list[int]]], path: str) -> None:
        """A folder written piece by piece, each with the buckets it has; the folder is complete when all are there."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.delete(folder, True)
        for rows, buckets in pieces:
            rows = rows.withColumn("_bucket", self.bucket_of(self.bucket))
            rows = by_partition(rows, "_bucket") if len(buckets) > 1 else rows
            with freed(spark):
                rows.write.mode("append").option("compression", "zstd").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("_bucket").parquet(path)
        fs.create(spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS"), True).close()

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        self.schema = StructType([StructField(f.name, f.dataType) for f in batch.schema.fields])
        self._write(latest(batch, self.keys, self.order), self._folder("delta", batch_id))

    def upsert_pieces(self, spark: SparkSession, pieces: Iterable[tuple[DataFrame, list[int]]], batch_id: int) -> None:
        """``upsert`` of a batch that comes as pieces of different buckets, one row per key: only one piece is worked on at a time."""

        def known() -> Iterator[tuple[DataFrame, list[int]]]:
            for rows, buckets in pieces:
                self.schema = StructType([StructField(f.name, f.dataType) for f in rows.schema.fields])
                yield rows, buckets

        self._write_pieces(spark, known(), self._folder("delta", batch_id))

    def stored_bytes(self, spark: SparkSession, upto: int | None = None) -> int:
        """Bytes of the files that a read opens."""
        base, deltas = self._versions(spark, upto)
        paths = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in [self._folder("base", v) for v in base] + [self._folder("delta", v) for v in deltas]]
        return sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength() for p in paths)

    def _versions(self, spark: SparkSession, upto: int | None) -> tuple[list[int], list[int]]:
        known = lambda kind: [v for v in versions(spark, f"{self.path}/_kind={kind}") if upto is None or v <= upto]
        base = known("base")[-1:]
        return base, [v for v in known("delta") if not base or v > base[0]]

    def read(self, spark: SparkSession, upto: int | None = None, only: Sequence[int] | None = None) -> DataFrame | None:
        """The table after batch ``upto`` (the newest when omitted); None while nothing was written.

        ``only`` lists the buckets to read. After a fold, states before it cannot be read any more.
        """
        base, deltas = self._versions(spark, upto)
        paths = [self._folder("base", v) for v in base] + [self._folder("delta", v) for v in deltas]
        if not paths:
            return None
        reader = spark.read.option("basePath", self.path)
        if self.schema is not None:
            reader = reader.schema(StructType(self.schema.fields + [StructField("_bucket", IntegerType())] * bool(self.bucket)))
        rows = reader.parquet(*paths)
        if only is not None:
            rows = rows.where(F.col("_bucket").isin(list(only)))
        rows = rows.drop("_kind", "_v", "_bucket")
        return latest(rows, self.keys, self.order) if len(paths) > 1 else rows

    def compact(self, spark: SparkSession, upto: int) -> None:
        size = self.stored_bytes(spark, upto)
        if self.bucket is None or size <= PIECE:
            self._write(self.read(spark, upto), self._folder("base", upto))
        else:
            pieces = in_pieces(range(self.buckets), size / self.buckets)
            self._write_pieces(spark, ((self.read(spark, upto, only), only) for only in pieces), self._folder("base", upto))

    def fold(self, spark: SparkSession, batch_id: int, every: int) -> None:
        """A new base once ``every`` deltas have gathered; what it replaces is removed.

        Only complete versions are read, so a fold that was cut off is done again, and a batch that is repeated after
        its fold changes nothing. Frames read before a fold must have been used by then.
        """
        base, deltas = self._versions(spark, batch_id)
        if len(deltas) >= every and len(base) + len(deltas) > 1:  # a delta alone is as good as a base
            self.compact(spark, batch_id)
            base, deltas = [batch_id], []
        for kind in ("base", "delta"):
            old = [v for v in versions(spark, f"{self.path}/_kind={kind}") if base and (v < base[0] or kind == "delta" and v == base[0])]
            drop_partitions(spark, f"{self.path}/_kind={kind}", "_v", [str(v) for v in old])
