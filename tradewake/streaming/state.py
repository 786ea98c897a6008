"""Keyed state on streams: new-visitor repair, newest only, merge of partial rows, snapshot end.

Each processor works through the rows a key has in a micro-batch in order, so
that the result does not depend on how a shuffle or Arrow cut them, and keeps a
few values per key; the merge of partial rows takes all keys of a bucket at once. A micro-batch is bounded by the reader's rows or files per
trigger. State expires by TTL, so the state store (RocksDB on a cluster) does
not grow with history.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState

DAY_MS = 86_400_000
SNAPSHOT_IDLE_MS = 15_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark, run_to_end: bool = False) -> None:
    """RocksDB state. Processing-time state asks for one more empty batch for ever, so a query that
    is to end with its input (``availableNow``) must go without empty batches."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(not run_to_end).lower())


@contextmanager
def running_to_end(spark):
    """The settings of ``configure`` for one query that ends with its input, taken back afterwards."""
    names = ("spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.noDataMicroBatches.enabled")
    before = {n: spark.conf.get(n, None) for n in names}
    configure(spark, run_to_end=True)
    try:
        yield
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def snapshot_only(changes: DataFrame) -> DataFrame:
    """Rows of the initial snapshot; changes after it leave."""
    return changes.where((F.col("op") == "r") | (F.col("source")["snapshot"] == "true"))


def in_order(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    """A key's rows of one micro-batch; rows equal in ``order`` are ordered by their other columns."""
    pdf = pd.concat(list(rows), ignore_index=True)
    return pdf.sort_values(order + [c for c in pdf.columns if c not in order], kind="stable", ignore_index=True)


class NewFlagRepair(StatefulProcessor):
    """Clears ``is_new`` on days other than the remembered first day of the key."""

    def __init__(self, flag: str, order: list[str], ttl_ms: int):
        self.flag, self.order, self.ts, self.ttl_ms = flag, order, order[0], ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.day = handle.getValueState("first_day", "day string", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(rows, self.order)
        days = pdf[self.ts].dt.strftime("%Y-%m-%d")
        if not self.day.exists():
            first = pdf[self.ts].iloc[0]
            remembered = first if pdf[self.flag].iloc[0] == "1" else first - timedelta(days=1)
            self.day.update((remembered.strftime("%Y-%m-%d"),))
        pdf.loc[(pdf[self.flag] == "1") & (days != self.day.get()[0]), self.flag] = "0"
        yield pdf


class NewerOnly(StatefulProcessor):
    """Emits rows whose time is newer than anything the key has brought, in the order of arrival."""

    def __init__(self, ts: str, order: list[str], ttl_ms: int):
        self.ts, self.order, self.ttl_ms = ts, order, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "ts bigint", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(rows, self.order)
        earlier = pdf[self.ts].cummax().shift()
        fresh = earlier.isna() | (pdf[self.ts] > earlier)
        top = int(pdf[self.ts].max())
        if self.seen.exists():
            best = self.seen.get()[0]
            fresh &= pdf[self.ts] > best
            top = max(best, top)
        self.seen.update((top,))
        yield pdf[fresh]


class MergeParts:
    """Completes every partial row with the last known value of each field, for all keys of a bucket at once.

    The state of a bucket is one Arrow table of its keys, their last values and the time they were last seen, so a
    micro-batch costs one look-up a bucket and no Python call a key or row. A key not seen for ``ttl_ms`` is forgotten.
    """

    def __init__(self, key: str, fields: list[str], order: list[str], ttl_ms: int, schema: T.StructType):
        self.key, self.fields, self.order, self.ttl_ms = key, fields, order, ttl_ms
        self.schema = pa.schema([(f, to_arrow_type(schema[f].dataType)) for f in [key, *fields]] + [("at", pa.int64())])

    def __call__(self, bucket, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = state.getCurrentProcessingTimeMs()
        known = pd.DataFrame({f: [] for f in self.schema.names})
        if state.exists:
            known = pa.ipc.open_stream(state.get[0]).read_pandas()
            known = known[known["at"] + self.ttl_ms > now]
        pdf = pd.concat(list(rows), ignore_index=True)
        pdf = in_order([pdf], self.order) if pdf.duplicated([self.key, *self.order]).any() else pdf.sort_values(self.order, kind="stable", ignore_index=True)
        codes, _ = pd.factorize(pd.concat([known[self.key], pdf[self.key]], ignore_index=True) if len(known) else pdf[self.key], use_na_sentinel=False)
        old, codes = codes[: len(known)], codes[len(known) :]
        at = np.full(codes.max() + 1 if not len(old) else max(codes.max(), old.max()) + 1, -1)
        at[old] = np.arange(len(old))
        row = at[codes]  # of what is known, -1 where nothing is
        for f in self.fields:
            filled = pdf[f].groupby(codes).ffill()
            if len(known):
                filled = filled.where(filled.notna() | (row < 0), known[f].to_numpy()[row])
            pdf[f] = filled
        last = pdf[[self.key, *self.fields]].groupby(codes).tail(1).assign(at=now)
        stays = known[~np.isin(old, codes)]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for part in (stays, last):
                if len(part):
                    out.write_table(pa.Table.from_pandas(part, schema=self.schema, preserve_index=False, safe=False))
        state.update((sink.getvalue().to_pybytes(),))
        state.setTimeoutDuration(self.ttl_ms)
        yield pdf


class SnapshotGate(StatefulProcessor):
    """Passes snapshot rows; the snapshot ends with the first change or after an idle time.

    Emits one marker row (op ``end``) per key when its snapshot ends.
    """

    def __init__(self, idle_ms: int, columns: list[str]):
        self.idle_ms, self.columns = idle_ms, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.done = handle.getValueState("done", "done boolean")
        self.timer = handle.getValueState("timer", "at bigint")

    def _marker(self, key) -> pd.DataFrame:
        return pd.DataFrame([{c: (key[0] if i == 0 else "end" if c == "op" else None) for i, c in enumerate(self.columns)}])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        done, changed = self.done.exists(), False
        for pdf in rows:
            snapshot = pdf["op"].eq("r") | pdf["snapshot"].eq("true")
            changed |= not bool(snapshot.all())
            yield pdf.loc[snapshot, self.columns]
        if self.timer.exists():
            self.handle.deleteTimer(self.timer.get()[0])
            self.timer.clear()
        if done:
            return
        if changed:
            self.done.update((True,))
            yield self._marker(key)
        else:
            at = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.done.exists():
            return
        self.done.update((True,))
        self.timer.clear()
        yield self._marker(key)


def _transform(df: DataFrame, key: str, processor: StatefulProcessor, schema: T.StructType) -> DataFrame:
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode="ProcessingTime"
    )


def repair_new_flag(df: DataFrame, key: str = "mid", flag: str = "is_new", ts: str = "ts", ttl_ms: int = DAY_MS, order: list[str] | None = None) -> DataFrame:
    """``order``: time first, then what decides between equal times."""
    return _transform(df, key, NewFlagRepair(flag, order or [ts], ttl_ms), df.schema)


def newer_only(df: DataFrame, key: str, ts: str, order: list[str], ttl_ms: int = DAY_MS) -> DataFrame:
    """``order``: columns that tell the order of arrival inside a micro-batch, such as a position in a topic."""
    return _transform(df, key, NewerOnly(ts, order, ttl_ms), df.schema)


def merge_parts(df: DataFrame, key: str, fields: list[str], ts: str, ttl_ms: int = DAY_MS, order: list[str] | None = None, buckets: int = 1024) -> DataFrame:
    """Keys are dealt over ``buckets`` by hash; a micro-batch reads and writes the state of the buckets that it touches."""
    merge = MergeParts(key, fields, order or [ts], ttl_ms, df.schema)
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    columns = df.columns
    return rows.groupBy("_bucket").applyInPandasWithState(
        lambda bucket, pdfs, state: (pdf[columns] for pdf in merge(bucket, pdfs, state)), df.schema, "known binary", "append", "ProcessingTimeTimeout")


def snapshot_gate(df: DataFrame, key: str, idle_ms: int = SNAPSHOT_IDLE_MS) -> DataFrame:
    """``df`` has the key first, then ``op`` and ``snapshot`` among its text columns."""
    columns = [key, *[c for c in df.columns if c != key]]
    schema = T.StructType([df.schema[c] for c in columns])
    return _transform(df.select(*columns), key, SnapshotGate(idle_ms, columns), schema)
