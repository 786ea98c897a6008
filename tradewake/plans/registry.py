"""Registry of runnable queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewake.sources.tables import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    """Register a query under ``key``; ``oracle`` is its SQL twin where one exists."""

    def add(fn: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return add


def presented(df: DataFrame) -> DataFrame:
    """One type per kind of value: bigint, double, text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)
