"""Where queries and their SQL twins are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.names import qcol

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL twin where there is one."""

    def add(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key!r} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return add


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Result form that compares across engines: ISO text for days, rounded doubles, bigint counts."""

    def column(f: T.StructField):
        if isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            return qcol(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.round(qcol(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            return qcol(f.name).cast("bigint").alias(f.name)
        return qcol(f.name)

    return df.select([column(f) for f in df.schema.fields])
