"""A stored table with one record per key, kept as Parquet.

There are two layouts.  *Ranges* hold the keys in order, each file a range of
them, sorted, so that a lookup by key reads the row groups whose statistics
hold it.  *Parts* are folders by something that follows from the key (its
month, say); an update reads and writes only the parts that it touches.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.names import qcol
from daytally.operators.dedupe import keep_last
from daytally.scratch import fresh_path

#: Column of the part, the name of its folder.
PART = "_part"


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """The whole stored table; later selects and filters reach the scan.

    ``merge_schema`` looks at all files for columns that only some of them have.
    """
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def upsert(existing: DataFrame, updates: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Existing rows with those of ``updates`` put over them, key by key.

    The last update of a key in ``order`` wins and replaces the whole record:
    columns it does not have become null, columns only it has are added.
    ``order`` must be given, as nothing else says which update is the last.
    Updates without a key cannot be stored and are left out.  ``order`` columns
    that the stored table does not have are not stored.
    """
    if not order:
        raise ValueError("an order is needed: a key may repeat among the updates")
    latest = keep_last(updates.filter(qcol(key).isNotNull()), [key], order)
    latest = latest.select([qcol(c) for c in latest.columns if c in existing.columns or c not in order])
    return _replaced(existing, latest, key)


def _replaced(existing: DataFrame, latest: DataFrame, key: str) -> DataFrame:
    """``latest``, one row per key, and the existing rows of other keys."""
    untouched = existing.join(latest.select(qcol(key)), [key], "left_anti")
    return untouched.select([qcol(c) for c in existing.columns]).unionByName(latest, allowMissingColumns=True)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write to a path that must not exist yet; readers of older paths are not disturbed."""
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_ranges(df: DataFrame, path: str, key: list[str], row_group_bytes: int | None = None) -> None:
    """Write to a new path in ranges of ``key``, sorted within each file.

    The ranges come from a sample of the keys, so they are of like size also
    where keys are dealt unevenly; a key's rows are in one file.
    """
    names = [qcol(c) for c in key]
    writer = df.repartitionByRange(*names).sortWithinPartitions(*names).write.mode("error")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def _in_parts(df: DataFrame, part: Column) -> DataFrame:
    # the letter keeps the reader from taking the folder's name for a number or a day
    return df.withColumn(PART, F.concat(F.lit("p"), F.coalesce(part.cast("string"), F.lit(""))))


def _dealt(df: DataFrame, key: str):
    """Writer of rows dealt by part, a large part over several tasks, sorted by key."""
    return df.hint("rebalance", F.col(PART)).sortWithinPartitions(PART, qcol(key)).write.partitionBy(PART)


def write_parts(df: DataFrame, path: str, key: str, part: Column) -> None:
    """Write to a new path in one folder for each value of ``part``, an expression over the key."""
    _dealt(_in_parts(df, part), key).mode("error").parquet(path)


def upsert_parts(spark: SparkSession, path: str, updates: DataFrame, key: str, order: list[str], part: Column) -> DataFrame:
    """Upsert into the table in parts at ``path``, replacing the parts that the updates touch and no other.

    ``part`` must be the expression that the table was written with.  Records
    are replaced as by ``upsert``.  The new files of a part take the place of
    the old ones when all are written; a run that fails before leaves the
    table as it was, and can be run again.  Whoever reads the table at the
    time of the replacement has to read again; where that matters use
    ``upsert_to``.  The driver gets the names of the touched parts.
    """
    if not order:
        raise ValueError("an order is needed: a key may repeat among the updates")
    existing = read_table(spark, path)
    latest = keep_last(updates.filter(qcol(key).isNotNull()), [key], order)
    latest = latest.select([qcol(c) for c in latest.columns if c in existing.columns or c not in order])
    # stored by part, so that the names of its folders tell which parts are touched
    stored = fresh_path(spark, "updates")
    _dealt(_in_parts(latest, part), key).parquet(stored)
    latest = spark.read.schema(_in_parts(latest, part).schema).parquet(stored)
    touched = sorted({unquote(unquote(folder)) for file in latest.inputFiles() for folder in re.findall(f"/{PART}=([^/]*)/", file)})
    if not touched:
        return existing
    merged = _replaced(existing.filter(F.col(PART).isin(touched)), latest, key)
    _dealt(merged, key).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return read_table(spark, path, merge_schema=not set(latest.columns) <= set(existing.columns))


def upsert_to(spark: SparkSession, existing_path: str, updates: DataFrame, key: str, order: list[str], new_path: str) -> DataFrame:
    """Upsert into the table at ``existing_path``, written to ``new_path``."""
    write_table(upsert(read_table(spark, existing_path), updates, key, order), new_path)
    return read_table(spark, new_path)
