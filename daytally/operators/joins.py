"""Joins of day-keyed tables.

No side is forced into a broadcast: both sides are grouped by day already, so a
sort-merge join needs no further shuffle, and adaptive execution switches to a
broadcast when a side turns out small enough.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from daytally.names import qcol
from daytally.operators.dedupe import dedupe_keep_first, keep_last


def one_per_day(df: DataFrame, day: str, order: list[str], last: bool = True) -> DataFrame:
    """At most one row per day; the last one written counts."""
    return (keep_last if last else dedupe_keep_first)(df, [day], order)


def join_by_day(left: DataFrame, right: DataFrame, day: str) -> DataFrame:
    """Inner join; ``right`` has one row per day, so no left row is multiplied."""
    return left.join(right, day)


def merge_right_wins(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Join two records per key; on a name clash the right value stands, null included."""
    clash = [c for c in left.columns if c in right.columns and c != key]
    return left.select([qcol(c) for c in left.columns if c not in clash]).join(right, key)


def overlay(left: DataFrame, right: DataFrame, day: str) -> DataFrame:
    """Two series on one axis; a day may have a value in either."""
    return left.join(right, day, "full_outer")


def align_series(actual: DataFrame, series: dict[str, DataFrame], day: str, value: str) -> DataFrame:
    """Put one value column per series next to the actual values, by day."""
    out = actual
    for name, df in series.items():
        out = out.join(df.select(qcol(day), qcol(value).alias(name)), day, "left")
    return out
