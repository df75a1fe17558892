"""Time series for the dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daytally.functions.days import date_parts, format_long_day, in_recent_days
from daytally.names import qcol, require_columns

MEASURES = ["Depart", "Heat", "PrecipTotal", "Tavg", "Tmax", "Tmin"]


def project_measures(df: DataFrame, day: str, measures: list[str]) -> DataFrame:
    require_columns(df, [day, *measures])
    return df.select(qcol(day), *[qcol(c) for c in measures])


def project_field(df: DataFrame, day: str, field: str, name: str | None = None) -> DataFrame:
    """Date parts and one field as a double, under ``name``."""
    require_columns(df, [day, field])
    return df.select(*date_parts(qcol(day)), qcol(field).cast("double").alias(name or field))


def series_rows(df: DataFrame, day: str, types: dict[str, str]) -> DataFrame:
    """Date parts and the given fields in the given types."""
    require_columns(df, [day, *types])
    return df.select(*date_parts(qcol(day)), *[qcol(c).cast(t).alias(c) for c, t in types.items()])


def sort_by_day(df: DataFrame, *keys: str) -> DataFrame:
    """Ascending by day, as a distributed range sort."""
    return df.orderBy(*[qcol(k) for k in keys])


def with_day_ordinal(df: DataFrame, day: str, name: str = "ordinal") -> DataFrame:
    """Position of each row's day among the distinct days, counted from 1.

    Days are numbered inside their year, and the year's first position comes
    from the day counts of the years before it.  The window over the counts has
    one row per calendar year, the other at most 366 distinct days per year, so
    no task sees the whole series, however many rows a day has.
    """
    days = df.select(qcol(day)).distinct().withColumn("_year", F.year(qcol(day)))
    before = F.sum("_days").over(W.orderBy("_year").rowsBetween(W.unboundedPreceding, -1))
    starts = days.groupBy("_year").agg(F.count(F.lit(1)).alias("_days"))
    starts = starts.select("_year", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(W.partitionBy("_year").orderBy(qcol(day)))
    placed = days.withColumn("_place", place).join(starts, "_year")
    ordinals = placed.select(qcol(day), (F.col("_before") + F.col("_place")).cast("bigint").alias(name))
    return df.join(ordinals, [day])


def preview(df: DataFrame, order: list[str], n: int = 2) -> DataFrame:
    """First ``n`` rows in an explicit order."""
    return df.orderBy(*[qcol(c) for c in order]).limit(n)


def default_row_if_empty(df: DataFrame, default: object = 0) -> DataFrame:
    """The table itself, or one row of defaults when it has none.

    Only one row is looked at to tell the two apart.
    """
    none = df.limit(1).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == 0)
    row = none.select([F.lit(default).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return df.unionByName(row)


def unpivot(df: DataFrame, day: str, columns: list[str] | None = None) -> DataFrame:
    """Wide to long: ``(day, category, n)``."""
    values = columns or [c for c in df.columns if c != day]
    return df.unpivot([qcol(day)], [qcol(c) for c in values], "category", "n")


def select_groups(long: DataFrame, groups: DataFrame, category: str = "category") -> DataFrame:
    """Rows of the series that belong to a group, with the group's name."""
    return long.join(groups, category)


def recent_days(df: DataFrame, day: str, asof: Column, days: int = 5) -> DataFrame:
    """Rows of the last days up to ``asof``, with the day as ``MM/dd/yyyy`` text."""
    return df.filter(in_recent_days(qcol(day), asof, days)).withColumn("Date", format_long_day(qcol(day)))
