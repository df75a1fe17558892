"""From single incidents to per-day count tables.

The deduplicated incidents are reduced once to a *day cube*: one row per day
and combination of dimension values with its count.  Category frequencies, the
leading categories, the long table, the pivots and the totals are all read off
the cube, so the raw events are scanned and shuffled a single time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.functions.days import truncate_to_day
from daytally.names import qcol

OTHER = "OTHER"
LEADING = 20
TOTAL = "Total Crimes"
DAY = "date"
COUNT = "n"


def day_cube(incidents: DataFrame, ts: str, dims: list[str]) -> DataFrame:
    """``(date, *dims, n)``.  Counts are summed inside each task before the shuffle.

    Incidents without a day count for the frequencies, so they stay; the daily
    tables leave them out.
    """
    keyed = incidents.select(truncate_to_day(qcol(ts)).alias(DAY), *[qcol(d) for d in dims])
    return keyed.groupBy(DAY, *[qcol(d) for d in dims]).agg(F.count(F.lit(1)).alias(COUNT))


def _rows(weight: str | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(qcol(weight))


def category_frequency(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """``(category, n)`` without nulls; ``weight`` sums a count column instead of counting rows."""
    named = df.filter(qcol(column).isNotNull()).withColumn("category", qcol(column))
    return named.groupBy("category").agg(_rows(weight).cast("bigint").alias(COUNT))


def ranked_categories(freq: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` most frequent categories; equal counts go by name."""
    return freq.orderBy(F.desc(COUNT), F.asc("category")).limit(limit)


def bucket_topn(df: DataFrame, column: str, n: int = LEADING, weight: str | None = None, other: str = OTHER) -> DataFrame:
    """Replace every category outside the ``n`` leading ones; null stays null.

    The broadcast side has at most ``n`` rows.
    """
    keep = ranked_categories(category_frequency(df, column, weight), n).select(F.col("category").alias("_keep"))
    hit = df.join(F.broadcast(keep), qcol(column) == F.col("_keep"), "left")
    bucket = F.when(qcol(column).isNull(), F.lit(None)).when(F.col("_keep").isNotNull(), qcol(column)).otherwise(other)
    return hit.withColumn(column, bucket).drop("_keep")


def category_domain(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct categories."""
    named = df.filter(qcol(column).isNotNull()).select(qcol(column).alias("category"))
    return named.distinct().orderBy("category")


class Buckets:
    """The leading categories of one dimension, known on the driver."""

    def __init__(self, column: str, ranked: list[str], n: int = LEADING, other: str = OTHER):
        """``ranked``: category names by falling frequency, at least ``n + 1`` of them if there are as many."""
        self.column, self.other = column, other
        self.keep = ranked[:n]
        self.domain = sorted({*self.keep, other}) if len(ranked) > n else sorted(self.keep)

    def expr(self) -> Column:
        """Bucketed value of a row."""
        c = qcol(self.column)
        return F.when(c.isin(self.keep), c).when(c.isNotNull(), F.lit(self.other))


def leading_buckets(df: DataFrame, columns: list[str], n: int = LEADING, weight: str | None = None) -> list[Buckets]:
    """Buckets of several dimensions, from one job.

    At most ``n + 1`` rows per dimension are fetched: the extra one only tells
    whether anything is left for the other bucket.
    """
    tops = [
        ranked_categories(category_frequency(df, c, weight), n + 1).select(F.lit(i).alias("i"), "category", COUNT)
        for i, c in enumerate(columns)
    ]
    found = sorted(reduce(DataFrame.unionAll, tops).collect(), key=lambda r: (r["i"], -r[COUNT], r["category"]))
    return [Buckets(c, [r["category"] for r in found if r["i"] == i], n) for i, c in enumerate(columns)]


def _dated(df: DataFrame) -> DataFrame:
    return df.filter(F.col(DAY).isNotNull())


def daily_pivot(df: DataFrame, column: str, domain: list[str], weight: str | None = None) -> DataFrame:
    """One row per day, one count column per category; days without any category are absent."""
    named = _dated(df).filter(qcol(column).isNotNull())
    wide = named.groupBy(DAY).pivot(column, domain).agg(_rows(weight).cast("bigint"))
    return wide.select(DAY, *[F.coalesce(qcol(c), F.lit(0).cast("bigint")).alias(c) for c in domain])


def prefix_columns(df: DataFrame, prefix: str, keep: list[str]) -> DataFrame:
    """Put ``prefix`` before every column name but those in ``keep``."""
    return df.select([qcol(c) if c in keep else qcol(c).alias(prefix + c) for c in df.columns])


def row_total(df: DataFrame, columns: list[str], name: str = TOTAL) -> DataFrame:
    """``(date, total)``: sum across the given columns."""
    total = reduce(lambda a, b: a + b, [F.coalesce(qcol(c), F.lit(0)) for c in columns])
    return df.select(DAY, total.cast("bigint").alias(name))


def join_daily(*frames: DataFrame) -> DataFrame:
    """Inner join of day-keyed tables."""
    return reduce(lambda a, b: a.join(b, DAY), frames)


def daily_totals(incidents: DataFrame, ts: str, type_col: str, location_col: str) -> DataFrame:
    """``(date, Total Crimes)`` for the days of the wide table, without the cube.

    Incidents without a type do not count; a day needs a type and a location.
    """
    dated = _dated(incidents.withColumn(DAY, truncate_to_day(qcol(ts))))
    per_day = dated.groupBy(DAY).agg(
        F.count(qcol(type_col)).alias(TOTAL), F.count(qcol(location_col)).alias("_located")
    )
    return per_day.filter((qcol(TOTAL) > 0) & (F.col("_located") > 0)).drop("_located")


def daily_wide(cube: DataFrame, types: Buckets, locations: Buckets) -> DataFrame:
    """Date, total, and a count column per type and per location, in one aggregate."""
    n = F.col(COUNT)
    cols, t, loc = [], types.expr(), locations.expr()
    for prefix, value, domain in (("Type: ", t, types.domain), ("Location: ", loc, locations.domain)):
        cols += [F.sum(F.when(value == c, n).otherwise(0)).cast("bigint").alias(prefix + c) for c in domain]
    wide = _dated(cube).groupBy(DAY).agg(
        F.sum(F.when(t.isNotNull(), n)).cast("bigint").alias(TOTAL),
        F.sum(F.when(loc.isNotNull(), n)).alias("_located"),
        *cols,
    )
    return wide.filter(qcol(TOTAL).isNotNull() & F.col("_located").isNotNull()).drop("_located")


def daily_long(cube: DataFrame, types: Buckets, locations: Buckets) -> DataFrame:
    """``(date, dimension, category, n)``, the form that scales with any number of categories."""
    entries = F.array(
        F.struct(F.lit("Type").alias("dimension"), types.expr().alias("category")),
        F.struct(F.lit("Location").alias("dimension"), locations.expr().alias("category")),
    )
    rows = _dated(cube).select(DAY, COUNT, F.explode(entries).alias("_e")).select(DAY, "_e.dimension", "_e.category", COUNT)
    named = rows.filter(F.col("category").isNotNull())
    return named.groupBy(DAY, "dimension", "category").agg(F.sum(COUNT).alias(COUNT))
