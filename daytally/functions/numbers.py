"""Expressions for numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def midrange_int(low: Column, high: Column) -> Column:
    """Integer mean of two integers, rounded towards minus infinity."""
    return F.floor((low.cast("bigint") + high.cast("bigint")) / F.lit(2)).cast("bigint")


def as_percent(share: Column) -> Column:
    """Share as a percentage with one decimal."""
    return F.round(share * 100, 1)


def root_mean_square(error: Column) -> Column:
    """Aggregate: square root of the mean squared error."""
    return F.sqrt(F.avg(error * error))
