"""One row per key, chosen by an explicit order.

Both are aggregates over a struct ordered by the ``order`` columns first.  Each
task reduces its own rows to one per key before the shuffle, so a key that
holds a large share of all rows (for instance the null key) costs one row per
task and never gathers in one place.  Remaining columns break ties, which makes
the choice the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.names import qcol, require_columns


def _pick(df: DataFrame, keys: list[str], order: list[str], choose) -> DataFrame:
    require_columns(df, [*keys, *order])
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = [c for c in order if c not in keys]
    if not ranked and not rest:
        return df.distinct()
    row = F.struct(*[qcol(c) for c in [*ranked, *rest]])
    picked = df.groupBy(*[qcol(c) for c in keys]).agg(choose(row).alias("_row"))
    fields = {c: F.col("_row").getField(c).alias(c) for c in [*ranked, *rest]}
    return picked.select([fields.get(c, qcol(c)) for c in df.columns])


def dedupe_keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of each key; null keys are equal to each other, nulls order first."""
    return _pick(df, keys, order, F.min)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row of each key in ``order``."""
    return _pick(df, keys, order, F.max)
