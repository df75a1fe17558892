"""Row selection, weather cells, typing, and the rows that fail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.functions.text import blank_to_null, is_missing_marker, trace_to_zero
from daytally.names import qcol, require_columns

REASON = "reason"


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack tables; columns are matched by name, absent ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def filter_year_upto(df: DataFrame, year: str, last: int) -> DataFrame:
    """Rows up to and including a year; rows without a year stay."""
    return df.filter(qcol(year).isNull() | (qcol(year) <= last))


def filter_day_upto(df: DataFrame, ts: str, last_year: int) -> DataFrame:
    """The same cutoff on the timestamp itself, in a form the file scan can use."""
    end = F.make_date(F.lit(last_year + 1), F.lit(1), F.lit(1)).cast("timestamp_ntz")
    return df.filter(qcol(ts).isNull() | (qcol(ts) < end))


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop the named columns, all of which must exist."""
    require_columns(df, names)
    return df.select([qcol(c) for c in df.columns if c not in set(names)])


def blanks_to_null(df: DataFrame, cells: list[str]) -> DataFrame:
    return df.withColumns({c: blank_to_null(qcol(c)) for c in cells})


def traces_to_zero(df: DataFrame, cells: list[str]) -> DataFrame:
    return df.withColumns({c: trace_to_zero(qcol(c)) for c in cells})


def has_missing_marker(cells: list[str]) -> Column:
    """True when any of the cells rejects its row."""
    return reduce(lambda a, b: a | b, [is_missing_marker(qcol(c)) for c in cells])


def reject_missing_rows(df: DataFrame, cells: list[str]) -> DataFrame:
    return df.filter(~has_missing_marker(cells))


def with_reject_reason(df: DataFrame, cells: list[str], key: str, overflow: str) -> DataFrame:
    """Name what is wrong with a raw weather row; null for a good row.

    A surplus cell stands to the right of all declared cells, so the missing
    mark is reported first.
    """
    surplus = blank_to_null(qcol(overflow)).isNotNull()
    no_key = blank_to_null(qcol(key)).isNull()
    reason = (
        F.when(has_missing_marker(cells), "missing_marker")
        .when(surplus, "surplus_cell")
        .when(no_key, "no_key")
    )
    return df.withColumn(REASON, reason)


def clean_or_tag(df: DataFrame, cells: list[str], key: str, overflow: str) -> DataFrame:
    """All rows in one pass: good rows cleaned, the others as they came, with their reason."""
    tagged = with_reject_reason(df, cells, key, overflow)
    good = F.col(REASON).isNull()
    return tagged.withColumns({c: F.when(good, trace_to_zero(blank_to_null(qcol(c)))).otherwise(qcol(c)) for c in cells})


def quarantine(df: DataFrame, cells: list[str], key: str, overflow: str) -> tuple[DataFrame, DataFrame]:
    """Split raw weather rows into cleaned good rows and rejected raw rows.

    Using both parts reads the input twice; where it is large, store
    ``clean_or_tag`` first and split the stored table with ``split_tagged``.
    """
    return split_tagged(clean_or_tag(df, cells, key, overflow), overflow)


def split_tagged(tagged: DataFrame, overflow: str) -> tuple[DataFrame, DataFrame]:
    """Good rows without the helper columns, and the rejected rows."""
    good = tagged.filter(F.col(REASON).isNull()).drop(REASON, overflow)
    return good, tagged.filter(F.col(REASON).isNotNull())


def cast_record_types(df: DataFrame, types: dict[str, str], bad: str = "bad_cells") -> DataFrame:
    """Text to the given types; ``bad`` counts the non-null cells that did not convert."""
    require_columns(df, types)
    typed = {c: qcol(c).try_cast(t) for c, t in types.items()}
    failed = [(qcol(c).isNotNull() & typed[c].isNull()).cast("int") for c in types]
    kept = [typed[c].alias(c) if c in typed else qcol(c) for c in df.columns]
    return df.select(*kept, reduce(lambda a, b: a + b, failed).alias(bad))
