"""Expressions for text cells and field names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks in a field's short name and what they stand for, replaced
# from top to bottom.
SLUG_MARKS = [
    ("Location_", "Location: "),
    ("Type_", "Type: "),
    ("_s_", " / "),
    ("_c_", ", "),
    ("_p1_", "("),
    ("_p2_", ")"),
    ("_x_", "."),
    ("_h_", "-"),
    ("__", "/"),
    ("_", " "),
]

TRACE_MARK = "T"
MISSING_MARK = "M"


def decode_field_slug(slug: Column) -> Column:
    """Column name that a short name stands for."""
    return reduce(lambda text, mark: F.replace(text, F.lit(mark[0]), F.lit(mark[1])), SLUG_MARKS, slug)


def decode_slug_text(slug: str) -> str:
    """The same for one name given as a parameter."""
    return reduce(lambda text, mark: text.replace(*mark), SLUG_MARKS, slug)


def blank_to_null(cell: Column) -> Column:
    return F.nullif(cell, F.lit(""))


def trace_to_zero(cell: Column) -> Column:
    """A cell with the trace mark in it counts as zero."""
    return F.when(cell.contains(TRACE_MARK), F.lit("0")).otherwise(cell)


def is_missing_marker(cell: Column) -> Column:
    """True for a cell with the missing mark and no trace mark; false for null."""
    marked = cell.contains(MISSING_MARK) & ~cell.contains(TRACE_MARK)
    return F.coalesce(marked, F.lit(False))
