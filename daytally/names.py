"""Column-name helpers.

Category names turn into column names in the wide tables, and they may hold
dots, commas, slashes and parentheses, so every lookup by name goes through
``q``/``qcol``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def q(name: str) -> str:
    """Backtick-quote a column name."""
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    """Column reference for a name with any characters in it."""
    return F.col(q(name))


def require_columns(df, names) -> None:
    """Raise a clear error when a requested column does not exist."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"unknown column(s) {missing}; available: {df.columns}")
