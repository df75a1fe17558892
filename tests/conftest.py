from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daytally.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


@pytest.fixture
def rows():
    """Sorted list of plain tuples, nulls first."""

    def to_rows(df):
        return sorted([tuple(r) for r in df.collect()], key=lambda r: [(v is not None, v) for v in r])

    return to_rows
