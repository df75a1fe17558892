"""Every registered query next to its SQL twin, and rules for the plans."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from daytally.queries.registry import ORACLE, QUERIES
from tests.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_equals_its_twin(spark, con, key):
    assert key in ORACLE
    made = []

    def query(session, sf_dir):
        made.append(QUERIES[key](session, sf_dir))
        return made[0]

    assert differences(spark, con, key, query, ORACLE[key], SF_DIR) is None
    text = plan(made[0])
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert word not in text


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["date", "Total Crimes"] and df.count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_cutoff_and_columns_reach_the_scan(spark):
    from daytally.sources.generated_tables import incident_cube

    text = plan(incident_cube(spark, SF_DIR))
    assert "LessThan(l_shipdate,2000-01-01" in text
    line = next(x for x in text.splitlines() if "lineitem.parquet" in x)
    assert "l_extendedprice" not in line and "l_tax" not in line
    assert "partial_count" in text and "partial_min" in text
