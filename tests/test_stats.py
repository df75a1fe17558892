from __future__ import annotations

import numpy as np
import pytest

from daytally.operators.stats import corr_with_target, correlation_percent, rmse


@pytest.fixture
def frame(spark):
    rng = np.random.default_rng(1)
    a, b, y = rng.normal(size=50), rng.normal(size=50), rng.normal(size=50)
    data = [(float(a[i]), None if i < 10 else float(b[i]), 0.1, float(y[i])) for i in range(50)]
    return spark.createDataFrame(data, "`a.1` double, b double, const double, y double"), a, b, y


def test_corr(frame):
    df, a, b, y = frame
    got = {r.measure: r["corr"] for r in corr_with_target(df, ["a.1", "b", "const", "y"], "y").collect()}
    assert got["a.1"] == pytest.approx(np.corrcoef(a, y)[0, 1], abs=1e-12)
    assert got["b"] == pytest.approx(np.corrcoef(b[10:], y[10:])[0, 1], abs=1e-12)
    assert got["const"] is None
    assert got["y"] == pytest.approx(1.0)


def test_percent_keeps_the_chart_order(frame):
    df, a, _, y = frame
    corr = corr_with_target(df, ["a.1", "const", "y"], "y")
    rows = correlation_percent(corr, ["const", "a.1"]).orderBy("place").collect()
    assert [(r.place, r.measure) for r in rows] == [(1, "const"), (2, "a.1")]
    assert rows[0].percent is None
    assert rows[1].percent == pytest.approx(round(np.corrcoef(a, y)[0, 1] * 100, 1))


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 1.0)], "label double, prediction double")
    assert rmse(df).first().rmse == pytest.approx(np.sqrt(17 / 3))
