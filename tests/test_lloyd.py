"""K-Means steps against plain numpy ones."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from daytally.ml import lloyd

DIMENSIONS = ["x", "y.z"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(0, 1, (400, 2)) + rng.integers(0, 5, (400, 1)) * 4, 3)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(x)]
    return x, spark.createDataFrame([*rows, (900, None, 1.0)], "id int, x double, `y.z` double")


def plain(x, k, steps):
    order = sorted(range(len(x)), key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
    centres = x[order[:k]].copy()
    for _ in range(steps):
        near = ((x[:, None] - centres) ** 2).sum(2).argmin(1)
        centres = np.array([x[near == j].mean(0) if (near == j).any() else centres[j] for j in range(len(centres))])
    return centres


@pytest.mark.parametrize(("k", "steps"), [(2, 3), (6, 5), (100, 2), (6, 0)])
def test_centres_after_a_number_of_steps(data, k, steps):
    x, df = data
    got = lloyd.fit(df, "id", DIMENSIONS, k, steps)
    assert np.allclose(got, plain(x, k, steps), atol=1e-9)
    distance = ((x[:, None] - np.array(got)) ** 2).sum(2)
    errors = lloyd.errors(df, DIMENSIONS, got).collect()
    assert sum(r.days for r in errors) == len(x)
    assert sum(r.error for r in errors) == pytest.approx(distance.min(1).sum())


def test_few_rows_ties_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 4.0, 0.0)], "id int, x double, `y.z` double")
    centres = lloyd.fit(df, "id", DIMENSIONS, 6, 3)
    assert len(centres) == 3
    assigned = lloyd.assign(df, DIMENSIONS, [[0.0, 0.0], [0.0, 0.0], [2.0, 0.0]])
    assert {r.id: r.cluster for r in assigned.collect()} == {1: 0, 2: 0, 3: 2}
    assert {r.cluster for r in lloyd.assign(df.where("id = 3"), DIMENSIONS, [[8.0, 0.0], [0.0, 0.0]]).collect()} == {0}
    assert lloyd.fit(df.limit(0), "id", DIMENSIONS, 2, 2) == []
    with pytest.raises(ValueError, match="between 2 and 100"):
        lloyd.fit(df, "id", DIMENSIONS, 1, 1)


def test_a_step_sums_before_the_shuffle(data):
    _, df = data
    plan = lloyd.errors(df, DIMENSIONS, [[0.0, 0.0], [9.0, 9.0]])._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Join" not in plan
    assert lloyd.assign(df.where(F.col("id") < 0), DIMENSIONS, [[0.0, 0.0]]).count() == 0
