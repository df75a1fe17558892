"""Exact split search against Spark ML and against a plain search; forests and boosting on top of it."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from daytally.ml import regressors, splits
from daytally.ml.features import assembler

NAMES = ["a", "b", "c"]


def frame(spark, n=300, values=7, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, values, (n, 3)).astype(float)
    y = np.round(5 * x[:, 0] + (x[:, 1] > 3) * 17 + rng.integers(0, 9, n))
    return spark.createDataFrame([(i, *map(float, x[i]), float(y[i])) for i in range(n)], "id int, a double, b double, c double, label double"), x, y


def plain_tree(x, y, w, depth, looked=None, node=1):
    """Nodes by trying every split of every feature."""
    total, n = float((w * y).sum()), float(w.sum())
    out = {node: (None, None, n, total / n)}
    if not depth:
        return out
    best = None
    for f in looked(node) if looked else range(x.shape[1]):
        values = sorted(set(x[:, f]))
        for low, high in zip(values, values[1:]):
            left = x[:, f] <= low
            nl, sl = float(w[left].sum()), float((w * y)[left].sum())
            gain = sl * sl / nl + (total - sl) ** 2 / (n - nl) - total * total / n
            if gain > splits.LEAST_GAIN and (best is None or round(gain, 6) > best[0]):
                best = (round(gain, 6), f, (low + high) / 2)
    if best is None:
        return out
    _, f, threshold = best
    out[node] = (f, threshold, n, total / n)
    for child, side in ((2 * node, x[:, f] <= threshold), (2 * node + 1, x[:, f] > threshold)):
        out |= plain_tree(x[side], y[side], w[side], depth - 1, looked, child)
    return out


def as_dict(nodes, tree=0):
    return {r.node: (r.feature, r.threshold, r.n, r["mean"]) for r in nodes.collect() if r.tree == tree}


@pytest.mark.parametrize("depth", [1, 2])
def test_thresholds_and_means_are_those_of_spark(spark, tmp_path, depth):
    df, _, _ = frame(spark)
    DecisionTreeRegressor(maxDepth=depth).fit(assembler(NAMES).transform(df)).write().save(str(tmp_path / "m"))
    want = {r.node: (r.feature, r.threshold, r.days, r["mean"]) for r in regressors.tree_nodes(spark, str(tmp_path / "m")).collect()}
    rows = splits.training_rows(df, "id", NAMES)
    got = as_dict(splits.nodes(rows, splits.grow(rows, 3, depth)))
    assert got.keys() == want.keys()
    for node, (feature, threshold, n, mean) in got.items():
        assert (feature, threshold, n) == want[node][:3] and mean == pytest.approx(want[node][3], rel=1e-12)


@pytest.mark.parametrize(("values", "slices"), [(5, 64), (500, 64), (500, 3), (100_000, 8)])
def test_trees_are_those_of_a_plain_search(spark, monkeypatch, values, slices):
    """Whether the values of a feature are in one slice or in many."""
    monkeypatch.setattr(splits, "SLICES", slices)
    df, x, y = frame(spark, 400, values, 2)
    rows = splits.training_rows(df, "id", NAMES)
    assert as_dict(splits.nodes(rows, splits.grow(rows, 3, 3))) == plain_tree(x, y, np.ones(400), 3)  # sums of whole numbers are exact


def test_ties_and_constant_features_and_labels(spark):
    data = [(i, float(i % 2), float(i % 2), 1.0, float(i % 2)) for i in range(20)]
    df = spark.createDataFrame(data, "id int, a double, b double, c double, label double")
    rows = splits.training_rows(df, "id", NAMES)
    assert splits.grow(rows, 3, 4) == [(0, 1, 0, 0.5)]  # equal gains: the earlier feature; pure nodes are not split
    same = splits.training_rows(df.withColumn("label", F.lit(3.0)), "id", NAMES)
    assert splits.grow(same, 3, 2) == [] and as_dict(splits.nodes(same, [])) == {1: (None, None, 20.0, 3.0)}


def test_rows_with_gaps_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None, 1.0, 1.0, 1.0), (2, float("nan"), 1.0, 1.0, 1.0), (3, 1.0, 1.0, 1.0, None), (4, 1.0, 1.0, 1.0, 4.0)], "id int, a double, b double, c double, label double")
    assert [r.id for r in splits.training_rows(df, "id", NAMES).collect()] == [4]
    none = splits.training_rows(df.limit(0), "id", NAMES)
    assert splits.grow(none, 3, 2) == []


def test_a_common_value_is_summed_before_the_shuffle(spark):
    df = spark.range(0, 90_000, 1, 8).selectExpr("id", "case when id % 3 = 0 then 0.0 else double(id) end as a", "double(id % 5) as b", "1.0D as c", "double(id % 11) as label")
    rows = splits.training_rows(df, "id", NAMES)
    table = rows.withColumn("looked", F.array(F.lit(0), F.lit(1))).withColumn(splits.NODE, F.lit(1))
    plan = splits._best(table, splits._slices(rows, 3))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Window [sum(n" in plan
    assert len(splits.grow(rows, 3, 1)) == 1


def test_draws_follow_from_the_key(spark):
    keys = spark.range(3000).select(F.col("id").alias("key"), F.lit(2).alias("tree"))
    got = {r.key: r.n for r in keys.select("key", splits.draws(F.col("key"), F.col("tree")).alias("n")).collect()}
    for key, n in got.items():
        share, total, want = int(hashlib.md5(f"42:2:{key}".encode()).hexdigest()[:8], 16), 0.0, 0
        for i in range(8):
            total += math.exp(-1) / math.factorial(i)
            want += share >= int(total * 2**32)
        assert n == want
    assert abs(sum(got.values()) / 3000 - 1) < 0.06
    assert abs(sum(n == 0 for n in got.values()) / 3000 - math.exp(-1)) < 0.04


def test_forest_trees_are_plain_trees_on_the_same_draws(spark):
    df, x, y = frame(spark, 200, 50, 3)
    rows = splits.training_rows(df, "id", NAMES)
    found, nodes = splits.forest(rows, "id", 3, 3, 2)
    choose, each = splits.looked_at(3), {}
    for tree in range(3):
        w = np.array([r.n for r in df.orderBy("id").select(splits.draws(F.col("id"), F.lit(tree)).alias("n")).collect()], float)
        kept = w > 0
        each[tree] = plain_tree(x[kept], y[kept], w[kept], 2, lambda node, tree=tree: choose(tree, node))
        assert as_dict(nodes, tree) == each[tree]
    predictions = {(r.id, r.tree): r.prediction for r in splits.predict_trees(rows, 3, found, nodes).collect()}
    assert len(predictions) == 600
    for i in range(0, 200, 17):
        for tree, plain in each.items():
            node = 1
            while plain[node][0] is not None:
                node = 2 * node + (x[i, plain[node][0]] > plain[node][1])
            assert predictions[i, tree] == pytest.approx(plain[node][3])


def test_stage_errors_are_those_of_spark(spark):
    df, _, y = frame(spark)
    vectors = assembler(NAMES).transform(df)
    want = GBTRegressor(maxIter=4, maxDepth=2).fit(vectors).evaluateEachIteration(vectors, "squared")
    trees, ledger = splits.boost(splits.training_rows(df, "id", NAMES), "id", 3, 4, 2)
    got = {r.stage: r.rmse for r in splits.stage_errors(ledger).collect()}
    assert len(trees) == 4 and [got[i] ** 2 for i in range(4)] == pytest.approx(want, rel=1e-9)
    rows = ledger.collect()
    assert len(rows) == 4 * len(y) and all(r.residual == r.label - r.prediction and r.label == y[r.id] for r in rows)
