from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from daytally.ml import clusters, features, regressors
from daytally.operators.daily import TOTAL
from daytally.operators.series import MEASURES


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    n = 300
    x = np.column_stack(
        [rng.normal(0, 8, n), rng.integers(0, 40, n), rng.exponential(0.2, n), rng.normal(55, 20, n), rng.normal(65, 20, n), rng.normal(45, 20, n)]
    )
    y = np.round(800 + 3 * x[:, 3] - 20 * x[:, 2] + rng.normal(0, 30, n))
    return x, y


@pytest.fixture(scope="module")
def days(spark, data):
    x, y = data
    rows = [(dt.date(2005, 1, 1) + dt.timedelta(i), *map(float, x[i]), int(y[i])) for i in range(len(y))]
    cols = ", ".join(f"{m} double" for m in MEASURES)
    return spark.createDataFrame(rows, f"date date, {cols}, `{TOTAL}` bigint").cache()


def test_ridge_matches_the_closed_form(spark, days, data):
    x, y = data
    model = regressors.fit(regressors.LINEAR, days)
    sx, sy = x.std(0), y.std()
    cov = np.cov(x.T, bias=True) + np.diag(0.3 / sy * sx**2)
    beta = np.linalg.solve(cov, ((x - x.mean(0)) * (y - y.mean())[:, None]).mean(0))
    got = {r.term: r.value for r in regressors.coefficients(spark, model).collect()}
    assert [got[m] for m in MEASURES] == pytest.approx(list(beta), rel=1e-8)
    assert got["intercept"] == pytest.approx(y.mean() - beta @ x.mean(0), rel=1e-8)


def test_predictions_keep_their_day(days, data):
    _, y = data
    rows = regressors.fit_predict(regressors.TREE, days).collect()
    assert {r.date: r.actual for r in rows} == {dt.date(2005, 1, 1) + dt.timedelta(i): float(v) for i, v in enumerate(y)}


@pytest.mark.parametrize("name", regressors.MODELS)
def test_fits_are_repeatable_and_better_than_the_mean(days, data, name):
    one = {r.date: r.prediction for r in regressors.fit_predict(name, days).collect()}
    two = {r.date: r.prediction for r in regressors.fit_predict(name, days).collect()}
    assert one == two and len(one) == 300
    assert regressors.model_rmse(regressors.fit(name, days), days).first().rmse < data[1].std()


def test_unknown_model(days):
    with pytest.raises(ValueError, match="unknown model"):
        regressors.fit("svm", days)


def test_rows_with_null_are_skipped(days):
    holes = days.withColumn("Heat", F.when(F.dayofmonth("date") != 1, F.col("Heat")))
    assert features.feature_frame(holes).count() == holes.filter("Heat is not null").count() < 300


def test_indexer_codes(spark):
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate([-2.0, 0.0, 3.0, 0.0, -2.0, 3.0])], "a double, b double")
    vectors = features.assembler(["a", "b"]).transform(df)
    fitted = features.category_indexer().fit(vectors)
    coded = fitted.transform(vectors).select("a", vector_to_array("indexedFeatures").alias("x"))
    assert {(r.a, r.x[0]) for r in coded.collect()} == {(0.0, 0.0), (-2.0, 1.0), (3.0, 2.0)}
    unseen = features.assembler(["a", "b"]).transform(spark.createDataFrame([(9.0, 1.0)], "a double, b double"))
    assert fitted.transform(unseen).count() == 1


def test_split_is_disjoint_complete_and_stable(days):
    train, held = features.split(days)
    a, b = {r.date for r in train.collect()}, {r.date for r in held.collect()}
    assert not a & b and len(a | b) == 300 and 0.55 < len(a) / 300 < 0.85
    again, _ = features.split(days.repartition(7, "Tavg"))
    assert {r.date for r in again.collect()} == a


@pytest.mark.parametrize("share", [0, 1, 1.5])
def test_share_is_checked(days, share):
    with pytest.raises(ValueError, match="between 0 and 1"):
        features.split(days, share=share)


def test_share_is_met(spark):
    train, _ = features.split(spark.range(20000), "id")
    assert abs(train.count() / 20000 - 0.7) < 0.02
    other, _ = features.split(spark.range(20000), "id", seed=7)
    assert train.join(other, "id").count() < 0.6 * 20000


def test_leaderboard(days, data):
    board = {(r.model, r.split): r for r in regressors.leaderboard(days).collect()}
    assert len(board) == 8
    for name in regressors.MODELS:
        assert board[name, "train"].days == 300
        assert 0 < board[name, "holdout"].days < 300
    want = regressors.model_rmse(regressors.fit(regressors.GBT, days), days).first().rmse
    assert board[regressors.GBT, "train"].rmse == pytest.approx(want)


def test_summary(spark, days):
    models = {n: regressors.fit(n, days) for n in (regressors.TREE, regressors.FOREST)}
    rows = {r.model: r for r in regressors.summary(spark, models).collect()}
    assert rows["decision_tree"].num_trees == 1 and rows["random_forest"].num_trees == 20
    assert all(1 <= r.depth <= 5 and r.num_features == 6 for r in rows.values())


def test_predictions_by_model(days):
    models = {n: regressors.fit(n, days) for n in (regressors.LINEAR, regressors.TREE)}
    out = regressors.predictions_by_model(models, days)
    assert {r.model: r["count"] for r in out.groupBy("model").count().collect()} == {"linear": 300, "decision_tree": 300}


def test_new_days_need_no_total(spark, days):
    model = regressors.fit(regressors.FOREST, days)
    new = spark.createDataFrame([(dt.date(2018, 1, 1), 2.0, 0.0, 1.11, 73.0, 80.0, 66.0)], "date date, " + ", ".join(f"{m} double" for m in MEASURES))
    rows = regressors.score_new_days(model, new).collect()
    assert len(rows) == 1 and rows[0].prediction > 0


def test_kmeans(spark, days):
    points = features.cluster_frame(days)
    model = clusters.fit(points, 4)
    assigned = clusters.assign(points, model)
    rows = clusters.coordinates(assigned, ["date", "cluster"]).collect()
    x = np.array([[r[n] for n in clusters.DIMENSIONS] for r in rows])
    c = np.array([list(v) for v in model.clusterCenters()])
    dist = ((x[:, None, :] - c[None]) ** 2).sum(2)
    assert [r.cluster for r in rows] == list(dist.argmin(1))
    assert clusters.wssse(spark, assigned, model).first().wssse == pytest.approx(dist.min(1).sum())
    table = {(r.cluster, r.feature): r.value for r in clusters.centers(spark, model).collect()}
    assert len(table) == 28 and table[2, TOTAL] == c[2][6]
    again = clusters.fit(points, 4).clusterCenters()
    assert np.array_equal(np.array(again), c)


@pytest.mark.parametrize("k", [1, 101, 0])
def test_k_is_checked(days, k):
    with pytest.raises(ValueError, match="between 2 and 100"):
        clusters.fit(features.cluster_frame(days), k)


def test_scaled_kmeans(days):
    model, scaled = clusters.fit_scaled(features.cluster_frame(days), 3)
    assert len(model.clusterCenters()) == 3
    sd = scaled.select(vector_to_array("scaled")[6].alias("x")).agg(F.stddev_samp("x")).first()[0]
    assert sd == pytest.approx(1.0)


def test_series_rows(days):
    points = features.cluster_frame(days)
    assigned = clusters.assign(points, clusters.fit(points, 3))
    rows = clusters.cluster_series(clusters.scatter_points(assigned)).collect()
    assert len(rows) == 300 and {r.name for r in rows} == {"Cluster0", "Cluster1", "Cluster2"}
    assert [(r.name, r.date) for r in rows] == sorted((r.name, r.date) for r in rows)


def test_predictions_beside_need_no_join(days):
    models = regressors.fit_models(days, [regressors.LINEAR, regressors.TREE])
    beside = regressors.predictions_beside(models, days)
    assert beside.columns == ["date", "actual", regressors.LINEAR, regressors.TREE]
    assert "Join" not in beside._jdf.queryExecution().executedPlan().toString()
    for name, model in models.items():
        alone = regressors.predict(model, days)
        assert beside.select("date", "actual", name).exceptAll(alone).isEmpty()
        assert alone.exceptAll(beside.select("date", "actual", name)).isEmpty()


SCORE = """
import sys
from pyspark.sql import SparkSession
from daytally.ml import regressors
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
days = spark.read.parquet(sys.argv[2])
regressors.score_new_days(regressors.load(spark, sys.argv[1]), days).write.parquet(sys.argv[3])
"""


def test_a_stored_model_scores_in_another_process(spark, days, tmp_path):
    for name in (regressors.LINEAR, regressors.GBT):
        model, base = regressors.fit(name, days), str(tmp_path / name)
        regressors.save(model, f"{base}-model")
        with pytest.raises(Exception, match="(?i)exist"):
            regressors.save(model, f"{base}-model")
        days.drop(TOTAL).write.parquet(f"{base}-days")
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        run = [sys.executable, "-c", SCORE, f"{base}-model", f"{base}-days", f"{base}-scores"]
        subprocess.run(run, check=True, env={**os.environ, "PYTHONPATH": root}, timeout=300)
        stored = {r.date: r.prediction for r in spark.read.parquet(f"{base}-scores").collect()}
        assert stored == {r.date: r.prediction for r in regressors.score_new_days(model, days).collect()} and len(stored) == 300
