"""Four regression models of the daily total on the weather measures.

Fits run on Spark ML over a feature table that the caller has stored, one row
per day.  Results are tables keyed by day; nothing that grows with the data
comes to the driver.
"""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.numbers import root_mean_square
from daytally.ml.features import SEED, assembler, category_indexer, labelled, split
from daytally.operators.series import MEASURES
from daytally.operators.stats import rmse

LINEAR, GBT, FOREST, TREE = "linear", "gbt", "random_forest", "decision_tree"
MODELS = [LINEAR, GBT, TREE, FOREST]
REG_PARAM = 0.3
GBT_ROUNDS = 10

# Fits that are submitted at the same time; each is a chain of short jobs.
PARALLEL_FITS = 4


def stages(name: str, inputs: list[str] = MEASURES, seed: int = SEED, reg_param: float = REG_PARAM) -> list:
    """Assembler, indexer (tree models) and estimator."""
    if name == LINEAR:
        return [assembler(inputs), LinearRegression(regParam=reg_param)]
    trees = {
        GBT: lambda: GBTRegressor(featuresCol="indexedFeatures", maxIter=GBT_ROUNDS, seed=seed),
        FOREST: lambda: RandomForestRegressor(featuresCol="indexedFeatures", seed=seed),
        TREE: lambda: DecisionTreeRegressor(featuresCol="indexedFeatures", seed=seed),
    }
    if name not in trees:
        raise ValueError(f"unknown model {name!r}; known: {MODELS}")
    return [assembler(inputs), category_indexer(), trees[name]()]


def fit(name: str, days: DataFrame, inputs: list[str] = MEASURES, **params) -> PipelineModel:
    """Fit on all given days; ``days`` holds the measures and the total."""
    return Pipeline(stages=stages(name, inputs, **params)).fit(labelled(days))


def fit_all(requests: list[tuple[str, DataFrame]]) -> list[PipelineModel]:
    """Independent fits, side by side; the order of the results is that of the requests."""
    if not requests:
        return []
    run = inheritable_thread_target(requests[0][1].sparkSession)(lambda request: fit(*request))
    with ThreadPool(min(PARALLEL_FITS, len(requests))) as pool:
        return pool.map(run, requests)


def fit_models(days: DataFrame, names: list[str] = MODELS) -> dict[str, PipelineModel]:
    """Several models on the same days."""
    return dict(zip(names, fit_all([(n, days) for n in names])))


def predict(model: PipelineModel, days: DataFrame, day: str = "date") -> DataFrame:
    """``(day, actual, prediction)``."""
    scored = model.transform(labelled(days))
    return scored.select(day, F.col("label").alias("actual"), "prediction")


def score_new_days(model: PipelineModel, new_days: DataFrame, day: str = "date") -> DataFrame:
    """``(day, prediction)`` for days without a total."""
    return model.transform(new_days).select(day, "prediction")


def save(model: PipelineModel, path: str) -> str:
    """Write a fitted model to a path that must not exist yet, as a job's result that later jobs score with."""
    model.write().save(path)
    return path


def load(spark: SparkSession, path: str) -> PipelineModel:
    """A model that an earlier job or another session has written."""
    return PipelineModel.read().session(spark).load(path)


def fit_predict(name: str, days: DataFrame, day: str = "date") -> DataFrame:
    """Predictions for the same days the model is fitted on."""
    return predict(fit(name, days), days, day)


def model_rmse(model: PipelineModel, days: DataFrame) -> DataFrame:
    return rmse(predict(model, days), "actual", "prediction")


def predictions_by_model(models: dict[str, PipelineModel], days: DataFrame, day: str = "date") -> DataFrame:
    """``(day, model, actual, prediction)``."""
    parts = [predict(m, days, day).select(day, F.lit(n).alias("model"), "actual", "prediction") for n, m in models.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def predictions_beside(models: dict[str, PipelineModel], days: DataFrame, day: str = "date") -> DataFrame:
    """``(day, actual, <one column per model>)``: each model adds its column to the same rows, so nothing is joined."""
    rows = labelled(days)
    for name, model in models.items():
        rows = model.transform(rows).withColumnRenamed("prediction", name).drop("features", "indexedFeatures")
    return rows.select(day, F.col("label").alias("actual"), *models)


def leaderboard(days: DataFrame, day: str = "date", names: list[str] = MODELS) -> DataFrame:
    """``(model, split, days, rmse)``.

    ``train``: fitted and measured on all days.  ``holdout``: fitted on the
    training part, measured on the rest.
    """
    train, held = split(days, day)
    parts = {"train": (days, days), "holdout": (train, held)}
    wanted = [(name, part) for name in names for part in parts]
    models = fit_all([(name, parts[part][0]) for name, part in wanted])
    rows = []
    for (name, part), model in zip(wanted, models):
        error = root_mean_square(F.col("actual") - F.col("prediction"))
        row = predict(model, parts[part][1], day).agg(F.count(F.lit(1)).alias("days"), error.alias("rmse"))
        rows.append(row.select(F.lit(name).alias("model"), F.lit(part).alias("split"), "days", "rmse"))
    return reduce(lambda a, b: a.unionByName(b), rows)


def summary(spark: SparkSession, models: dict[str, PipelineModel]) -> DataFrame:
    """``(model, num_trees, depth, total_nodes, num_features)`` of the tree models."""
    rows = []
    for name, fitted in models.items():
        last = fitted.stages[-1]
        if name == TREE:
            rows.append((name, 1, last.depth, last.numNodes, last.numFeatures))
        elif name in (GBT, FOREST):
            depth = max(t.depth for t in last.trees)
            rows.append((name, last.getNumTrees, depth, last.totalNumNodes, last.numFeatures))
    schema = "model string, num_trees int, depth int, total_nodes int, num_features int"
    return spark.createDataFrame(rows, schema)


def tree_nodes(spark: SparkSession, path: str) -> DataFrame:
    """``(node, feature, threshold, days, mean)`` of a stored decision tree over numbers: node 1 is the root, 2i and 2i + 1 are below i.

    Read from the stored form of the model; a tree has a few dozen nodes.
    """
    stored = {r.id: r for r in spark.read.parquet(f"{path}/data").collect()}
    rows, todo = [], [(0, 1)] if stored else []
    while todo:
        number, node = todo.pop()
        r = stored[number]
        inner = r.leftChild >= 0
        split = (r.split.featureIndex, float(r.split.leftCategoriesOrThreshold[0])) if inner else (None, None)
        rows.append((node, *split, int(r.rawCount), float(r.prediction)))
        todo += [(r.leftChild, 2 * node), (r.rightChild, 2 * node + 1)] if inner else []
    return spark.createDataFrame(rows, "node int, feature int, threshold double, days long, mean double")


def coefficients(spark: SparkSession, model: PipelineModel, inputs: list[str] = MEASURES) -> DataFrame:
    """``(term, value)`` of the linear model, the intercept last."""
    last = model.stages[-1]
    rows = [(n, float(v)) for n, v in zip(inputs, last.coefficients)] + [("intercept", float(last.intercept))]
    return spark.createDataFrame(rows, "term string, value double")
