"""K-Means over the daily vectors.

The vector includes the daily total and is not scaled unless asked for.  The
centres are the only thing on the driver: at most 100 rows of seven numbers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.ml.features import SEED, scale_to_unit_deviation
from daytally.names import q, qcol
from daytally.operators.daily import TOTAL
from daytally.operators.series import MEASURES

DIMENSIONS = [*MEASURES, TOTAL]
MIN_K, MAX_K, DEFAULT_K = 2, 100, 6


def fit(points: DataFrame, k: int = DEFAULT_K, seed: int = SEED, features: str = "features") -> KMeansModel:
    if not MIN_K <= k <= MAX_K:
        raise ValueError(f"k must be between {MIN_K} and {MAX_K}, got {k}")
    return KMeans(k=k, seed=seed, featuresCol=features).fit(points)


def fit_scaled(points: DataFrame, k: int = DEFAULT_K, seed: int = SEED) -> tuple[KMeansModel, DataFrame]:
    """Fit on vectors of unit standard deviation; returns them as well."""
    _, scaled = scale_to_unit_deviation(points)
    return fit(scaled, k, seed, "scaled"), scaled


def center_records(spark: SparkSession, model: KMeansModel, names: list[str] = DIMENSIONS) -> DataFrame:
    """One record per centre: ``cluster`` and a column per dimension."""
    rows = [(i, *[float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster int, " + ", ".join(f"{q(n)} double" for n in names))


def centers(spark: SparkSession, model: KMeansModel, names: list[str] = DIMENSIONS) -> DataFrame:
    """``(cluster, feature, value)``."""
    return center_records(spark, model, names).unpivot(["cluster"], [q(n) for n in names], "feature", "value")


def assign(points: DataFrame, model: KMeansModel) -> DataFrame:
    """The points with the number of their cluster."""
    return model.transform(points).withColumnRenamed("prediction", "cluster")


def coordinates(assigned: DataFrame, keep: list[str], names: list[str] = DIMENSIONS, features: str = "features") -> DataFrame:
    """One double column per dimension."""
    values = vector_to_array(F.col(features))
    return assigned.select(*keep, *[values[i].alias(n) for i, n in enumerate(names)])


def squared_error(rows: DataFrame, spark: SparkSession, model: KMeansModel, names: list[str] = DIMENSIONS) -> DataFrame:
    """Add ``error``: squared distance of each row's coordinates to its cluster's centre.

    The broadcast side has one row per cluster, at most ``MAX_K``.
    """
    slots = [f"_c{i}" for i in range(len(names))]
    table = center_records(spark, model, slots)
    joined = rows.join(F.broadcast(table), "cluster")
    parts = [(qcol(n) - F.col(s)) * (qcol(n) - F.col(s)) for n, s in zip(names, slots)]
    return joined.withColumn("error", reduce(lambda a, b: a + b, parts)).drop(*slots)


def wssse(spark: SparkSession, assigned: DataFrame, model: KMeansModel) -> DataFrame:
    """One row with the within-set sum of squared errors, from the assigned points."""
    rows = squared_error(coordinates(assigned, ["cluster"]), spark, model)
    return rows.agg(F.sum("error").alias("wssse"))


def training_wssse(model: KMeansModel) -> float:
    """The figure the fit recorded, which is the one before its last step."""
    return model.summary.trainingCost


def scatter_points(assigned: DataFrame, day: str = "date") -> DataFrame:
    """``(cluster, day, Tavg, crimes, precip)``, one row per day."""
    rows = coordinates(assigned, [day, "cluster"])
    return rows.select(
        "cluster", day, "Tavg", qcol(TOTAL).alias("crimes"), F.col("PrecipTotal").alias("precip")
    )


def cluster_series(points: DataFrame, day: str = "date") -> DataFrame:
    """The points as named series: one row per point, grouped by the series name.

    A list of points per cluster would gather a cluster of any size in one
    task; sorted rows carry the same data and stay distributed.
    """
    named = points.withColumn("name", F.concat(F.lit("Cluster"), F.col("cluster").cast("string")))
    return named.select("name", day, "Tavg", "crimes", "precip").orderBy("name", day)
