"""The questions the dashboards ask, as functions from tables to tables.

``weather`` has one row per day with a ``date`` and the six measures; ``wide``
is the wide daily table; ``days`` is their join, stored beforehand.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.days import format_long_day
from daytally.functions.groups import SERIES_GROUPS
from daytally.functions.text import decode_slug_text
from daytally.ml import clusters, features, regressors
from daytally.names import qcol
from daytally.operators.daily import DAY, TOTAL
from daytally.operators.joins import overlay
from daytally.operators.series import (
    MEASURES,
    default_row_if_empty,
    project_field,
    project_measures,
    recent_days,
    series_rows,
    sort_by_day,
    unpivot,
)
from daytally.operators.stats import corr_with_target, correlation_percent
from daytally.sources.json_docs import forecast_days, history_days, next_days_by_key

# The sort key has a two-digit year, so the year goes first.
BY_DAY = ["Year", "Date"]

# Order of the measures in the correlation chart.
CHART_ORDER = ["Tavg", "Tmin", "Tmax", "Depart", "PrecipTotal", "Heat"]


def weather_data(weather: DataFrame) -> DataFrame:
    """All measures by day; one row of zeros when there are none."""
    rows = series_rows(weather, DAY, {m: "double" for m in MEASURES})
    return sort_by_day(default_row_if_empty(rows), *BY_DAY)


def weather_field(weather: DataFrame, field: str) -> DataFrame:
    """One measure by day."""
    return sort_by_day(default_row_if_empty(project_field(weather, DAY, field)), *BY_DAY)


def crime_data(wide: DataFrame) -> DataFrame:
    """All counts by day; an empty table stays empty."""
    counts = {c: "bigint" for c in wide.columns if c != DAY}
    return sort_by_day(series_rows(wide, DAY, counts), *BY_DAY)


def crime_field(wide: DataFrame, slug: str) -> DataFrame:
    """One count by day, asked for and returned under its short name."""
    rows = project_field(wide, DAY, decode_slug_text(slug), slug)
    return sort_by_day(default_row_if_empty(rows), *BY_DAY)


def group_series(table: DataFrame, group: str) -> DataFrame:
    """``(date, category, n)`` of the series one page shows together; only their columns are read."""
    if group not in SERIES_GROUPS:
        raise ValueError(f"unknown group {group!r}; known: {list(SERIES_GROUPS)}")
    names = [decode_slug_text(slug) for slug in SERIES_GROUPS[group]]
    values = project_measures(table, DAY, names).select(DAY, *[qcol(n).cast("double").alias(n) for n in names])
    return sort_by_day(unpivot(values, DAY, names), DAY)


def past_weather(docs: DataFrame, doc: str, day: str, asof: Column, days: int = 5) -> DataFrame:
    """Measures of the last days from their history documents, latest first."""
    recent = recent_days(docs, day, asof, days).orderBy(F.desc(day))
    return history_days(recent, doc, F.col(day))


def forecast(docs: DataFrame, doc: str, asof: Column, days: int = 5) -> DataFrame:
    """The next days from a forecast document, ``asof`` included."""
    rows = forecast_days(docs, doc, asof, days)
    return rows.orderBy("day").withColumn("Date", format_long_day(F.col("day"))).drop("day")


def forecast_by_key(docs: DataFrame, key: str, doc: str, issued: Column, today: Column, days: int = 5) -> DataFrame:
    """The next days of every key from all its forecast documents."""
    rows = next_days_by_key(docs, key, doc, issued, today, days)
    return rows.withColumn("Date", format_long_day(F.col("day"))).drop("day")


def temperature_and_total(weather: DataFrame, wide: DataFrame) -> DataFrame:
    """Mean temperature and total on one time axis."""
    return sort_by_day(overlay(weather.select(DAY, "Tavg"), wide.select(DAY, f"`{TOTAL}`"), DAY), DAY)


def correlations(days: DataFrame) -> DataFrame:
    """Correlation of every measure, and of the total itself, with the total."""
    return corr_with_target(days, [*MEASURES, TOTAL], TOTAL)


def correlation_chart(days: DataFrame) -> DataFrame:
    return correlation_percent(correlations(days), CHART_ORDER)


def regression(days: DataFrame, name: str, model: PipelineModel | None = None) -> dict[str, DataFrame]:
    """Actual and predicted totals by day, and the training error."""
    model = model or regressors.fit(name, days)
    out = {"predictions": regressors.predict(model, days), "rmse": regressors.model_rmse(model, days)}
    if name != regressors.LINEAR:
        out["summary"] = regressors.summary(days.sparkSession, {name: model})
    return out


def kmeans(days: DataFrame, k: int = clusters.DEFAULT_K) -> dict[str, DataFrame]:
    """Points by cluster, centres, and the within-set sum of squared errors."""
    spark: SparkSession = days.sparkSession
    points = features.cluster_frame(days)
    model = clusters.fit(points, k)
    assigned = clusters.assign(points, model)
    return {
        "clusters": clusters.cluster_series(clusters.scatter_points(assigned)),
        "centers": clusters.centers(spark, model),
        "wssse": clusters.wssse(spark, assigned, model),
    }


def predictive_data(days: DataFrame, k: int = clusters.DEFAULT_K) -> dict[str, dict[str, DataFrame] | DataFrame]:
    """Everything the predictive page shows."""
    models = regressors.fit_models(days)
    out: dict[str, dict[str, DataFrame] | DataFrame] = {n: regression(days, n, m) for n, m in models.items()}
    out["kmeans"] = kmeans(days, k)
    out["corr"] = correlations(days)
    return out
