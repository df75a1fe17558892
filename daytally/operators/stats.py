"""Correlations and errors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.functions.numbers import as_percent, root_mean_square
from daytally.names import q, qcol, require_columns


def corr_with_target(df: DataFrame, measures: list[str], target: str) -> DataFrame:
    """``(measure, corr)``: Pearson correlation of every measure with the target.

    Each pair uses the rows where both values are present; a measure without
    variance has a null correlation.  One pass over the data.
    """
    require_columns(df, [*measures, target])
    aggs = []
    for i, m in enumerate(measures):
        both = qcol(m).isNotNull() & qcol(target).isNotNull()
        x = F.when(both, qcol(m).cast("double"))
        y = F.when(both, qcol(target).cast("double"))
        # A product of the deviations of 0 gives null instead of an error.
        spread = F.stddev_samp(x) * F.stddev_samp(y)
        aggs.append(F.try_divide(F.covar_samp(x, y), spread).alias(f"_c{i}"))
    # The measure names are column names of the one-row result, unpivoted to rows.
    one = df.agg(*aggs).select([F.col(f"_c{i}").alias(m) for i, m in enumerate(measures)])
    return one.unpivot([], [q(m) for m in measures], "measure", "corr")


def correlation_percent(corr: DataFrame, order: list[str]) -> DataFrame:
    """Correlations as percentages with one decimal, with their place in the chart."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("measure")).cast("int")
    shown = corr.filter(F.col("measure").isin(order))
    return shown.select(place.alias("place"), "measure", as_percent(F.col("corr")).alias("percent"))


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row with the root mean squared error."""
    return df.agg(root_mean_square(qcol(label) - qcol(prediction)).alias("rmse"))
