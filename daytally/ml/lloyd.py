"""K-Means with a seeding and steps that any engine can repeat.

The first centres are the rows with the lowest digests of their key.  A step
gives every row to its nearest centre (ties to the lower number) and moves each
centre to the mean of its rows; one without rows stays.  A step is one
aggregate with a partial step per task; the driver holds the centres, at most
``MAX_K`` of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.ml.clusters import MAX_K, MIN_K
from daytally.ml.features import SEED
from daytally.names import qcol

Centres = list[list[float]]


def seeds(points: DataFrame, key: str, dimensions: list[str], k: int, seed: int = SEED) -> Centres:
    """Coordinates of the ``k`` rows with the lowest digests; fewer if there are fewer rows."""
    if not MIN_K <= k <= MAX_K:
        raise ValueError(f"k must be between {MIN_K} and {MAX_K}, got {k}")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), qcol(key).cast("string")).cast("binary"))
    found = points.orderBy(digest, qcol(key)).limit(k).select(*[qcol(d).cast("double") for d in dimensions]).collect()
    return [list(r) for r in found]


def _whole(points: DataFrame, dimensions: list[str]) -> DataFrame:
    return points.filter(reduce(lambda a, b: a & b, [qcol(d).isNotNull() for d in dimensions]))


def _nearest(dimensions: list[str], centres: Centres) -> Column:
    """Squared distance to the nearest centre, and its number."""

    def entry(centre: Column, number: Column) -> Column:
        apart = [qcol(d).cast("double") - centre[i] for i, d in enumerate(dimensions)]
        return F.struct(sum((a * a for a in apart[1:]), apart[0] * apart[0]).alias("distance"), number.alias("cluster"))

    return F.array_min(F.transform(F.array(*[F.array(*map(F.lit, c)) for c in centres]), entry))


def assign(points: DataFrame, dimensions: list[str], centres: Centres) -> DataFrame:
    """The points with ``cluster`` and ``distance`` (squared)."""
    found = points.withColumn("_nearest", _nearest(dimensions, centres))
    return found.withColumns({c: F.col("_nearest").getField(c) for c in ("cluster", "distance")}).drop("_nearest")


def step(points: DataFrame, dimensions: list[str], centres: Centres) -> Centres:
    """The centres after one step."""
    means = assign(points, dimensions, centres).groupBy("cluster").agg(*[F.avg(qcol(d).cast("double")).alias(f"_{i}") for i, d in enumerate(dimensions)])
    moved = {r[0]: list(r[1:]) for r in means.collect()}  # at most one row per centre
    return [moved.get(i, c) for i, c in enumerate(centres)]


def fit(points: DataFrame, key: str, dimensions: list[str], k: int, steps: int, seed: int = SEED) -> Centres:
    """Centres after a fixed number of steps; rows with a null coordinate take no part."""
    whole = _whole(points, dimensions)
    centres = seeds(whole, key, dimensions, k, seed)
    for _ in range(steps if centres else 0):
        centres = step(whole, dimensions, centres)
    return centres


def errors(points: DataFrame, dimensions: list[str], centres: Centres) -> DataFrame:
    """``(cluster, days, error)``: rows and sum of squared distances of every centre that has rows."""
    assigned = assign(_whole(points, dimensions), dimensions, centres)
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("days"), F.sum("distance").alias("error"))
