"""Centroid clustering with integer vectors and a bounded, shrinking search.

Every vector remembers its nearest and second-nearest centroid, an upper bound
of the distance to the first and a lower bound of the distance to any other.
A round moves the bounds by how far the centroids went; where they still part,
the nearest centroid has not changed and nothing is computed.  Else both
remembered centroids are measured, and the search starts from the closer one:
its neighbours are visited in order of their distance from it, inside a ball
whose radius is the distance to it plus that to the second-nearest one found so
far, so the ball shrinks as the search goes on.  Bounds are floats rounded
outwards; whatever survives them is compared by exact integer distances.

The vectors stay where they are: a round is one narrow pass over a written
table, and one row per task and centroid goes to the sums.  The driver holds
the centroids, a number of integers fixed by the parameters.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.scratch import materialize

DIMENSIONS, CENTROIDS, ROUNDS, SCALE, SALT = 64, 16, 3, 64, "1:"
#: Relative error granted to float bounds; the square root of an exact integer has far less.
SLACK = 1e-9

_STATE = "vec_id long, point array<int>, cluster int, second int, upper double, lower double"
CLUSTERED = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def reach(dimensions: int) -> int:
    """Integer components below this in size keep every squared distance inside 64 bits."""
    return math.isqrt(2**62 // max(1, dimensions)) // 2


def integer_vectors(vectors: DataFrame, dimensions: int, scale: int) -> DataFrame:
    """``vec_id`` and ``point``, the components times ``scale`` rounded down, of the vectors that take part."""
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("given"))
    most = reach(dimensions) / scale
    fits = F.forall("given", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < most))
    return given.where((F.size("given") == dimensions) & fits).select(
        "vec_id", F.transform("given", lambda x: F.floor(x * float(scale)).cast("int")).alias("point")
    )


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` from ``y`` (a row or one row each)."""
    apart = x - y
    return np.einsum("ij,ij->i", apart, apart)


class Centroids:
    """The centroids of one round, their neighbours in order, and how far each moved since the last one."""

    def __init__(self, now: np.ndarray, before: np.ndarray | None):
        self.now = now
        k = len(now)
        self.gaps = np.stack([np.sqrt(squared(now, c)) for c in now]) * (1 - SLACK)
        self.neighbours = [[j for j in np.argsort(row, kind="stable").tolist() if j != c] for c, row in enumerate(self.gaps)]
        self.moved = np.full(k, np.inf) if before is None else np.sqrt(squared(now, before)) * (1 + SLACK)
        self.other_moved = np.array([np.max(np.delete(self.moved, c), initial=0.0) for c in range(k)])

    def assign(self, x: np.ndarray, first: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> None:
        """Bring the assignment of the rows of ``x`` and its bounds up to these centroids, in place."""
        upper += self.moved[first]
        lower -= self.other_moved[first]
        if len(self.now) == 1:
            return
        rows = np.flatnonzero(~(upper < lower))
        near = squared(x[rows], self.now[first[rows]])
        upper[rows] = np.sqrt(near) * (1 + SLACK)
        still = ~(upper[rows] < lower[rows])
        rows, near = rows[still], near[still]
        far = squared(x[rows], self.now[second[rows]])
        a, b = first[rows], second[rows]
        turn = (far < near) | ((far == near) & (b < a))
        a, b = np.where(turn, b, a), np.where(turn, a, b)
        near, far = np.where(turn, far, near), np.where(turn, near, far)
        for start in np.unique(a):
            here = np.flatnonzero(a == start)
            a[here], b[here], near[here], far[here] = self._ball(int(start), x[rows[here]], b[here], near[here], far[here])
        first[rows], second[rows] = a, b
        upper[rows], lower[rows] = np.sqrt(near) * (1 + SLACK), np.sqrt(far) * (1 - SLACK)

    def _ball(self, start: int, x: np.ndarray, b: np.ndarray, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, ...]:
        """The two nearest centroids of each row, searched from ``start`` outwards; ``b`` is measured already."""
        a, known = np.full(len(x), start), b.copy()
        from_start = np.sqrt(near) * (1 + SLACK)
        radius = from_start + np.sqrt(far) * (1 + SLACK)
        inside = np.arange(len(x))
        for j in self.neighbours[start]:
            inside = inside[self.gaps[start, j] <= radius[inside]]
            if not len(inside):
                break
            rows = inside[known[inside] != j]
            d = squared(x[rows], self.now[j])
            best = (d < near[rows]) | ((d == near[rows]) & (j < a[rows]))
            rows_best, rows_next = rows[best], rows[~best & (d < far[rows])]
            far[rows_best], b[rows_best] = near[rows_best], a[rows_best]
            near[rows_best], a[rows_best] = d[best], j
            far[rows_next], b[rows_next] = d[~best & (d < far[rows])], j
            radius[rows] = from_start[rows] + np.sqrt(far[rows]) * (1 + SLACK)
        return a, b, near, far


def _matrix(column: pa.ListArray, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions).astype(np.int64)


def _assigned(state: DataFrame, centroids: Centroids, distances: bool) -> DataFrame:
    """The state after one round, or ids with cluster and exact distance."""
    dimensions = centroids.now.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dimensions)
            first, second, upper, lower = (batch.column(i).to_numpy(zero_copy_only=False).copy() for i in range(2, 6))
            centroids.assign(x, first, second, upper, lower)
            if distances:
                columns = [batch.column(0), pa.array(first), pa.array(squared(x, centroids.now[first]))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])
            else:
                columns = [batch.column(0), batch.column(1), *map(pa.array, (first, second, upper, lower))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "point", "cluster", "second", "upper", "lower"])

    return state.mapInArrow(run, "vec_id long, cluster int, distance long" if distances else _STATE)


def _replaced(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid's exact mean rounded down; one without vectors stays."""
    k, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for batch in batches:
            first = batch.column(0).to_numpy(zero_copy_only=False)
            x = _matrix(batch.column(1), dimensions)
            for c in np.unique(first):
                rows = x[first == c]
                count[c] += len(rows)
                total[c] += rows.sum(axis=0)
        used = np.flatnonzero(count)
        columns = [pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(total[used].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "total"])

    parts = state.select("cluster", "point").mapInArrow(run, "cluster int, n long, total array<long>")
    cells = parts.select("cluster", "n", F.posexplode("total").alias("at", "part"))
    sums = cells.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(20,0)")).alias("total"))
    out = centroids.copy()
    for r in sums.collect():  # one row for each component of a centroid
        out[r.cluster, r.at] = int(r.total) // r.n
    return out


def _fits(n: int) -> int | None:
    return n if n < 2**63 else None


def cluster(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, salt: str = SALT
) -> DataFrame:
    """Nearest of ``k`` centroids for each vector, after ``rounds`` rounds of assigning and averaging.

    ``vectors`` has ``vec_id`` and ``embedding`` (array of numbers); other
    columns are ignored.  Every component becomes the integer
    ``floor(scale * component)``.  The first centroids are the vectors whose
    ``sha256(salt + vec_id)`` is smallest (ids that repeat: the smaller vector;
    null ids last).  Assignment is by squared distance, ties to the smaller
    number; averages are exact and rounded down; a centroid without vectors
    stays where it is.

    Result: ``vec_id``, ``cluster``, ``distance`` (squared), the sums of
    distances ``cluster_inertia`` and ``inertia`` (null beyond 64 bits) and
    ``centroid_sha256``, the digest of the final centroid's components as
    decimal integers joined by commas.

    Vectors that are null, of another length, or hold null, non-finite or huge
    components (``reach``: beyond that a squared distance exceeds 64 bits) take
    no part.  Repeated rows are vectors of their own; a null id stays null.
    With fewer vectors than ``k`` there is one centroid for each; an empty
    table gives an empty result.
    """
    spark = vectors.sparkSession
    points = integer_vectors(vectors, dimensions, scale)
    order = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    seeds = points.orderBy(order.asc_nulls_last(), "point").limit(k).collect()
    if not seeds:
        return spark.createDataFrame([], CLUSTERED)
    now, before = np.array([r.point for r in seeds], np.int64), None
    state = points.select(
        "vec_id",
        "point",
        F.lit(0).alias("cluster"),
        F.lit(min(1, len(seeds) - 1)).alias("second"),
        F.lit(0.0).alias("upper"),
        F.lit(float("inf") if len(seeds) == 1 else 0.0).alias("lower"),
    )
    for _ in range(rounds):
        state = materialize(_assigned(state, Centroids(now, before), False), "assigned")
        now, before = _replaced(state, now), now
    found = materialize(_assigned(state, Centroids(now, before), True), "clustered")
    sums = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    facts = spark.createDataFrame(
        [
            (c, _fits(total), _fits(sum(sums.values())), hashlib.sha256(",".join(map(str, now[c].tolist())).encode()).hexdigest())
            for c, total in sums.items()
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
