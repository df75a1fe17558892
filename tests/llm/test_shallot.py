"""Centroid clustering against plain rounds over all centroids in Python integers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from daytally.llm import queries, shallot

SF_DIR = "/root/testdata/sf0.001"


def plain(rows, k, rounds, dimensions, scale):
    """What the docstring says, vector by vector."""
    kept = [
        (i, [math.floor(scale * float(c)) for c in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(c is not None and math.isfinite(c) and abs(c) < shallot.reach(dimensions) / scale for c in v)
    ]
    digest = lambda i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "")
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups: dict[int, list] = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(centroids)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia: dict[int, int] = {}
    for _, d, j in found:
        inertia[j] = inertia.get(j, 0) + d
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), j, d, inertia[j], sum(inertia.values()), name[j]) for i, d, j in found)


def result(df):
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((str(r[0]), *tuple(r)[1:]) for r in df.collect())


@pytest.fixture(scope="module")
def table(spark):
    """Vectors in clumps with repeated rows, ties, hard rows and columns whose names clash."""
    rng = np.random.default_rng(3)
    middles = rng.normal(0, 1, (9, 8))
    rows = [(i, (middles[i % 9] + rng.normal(0, 0.3, 8)).tolist()) for i in range(700)]
    rows += [(1000 + i, [float(i % 3)] * 8) for i in range(300)]  # a third of the rows in three places, with ties
    rows += rows[:20] + [(5, [9.0] * 8), (None, [1.0] * 8), (None, [1.0] * 8)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 7), (2003, [1.0] * 9), (2004, [None] * 8), (2005, [float("nan")] + [1.0] * 7)]
    rows += [(2006, [float("inf")] * 8), (2007, [-float("inf")] * 8), (2008, [1e300] * 8), (2009, [2.0**20] * 8), (2010, [0.0] * 8), (2011, [-0.001] * 8)]
    frame = spark.createDataFrame([(i, v, "x", 1, 1.0) for i, v in rows], "vec_id long, embedding array<double>, point string, cluster int, distance double")
    return rows, frame


@pytest.mark.parametrize(("k", "rounds"), [(16, 3), (40, 5), (2, 4), (1, 2), (5, 0)])
def test_clusters_are_those_of_plain_rounds(table, k, rounds):
    rows, frame = table
    assert result(shallot.cluster(frame, k, rounds, 8)) == plain(rows, k, rounds, 8, 64)


def test_the_query_on_its_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert result(queries.op11_shallot_clusters(spark, SF_DIR)) == plain(rows, 16, 3, 64, 64)


def test_fewer_vectors_than_centroids_and_none(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [5.0, 5.0]), (2, [5.0, 5.0])], "vec_id long, embedding array<float>")
    assert result(shallot.cluster(frame, dimensions=2)) == plain([(1, [1.0, 2.0]), (2, [5.0, 5.0]), (2, [5.0, 5.0])], 16, 3, 2, 64)
    assert result(shallot.cluster(frame.limit(0), dimensions=2)) == []
    assert result(shallot.cluster(frame, dimensions=3)) == []


def test_the_largest_components_stay_exact(spark):
    most = float(shallot.reach(2) // 64 - 1)
    rows = [(1, [most, -most]), (2, [-most, most]), (3, [most, most - 1]), (4, [most - 0.015625, most])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(shallot.cluster(frame, 2, 2, 2)) == plain(rows, 2, 2, 2, 64)


def test_bounds_spare_vectors_and_the_ball_spares_centroids(monkeypatch):
    """Where centroids hardly move no vector is searched, and a search visits the centroids close by."""
    rng = np.random.default_rng(4)
    middles = np.zeros((30, 16), np.int64)
    middles[:, 0] = rng.permutation(30) * 1000
    x = np.repeat(middles, 50, axis=0) + rng.integers(-20, 20, (1500, 16))
    measured = []
    exact = shallot.squared
    monkeypatch.setattr(shallot, "squared", lambda a, b: measured.append(len(a)) or exact(a, b))
    state = [np.zeros(1500, np.int32), np.ones(1500, np.int32), np.zeros(1500), np.zeros(1500)]
    shallot.Centroids(middles, None).assign(x, *state)
    assert (state[0] == np.repeat(np.arange(30), 50)).all()
    near = shallot.Centroids(middles + 1, middles)
    measured.clear()
    near.assign(x, *state)
    assert sum(measured) < 0.1 * 1500
    along = np.eye(16, dtype=np.int64)[0] * 600
    far = shallot.Centroids(middles + along, middles + 1)
    measured.clear()
    far.assign(x, *state)
    assert 1500 < sum(measured) < 0.2 * 30 * 1500
    want = np.argmin([exact(x, c) for c in middles + along], axis=0)
    assert (state[0] == want).all()
