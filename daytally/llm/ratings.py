"""Quality classifier: ordinal regression with cumulative links on graded ratings.

P(grade <= k) = sigmoid(threshold_k - w.x): all grades share the weights w of
the hashed text, and the thresholds are ordered.  The model gives the expected
grade and, for selection, the probability that the grade is at least some
value.

x is the share of each hashed feature among a text's tokens.  A token (a run
without white space) has two features: its lower-case form, and its shape,
where runs of capitals, other letters and digits are one character each.  A
token that repeats the one before it has a third.
"""

import itertools
import operator
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.words import Remembered, slices
from daytally.scratch import materialize

#: Hashed features.
DIMENSIONS = 1 << 14
#: Rated documents that the model is fitted on, at most; chosen by a hash of the id.
MAX_RATED = 20_000
#: Partitions of the rated documents.
FIT_PARTITIONS = 8
SCALE = 10.0
PENALTY = 1e-5
ROUNDS = 30

_SHAPES = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("9") if 48 <= b <= 57 else b for b in range(256)
)
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)


def features_of(token: bytes) -> tuple[int, int]:
    """Hashed features of a token: its lower-case form and its shape."""
    shape = _RUNS.sub(rb"\1", token.translate(_SHAPES))
    return xxhash.xxh32_intdigest(b"w" + token.lower()) % DIMENSIONS, xxhash.xxh32_intdigest(b"s" + shape) % DIMENSIONS


REPEATED = xxhash.xxh32_intdigest(b"r") % DIMENSIONS


def repeats(found: list[bytes]) -> int:
    """Tokens that are the same as the one before."""
    return sum(map(operator.eq, found, itertools.islice(found, 1, None)))


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


@dataclass
class Model:
    """Shared weights and ordered thresholds; grade k is ``grades[k]``."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[int]

    def score(self, text: str | None, known: Remembered) -> float:
        found = tokens(text)
        if not found:
            return 0.0
        return SCALE * (sum(map(known.__getitem__, found)) + repeats(found) * float(self.weights[REPEATED])) / len(found)

    def token_weight(self, token: bytes) -> float:
        a, b = features_of(token)
        return float(self.weights[a] + self.weights[b])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def features(docs: DataFrame) -> DataFrame:
    """``grade``, ``index`` and ``value`` (arrays) of rated documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(features_of)
        for batch in slices(batches):
            index, value = [], []
            for text in batch.column(1).to_pylist():
                found = tokens(text)
                ids = np.fromiter((i for t in found for i in known[t]), np.int32, 2 * len(found))
                ids, counts = np.unique(np.r_[ids, np.full(repeats(found), REPEATED, np.int32)], return_counts=True)
                index.append(ids)
                value.append((counts * (SCALE / max(1, len(found)))).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))],
                names=["grade", "index", "value"],
            )

    return docs.select(F.col("grade").cast("int").alias("grade"), "text").mapInArrow(run, "grade int, index array<int>, value array<float>")


def _loss(rows: DataFrame, weights: np.ndarray, thresholds: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Summed negative log likelihood and its gradients; each task sends one row."""
    sent = rows.sparkSession.sparkContext.broadcast((weights, np.r_[-np.inf, thresholds, np.inf]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, cuts = sent.value
        loss, by_weight, by_cut = 0.0, np.zeros(len(w)), np.zeros(len(cuts))
        for batch in batches:
            grade = batch.column(0).to_numpy()
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            index = lists.flatten().to_numpy()
            value = batch.column(2).flatten().to_numpy()
            row = np.repeat(np.arange(len(grade)), sizes)
            z = np.bincount(row, w[index] * value, len(grade))
            up, low = _sigmoid(cuts[grade + 1] - z), _sigmoid(cuts[grade] - z)
            up, low = np.where(np.isinf(cuts[grade + 1]), 1.0, up), np.where(np.isinf(cuts[grade]), 0.0, low)
            p = np.maximum(up - low, 1e-12)
            d_up, d_low = up * (1 - up) / p, low * (1 - low) / p
            loss -= np.log(p).sum()
            by_weight += np.bincount(index, ((d_up - d_low)[row]) * value, len(w))
            np.add.at(by_cut, grade + 1, -d_up)
            np.add.at(by_cut, grade, d_low)
        made = [pa.array([loss]), pa.array([by_weight.tobytes()]), pa.array([by_cut[1:-1].tobytes()])]
        yield pa.RecordBatch.from_arrays(made, names=["loss", "by_weight", "by_cut"])

    parts = rows.mapInArrow(run, "loss double, by_weight binary, by_cut binary").collect()
    add = lambda name: sum(np.frombuffer(r[name]) for r in parts)
    sent.destroy()
    return sum(r.loss for r in parts), add("by_weight"), add("by_cut")


def minimize(function: Callable, x: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with step halving; ``function`` gives value and gradient."""
    value, slope = function(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, alphas = slope.copy(), []
        for s, y in reversed(steps):
            alphas.append(s @ q / (s @ y))
            q -= alphas[-1] * y
        if steps:
            s, y = steps[-1]
            q *= s @ y / (y @ y)
        for (s, y), a in zip(steps, reversed(alphas), strict=True):
            q += (a - y @ q / (s @ y)) * s
        size = 1.0 if steps else min(1.0, 1.0 / max(1e-12, np.abs(slope).sum()))
        for _ in range(12):
            new = x - size * q
            new_value, new_slope = function(new)
            if new_value <= value - 1e-4 * size * (slope @ q):
                break
            size /= 2
        else:
            break
        s, y = new - x, new_slope - slope
        if s @ y > 1e-12:
            steps = [*steps, (s, y)][-memory:]
        done = value - new_value < 1e-6 * max(1.0, abs(value))
        x, value, slope = new, new_value, new_slope
        if done:
            break
    return x


def fit(docs: DataFrame, ratings: DataFrame, max_rated: int = MAX_RATED, rounds: int = ROUNDS) -> Model | None:
    """Fit on the documents that have a grade, at most ``max_rated`` of them.

    ``ratings`` has ``doc_id`` and the whole number ``grade``; null ids and
    grades take no part, and of several grades of one document the lowest
    counts.  Each round is one Spark job in which every task sums the gradient
    over its documents.  With fewer than two grades there is nothing to fit
    and the result is None.
    """
    rated = ratings.where("doc_id is not null and grade is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    rated = rated.agg(F.min(F.col("grade").cast("int")).alias("grade"))
    chosen = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rated)  # bounded, so it may be broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    rows = materialize(features(texts).repartition(FIT_PARTITIONS), "rated")
    counts = {r.grade: r["count"] for r in rows.groupBy("grade").count().collect()}
    grades, total = sorted(counts), sum(counts.values())
    if len(grades) < 2:
        return None
    rank = F.lit(0)
    for g in grades[1:]:
        rank = rank + (F.col("grade") >= g).cast("int")
    rows = rows.withColumn("grade", rank)
    n = len(grades) - 1

    def cuts(d: np.ndarray) -> np.ndarray:
        return np.cumsum(np.r_[d[:1], np.exp(d[1:])])

    def function(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, d = x[:DIMENSIONS], x[DIMENSIONS:]
        loss, by_weight, by_cut = _loss(rows, w, cuts(d))
        tail = np.cumsum(by_cut[::-1])[::-1]
        by_d = tail * np.r_[1.0, np.exp(d[1:])]
        value = loss / total + PENALTY * (w @ w) / 2
        return value, np.r_[by_weight / total + PENALTY * w, by_d / total]

    share = np.cumsum([counts[g] for g in grades])[:-1] / total
    first = np.log(share / (1 - share))
    start = np.r_[np.zeros(DIMENSIONS), first[:1], np.log(np.maximum(np.diff(first), 1e-3))]
    found = minimize(function, start, rounds)
    return Model(found[:DIMENSIONS], cuts(found[DIMENSIONS : DIMENSIONS + n]), grades)


def scores(docs: DataFrame, model: Model | None, at_least: int) -> Column:
    """``expected_grade`` and ``tail_probability`` (grade at least ``at_least``) as a struct column over ``text``.

    A null or blank text has the score of no evidence, that is the thresholds
    alone.  Without a model the grade is null and the probability 1, so that
    nothing is rejected.
    """
    if model is None:
        return F.struct(F.lit(None).cast("double").alias("expected_grade"), F.lit(1.0).alias("tail_probability"))
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds, model.grades))
    grades = np.array(model.grades, float)
    cut = int(np.searchsorted(grades, at_least))

    @F.pandas_udf("expected_grade double, tail_probability double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Model(*sent.value)
        known = Remembered(model.token_weight)
        for texts in parts:
            z = np.array([model.score(t, known) for t in texts])
            below = _sigmoid(model.thresholds[None, :] - z[:, None])  # P(grade <= k)
            each = np.diff(np.c_[np.zeros(len(z)), below, np.ones(len(z))], axis=1)
            tail = np.ones(len(z)) if cut == 0 else np.zeros(len(z)) if cut >= len(grades) else 1 - below[:, cut - 1]
            yield pd.DataFrame({"expected_grade": each @ grades, "tail_probability": tail})

    return run(F.col("text"))


def rate(docs: DataFrame, model: Model | None, at_least: int = 1, probability: float = 0.5) -> DataFrame:
    """``doc_id``, ``expected_grade``, ``tail_probability`` and ``keep`` of every document; one narrow pass.

    ``keep`` says that the grade is at least ``at_least`` with ``probability``
    or more.  Repeated rows give repeated results; null ids stay; other
    columns are ignored.
    """
    scored = docs.select("doc_id", scores(docs, model, at_least).alias("s"))
    return scored.select("doc_id", "s.expected_grade", "s.tail_probability", (F.col("s.tail_probability") >= probability).alias("keep"))


def select(docs: DataFrame, model: Model | None, at_least: int = 1, probability: float = 0.5) -> DataFrame:
    """The documents, with all their columns, that the model does not reject."""
    name = "_rating"
    while name in docs.columns:
        name += "_"
    scored = docs.withColumn(name, scores(docs, model, at_least))
    return scored.where(F.col(f"{name}.tail_probability") >= probability).drop(name)
