"""Regression trees by exact split search, as aggregates and prefix sums.

Every distinct value of a feature in a node is one row with its weight and its
weighted sum of labels.  Running sums over the values in order give both sides
of every split between two neighbouring values; the split that lowers the
squared error most is taken, ties to the earlier feature and the lower
threshold.  All nodes of a level, and all trees of a forest, are searched in
one job.

Rows are reduced to distinct values before the shuffle, so neither a common
value nor a node with all rows gathers in one task.  The running sums have two
levels, inside slices of the values and over the slices, so no task orders all
values of a feature.  The driver holds the splits, a number fixed by depth and
trees.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daytally.ml.features import SEED
from daytally.names import qcol
from daytally.scratch import materialize

LABEL, WEIGHT, TREE, NODE = "label", "weight", "tree", "node"

#: Slices of the values of a feature whose running sums are made apart.
SLICES = 64
#: A split has to lower the squared error by more than this, and gains are compared in whole units of it.
LEAST_GAIN, GAIN_DIGITS = 1e-6, 6
#: Share of the features that a node of a forest looks at.
FEATURE_SHARE = 1 / 3
#: Boosting fits the gradient of the squared error, which is twice the residual, and takes this share of it.
LEARNING_RATE = 0.1
GRADIENT = 2.0


class Split(NamedTuple):
    """Rows of a node with more than ``threshold`` go to node ``2 * node + 1``, the others to ``2 * node``."""

    tree: int
    node: int
    feature: int
    threshold: float


def training_rows(days: DataFrame, key: str, features: list[str], label: str = LABEL) -> DataFrame:
    """Key, features as ``x`` (array of double), label, weight 1, tree 0; rows with a null in any of them are left out."""
    x = F.array(*[qcol(f).cast("double") for f in features])
    rows = days.select(key, x.alias("x"), qcol(label).cast("double").alias(LABEL), F.lit(1.0).alias(WEIGHT), F.lit(0).alias(TREE))
    return rows.where(F.col(LABEL).isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))


def route(rows: DataFrame, splits: list[Split]) -> DataFrame:
    """The rows with the ``node`` that they end in; the splits are as few as their trees have nodes."""
    rows = rows.withColumn(NODE, F.lit(1))
    by_level: dict[int, list[Split]] = {}
    for split in splits:
        by_level.setdefault(split.node.bit_length(), []).append(split)
    for level in sorted(by_level):
        table = rows.sparkSession.createDataFrame(by_level[level], f"{TREE} int, {NODE} int, feature int, threshold double")
        above = F.element_at("x", F.col("feature") + 1) > F.col("threshold")
        child = F.when(F.col("feature").isNull(), F.col(NODE)).otherwise(2 * F.col(NODE) + above.cast("int"))
        rows = rows.join(F.broadcast(table), [TREE, NODE], "left").withColumn(NODE, child).drop("feature", "threshold")
    return rows


def _slices(rows: DataFrame, dimensions: int) -> list[list[float]]:
    """Values that cut each feature into slices of like size, found once for the whole table."""
    shares = [i / SLICES for i in range(1, SLICES)]
    found = rows.agg(*[F.percentile_approx(F.col("x")[i], shares, 1000).alias(f"c{i}") for i in range(dimensions)]).first()
    return [sorted(set(cuts or [])) for cuts in found]


def _running(values: DataFrame) -> DataFrame:
    """Add to each value of a feature in a node the sums up to it, those of the node, and the next value."""
    group = [TREE, NODE, "feature"]
    inside = Window.partitionBy(*group, "slice").orderBy("value")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = values.groupBy(*group, "slice").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("value").alias("low"))
    slices = slices.select(
        *group,
        "slice",
        *[F.coalesce(F.sum(c).over(before), F.lit(0.0)).alias(f"{c}_before") for c in ("n", "s")],
        *[F.sum(c).over(Window.partitionBy(*group)).alias(f"{c}_all") for c in ("n", "s")],
        F.lead("low").over(Window.partitionBy(*group).orderBy("slice")).alias("low_after"),
    )
    summed = values.withColumns({f"{c}_left": F.sum(c).over(upto) for c in ("n", "s")} | {"next": F.lead("value").over(inside)})
    joined = summed.join(slices, [*group, "slice"])
    sums = {f"{c}_left": F.col(f"{c}_before") + F.col(f"{c}_left") for c in ("n", "s")}
    return joined.withColumns(sums | {"next": F.coalesce("next", "low_after")})


def _best(rows: DataFrame, cuts: list[list[float]]) -> DataFrame:
    """The best split of every node; rows have the features to look at in ``looked``."""
    each = F.explode(F.transform("looked", lambda i: F.struct(i.alias("feature"), F.element_at("x", i + 1).alias("value"))))
    long = rows.select(TREE, NODE, WEIGHT, LABEL, each.alias("of")).select(TREE, NODE, WEIGHT, LABEL, "of.*")
    values = long.groupBy(TREE, NODE, "feature", "value").agg(
        F.sum(WEIGHT).alias("n"), F.sum(F.col(WEIGHT) * F.col(LABEL)).alias("s")
    )
    bounds = F.array(*[F.array(*map(F.lit, c)).cast("array<double>") for c in cuts])
    values = values.withColumn("slice", F.size(F.filter(F.element_at(bounds, F.col("feature") + 1), lambda b: b < F.col("value"))))
    sides = _running(values).where(F.col("next").isNotNull()).select(
        TREE, NODE, "feature", ((F.col("value") + F.col("next")) / 2).alias("threshold"),
        (_square("s_left", F.col("n_left")) + (F.col("s_all") - F.col("s_left")) * (F.col("s_all") - F.col("s_left")) / (F.col("n_all") - F.col("n_left"))
         - _square("s_all", F.col("n_all"))).alias("gain"),
    )
    better = sides.where(F.col("gain") > LEAST_GAIN).groupBy(TREE, NODE)
    best = F.min(F.struct((-F.round("gain", GAIN_DIGITS)).alias("loss"), "feature", "threshold"))
    return better.agg(best.alias("best")).select(TREE, NODE, "best.feature", "best.threshold")


def _square(sum_: str, n: Column) -> Column:
    return F.col(sum_) * F.col(sum_) / n


def grow(rows: DataFrame, dimensions: int, depth: int, looked=None) -> list[Split]:
    """Splits of the trees over ``rows`` (``training_rows``, ``bootstrap``), level by level.

    ``looked(tree, node)`` gives the features that a node looks at; all if it
    is not given.
    """
    cuts = _slices(rows, dimensions)
    trees = [r[0] for r in rows.select(TREE).distinct().collect()]
    splits: list[Split] = []
    open_nodes = [(t, 1) for t in sorted(trees)]
    for _ in range(depth):
        if not open_nodes:
            break
        wanted = [(t, n, list(looked(t, n) if looked else range(dimensions))) for t, n in open_nodes]
        table = rows.sparkSession.createDataFrame(wanted, f"{TREE} int, {NODE} int, looked array<int>")
        here = route(rows, splits).join(F.broadcast(table), [TREE, NODE])
        found = sorted(Split(*r) for r in _best(here, cuts).collect())
        splits += found
        open_nodes = [(s.tree, child) for s in found for child in (2 * s.node, 2 * s.node + 1)]
    return splits


def nodes(rows: DataFrame, splits: list[Split]) -> DataFrame:
    """``(tree, node, feature, threshold, n, mean)`` of all nodes; leaves have neither feature nor threshold."""
    table = rows.sparkSession.createDataFrame(splits, f"{TREE} int, {NODE} int, feature int, threshold double")
    ended = route(rows, splits).groupBy(TREE, NODE).agg(F.sum(WEIGHT).alias("n"), F.sum(F.col(WEIGHT) * F.col(LABEL)).alias("s"))
    # a leaf counts in every node above it
    above = F.explode(F.transform(F.sequence(F.lit(0), F.length(F.bin(NODE)) - 1), lambda i: F.floor(F.col(NODE) / F.pow(F.lit(2), i)).cast("int")))
    sums = ended.select(TREE, above.alias(NODE), "n", "s").groupBy(TREE, NODE).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    return sums.join(F.broadcast(table), [TREE, NODE], "left").select(TREE, NODE, "feature", "threshold", "n", (F.col("s") / F.col("n")).alias("mean"))


def predict(rows: DataFrame, splits: list[Split], trained: DataFrame) -> DataFrame:
    """The rows with ``prediction``, the mean of their leaf among the rows of ``nodes``."""
    leaves = trained.where("feature is null").select(TREE, NODE, F.col("mean").alias("prediction"))
    return route(rows, splits).join(F.broadcast(leaves), [TREE, NODE])


# Forest.


def _bounds() -> list[str]:
    """Digests at which the number of draws of a row rises: those of a Poisson number with mean one."""
    total, out = 0.0, []
    for i in range(8):
        total += math.exp(-1) / math.factorial(i)
        out.append(f"{int(total * 2**32):08x}")
    return out


def draws(key: Column, tree: Column, seed: int = SEED) -> Column:
    """How often a row is drawn for a tree, told by a digest of both, so that a lost task draws the same again."""
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), tree.cast("string"), F.lit(":"), key.cast("string")).cast("binary")), 1, 8)
    return sum((digest >= bound).cast("int") for bound in _bounds())


def bootstrap(rows: DataFrame, key: str, trees: int, seed: int = SEED) -> DataFrame:
    """The rows once for each tree that draws them, with the number of draws as weight."""
    each = rows.drop(TREE, WEIGHT).withColumn(TREE, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    return each.withColumn(WEIGHT, draws(qcol(key), F.col(TREE), seed).cast("double")).where(F.col(WEIGHT) > 0)


def looked_at(dimensions: int, seed: int = SEED, share: float = FEATURE_SHARE):
    """Features that a node looks at: those with the lowest digests of tree, node and feature."""
    count = max(1, math.ceil(dimensions * share))

    def choose(tree: int, node: int) -> list[int]:
        return sorted(sorted(range(dimensions), key=lambda f: hashlib.md5(f"{seed}:{tree}:{node}:{f}".encode()).hexdigest())[:count])

    return choose


def forest(rows: DataFrame, key: str, dimensions: int, trees: int, depth: int, seed: int = SEED) -> tuple[list[Split], DataFrame]:
    """Splits of all trees, each on its own draws, and their ``nodes``."""
    drawn = materialize(bootstrap(rows, key, trees, seed), "draws")
    splits = grow(drawn, dimensions, depth, looked_at(dimensions, seed))
    return splits, nodes(drawn, splits)


def predict_trees(rows: DataFrame, trees: int, splits: list[Split], trained: DataFrame) -> DataFrame:
    """Every row once for each tree, with that tree's ``prediction``; the forest's is their mean."""
    each = rows.drop(TREE).withColumn(TREE, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    return predict(each, splits, trained)


# Boosting.


def boost(rows: DataFrame, key: str, dimensions: int, stages: int, depth: int, rate: float = LEARNING_RATE) -> tuple[list[list[Split]], DataFrame]:
    """Trees of every stage, and the ledger: ``(key, stage, label, prediction, residual)`` of every row after each stage.

    The first tree is fitted to the label and counts in full; each later one is
    fitted to the gradient of the squared error and counts by ``rate``.  A stage
    reads the rows that the one before it has written.
    """
    kept = [c for c in rows.columns if c != LABEL]
    now, trees, ledger = rows.withColumns({"target": F.col(LABEL), "before": F.lit(0.0)}), [], []
    for stage in range(stages):
        splits = grow(now, dimensions, depth)
        means = nodes(now, splits).where("feature is null").select(TREE, NODE, "mean")
        after = F.col("before") + F.col("mean") * F.lit(1.0 if stage == 0 else rate)
        stored = route(now, splits).join(F.broadcast(means), [TREE, NODE]).select(*kept, "target", after.alias("before"))
        stored = materialize(stored, "boosted")
        residual = F.col("target") - F.col("before")
        entry = [key, F.lit(stage).alias("stage"), F.col("target").alias(LABEL), F.col("before").alias("prediction")]
        ledger.append(stored.select(*entry, residual.alias("residual")))
        now = stored.withColumn(LABEL, residual * GRADIENT)
        trees.append(splits)
    return trees, reduce(DataFrame.unionByName, ledger)


def stage_errors(ledger: DataFrame) -> DataFrame:
    """``(stage, rmse)``."""
    return ledger.groupBy("stage").agg(F.sqrt(F.avg(F.col("residual") * F.col("residual"))).alias("rmse"))
