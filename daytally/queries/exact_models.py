"""Tree models and K-Means as numbers: what Spark ML and the library's own searches find, next to the same searches in SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.ml import lloyd, regressors, splits
from daytally.ml.clusters import DIMENSIONS
from daytally.ml.features import SEED, assembler, labelled
from daytally.names import qcol
from daytally.operators.series import MEASURES
from daytally.queries import model_sql
from daytally.queries.base_sql import sql
from daytally.queries.registry import query, shown
from daytally.scratch import fresh_path, materialize
from daytally.sources.generated_tables import stored_day_frame

# Width of the classes that turn each measure into at most eight values, few enough for Spark to try every split.
WIDTHS = {"Depart": 8.0, "Heat": 2.0, "PrecipTotal": 0.125, "Tavg": 30.0, "Tmax": 50.0, "Tmin": 20.0}
CLASSES = 8
DEPTH, TREES, STAGES = 2, 5, 4
STEPS, KS = 4, (2, 6, 100)
# Added before rounding, so that a mean that ends in a half is not rounded by the noise of its sum.
OFF_HALF = 1.3e-7


def few_valued(days: DataFrame) -> DataFrame:
    """The days with every measure replaced by its class."""
    classes = {m: F.least(F.lit(CLASSES - 1.0), F.greatest(F.lit(0.0), F.floor(qcol(m) / w).cast("double"))) for m, w in WIDTHS.items()}
    return days.withColumns(classes)


_X = "[" + ", ".join(f'cast("{m}" as double)' for m in MEASURES) + "]"
_FEW = "[" + ", ".join(f'cast(least({CLASSES - 1}, greatest(0, floor("{m}" / {WIDTHS[m]}))) as double)' for m in MEASURES) + "]"


def _source(x: str) -> tuple[str, str]:
    return "given", f"select cast(date as varchar) as key, 0 as tree, cast(1 as double) as w, y, {x} as x from days"


_NODES = """
select cast(node as bigint) as node, cast(feature as bigint) as feature, round(threshold, 6) as threshold,
       cast(n as bigint) as days, round(mean, 6) as mean
from t_nodes"""


@query("decision_tree_nodes", sql(_NODES, "days", stored=[_source(_FEW), *model_sql.tree("t", "given", len(MEASURES), DEPTH)]))
def decision_tree_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark's decision tree of depth two on measures of few values, stored and read back: thresholds and means are exact."""
    days = labelled(few_valued(stored_day_frame(spark, sf_dir)))
    tree = DecisionTreeRegressor(maxDepth=DEPTH, seed=SEED).fit(assembler().transform(days))
    path = fresh_path(spark, "tree")
    tree.write().save(path)
    return shown(regressors.tree_nodes(spark, path))


def _rows(spark: SparkSession, sf_dir: str, few: bool = False) -> DataFrame:
    days = labelled(stored_day_frame(spark, sf_dir))
    return materialize(splits.training_rows(few_valued(days) if few else days, "date", MEASURES), "training-rows")


@query("tree_split_search", sql(_NODES, "days", stored=[_source(_X), *model_sql.tree("t", "given", len(MEASURES), 3)]))
def tree_split_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library's own tree of depth three over all values of all measures."""
    rows = _rows(spark, sf_dir)
    found = splits.nodes(rows, splits.grow(rows, len(MEASURES), 3))
    return shown(found.select("node", "feature", "threshold", F.col("n").cast("bigint").alias("days"), "mean"))


_DRAWN = ("drawn", f"""
select g.key, t.tree, cast({model_sql.draws("g.key", "t.tree")} as double) as w, g.y, g.x from given g, (select unnest(range({TREES})) as tree) t""")


@query("forest_tree_predictions", sql("""
select e.key as date, cast(e.tree as bigint) as tree, cast(e.w as bigint) as draws, round(n.mean, 6) as prediction
from (select key, tree, w, node from t_2
      union all select o.key, o.tree, o.w, case when b.feature is null then o.node else 2 * o.node + case when o.x[b.feature + 1] > b.threshold then 1 else 0 end end
      from (select u.key, u.tree, u.w, u.x, case when a.feature is null then 1 else 2 + case when u.x[a.feature + 1] > a.threshold then 1 else 0 end end as node
            from undrawn u left join t_best_0 a on u.tree = a.tree) o
           left join t_best_1 b on o.tree = b.tree and o.node = b.node) e
     join t_nodes n on e.tree = n.tree and e.node = n.node
""", "days", stored=[_source(_X), _DRAWN, ("bag", "select * from drawn where w > 0"), ("undrawn", "select * from drawn where w = 0"),
                     *model_sql.tree("t", "bag", len(MEASURES), DEPTH, looked=True)]))
def forest_tree_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each tree of a forest predicts for every day, with how often it has drawn the day."""
    rows = _rows(spark, sf_dir)
    found, trained = splits.forest(rows, "date", len(MEASURES), TREES, DEPTH)
    each = splits.predict_trees(rows, TREES, found, trained)
    draws = splits.draws(F.col("date"), F.col("tree")).cast("bigint")
    return shown(each.select("date", "tree", draws.alias("draws"), "prediction"))


@query("gbt_stage_errors", sql(" union all ".join(
    f"select cast({i} as bigint) as stage, round(sqrt(avg((target - prediction) * (target - prediction))), 6) as spark_rmse, spark_rmse as ledger_rmse from b_stage_{i}"
    for i in range(STAGES)
), "days", stored=[_source(_FEW), *model_sql.boosted("b", "given", len(MEASURES), STAGES, DEPTH)]))
def gbt_stage_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error after each of the first stages, of Spark's boosted trees and of the library's own ledger of residuals."""
    rows = _rows(spark, sf_dir, few=True)
    vectors = materialize(assembler().transform(labelled(few_valued(stored_day_frame(spark, sf_dir)))).select("features", "label"), "vectors")
    model = GBTRegressor(maxIter=STAGES, maxDepth=DEPTH, seed=SEED).fit(vectors)
    errors = [(i, float(e) ** 0.5) for i, e in enumerate(model.evaluateEachIteration(vectors, "squared"))]
    spark_errors = spark.createDataFrame(errors, "stage int, spark_rmse double")
    _, ledger = splits.boost(rows, "date", len(MEASURES), STAGES, DEPTH)
    own = splits.stage_errors(ledger).withColumnRenamed("rmse", "ledger_rmse")
    return shown(own.join(F.broadcast(spark_errors), "stage").select("stage", "spark_rmse", "ledger_rmse"))


_KMEANS = [("given", 'select cast(date as varchar) as key, * exclude (y), y as "Total Crimes" from days')]
for _k in KS:
    _KMEANS += model_sql.lloyd(f"k{_k}", "given", DIMENSIONS, _k, STEPS)
_CENTRES = " union all ".join(f"""
select cast({k} as bigint) as k, cast(c.cluster as bigint) as cluster, cast(coalesce(e.days, 0) as bigint) as days,
       {", ".join(f'round(c.c{i} + {OFF_HALF}, 6) as "{d}"' for i, d in enumerate(DIMENSIONS))}, round(coalesce(e.error, 0), 4) as error
from k{k}_{STEPS} c left join (select cluster, count(*) as days, sum(distance) as error from k{k}_end group by 1) e on c.cluster = e.cluster""" for k in KS)


@query("kmeans_steps", sql(_CENTRES, "days", stored=_KMEANS))
def kmeans_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centres, days and errors after a fixed number of steps from seeds by digest, for 2, 6 and 100 clusters."""
    days = stored_day_frame(spark, sf_dir)
    parts = []
    for k in KS:
        centres = lloyd.fit(days, "date", DIMENSIONS, k, STEPS)
        slots = ", ".join(f"c{i} double" for i in range(len(DIMENSIONS)))
        table = spark.createDataFrame([(i, *c) for i, c in enumerate(centres)], f"cluster int, {slots}")
        rows = F.broadcast(table).join(lloyd.errors(days, DIMENSIONS, centres), "cluster", "left")
        named = [(F.col(f"c{i}") + F.lit(OFF_HALF)).alias(d) for i, d in enumerate(DIMENSIONS)]
        parts.append(rows.select(F.lit(k).alias("k"), "cluster", F.coalesce("days", F.lit(0)).alias("days"), *named, F.round(F.coalesce("error", F.lit(0.0)), 4).alias("error")))
    return shown(reduce(DataFrame.unionByName, parts))
