"""Features, regression models and clusters.

Where a model has no closed form, the query returns counts that state an
invariant, and the SQL twin is what the invariant demands.  Such a query proves
that property and no more; its docstring says so.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.ml import clusters, features, regressors
from daytally.names import qcol
from daytally.operators.series import MEASURES
from daytally.queries.base_sql import RIDGE_PREDICTION, ridge, sql
from daytally.queries.registry import query, shown
from daytally.scratch import fresh_path, materialize
from daytally.sources.generated_tables import LAST_YEAR, daily_obs, day_frame, stored_day_frame, table

# Relative difference up to which two ways of computing a sum count as equal.
CLOSE = 1e-9

# Decimals of a prediction that two ways of solving the same equations agree on.
DIGITS = 4


def _count(condition: Column) -> Column:
    """Aggregate: rows that meet the condition; null counts as met."""
    return F.count_if(F.coalesce(condition, F.lit(True)))


def _vector_columns(df: DataFrame, column: str, names: list[str]) -> DataFrame:
    return df.select("date", "label", *[vector_to_array(F.col(column))[i].alias(n) for i, n in enumerate(names)])


def _dry_days_sql(columns: str) -> str:
    return sql(f"""select cast(date as varchar) as date, y as label, {columns} from days where "PrecipTotal" <> 0""", "days")


_MEASURE_SQL = ", ".join(f'round("{m}", 6) as "{m}"' for m in MEASURES)


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day frame with a precipitation of zero made null."""
    return day_frame(spark, sf_dir).withColumn("PrecipTotal", F.nullif(F.col("PrecipTotal"), F.lit(0.0)))


@query("assemble_features", _dry_days_sql(_MEASURE_SQL))
def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six-dimensional vectors, shown by coordinate; days with a null are left out."""
    return shown(_vector_columns(features.feature_frame(_with_gaps(spark, sf_dir)), "features", MEASURES))


@query("assemble_features_with_target", _dry_days_sql(_MEASURE_SQL + ', y as "Total Crimes"'))
def assemble_features_with_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven-dimensional vectors."""
    return shown(_vector_columns(features.cluster_frame(_with_gaps(spark, sf_dir)), "features", clusters.DIMENSIONS))


@query("standard_scale", sql("select cast(date as varchar) as date, y as label, " + ", ".join(
    f'round("{m}" / (select stddev_samp("{m}") from days), 6) as "{m}"' for m in MEASURES
) + " from days", "days"))
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each coordinate divided by its sample standard deviation."""
    days = stored_day_frame(spark, sf_dir)
    _, scaled = features.scale_to_unit_deviation(features.feature_frame(days))
    return shown(_vector_columns(scaled, "scaled", MEASURES))


@query("index_categorical_features", """
select s as status, p as priority, cast(case s when 0 then 0 when -2 then 1 else 2 end as bigint) as status_code, p as priority_code,
       cast(count(*) as bigint) as rows
from (select cast(case o_orderstatus when 'F' then -2 when 'O' then 0 else 3 end as double) as s,
             cast(left(o_orderpriority, 1) as double) as p from orders)
group by s, p
""")
def index_categorical_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three distinct statuses become codes, five priorities stay numbers."""
    status = F.when(F.col("o_orderstatus") == "F", -2.0).when(F.col("o_orderstatus") == "O", 0.0).otherwise(3.0)
    rows = table(spark, sf_dir, "orders").select(
        status.alias("status"), F.substring("o_orderpriority", 1, 1).cast("double").alias("priority")
    )
    vectors = features.assembler(["status", "priority"]).transform(rows)
    coded = features.category_indexer().fit(vectors).transform(vectors)
    codes = vector_to_array(F.col("indexedFeatures"))
    grouped = coded.groupBy(
        "status", "priority", codes[0].cast("int").alias("status_code"), codes[1].alias("priority_code")
    )
    return shown(grouped.agg(F.count(F.lit(1)).alias("rows")))


def _train_sql(key: str) -> str:
    return f"left(md5('{features.SEED}:' || {key}), 8) < '{features.split_bound()}'"


@query("random_split", f"""
select o_orderkey, case when {_train_sql('o_orderkey')} then 'train' else 'holdout' end as side from orders
""")
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with the side it is on; the twin works out the digests itself."""
    train, held = features.split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    return train.withColumn("side", F.lit("train")).unionByName(held.withColumn("side", F.lit("holdout")))


_TERMS = " union all ".join(
    [f"select '{m}' as term, round(b{i + 1}, 6) as value from ridge" for i, m in enumerate(MEASURES)]
    + ["select 'intercept', round(b0, 6) from ridge"]
)


@query("linear_regression", sql(_TERMS, "days", extra=ridge()))
def linear_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients of the ridge fit; the twin solves the normal equations."""
    return shown(regressors.coefficients(spark, regressors.fit(regressors.LINEAR, stored_day_frame(spark, sf_dir))))


@query("linear_regression_one_feature", sql("""
select 'Tavg' as term, round(regr_slope(y, "Tavg"), 6) as value from days
union all select 'intercept', round(regr_intercept(y, "Tavg"), 6) from days
""", "days"))
def linear_regression_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain least squares on one measure."""
    model = regressors.fit(regressors.LINEAR, stored_day_frame(spark, sf_dir), ["Tavg"], reg_param=0.0)
    return shown(regressors.coefficients(spark, model, ["Tavg"]))


_ERROR = f"(y - ({RIDGE_PREDICTION})) * (y - ({RIDGE_PREDICTION}))"


@query("predict_vs_actual", sql(f"""
select cast(date as varchar) as date, y as actual, round({RIDGE_PREDICTION}, 4) as prediction from days, ridge
""", "days", extra=ridge()))
def predict_vs_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual and predicted total of every day, linear model."""
    return shown(regressors.fit_predict(regressors.LINEAR, stored_day_frame(spark, sf_dir)), DIGITS)


@query("score_new_days", sql(f"""
select cast(o.date as varchar) as date, round({RIDGE_PREDICTION}, 4) as prediction
from obs o, ridge where o.date >= date '{LAST_YEAR + 1}-01-01'
""", "days", extra=ridge()))
def score_new_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days after the last incident year, which the model has not seen, scored with the stored model."""
    path = regressors.save(regressors.fit(regressors.LINEAR, stored_day_frame(spark, sf_dir)), fresh_path(spark, "model"))
    model = regressors.load(spark, path)
    new_days = daily_obs(spark, sf_dir).filter(F.col("date") >= F.lit(f"{LAST_YEAR + 1}-01-01").cast("date"))
    return shown(regressors.score_new_days(model, new_days), DIGITS)


def _tree_sql(trees: int) -> str:
    return sql(f"""
select cast(count(*) as bigint) as days, cast({trees} as bigint) as num_trees, cast(0 as bigint) as too_deep,
       cast(0 as bigint) as without_prediction, cast(0 as bigint) as off_trees, cast(0 as bigint) as outside_range,
       cast(0 as bigint) as worse_than_mean
from days""", "days")


def _with_tree_sum(model: PipelineModel, days: DataFrame) -> DataFrame:
    """Predictions of an ensemble beside ``from_trees``, the weighted sum of what its single trees predict."""
    rows = features.labelled(days)
    for stage in model.stages:
        rows = stage.transform(rows)
    ensemble, total = model.stages[-1], F.lit(0.0)
    for i, (tree, weight) in enumerate(zip(ensemble.trees, ensemble.treeWeights)):
        rows = tree.setFeaturesCol("indexedFeatures").setPredictionCol(f"_t{i}").transform(rows)
        total = total + F.col(f"_t{i}") * weight
    return rows.select("date", F.col("label").alias("actual"), "prediction", total.alias("from_trees"))


def _tree_checks(spark: SparkSession, sf_dir: str, name: str, bounded: bool) -> DataFrame:
    """Invariant counts of an ensemble of trees fitted on all days.

    ``bounded``: the prediction is the mean of the trees and cannot leave the
    range of the totals; otherwise it is their weighted sum, which can.
    """
    days = stored_day_frame(spark, sf_dir)
    model = regressors.fit(name, days)
    ensemble = model.stages[-1]
    num_trees, depth = ensemble.getNumTrees, max(t.depth for t in ensemble.trees)
    rows = _with_tree_sum(model, days)
    trees = F.col("from_trees") / num_trees if bounded else F.col("from_trees")
    off = F.abs(F.col("prediction") - trees) > CLOSE * (1 + F.abs(trees))
    outside = (F.min("prediction") < F.min("actual")) | (F.max("prediction") > F.max("actual"))
    error = (F.col("actual") - F.col("prediction")) * (F.col("actual") - F.col("prediction"))
    return rows.agg(
        F.count(F.lit(1)).alias("days"),
        F.lit(num_trees).cast("bigint").alias("num_trees"),
        F.lit(int(depth > 5)).cast("bigint").alias("too_deep"),
        F.count_if(F.col("prediction").isNull()).alias("without_prediction"),
        _count(off).alias("off_trees"),
        (F.coalesce(outside, F.lit(True)) if bounded else F.lit(False)).cast("bigint").alias("outside_range"),
        (F.avg(error) > F.var_pop("actual")).cast("bigint").alias("worse_than_mean"),
    )


@query("gbt_regression", _tree_sql(10))
def gbt_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariant: predictions are the weighted sum of 10 trees of depth 5 at most, and beat the mean."""
    return _tree_checks(spark, sf_dir, regressors.GBT, bounded=False)


@query("random_forest_regression", _tree_sql(20))
def random_forest_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariant: predictions are the mean of 20 trees, stay in the range of the totals, and beat the mean."""
    return _tree_checks(spark, sf_dir, regressors.FOREST, bounded=True)


@query("decision_tree_regression", sql("""
select cast(count(*) as bigint) as days, cast(0 as bigint) as leaves_off_mean, cast(0 as bigint) as too_many_leaves from days
""", "days"))
def decision_tree_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariant: each predicted value is the mean total of the days it is given to; at most 32 leaves."""
    rows = regressors.fit_predict(regressors.TREE, stored_day_frame(spark, sf_dir))
    leaves = rows.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"), F.avg("actual").alias("mean"))
    off = F.abs(F.col("mean") - F.col("prediction")) > CLOSE * (1 + F.abs(F.col("mean")))
    return leaves.agg(
        F.sum("n").alias("days"),
        _count(off).alias("leaves_off_mean"),
        (F.count(F.lit(1)) > 32).cast("bigint").alias("too_many_leaves"),
    )


@query("ml_pipeline", sql("""
select cast(count(*) as bigint) as days, cast(3 as bigint) as stages, cast(0 as bigint) as differing from days
""", "days"))
def ml_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariant: the fitted chain predicts what its stages predict one after the other."""
    days = stored_day_frame(spark, sf_dir)
    model = regressors.fit(regressors.TREE, days)
    chained = regressors.predict(model, days)
    step = features.labelled(days)
    for stage in model.stages:
        step = stage.transform(step)
    single = step.select("date", F.col("prediction").alias("single"))
    return chained.join(single, "date", "left").agg(
        F.count(F.lit(1)).alias("days"),
        F.lit(len(model.stages)).cast("bigint").alias("stages"),
        _count(F.col("prediction") != F.col("single")).alias("differing"),
    )


def _linear_error_sql(source: str, model: str) -> str:
    return f"select count(*) as days, round(sqrt(avg({_ERROR})), 6) as linear_rmse from {source}, {model}"


@query("model_leaderboard", sql(f"""
select m.model, s.split, cast(s.days as bigint) as days,
       case when m.model = 'linear' then s.linear_rmse end as linear_rmse, cast(0 as bigint) as without_error
from (values ('linear'), ('gbt'), ('decision_tree'), ('random_forest')) m(model),
     (select 'train' as split, * from ({_linear_error_sql('days', 'ridge')})
      union all select 'holdout', * from ({_linear_error_sql('held_days', 'train_ridge')})) s
""", "days", extra=[
    ("train_days", f"select * from days where {_train_sql('date')}"),
    ("held_days", f"select * from days where not {_train_sql('date')}"),
    *ridge(),
    *ridge("train_days", "train_ridge"),
]))
def model_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight rows; day counts and both linear errors are exact, the other models must have an error."""
    board = regressors.leaderboard(stored_day_frame(spark, sf_dir))
    return shown(
        board.select(
            "model",
            "split",
            "days",
            F.when(F.col("model") == regressors.LINEAR, F.col("rmse")).alias("linear_rmse"),
            F.coalesce(~(F.col("rmse") > 0), F.lit(True)).cast("bigint").alias("without_error"),
        )
    )


@query("model_summary", sql("""
select m.model, cast(m.trees as bigint) as num_trees, cast(0 as bigint) as bad_size, cast(6 as bigint) as num_features
from (values ('gbt', 10), ('random_forest', 20), ('decision_tree', 1)) m(model, trees)
where (select count(*) from days) > 0
""", "days"))
def model_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariant: tree counts and inputs as configured; depth 1 to 5 and a fitting number of nodes."""
    days = stored_day_frame(spark, sf_dir)
    models = regressors.fit_models(days, [regressors.GBT, regressors.FOREST, regressors.TREE])
    rows = regressors.summary(spark, models)
    nodes = F.col("total_nodes")
    fits = F.col("depth").between(1, 5) & (nodes > F.col("num_trees")) & (nodes <= F.col("num_trees") * 63)
    return shown(rows.select("model", "num_trees", (~fits).cast("bigint").alias("bad_size"), "num_features"))


@query("align_predictions_by_date", sql(f"""
select cast(date as varchar) as date, y as actual, round({RIDGE_PREDICTION}, 4) as linear, cast(3 as bigint) as tree_models
from days, ridge
""", "days", extra=ridge()))
def align_predictions_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual values and four predictions side by side; the linear one is exact, the others must be there."""
    days = stored_day_frame(spark, sf_dir)
    rows = regressors.predictions_beside(regressors.fit_models(days), days)
    trees = sum(qcol(n).isNotNull().cast("bigint") for n in regressors.MODELS if n != regressors.LINEAR)
    return shown(rows.select("date", "actual", regressors.LINEAR, trees.alias("tree_models")), DIGITS)


def _clustered(spark: SparkSession, sf_dir: str, k: int = clusters.DEFAULT_K):
    points = features.cluster_frame(stored_day_frame(spark, sf_dir))
    model = clusters.fit(points, k)
    # Later checks read the assignment several times.
    return model, materialize(clusters.assign(points, model), "assigned")


@query("kmeans_fit", sql("select cast(count(*) as bigint) as days, cast(6 as bigint) as k, cast(7 as bigint) as dimensions, cast(6 as bigint) as used from days", "days"))
def kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariant: six centres of seven numbers, each with days of its own."""
    model, assigned = _clustered(spark, sf_dir)
    found = model.clusterCenters()
    return assigned.agg(
        F.count(F.lit(1)).alias("days"),
        F.lit(len(found)).cast("bigint").alias("k"),
        F.lit(len(found[0])).cast("bigint").alias("dimensions"),
        F.count_distinct("cluster").alias("used"),
    )


@query("kmeans_centers", sql("""
select cast(42 as bigint) as coordinates, cast(count(*) as bigint) as days, cast(0 as bigint) as off_mean from days
""", "days"))
def kmeans_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariant: each centre lies within 5 percent of a deviation of the mean of its members.

    Not closer, since the fit may stop at its iteration limit.
    """
    model, assigned = _clustered(spark, sf_dir)
    long = clusters.coordinates(assigned, ["cluster"]).unpivot(
        ["cluster"], [f"`{n}`" for n in clusters.DIMENSIONS], "feature", "x"
    )
    means = long.groupBy("cluster", "feature").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"))
    spread = long.groupBy("feature").agg(F.stddev_samp("x").alias("sd"))
    rows = clusters.centers(spark, model).join(means, ["cluster", "feature"], "left").join(spread, "feature")
    off = F.abs(F.col("value") - F.col("mean")) > 0.05 * F.col("sd")
    return rows.agg(
        F.count(F.lit(1)).alias("coordinates"),
        F.expr(f"sum(n) div {len(clusters.DIMENSIONS)}").alias("days"),
        _count(off).alias("off_mean"),
    )


def _distance(center) -> Column:
    """Squared distance of a row's coordinates to one centre."""
    return sum((qcol(n) - F.lit(float(v))) * (qcol(n) - F.lit(float(v))) for n, v in zip(clusters.DIMENSIONS, center))


def _own_and_nearest(spark: SparkSession, sf_dir: str):
    """The model, and per day the squared distance to its own and to the nearest centre."""
    model, assigned = _clustered(spark, sf_dir)
    rows = clusters.squared_error(clusters.coordinates(assigned, ["cluster"]), spark, model)
    return model, rows.withColumn("nearest", F.least(*[_distance(c) for c in model.clusterCenters()]))


@query("kmeans_wssse", sql("""
select cast(count(*) as bigint) as days, cast(0 as bigint) as differs, cast(0 as bigint) as above_recorded from days
""", "days"))
def kmeans_wssse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariant: the error over the assigned points is the sum of nearest distances.

    The fit records the error before its last step, which never is below.
    """
    model, rows = _own_and_nearest(spark, sf_dir)
    total, recorded = F.sum("error"), clusters.training_wssse(model)
    return rows.agg(
        F.count(F.lit(1)).alias("days"),
        (F.abs(total - F.sum("nearest")) > CLOSE * total).cast("bigint").alias("differs"),
        (total > F.lit(recorded * (1 + CLOSE))).cast("bigint").alias("above_recorded"),
    )


@query("kmeans_assign", sql("""
select cast(count(*) as bigint) as days, cast(0 as bigint) as nearer_elsewhere, cast(0 as bigint) as out_of_range from days
""", "days"))
def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariant: no other centre is nearer to a day than the one it was given."""
    _, rows = _own_and_nearest(spark, sf_dir)
    nearest = F.col("nearest")
    return rows.agg(
        F.count(F.lit(1)).alias("days"),
        _count(F.col("error") > nearest + CLOSE * (1 + nearest)).alias("nearer_elsewhere"),
        _count(~F.col("cluster").between(0, clusters.DEFAULT_K - 1)).alias("out_of_range"),
    )


_POINTS_SQL = """
select cast(date as varchar) as date, round("Tavg", 6) as "Tavg", y as crimes, round("PrecipTotal", 6) as precip,
       cast(1 as bigint) as has_cluster
from days"""


@query("kmeans_points", sql(_POINTS_SQL, "days"))
def kmeans_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scatter points of all days; the cluster number is only checked to be there."""
    _, assigned = _clustered(spark, sf_dir)
    rows = clusters.scatter_points(assigned)
    known = F.col("cluster").isNotNull().cast("bigint")
    return shown(rows.select("date", "Tavg", "crimes", "precip", known.alias("has_cluster")))


@query("collect_cluster_series", sql("""
select cast(6 as bigint) as series, cast(count(*) as bigint) as points, round(sum(y), 6) as crimes,
       cast(0 as bigint) as unnamed
from days""", "days"))
def collect_cluster_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariant: six named series hold every day once, none under another name."""
    _, assigned = _clustered(spark, sf_dir)
    rows = clusters.cluster_series(clusters.scatter_points(assigned))
    return shown(
        rows.agg(
            F.count_distinct("name").alias("series"),
            F.count(F.lit(1)).alias("points"),
            F.sum("crimes").alias("crimes"),
            _count(~F.col("name").rlike("^Cluster[0-5]$")).alias("unnamed"),
        )
    )
