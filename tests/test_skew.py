"""One key holding a third of all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daytally.operators import daily as d
from daytally.operators.dedupe import dedupe_keep_first
from daytally.sources import generated_tables as g

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def large_join_settings(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    """A star schema whose line items name one part and one supplier in every third row."""
    base = tmp_path_factory.mktemp("hot")
    n = 300_000
    hot = F.col("id") % 3 == 0
    spark.range(0, n, 1, 8).select(
        F.col("id").alias("l_orderkey"),
        F.lit(1).alias("l_linenumber"),
        F.expr("timestamp_ntz'1996-01-01 00:00:00' + make_dt_interval(cast(id % 700 as int), 0, 0, cast(rand(1) * 86399 as decimal(18,6)))").alias("l_shipdate"),
        F.when(hot, 0).otherwise(F.col("id") % 5000).cast("bigint").alias("l_partkey"),
        F.when(hot, 0).otherwise(F.col("id") % 1000).cast("bigint").alias("l_suppkey"),
        *[F.rand(i).alias(c) for i, c in enumerate(["l_quantity", "l_extendedprice", "l_discount", "l_tax"])],
        F.lit("A").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"),
    ).write.parquet(f"{base}/lineitem.parquet")
    spark.range(5000).select(F.col("id").alias("p_partkey"), F.concat(F.lit("B"), F.col("id") % 30).alias("p_brand")).write.parquet(f"{base}/part.parquet")
    spark.range(1000).select(F.col("id").alias("s_suppkey"), (F.col("id") % 25).cast("int").alias("s_nationkey")).write.parquet(f"{base}/supplier.parquet")
    spark.range(25).select(F.col("id").cast("int").alias("n_nationkey"), F.concat(F.lit("N"), F.col("id")).alias("n_name")).write.parquet(f"{base}/nation.parquet")
    return str(base)


def test_hot_part_and_supplier_are_split(spark, hot_dir, large_join_settings):
    out = dedupe_keep_first(g.incidents(spark, hot_dir), g.KEYS, g.FIRST_ORDER)
    assert out.count() == 300_000
    out.write.format("noop").mode("overwrite").save()
    rows = g.incidents(spark, hot_dir).groupBy(g.TYPE).agg(F.count(F.lit(1)), F.max("id"), F.max("ts"), F.sum("l_quantity"))
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true) [l_partkey" in plan
    assert "SortMergeJoin(skew=true) [l_suppkey" in plan


def test_counts_with_a_hot_part(spark, hot_dir):
    cube = g.incident_cube(spark, hot_dir)
    freq = {r.category: r.n for r in d.category_frequency(cube, g.TYPE, "n").collect()}
    want = {}
    for i in range(300_000):
        k = f"B{0 if i % 3 == 0 else (i % 5000) % 30}"
        want[k] = want.get(k, 0) + 1
    assert freq == want


def test_one_key_with_a_third_of_the_rows(spark):
    n = 300_000
    df = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        (F.lit(n) - F.col("id")).alias("ts"),
    )
    first = dedupe_keep_first(df, ["k"], ["ts"])
    assert first.count() == n - n // 3 + 1
    assert first.filter("k = -1").first().ts == n - max(range(0, n, 3))
