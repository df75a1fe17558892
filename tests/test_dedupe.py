from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daytally.operators.dedupe import dedupe_keep_first, keep_last


def test_first_file_wins_and_null_keys_collapse(spark, rows):
    df = spark.createDataFrame(
        [
            (1, "A", 0, "theft"), (1, "A", 1, "arson"), (1, "B", 1, "arson"),
            (None, None, 1, "late"), (None, None, 0, "early"), (None, "A", 0, "own"),
        ],
        "ID int, `Case Number` string, file int, type string",
    )
    got = rows(dedupe_keep_first(df, ["ID", "Case Number"], ["file"]))
    assert got == [(None, None, 0, "early"), (None, "A", 0, "own"), (1, "A", 0, "theft"), (1, "B", 1, "arson")]


def test_null_order_value_comes_first(spark, rows):
    df = spark.createDataFrame([(1, 5), (1, None)], "k int, o int")
    assert rows(dedupe_keep_first(df, ["k"], ["o"])) == [(1, None)]
    assert rows(keep_last(df, ["k"], ["o"])) == [(1, 5)]


def test_column_names_with_dots(spark, rows):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "`k.1` int, `o.1` int, `v.1` string")
    out = dedupe_keep_first(df, ["k.1"], ["o.1"])
    assert out.columns == df.columns and rows(out) == [(1, 1, "a")]


def test_keys_only(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(dedupe_keep_first(df, ["k"], ["k"])) == [(1,), (2,)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    n = 200_000
    df = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"), F.col("id").alias("o")
    )
    out = dedupe_keep_first(df, ["k"], ["o"])
    assert out.count() == n - len(range(0, n, 3)) + 1
    assert out.filter("k is null").first().o == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 5)), min_size=1, max_size=30))
def test_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, o int, v int")
    want = {}
    for k, o, v in data:
        want[k] = min(want.get(k, (o, v)), (o, v))
    got = {r.k: (r.o, r.v) for r in dedupe_keep_first(df, ["k"], ["o"]).collect()}
    assert got == want
