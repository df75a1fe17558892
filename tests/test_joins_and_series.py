from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daytally.operators import joins as j
from daytally.operators import series as s


def D(n):
    return dt.date(2005, 1, n)


def test_last_written_row_of_a_day(spark, rows):
    df = spark.createDataFrame([(D(1), 1, 10), (D(1), 2, 20), (D(2), 1, 30)], "d date, seq int, v int")
    assert rows(j.one_per_day(df, "d", ["seq"])) == [(D(1), 2, 20), (D(2), 1, 30)]
    assert rows(j.one_per_day(df, "d", ["seq"], last=False)) == [(D(1), 1, 10), (D(2), 1, 30)]


def test_join_drops_unmatched(spark, rows):
    a = spark.createDataFrame([(D(1), 1), (D(2), 2)], "d date, a int")
    b = spark.createDataFrame([(D(2), 5), (D(3), 6)], "d date, b int")
    assert rows(j.join_by_day(a, b, "d")) == [(D(2), 2, 5)]
    assert rows(j.overlay(a, b, "d")) == [(D(1), 1, None), (D(2), 2, 5), (D(3), None, 6)]


def test_right_value_stands_even_when_null(spark):
    w = spark.createDataFrame([(D(1), 1.5, 7)], "d date, t double, x int")
    c = spark.createDataFrame([(D(1), None, 3)], "d date, x int, n int")
    assert j.merge_right_wins(w, c, "d").first().asDict() == {"d": D(1), "t": 1.5, "x": None, "n": 3}


def test_align_goes_by_day_and_not_by_position(spark):
    actual = spark.createDataFrame([(D(2), 2.0), (D(1), 1.0), (D(3), 3.0)], "d date, actual double")
    p = spark.createDataFrame([(D(1), 10.0), (D(2), 20.0)], "d date, prediction double")
    out = j.align_series(actual, {"m": p}, "d", "prediction")
    assert {r.d: r.m for r in out.collect()} == {D(1): 10.0, D(2): 20.0, D(3): None}


def test_default_row(spark, rows):
    df = spark.createDataFrame([(5, 1.5)], "a int, b double")
    assert rows(s.default_row_if_empty(df)) == [(5, 1.5)]
    empty = s.default_row_if_empty(df.filter("a > 9"))
    assert rows(empty) == [(0, 0.0)] and empty.dtypes == df.dtypes


def test_field_under_its_short_name(spark, rows):
    df = spark.createDataFrame([(D(5), 3)], "date date, `Location: A (X.Y)` int")
    out = s.project_field(df, "date", "Location: A (X.Y)", "slug")
    assert out.columns == ["Date", "Year", "Month", "Day", "slug"]
    assert rows(out) == [(50105, 2005, 1, 5, 3.0)]
    with pytest.raises(ValueError, match="unknown column"):
        s.project_field(df, "date", "nope")


def test_unpivot(spark, rows):
    df = spark.createDataFrame([(D(1), 1, 0)], "date date, `Type: a.b` bigint, `Type: c` bigint")
    assert rows(s.unpivot(df, "date")) == [(D(1), "Type: a.b", 1), (D(1), "Type: c", 0)]


def test_groups(spark, rows):
    long = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "category string, n int")
    groups = spark.createDataFrame([("x", "g1"), ("x", "g2"), ("z", "g1")], "category string, grp string")
    assert rows(s.select_groups(long, groups)) == [("x", 1, "g1"), ("x", 1, "g2"), ("z", 3, "g1")]


@settings(max_examples=8, deadline=None)
@given(st.sets(st.dates(dt.date(1999, 1, 1), dt.date(2004, 12, 31)), min_size=1, max_size=40))
def test_ordinals_match_sorting(spark, found):
    df = spark.createDataFrame([(d,) for d in found], "date date")
    got = {r.date: r.ordinal for r in s.with_day_ordinal(df, "date").collect()}
    assert got == {d: i for i, d in enumerate(sorted(found), 1)}


def test_rows_of_one_day_share_its_ordinal(spark):
    df = spark.createDataFrame([(D(3), 1), (D(1), 2), (D(3), 3)], "date date, v int")
    out = s.with_day_ordinal(df, "date")
    assert sorted((r.v, r.ordinal) for r in out.collect()) == [(1, 2), (2, 1), (3, 2)]


def test_sorting_and_preview(spark):
    df = spark.createDataFrame([(D(3),), (D(1),), (D(2),)], "date date")
    assert [r.date for r in s.sort_by_day(df, "date").collect()] == [D(1), D(2), D(3)]
    assert [r.date for r in s.preview(df, ["date"]).collect()] == [D(1), D(2)]


def test_recent_rows_carry_the_long_day(spark):
    df = spark.createDataFrame([(D(1),), (D(9),)], "day date")
    assert [r.Date for r in s.recent_days(df, "day", F.lit(D(10)), 5).collect()] == ["01/09/2005"]
