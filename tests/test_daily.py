from __future__ import annotations

import pytest

from daytally.operators import daily as d

DIMS = ["type", "location"]


def incidents(spark, data):
    return spark.createDataFrame(data, "ts string, type string, location string").selectExpr(
        "cast(ts as timestamp_ntz) as ts", "type", "location"
    )


@pytest.fixture
def cats(spark):
    values = ["a"] * 5 + ["b"] * 4 + ["c"] * 2 + ["d"] * 2 + ["OTHER"] * 1 + [None] * 3
    return spark.createDataFrame([(v,) for v in values], "c string")


def test_frequency_leaves_out_null(rows, cats):
    assert rows(d.category_frequency(cats, "c")) == [("OTHER", 1), ("a", 5), ("b", 4), ("c", 2), ("d", 2)]


def test_ties_go_by_name(cats):
    top = d.ranked_categories(d.category_frequency(cats, "c"), 3)
    assert [r.category for r in top.collect()] == ["a", "b", "c"]


def test_bucket_merges_with_real_other_and_keeps_null(rows, cats):
    out = d.bucket_topn(cats, "c", 3)
    got = {r.c: r["count"] for r in out.groupBy("c").count().collect()}
    assert got == {"a": 5, "b": 4, "c": 2, "OTHER": 3, None: 3}
    assert [r.category for r in d.category_domain(out, "c").collect()] == ["OTHER", "a", "b", "c"]


def test_real_other_among_the_leading_ones(spark):
    df = spark.createDataFrame([("OTHER",)] * 3 + [("a",)] * 2 + [("b",)], "c string")
    b = d.leading_buckets(df, ["c"], 2)[0]
    assert (b.keep, b.domain) == (["OTHER", "a"], ["OTHER", "a"])
    got = {r.c: r["count"] for r in df.withColumn("c", b.expr()).groupBy("c").count().collect()}
    assert got == {"OTHER": 4, "a": 2}


def test_no_other_bucket_when_nothing_is_left(cats):
    assert d.leading_buckets(cats, ["c"], 5)[0].domain == ["OTHER", "a", "b", "c", "d"]
    few = cats.filter("c <> 'OTHER'")
    assert d.leading_buckets(few, ["c"], 4)[0].domain == ["a", "b", "c", "d"]


def test_buckets_equal_bucket_topn(rows, cats):
    b = d.leading_buckets(cats, ["c"], 2)[0]
    assert rows(cats.withColumn("c", b.expr())) == rows(d.bucket_topn(cats, "c", 2))


@pytest.fixture
def null_dims(spark):
    return incidents(
        spark,
        [
            ("2005-01-01 01:00:00", "theft", "street"),
            ("2005-01-01 23:00:00", None, "street"),
            ("2005-01-01 23:59:59", "theft", None),
            ("2005-01-02 00:00:00", "arson", "alley, (rear)"),
            ("2005-01-03 00:00:00", None, "street"),
            ("2005-01-04 00:00:00", "theft", None),
            (None, "theft", "street"),
        ],
    )


def both(null_dims):
    cube = d.day_cube(null_dims, "ts", DIMS)
    return cube, *d.leading_buckets(cube, DIMS, weight="n")


def test_wide_table(null_dims):
    wide = d.daily_wide(*both(null_dims)).orderBy("date")
    assert wide.columns == ["date", d.TOTAL, "Type: arson", "Type: theft", "Location: alley, (rear)", "Location: street"]
    got = [(str(r[0]), *tuple(r)[1:]) for r in wide.collect()]
    # Days without any type or without any location are not in the table.
    assert got == [("2005-01-01", 2, 0, 2, 0, 2), ("2005-01-02", 1, 1, 0, 1, 0)]


def test_wide_equals_join_of_pivots(null_dims):
    cube, types, locations = both(null_dims)
    by_type = d.daily_pivot(cube.withColumn("type", types.expr()), "type", types.domain, "n")
    by_location = d.daily_pivot(cube.withColumn("location", locations.expr()), "location", locations.domain, "n")
    joined = d.join_daily(
        d.row_total(by_type, types.domain),
        d.prefix_columns(by_type, "Type: ", ["date"]),
        d.prefix_columns(by_location, "Location: ", ["date"]),
    )
    wide = d.daily_wide(cube, types, locations)
    assert joined.columns == wide.columns
    assert joined.exceptAll(wide).count() == 0 and wide.exceptAll(joined).count() == 0


def test_totals_without_the_cube(null_dims, rows):
    cube, types, locations = both(null_dims)
    wide = d.daily_wide(cube, types, locations)
    assert rows(d.daily_totals(null_dims, "ts", "type", "location")) == rows(wide.select("date", f"`{d.TOTAL}`"))


def test_pivot_counts_rows_and_skips_days_without_category(null_dims, rows):
    df = null_dims.selectExpr("cast(ts as date) as date", "location")
    got = [(str(r[0]), *r[1:]) for r in rows(d.daily_pivot(df, "location", ["street"]))]
    assert got == [("2005-01-01", 2), ("2005-01-02", 0), ("2005-01-03", 1)]


def test_long_table(null_dims, rows):
    long = d.daily_long(*both(null_dims))
    got = [(str(a), *r) for a, *r in rows(long)]
    assert ("2005-01-03", "Location", "street", 1) in got
    assert ("2005-01-04", "Type", "theft", 1) in got
    assert all(c is not None for _, _, c, _ in got)


def test_incidents_without_a_day_count_for_the_frequencies(null_dims, rows):
    cube, types, locations = both(null_dims)
    assert rows(d.category_frequency(cube, "type", "n")) == [("arson", 1), ("theft", 4)]
    assert all(r.date is not None for r in d.daily_long(cube, types, locations).collect())


def test_no_incidents_at_all(null_dims):
    cube, types, locations = both(null_dims.limit(0))
    assert types.domain == [] and locations.domain == []
    assert d.daily_wide(cube, types, locations).columns == ["date", d.TOTAL]
    assert d.daily_wide(cube, types, locations).count() == 0
    assert d.daily_long(cube, types, locations).count() == 0


def test_names_with_dots_and_commas(spark, rows):
    name = "PARKING LOT/GARAGE(NON.RESID.)"
    df = incidents(spark, [("2005-01-01 01:00:00", "t", name), ("2005-01-01 02:00:00", "t", "SCHOOL, PUBLIC")])
    cube = d.day_cube(df, "ts", DIMS)
    wide = d.daily_wide(cube, *d.leading_buckets(cube, DIMS, weight="n"))
    assert wide.select(f"`Location: {name}`", "`Location: SCHOOL, PUBLIC`").first() == (1, 1)


def test_same_bucket_name_in_both_dimensions(spark):
    data = [("2005-01-01 01:00:00", f"t{i}", f"l{i}") for i in range(4)]
    cube = d.day_cube(incidents(spark, data), "ts", DIMS)
    wide = d.daily_wide(cube, *d.leading_buckets(cube, DIMS, 2, "n"))
    assert wide.select("`Type: OTHER`", "`Location: OTHER`").first() == (2, 2)
