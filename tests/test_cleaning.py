from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daytally.operators import cleaning as cl
from daytally.sources.csv_files import OVERFLOW

CELLS = ["Date", "Tavg", "PrecipTotal"]


@pytest.fixture
def cells(spark):
    return spark.createDataFrame(
        [
            ("1/1/05", "30", "0.1", None),
            ("1/2/05", "30", "T", None),
            ("1/3/05", "M", "0.1", None),
            ("1/4/05", "TM", "0.1", None),
            ("1/5/05", "M", "T", None),
            ("1/6/05", "", None, None),
            ("1/7/05", "30", "0.1", "x"),
            ("1/8/05", "30", "0.1", ""),
            (None, "30", "0.1", None),
            ("1/9/05", "M", "0.1", "x"),
        ],
        f"Date string, Tavg string, PrecipTotal string, {OVERFLOW} string",
    )


def test_quarantine(rows, cells):
    good, rejects = cl.quarantine(cells, CELLS, "Date", OVERFLOW)
    assert rows(good) == [
        ("1/1/05", "30", "0.1"),
        ("1/2/05", "30", "0"),
        ("1/4/05", "0", "0.1"),
        ("1/6/05", None, None),
        ("1/8/05", "30", "0.1"),
    ]
    reasons = {(r.Date, r.reason) for r in rejects.collect()}
    assert reasons == {
        ("1/3/05", "missing_marker"),
        ("1/5/05", "missing_marker"),
        ("1/9/05", "missing_marker"),
        ("1/7/05", "surplus_cell"),
        (None, "no_key"),
    }


def test_good_and_rejects_cover_all_rows(cells):
    good, rejects = cl.quarantine(cells, CELLS, "Date", OVERFLOW)
    assert good.count() + rejects.count() == cells.count()


def test_year_filter_keeps_null(spark, rows):
    df = spark.createDataFrame([(2013,), (2014,), (2015,), (None,)], "Year int")
    assert rows(cl.filter_year_upto(df, "Year", 2014)) == [(None,), (2013,), (2014,)]


def test_day_filter_equals_year_filter(spark, rows):
    df = spark.sql("""select * from values (timestamp_ntz'2014-12-31 23:59:59.999'), (timestamp_ntz'2015-01-01 00:00:00'),
                      (timestamp_ntz'1999-05-05 01:02:03'), (null) t(ts)""")
    by_year = cl.filter_year_upto(df.withColumn("y", F.year("ts")), "y", 2014).drop("y")
    assert rows(cl.filter_day_upto(df, "ts", 2014)) == rows(by_year)


def test_drop_columns_names_must_exist(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, c int")
    assert cl.drop_columns(df, ["a.b"]).columns == ["c"]
    with pytest.raises(ValueError):
        cl.drop_columns(df, ["nope"])


def test_union_by_name(spark, rows):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2, 0.5)], "s string, n int, d double")
    assert rows(cl.union_by_name(a, b)) == [(1, "x", None), (2, "y", 0.5)]


def test_cast_counts_bad_cells(spark, rows):
    df = spark.createDataFrame([("1", "2.5"), ("x", "y"), (None, "3"), (" 7 ", "")], "a string, b string")
    got = rows(cl.cast_record_types(df, {"a": "int", "b": "double"}))
    assert got == [(None, None, 2), (None, 3.0, 0), (1, 2.5, 0), (7, None, 1)]
