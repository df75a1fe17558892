from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daytally.functions import days, numbers, text
from daytally.functions.groups import SERIES_GROUPS, series_groups


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    "key, short",
    [("1/5/05", "1/5/05"), ("01/05/05", "1/5/05"), ("12/31/14", "12/31/14"), ("bad", None), ("13/1/05", None), ("2/30/05", None)],
)
def test_normalize_day_key(spark, key, short):
    assert one(spark, days.normalize_day_key(F.lit(key))) == short


def test_two_digit_years_are_in_this_century(spark):
    assert one(spark, days.parse_day_key(F.lit("1/5/75"))) == dt.date(2075, 1, 5)


@pytest.mark.parametrize(
    "value, ts",
    [
        ("01/05/2005 12:00:00 AM", dt.datetime(2005, 1, 5, 0, 0)),
        ("01/05/2005 12:30:00 PM", dt.datetime(2005, 1, 5, 12, 30)),
        ("03/13/2005 02:30:00 AM", dt.datetime(2005, 3, 13, 2, 30)),
        ("12/31/2014 11:59:59 PM", dt.datetime(2014, 12, 31, 23, 59, 59)),
        ("02/30/2005 01:00:00 AM", None),
        ("01/05/2005 13:00:00 AM", None),
        ("2005-01-05", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, value, ts):
    assert one(spark, days.try_parse_ts_12h(F.lit(value).cast("string"))) == ts


def test_timestamps_do_not_depend_on_the_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        text_ = F.lit("03/13/2005 02:30:00 AM")
        assert one(spark, days.try_parse_ts_12h(text_).cast("string")) == "2005-03-13 02:30:00"
        assert one(spark, days.epoch_ms(days.truncate_to_day(days.parse_ts_12h(text_)))) == 1110672000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bad_timestamp_fails_the_strict_parse(spark):
    with pytest.raises(Exception):
        spark.createDataFrame([("x",)], "t string").select(days.parse_ts_12h(F.col("t"))).collect()


@settings(max_examples=15, deadline=None)
@given(st.dates(dt.date(2000, 1, 1), dt.date(2099, 12, 31)))
def test_day_functions_match_python(spark, day):
    d = F.lit(day)
    r = spark.range(1).select(
        days.yymmdd(d).alias("k"), days.epoch_ms(d).alias("ms"), days.format_day_key(d).alias("p"),
        days.format_short_day_key(d).alias("s"), days.parse_day_key(days.format_short_day_key(d)).alias("back"),
    ).first()
    assert r.k == int(day.strftime("%y%m%d"))
    assert r.ms == (day - dt.date(1970, 1, 1)).days * 86400000
    assert r.p == day.strftime("%m/%d/%y")
    assert r.s == f"{day.month}/{day.day}/{day:%y}"
    assert r.back == day


def test_recent_days(spark):
    asof = F.lit(dt.date(2017, 3, 2))
    day = F.explode(F.array(*[F.lit(dt.date(2017, 2, 25) + dt.timedelta(i)) for i in range(8)]))
    df = spark.range(1).select(day.alias("d")).filter(days.in_recent_days(F.col("d"), asof, 5))
    assert [r.d.day for r in df.collect()] == [26, 27, 28, 1, 2]


@pytest.mark.parametrize("low, high, mid", [(65, 70, 67), (-3, -4, -4), (-3, 4, 0), (2, 4, 3)])
def test_midrange(spark, low, high, mid):
    assert one(spark, numbers.midrange_int(F.lit(low), F.lit(high))) == mid


def test_percent(spark):
    assert one(spark, numbers.as_percent(F.lit(0.51234))) == 51.2


DECODED = {
    "Total_Crimes": "Total Crimes",
    "Location_COMMERCIAL_s_BUSINESS_OFFICE": "Location: COMMERCIAL / BUSINESS OFFICE",
    "Location_PARKING_LOT__GARAGE_p1_NON_x_RESID_x__p2_": "Location: PARKING LOT/GARAGE(NON.RESID.)",
    "Location_SCHOOL_c_PUBLIC_c_BUILDING": "Location: SCHOOL, PUBLIC, BUILDING",
    "Location_RESIDENCE_PORCH__HALLWAY": "Location: RESIDENCE PORCH/HALLWAY",
    "Location_RESIDENCE_h_GARAGE": "Location: RESIDENCE-GARAGE",
    "Location_RESIDENTIAL_YARD__p1_FRONT__BACK_p2_": "Location: RESIDENTIAL YARD (FRONT/BACK)",
    "Location_VEHICLE_NON_h_COMMERCIAL": "Location: VEHICLE NON-COMMERCIAL",
    "Type_CRIM_SEXUAL_ASSAULT": "Type: CRIM SEXUAL ASSAULT",
}


def test_slugs(spark):
    df = spark.createDataFrame([(k,) for k in DECODED], "slug string")
    got = {r.slug: r.name for r in df.select("slug", text.decode_field_slug(F.col("slug")).alias("name")).collect()}
    assert got == DECODED
    assert {k: text.decode_slug_text(k) for k in DECODED} == DECODED


def test_series_groups(spark):
    df = series_groups(spark)
    assert df.count() == sum(len(s) for s in SERIES_GROUPS.values()) == 47
    assert df.filter("`group` = 'public'").count() == 9
    assert df.filter("category = 'Location: STREET'").first().group == "public"


@pytest.mark.parametrize("cell, zero, missing", [("T", "0", False), ("M", "M", True), ("TM", "0", False), ("5", "5", False), (None, None, False)])
def test_marks(spark, cell, zero, missing):
    c = F.lit(cell).cast("string")
    assert one(spark, text.trace_to_zero(c)) == zero
    assert one(spark, text.is_missing_marker(c)) is missing
