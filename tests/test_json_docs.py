from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from daytally.sources import json_docs as jd


def test_row_documents(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text("\n".join(json.dumps(r) for r in [{"z": 1, "a": 0.5}, {"z": 2, "a": 1, "m": "x"}]))
    inferred = jd.read_json_rows(spark, str(path))
    assert dict(inferred.dtypes) == {"a": "double", "m": "string", "z": "bigint"}
    given = jd.read_json_rows(spark, str(path), "z int")
    assert sorted(r.z for r in given.collect()) == [1, 2]


def test_history(spark):
    full = {"history": {"dailysummary": [{"precipi": "0.1", "meantempi": "50", "maxtempi": "60", "mintempi": "40"}, {"precipi": "9"}]}}
    docs = spark.createDataFrame(
        [(dt.date(2017, 4, 1), json.dumps(full)), (dt.date(2017, 4, 2), json.dumps({"history": {"dailysummary": []}}))],
        "day date, doc string",
    )
    got = [tuple(r) for r in jd.history_days(docs, "doc", F.col("day")).orderBy("Date").collect()]
    assert got == [("04/01/2017", "0.1", "50", "60", "40"), ("04/02/2017", None, None, None, None)]


def test_forecast_keeps_five_days(spark):
    days = [{"low": str(30 + i), "high": str(45 + i)} for i in range(10)]
    doc = json.dumps({"query": {"results": {"channel": {"item": {"forecast": days}}}}})
    docs = spark.createDataFrame([(dt.date(2017, 4, 28), doc)], "asof date, doc string")
    got = [tuple(r) for r in jd.forecast_days(docs, "doc", F.col("asof")).orderBy("day").collect()]
    assert len(got) == 5
    assert got[0] == (dt.date(2017, 4, 28), "30", "45", "37")
    assert got[4][0] == dt.date(2017, 5, 2)


def test_forecast_with_negative_and_bad_temperatures(spark):
    days = [{"low": "-3", "high": "-4"}, {"low": "x", "high": "1"}]
    doc = json.dumps({"query": {"results": {"channel": {"item": {"forecast": days}}}}})
    docs = spark.createDataFrame([(dt.date(2017, 1, 1), doc)], "asof date, doc string")
    got = [r.Tavg for r in jd.forecast_days(docs, "doc", F.col("asof")).orderBy("day").collect()]
    assert got == ["-4", None]


def _doc(*pairs):
    days = [{"low": a, "high": b} for a, b in pairs]
    return json.dumps({"query": {"results": {"channel": {"item": {"forecast": days}}}}})


def test_next_days_of_every_key_from_many_documents(spark):
    d = dt.date(2017, 4, 28)
    docs = [
        ("a", d, _doc(("1", "3"), ("2", "4"), ("3", "5"))),
        ("a", d + dt.timedelta(1), _doc(("10", "20"), ("11", "21"), ("12", "22"), ("13", "23"))),  # issued later, so it counts
        ("a", d + dt.timedelta(1), _doc(("09", "20"))),  # issued the same day: the larger text counts
        ("b", d - dt.timedelta(9), _doc(("1", "1"))),  # over
        ("b", d + dt.timedelta(30), _doc(("x", "1"), (None, "2"))),
        ("c", d, "{not json"),
        (None, d, _doc(("5", "6"))),
    ]
    frame = spark.createDataFrame(docs, "place string, issued date, doc string")
    rows = jd.next_days_by_key(frame, "place", "doc", F.col("issued"), F.lit(d).cast("date"), 3).collect()
    got = sorted((str(r.place), (r.day - d).days, r.Tmin, r.Tmax, r.Tavg) for r in rows)
    assert got == [
        ("None", 0, "5", "6", "5"),
        ("a", 0, "1", "3", "2"), ("a", 1, "10", "20", "15"), ("a", 2, "11", "21", "16"),
        ("b", 30, "x", "1", None), ("b", 31, None, "2", None),
    ]


def test_a_key_with_most_documents_is_cut_before_the_shuffle(spark):
    days = ", ".join(f"struct('{i}' as low, '{i + 2}' as high)" for i in range(10))
    docs = spark.range(0, 3000, 1, 8).selectExpr(
        "case when id % 3 = 0 then 0 else id end as place", "date_add(date'2017-01-01', cast(id % 40 as int)) as issued",
        f"to_json(named_struct('query', named_struct('results', named_struct('channel', named_struct('item', named_struct('forecast', array({days}))))))) as doc",
    )
    out = jd.next_days_by_key(docs, "place", "doc", F.col("issued"), F.lit("2017-01-20").cast("date"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "WindowGroupLimit" in plan
    assert out.where("place = 0").count() == 5 and out.groupBy("place").count().where("count > 5").count() == 0
