from __future__ import annotations

import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from daytally import jobs
from daytally.operators.daily import TOTAL
from daytally.plans import endpoints, etl
from daytally.sources.csv_files import header_columns

HEADER = ",ID,Case Number,Date,Block,Primary Type,Location Description,Year"


@pytest.fixture
def incident_files(spark, tmp_path):
    one = tmp_path / "2005.csv"
    one.write_text("\n".join([
        HEADER,
        "0,1,A1,01/05/2005 11:30:00 PM,x,THEFT,STREET,2005",
        "1,2,A2,01/05/2005 12:00:00 AM,x,ARSON,\"SCHOOL, PUBLIC\",2005",
        "2,3,A3,01/06/2005 01:00:00 AM,x,THEFT,,2005",
        "3,4,A4,01/06/2005 01:00:00 AM,x,THEFT,STREET,2005,surplus",
        "4,7,A7,01/07/2005 01:00:00 AM,x,NA,STREET,2005",
    ]) + "\n")
    two = tmp_path / "2012.csv"
    two.write_text("\n".join([
        "Year,Location Description,Primary Type,Block,Date,Case Number,ID,",
        "2012,ALLEY,ROBBERY,x,01/05/2012 01:00:00 PM,A1,1,0",
        "2014,ALLEY,ROBBERY,x,12/31/2014 11:59:59 PM,A5,5,1",
        "2015,ALLEY,ROBBERY,x,01/01/2015 12:00:00 AM,A6,6,2",
        ",ALLEY,THEFT,x,12/31/2014 01:00:00 AM,A8,8,3",
    ]) + "\n")
    return [(str(p), header_columns(spark, str(p))) for p in (one, two)]


def test_incident_flow(spark, incident_files):
    clean = etl.clean_incidents(spark, incident_files)
    assert sorted(r.ID for r in clean.collect()) == ["1", "2", "3", "5", "7", "8"]
    wide, long = etl.daily_tables(clean)
    records = {r.Date: r.asDict() for r in etl.keyed_records(wide).collect()}
    assert set(records) == {"01/05/05", "12/31/14"}
    assert records["01/05/05"][TOTAL] == 2
    assert records["01/05/05"]["Location: SCHOOL, PUBLIC"] == 1
    assert records["12/31/14"] == {
        "Date": "12/31/14", TOTAL: 2, "Type: ARSON": 0, "Type: ROBBERY": 1, "Type: THEFT": 1,
        "Location: ALLEY": 2, "Location: SCHOOL, PUBLIC": 0, "Location: STREET": 0,
    }
    assert {(str(r.date), r.category) for r in long.collect()} >= {("2005-01-06", "THEFT"), ("2005-01-07", "STREET")}


@pytest.mark.parametrize("seed", [1, 2])
def test_flow_matches_a_single_process(spark, tmp_path, seed):
    """Random files with repeated keys, gaps, a real OTHER and late years, against pandas."""
    rng = np.random.default_rng(seed)
    files, frames = [], []
    for p, first in enumerate((2005, 2008, 2012)):
        n = 700
        years = rng.integers(first, first + 4, n)
        ids = rng.integers(0, 900, n)
        df = pd.DataFrame({
            "ID": ids,
            "Case Number": [f"C{i}" for i in ids],
            "Date": [f"{m:02d}/{d:02d}/{y} {h:02d}:00:00 {ap}" for m, d, y, h, ap in zip(
                rng.integers(1, 13, n), rng.integers(1, 4, n), years, rng.integers(1, 13, n), rng.choice(["AM", "PM"], n))],
            "Block": "b, with comma",
            "Primary Type": rng.choice([*(f"T{i}" for i in range(30)), "OTHER", None], n),
            "Location Description": rng.choice([*(f"L/{i} (X.)" for i in range(40)), None], n),
            "Year": [None if g else y for g, y in zip(rng.random(n) < 0.05, years)],
        })
        path = tmp_path / f"{p}.csv"
        df.to_csv(path)
        files.append((str(path), header_columns(spark, str(path))))
        frames.append(pd.read_csv(path))
    df = pd.concat(frames, axis=0, ignore_index=True).drop_duplicates(subset=["ID", "Case Number"])
    df = df[~(df["Year"] > 2014)].copy()
    day = pd.to_datetime(df["Date"], format="%m/%d/%Y %I:%M:%S %p").dt.strftime("%m/%d/%y")
    want = {}
    for prefix, column in (("Type: ", "Primary Type"), ("Location: ", "Location Description")):
        counts = sorted(df[column].value_counts().items(), key=lambda kv: (-kv[1], kv[0]))
        df.loc[df[column].isin([k for k, _ in counts[20:]]), column] = "OTHER"
        want[prefix] = pd.crosstab(day, df[column]).add_prefix(prefix)
    total = want["Type: "].sum(axis=1).to_frame(TOTAL)
    expected = total.join(want["Type: "], how="inner").join(want["Location: "], how="inner")
    wide, long = etl.daily_tables(etl.clean_incidents(spark, files))
    got = etl.keyed_records(wide).toPandas().set_index("Date").loc[expected.index, list(expected.columns)]
    assert wide.count() == len(expected)
    assert (got.to_numpy() == expected.to_numpy()).all()
    by_dimension = {r.dimension: r.n for r in long.groupBy("dimension").agg(F.sum("n").alias("n")).collect()}
    assert by_dimension == {"Type": df["Primary Type"].count(), "Location": df["Location Description"].count()}


def test_daily_records_are_stored_and_overwritten(spark, incident_files, tmp_path):
    wide, _ = etl.daily_tables(etl.clean_incidents(spark, incident_files))
    first = etl.store_daily(spark, wide, str(tmp_path / "v1"))
    assert first.count() == 2
    newer = wide.filter("date = '2014-12-31'").withColumn(TOTAL, F.lit(9).cast("bigint"))
    second = etl.store_daily(spark, newer, str(tmp_path / "v2"), str(tmp_path / "v1"))
    assert {r.Date: r[TOTAL] for r in second.collect()} == {"01/05/05": 2, "12/31/14": 9}


@pytest.fixture
def weather(spark, tmp_path):
    path = tmp_path / "weather.csv"
    path.write_text("\n".join([
        "Date,Depart,Heat,PrecipTotal,Tavg,Tmax,Tmin",
        "1/5/05,2,40,T,25,30,20",
        "1/6/05,M,40,0.1,25,30,20",
        "01/07/05,-3,,0.25,26,31,21",
        "1/8/05,1,1,1,1,1,1,1",
    ]) + "\n")
    return etl.clean_weather(spark, str(path))


def test_weather_flow(weather):
    good, rejects = weather
    got = {r.date_key: r for r in good.collect()}
    assert set(got) == {"1/5/05", "1/7/05"}
    assert got["1/5/05"].PrecipTotal == 0.0 and got["1/7/05"].Heat is None
    assert got["1/7/05"].day == dt.date(2005, 1, 7)
    assert sorted(r.reason for r in rejects.collect()) == ["missing_marker", "surplus_cell"]


def test_weather_goes_by_its_header_and_the_last_line_of_a_day_counts(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text("\n".join([
        "Station,Date,Tmax,Tmin,Tavg,Depart,Heat,PrecipTotal",
        "S,1/5/05,80,60,70,1,0,0.5",
        "S,1/6/05,81,61,71,1,0,0.5",
        "S,1/5/05,90,60,75,2,0,0.25",
        "M,1/7/05,90,60,75,2,0,0.25",
    ]) + "\n")
    good, rejects = etl.clean_weather(spark, str(path))
    got = {r.date_key: (r.Tmax, r.Tavg, r.Depart, r.PrecipTotal) for r in good.collect()}
    assert got == {"1/5/05": (90.0, 75.0, 2.0, 0.25), "1/6/05": (81.0, 71.0, 1.0, 0.5)}
    assert [r.reason for r in rejects.collect()] == ["missing_marker"]
    first = etl.store_weather(spark, good, str(tmp_path / "v1"))
    newer = good.filter("date_key = '1/6/05'").withColumn("Tmax", F.lit(1.0))
    second = etl.store_weather(spark, newer, str(tmp_path / "v2"), str(tmp_path / "v1"))
    assert first.count() == 2 and {r.date_key: r.Tmax for r in second.collect()} == {"1/5/05": 90.0, "1/6/05": 1.0}


def test_weather_without_a_needed_column_is_an_error(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text("Date,Tmax\n1/5/05,80\n")
    with pytest.raises(ValueError, match="PrecipTotal"):
        etl.clean_weather(spark, str(path))


def test_days_that_share_a_key(spark, incident_files, tmp_path):
    wide, _ = etl.daily_tables(etl.clean_incidents(spark, incident_files))
    one = wide.limit(1)
    both = one.withColumn("date", F.lit("1905-01-05").cast("date")).withColumn(TOTAL, F.lit(99).cast("bigint")).unionByName(
        one.withColumn("date", F.lit("2005-01-05").cast("date")).withColumn(TOTAL, F.lit(3).cast("bigint")))
    assert [r[TOTAL] for r in etl.store_daily(spark, both, str(tmp_path / "s")).collect()] == [3]


def test_endpoints(spark, incident_files, weather):
    wide, _ = etl.daily_tables(etl.clean_incidents(spark, incident_files))
    daily = weather[0].drop("Date").withColumnRenamed("day", "date")
    assert [r.Date for r in endpoints.weather_data(daily).collect()] == [50105, 50107]
    assert [r.Tavg for r in endpoints.weather_field(daily, "Tavg").collect()] == [25.0, 26.0]
    assert [r.Date for r in endpoints.crime_data(wide).collect()] == [50105, 141231]
    field = endpoints.crime_field(wide, "Location_SCHOOL_c_PUBLIC")
    assert [tuple(r) for r in field.collect()] == [(50105, 2005, 1, 5, 1.0), (141231, 2014, 12, 31, 0.0)]
    assert endpoints.crime_data(wide.limit(0)).count() == 0
    assert [tuple(r) for r in endpoints.weather_field(daily.limit(0), "Tavg").collect()] == [(0, 0, 0, 0, 0.0)]
    both = endpoints.temperature_and_total(daily, wide).collect()
    assert [(str(r.date), r.Tavg, r[TOTAL]) for r in both] == [
        ("2005-01-05", 25.0, 2), ("2005-01-07", 26.0, None), ("2014-12-31", None, 2),
    ]


def test_past_weather_and_forecast(spark):
    asof = dt.date(2017, 4, 30)

    def history(t):
        return json.dumps({"history": {"dailysummary": [{"precipi": "0", "meantempi": str(t), "maxtempi": "9", "mintempi": "1"}]}})

    docs = spark.createDataFrame([(asof - dt.timedelta(i), history(i)) for i in range(-2, 9)], "day date, doc string")
    past = endpoints.past_weather(docs, "doc", "day", F.lit(asof)).collect()
    assert [(r.Date, r.Tavg) for r in past] == [(f"04/{30 - i}/2017", str(i)) for i in range(5)]
    entries = [{"low": str(i), "high": str(i + 3)} for i in range(10)]
    nested = {"query": {"results": {"channel": {"item": {"forecast": entries}}}}}
    one = spark.createDataFrame([(json.dumps(nested),)], "doc string")
    ahead = endpoints.forecast(one, "doc", F.lit(asof)).collect()
    assert [(r.Date, r.Tmin, r.Tmax, r.Tavg) for r in ahead][:2] == [("04/30/2017", "0", "3", "1"), ("05/01/2017", "1", "4", "2")]
    assert len(ahead) == 5


def test_group_series(weather):
    daily = weather[0].drop("Date").withColumnRenamed("day", "date")
    rows = endpoints.group_series(daily, "weather").collect()
    assert len(rows) == 12 and {r.category for r in rows} == {"Depart", "Heat", "PrecipTotal", "Tavg", "Tmin", "Tmax"}
    with pytest.raises(ValueError, match="unknown group"):
        endpoints.group_series(daily, "nope")
    with pytest.raises(ValueError, match="unknown column"):
        endpoints.group_series(daily, "total")


def test_jobs(spark, incident_files, tmp_path):
    out = str(tmp_path / "daily")
    jobs.run(spark, ["daily", "--out", out, *[p for p, _ in incident_files]])
    assert spark.read.parquet(f"{out}/wide").count() == 2
    long = spark.read.parquet(f"{out}/long")
    assert set(long.columns) == {"date", "dimension", "category", "n"}
    again = str(tmp_path / "again")
    jobs.run(spark, ["daily", "--out", again, "--existing", out, incident_files[0][0]])
    assert sorted(r.Date for r in spark.read.parquet(f"{again}/wide").collect()) == ["01/05/05", "12/31/14"]
    path = tmp_path / "w.csv"
    path.write_text("Date,Depart,Heat,PrecipTotal,Tavg,Tmax,Tmin\n1/5/05,2,40,T,25,30,20\n1/6/05,M,1,1,1,1,1\n")
    jobs.run(spark, ["weather", "--out", str(tmp_path / "weather"), str(path)])
    assert spark.read.parquet(str(tmp_path / "weather" / "days")).count() == 1
    assert spark.read.parquet(str(tmp_path / "weather" / "rejects")).first().reason == "missing_marker"


def test_predictive_data(spark):
    from daytally.operators.series import MEASURES

    n = 60
    i = F.col("id").cast("double")
    days = spark.range(n).select(
        F.date_add(F.lit("2005-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        *[(F.sin(i * (k + 1)) * 10).alias(m) for k, m in enumerate(MEASURES)],
        (F.lit(100) + F.col("id") % 17).alias(TOTAL),
    ).cache()
    out = endpoints.predictive_data(days, 3)
    assert set(out) == {"linear", "gbt", "random_forest", "decision_tree", "kmeans", "corr"}
    for name in ("linear", "gbt", "random_forest", "decision_tree"):
        assert out[name]["predictions"].count() == n and out[name]["rmse"].first().rmse > 0
    assert out["kmeans"]["clusters"].count() == n and out["kmeans"]["centers"].count() == 21
    assert out["corr"].count() == 7
    assert endpoints.correlation_chart(days).count() == 6
