"""The dashboards' own questions, whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.operators.daily import daily_wide, leading_buckets
from daytally.operators.series import MEASURES
from daytally.plans import endpoints, etl
from daytally.queries.base_sql import PARTS, ROUNDED, counts_text, sql
from daytally.queries.daily_counts import as_text
from daytally.queries.registry import query, shown
from daytally.scratch import fresh_path, materialize
from daytally.sources.generated_tables import LOCATION, TYPE, crime_totals, daily_obs, stored_cube, table


@query("weather_data", sql(f"select {PARTS}, {ROUNDED} from obs", "obs"))
def weather_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(endpoints.weather_data(daily_obs(spark, sf_dir)))


@query("weather_field", sql(f'select {PARTS}, round("PrecipTotal", 6) as "PrecipTotal" from obs', "obs"))
def weather_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(endpoints.weather_field(daily_obs(spark, sf_dir), "PrecipTotal"))


_CRIME = counts_text("wide_rows", "cast(d.date as date) as date")


@query("crime_data", sql(f"select {PARTS}, counts from ({_CRIME})", "wide_rows"))
def crime_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = stored_cube(spark, sf_dir)
    wide = daily_wide(cube, *leading_buckets(cube, [TYPE, LOCATION], weight="n"))
    return as_text(shown(endpoints.crime_data(wide)), ["Date", "Year", "Month", "Day"])


@query("crime_field", sql(f'select {PARTS}, cast(total as double) as "Total_Crimes" from totals', "totals"))
def crime_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(endpoints.crime_field(crime_totals(spark, sf_dir), "Total_Crimes"))


@query("past_weather", """
select strftime(o_orderdate, '%m/%d/%Y') as "Date", cast(o_orderkey as varchar) as "PrecipTotal",
       cast(o_custkey as varchar) as "Tavg", o_orderstatus as "Tmax", o_orderpriority as "Tmin"
from orders where cast(o_orderdate as date) between date '1999-12-27' and date '1999-12-31'
""")
def past_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History documents of the last five days up to a given day."""
    summary = F.struct(
        F.col("o_orderkey").cast("string").alias("precipi"),
        F.col("o_custkey").cast("string").alias("meantempi"),
        F.col("o_orderstatus").alias("maxtempi"),
        F.col("o_orderpriority").alias("mintempi"),
    )
    doc = F.to_json(F.struct(F.struct(F.array(summary).alias("dailysummary")).alias("history")))
    docs = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"), doc.alias("doc"))
    docs = materialize(docs, "history-docs")
    return endpoints.past_weather(docs, "doc", "day", F.lit("1999-12-31").cast("date"))


@query("forecast", """
select o_custkey, strftime(day, '%m/%d/%Y') as "Date", cast(low as varchar) as "Tmin", cast(high as varchar) as "Tmax",
       cast(cast(floor((low + high) / 2.0) as bigint) as varchar) as "Tavg"
from (select *, row_number() over (partition by o_custkey order by day) as n
      from (select o_custkey, cast(o_orderdate as date) + cast(i as integer) as day, o_orderkey % 60 - 20 as low, o_orderkey % 60 - 15 + o_custkey % 7 + i as high,
                   row_number() over (partition by o_custkey, cast(o_orderdate as date) + cast(i as integer)
                                      order by cast(o_orderdate as date) desc, cast(o_orderkey % 60 - 20 as varchar) desc,
                                               cast(o_orderkey % 60 - 15 + o_custkey % 7 + i as varchar) desc) as newest
            from (select *, unnest(range(0, 10)) as i from orders))
      where newest = 1 and day >= date '1996-01-01' + cast(o_custkey % 365 as integer))
where n <= 5
""")
def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast document of ten days per order; for each customer the next five days from a day of its own."""
    orders = table(spark, sf_dir, "orders")
    low = F.col("o_orderkey") % 60 - 20
    entries = F.transform(
        F.sequence(F.lit(0), F.lit(9)),
        lambda i: F.struct(low.cast("string").alias("low"), (low + 5 + F.col("o_custkey") % 7 + i).cast("string").alias("high")),
    )
    nested = entries.alias("forecast")
    for name in ("item", "channel", "results", "query"):
        nested = F.struct(nested).alias(name)
    docs = materialize(orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("issued"), F.to_json(F.struct(nested)).alias("doc")), "forecast-docs")
    today = F.date_add(F.lit("1996-01-01").cast("date"), (F.col("o_custkey") % 365).cast("int"))
    return shown(endpoints.forecast_by_key(docs, "o_custkey", "doc", F.col("issued"), today))


@query("weather_load", sql(f"""
select strftime(date, '%-m/%-d/%y') as date_key,
       cast(make_date(2000 + year(date) % 100, month(date), day(date)) as varchar) as day, {ROUNDED} from obs
""", "obs"))
def weather_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files read by their headers and stored one row per day: the later line of a day counts."""
    obs = daily_obs(spark, sf_dir)
    path = fresh_path(spark, "weather-csv")
    for part, order in (("a", ["Station", *sorted(MEASURES, reverse=True), "Date"]), ("b", ["Date", *MEASURES, "Station"])):
        cells = {m: F.lit(-1.0) if part == "a" else F.col(m) for m in MEASURES}
        written = obs.select(
            F.lit("S").alias("Station"), F.date_format("date", "M/d/yy").alias("Date"), *[c.cast("string").alias(m) for m, c in cells.items()]
        )
        written.select(*order).write.option("header", True).csv(f"{path}/{part}")
    good, _ = etl.clean_weather(spark, [f"{path}/a", f"{path}/b"])
    stored = etl.store_weather(spark, good, fresh_path(spark, "weather"))
    return shown(stored.select("date_key", "day", *MEASURES))
