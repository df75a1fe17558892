"""Day, text and number expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.days import (
    date_parts,
    epoch_ms,
    format_day_key,
    normalize_day_key,
    parse_day_key,
    truncate_to_day,
    try_parse_ts_12h,
    yymmdd,
)
from daytally.functions.numbers import midrange_int
from daytally.functions.text import decode_field_slug
from daytally.operators.daily import TOTAL
from daytally.operators.series import MEASURES, recent_days
from daytally.operators.stats import corr_with_target, correlation_percent, rmse
from daytally.plans.endpoints import CHART_ORDER
from daytally.queries.base_sql import sql
from daytally.queries.registry import query, shown
from daytally.sources.generated_tables import day_frame, table


@query("parse_ts_12h", """
select event_id, case when event_type = 'error' then null else cast(date_trunc('second', ts) as varchar) end as ts from events
""")
def parse_ts_12h_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps written as 12-hour text and read back; unreadable text gives null."""
    text = F.when(F.col("event_type") == "error", "13/45/2024 99:00:00 XM").otherwise(
        F.date_format("ts", "MM/dd/yyyy hh:mm:ss a")
    )
    events = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return shown(events.select("event_id", try_parse_ts_12h(F.col("text")).alias("ts")))


@query("truncate_to_day", """
select cast(cast(ts as date) as varchar) as day, event_type, cast(count(*) as bigint) as rows from events group by all
""")
def truncate_to_day_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return shown(events.groupBy(truncate_to_day(F.col("ts")).alias("day"), "event_type").agg(F.count(F.lit(1)).alias("rows")))


@query("format_day_key", "select event_id, strftime(ts, '%m/%d/%y') as day_key from events")
def format_day_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", format_day_key(F.col("ts").cast("date")).alias("day_key"))


@query("normalize_day_key", """
select event_id, month(ts) || '/' || day(ts) || '/' || strftime(ts, '%y') as day_key from events
""")
def normalize_day_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded and unpadded keys become the same unpadded key."""
    style = F.when(F.col("event_type") == "view", F.date_format("ts", "M/d/yy")).otherwise(F.date_format("ts", "MM/dd/yy"))
    keys = table(spark, sf_dir, "events").select("event_id", style.alias("text"))
    return keys.select("event_id", normalize_day_key(F.col("text")).alias("day_key"))


@query("split_date_parts", """
select event_id, cast((year(ts) % 100) * 10000 + month(ts) * 100 + day(ts) as bigint) as "Date",
       cast(year(ts) as bigint) as "Year", cast(month(ts) as bigint) as "Month", cast(day(ts) as bigint) as "Day"
from events
""")
def split_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a text day key."""
    keys = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "M/d/yy").alias("text"))
    return shown(keys.select("event_id", *date_parts(parse_day_key(F.col("text")))))


@query("yymmdd_sort_key", """
select cast(strftime(l_shipdate, '%y%m%d') as bigint) as sort_key, cast(count(*) as bigint) as rows from lineitem group by 1
""")
def yymmdd_sort_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return shown(lines.groupBy(yymmdd(F.col("l_shipdate").cast("date")).alias("sort_key")).agg(F.count(F.lit(1)).alias("rows")))


@query("day_to_epoch_ms", """
select cast(epoch_ms(cast(cast(l_shipdate as date) as timestamp)) as bigint) as epoch_ms, cast(count(*) as bigint) as rows
from lineitem group by 1
""")
def day_to_epoch_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(epoch_ms(F.col("l_shipdate").cast("date")).alias("epoch_ms")).agg(F.count(F.lit(1)).alias("rows"))


@query("recent_days", """
select o_orderkey, cast(o_orderdate as date)::varchar as day, strftime(o_orderdate, '%m/%d/%Y') as "Date"
from orders where cast(o_orderdate as date) between date '1999-12-27' and date '1999-12-31'
""")
def recent_days_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the five days up to a given day."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return shown(recent_days(orders, "day", F.lit("1999-12-31").cast("date")))


@query("midrange_int", """
select low, high, cast(cast(floor((low + high) / 2.0) as bigint) as varchar) as mid, cast(count(*) as bigint) as rows
from (select cast(l_linenumber - 5 as bigint) as low, cast(l_quantity as bigint) - 30 as high from lineitem)
group by all
""")
def midrange_int_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole midranges of pairs with positive and negative sums."""
    pairs = table(spark, sf_dir, "lineitem").select(
        (F.col("l_linenumber") - 5).cast("bigint").alias("low"), (F.col("l_quantity").cast("bigint") - 30).alias("high")
    )
    mid = midrange_int(F.col("low"), F.col("high")).cast("string")
    return pairs.groupBy("low", "high", mid.alias("mid")).agg(F.count(F.lit(1)).alias("rows"))


_SLUG_SQL = """'Location_' || replace(p_name, ' ', '_') || '_s_' || p_type || '_c_' || p_size
               || '_p1_' || replace(p_brand, '#', '_h_') || '_x__p2_' || '__Type_' || p_type"""


@query("decode_field_slug", f"""
select p_partkey, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(slug,
       'Location_', 'Location: '), 'Type_', 'Type: '), '_s_', ' / '), '_c_', ', '), '_p1_', '('), '_p2_', ')'),
       '_x_', '.'), '_h_', '-'), '__', '/'), '_', ' ') as name
from (select p_partkey, {_SLUG_SQL} as slug from part)
""")
def decode_field_slug_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short names made from part attributes, with every mark in them."""
    slug = F.concat(
        F.lit("Location_"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_s_"), "p_type", F.lit("_c_"),
        F.col("p_size").cast("string"), F.lit("_p1_"), F.replace("p_brand", F.lit("#"), F.lit("_h_")),
        F.lit("_x__p2_"), F.lit("__Type_"), "p_type",
    )
    return table(spark, sf_dir, "part").select("p_partkey", decode_field_slug(slug).alias("name"))


def _corr_sql(body: str) -> str:
    rows = " union all ".join(
        f"""select '{m}' as measure, {i} as pos, corr("{m}", y) as corr from days""" for i, m in enumerate(MEASURES)
    )
    rows += " union all select 'Total Crimes', 6, corr(y, y) from days"
    return sql(body, "days", extra=[("corrs", rows)])


@query("corr_with_target", _corr_sql("select measure, round(case when isnan(corr) then null else corr end, 6) as corr from corrs"))
def corr_with_target_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(corr_with_target(day_frame(spark, sf_dir), [*MEASURES, TOTAL], TOTAL))


_CHART_SQL = ", ".join(f"'{m}'" for m in CHART_ORDER)


@query("correlation_percent", _corr_sql(f"""
select cast(list_position([{_CHART_SQL}], measure) as bigint) as place, measure, round(corr * 100, 1) as percent
from corrs where measure <> 'Total Crimes'
"""))
def correlation_percent_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    corr = corr_with_target(day_frame(spark, sf_dir), [*MEASURES, TOTAL], TOTAL)
    return shown(correlation_percent(corr, CHART_ORDER))


@query("rmse", sql('select round(sqrt(avg((y - "Tavg" / 10) * (y - "Tavg" / 10))), 6) as rmse from days', "days"))
def rmse_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error of a prediction made from the mean temperature alone."""
    days = day_frame(spark, sf_dir).select(F.col(f"`{TOTAL}`").cast("double").alias("label"), (F.col("Tavg") / 10).alias("prediction"))
    return shown(rmse(days))
