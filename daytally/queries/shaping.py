"""Union, dedupe, filters, projections, defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.text import decode_slug_text
from daytally.operators.cleaning import cast_record_types, drop_columns, filter_year_upto, union_by_name
from daytally.operators.daily import TOTAL
from daytally.operators.joins import merge_right_wins
from daytally.operators.series import (
    MEASURES,
    default_row_if_empty,
    project_field,
    project_measures,
    series_rows,
)
from daytally.queries.base_sql import PARTS, ROUNDED, sql
from daytally.queries.registry import query, shown
from daytally.sources.generated_tables import (
    FIRST_ORDER,
    first_incidents,
    KEYS,
    crime_totals,
    daily_obs,
    day_frame,
    incidents,
    table,
)


@query("union_all_by_name", """
select year(l_shipdate) as yr, l_returnflag as flag, cast(count(*) as bigint) as rows,
       cast(count(case when year(l_shipdate) <= 1998 then l_tax end) as bigint) as taxed,
       cast(sum(cast(l_quantity as bigint)) as bigint) as quantity
from lineitem group by all
""")
def union_all_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three period tables with columns in other orders, the last one without ``l_tax``."""
    lines = table(spark, sf_dir, "lineitem")

    def period(low: str, high: str, columns: list[str]) -> DataFrame:
        at = F.col("l_shipdate")
        return lines.filter((at >= F.lit(low).cast("timestamp_ntz")) & (at < F.lit(high).cast("timestamp_ntz"))).select(columns)

    stacked = union_by_name(
        period("0001-01-01", "1997-01-01", ["l_shipdate", "l_returnflag", "l_quantity", "l_tax"]),
        period("1997-01-01", "1999-01-01", ["l_tax", "l_quantity", "l_returnflag", "l_shipdate"]),
        period("1999-01-01", "9999-12-31", ["l_quantity", "l_shipdate", "l_returnflag"]),
    )
    out = stacked.groupBy(F.year("l_shipdate").alias("yr"), F.col("l_returnflag").alias("flag")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("l_tax").alias("taxed"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
    )
    return shown(out)


@query("dedupe_keep_first", sql("""
select id, cast(case_no as bigint) as case_no, cast(ts as varchar) as ts, primary_type, location,
       l_partkey, l_suppkey, round(l_quantity, 6) as l_quantity, l_returnflag
from deduped
""", "deduped"))
def dedupe_keep_first_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One incident per key; all remaining columns break ties."""
    return shown(first_incidents(spark, sf_dir).select(*KEYS, "ts", "primary_type", "location", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"))


@query("filter_year_upto", sql("""
select cast(yr as bigint) as yr, primary_type, cast(count(*) as bigint) as rows
from (select nullif(yr, 1997) as yr, primary_type from incidents) where yr is null or yr <= 1999
group by all
""", "incidents"))
def filter_year_upto_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years up to the cutoff; the rows made yearless stay."""
    rows = incidents(spark, sf_dir).withColumn("yr", F.nullif(F.col("yr"), F.lit(1997)))
    kept = filter_year_upto(rows, "yr", 1999)
    return shown(kept.groupBy("yr", "primary_type").agg(F.count(F.lit(1)).alias("rows")))


@query("drop_columns", sql("""
select id, cast(case_no as bigint) as case_no, cast(ts as varchar) as ts, primary_type, location from incidents
""", "incidents"))
def drop_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left after dropping the columns that no later step uses."""
    unused = ["yr", *[c for c in FIRST_ORDER if c != "ts"]]
    return shown(drop_columns(incidents(spark, sf_dir), unused))


@query("project_measures", sql(f"""
select cast(date as varchar) as date, {ROUNDED}, cast(y as bigint) as "Total Crimes" from days
""", "days"))
def project_measures_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six measures and the total of each joined day."""
    return shown(project_measures(day_frame(spark, sf_dir), "date", [*MEASURES, TOTAL]))


@query("project_single_field", sql(f'select {PARTS}, cast(total as double) as "Total_Crimes" from totals', "totals"))
def project_single_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One count, asked for by its short name, as a double beside its date parts."""
    slug = "Total_Crimes"
    return shown(project_field(crime_totals(spark, sf_dir), "date", decode_slug_text(slug), slug))


@query("cast_record_types", """
select o_orderkey,
       case when o_orderstatus = 'P' then null else round(o_totalprice, 6) end as price,
       case when o_orderpriority = '5-LOW' then null else cast(left(o_orderpriority, 1) as bigint) end as priority,
       cast(case when o_orderstatus = 'P' then 1 else 0 end
            + case when o_orderpriority = '5-LOW' then 1 else 0 end as bigint) as bad_cells
from orders
""")
def cast_record_types_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text cells to numbers; cells that do not convert become null and are counted."""
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(F.col("o_orderpriority") == "5-LOW", "low").otherwise(F.substring("o_orderpriority", 1, 1)).alias("priority"),
    )
    return shown(cast_record_types(text, {"price": "double", "priority": "int"}))


@query("default_row_if_empty", sql(f"""
select 'filled' as leg, {PARTS}, round("Tavg", 6) as "Tavg" from obs
union all select 'empty', 0, 0, 0, 0, 0
""", "obs"))
def default_row_if_empty_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole series, and the default row in place of a series without rows."""
    rows = series_rows(daily_obs(spark, sf_dir), "date", {"Tavg": "double"})
    none = rows.filter(F.col("Year") < 0)
    filled = default_row_if_empty(rows).withColumn("leg", F.lit("filled"))
    return shown(filled.unionByName(default_row_if_empty(none).withColumn("leg", F.lit("empty"))))


@query("merge_records_right_wins", sql("""
select cast(obs.date as varchar) as date, round("Tavg", 6) as "Tavg",
       case when total >= 20 then null else cast(total as bigint) end as "Heat",
       cast(total as bigint) as "Total Crimes"
from obs join totals on obs.date = totals.date
""", "obs", "totals"))
def merge_records_right_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both records have ``Heat``; the incident side's value stands even where it is null."""
    total = F.col(f"`{TOTAL}`")
    right = crime_totals(spark, sf_dir).withColumn("Heat", F.when(total < 20, total))
    left = daily_obs(spark, sf_dir).select("date", "Tavg", "Heat")
    return shown(merge_right_wins(left, right, "date"))
