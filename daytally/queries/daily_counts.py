"""Categories, pivots, totals, and the joins of day-keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.names import qcol
from daytally.operators.daily import (
    DAY,
    TOTAL,
    Buckets,
    bucket_topn,
    category_domain,
    category_frequency,
    daily_long,
    daily_pivot,
    daily_wide,
    join_daily,
    leading_buckets,
    prefix_columns,
    row_total,
)
from daytally.operators.joins import join_by_day, one_per_day, overlay
from daytally.operators.series import MEASURES, preview, select_groups, sort_by_day, unpivot, with_day_ordinal
from daytally.queries.base_sql import ROUNDED, counts_text, sql
from daytally.queries.registry import query, shown
from daytally.scratch import materialize
from daytally.sources.generated_tables import (
    LOCATION,
    TYPE,
    crime_totals,
    daily_obs,
    kept_incidents,
    stored_cube,
    table,
)


def as_text(wide: DataFrame, keep: list[str]) -> DataFrame:
    """A wide frame as one text per row, made from its own columns by name, so that any set of columns can be compared."""
    counts = [F.concat(F.lit(f"{c}="), qcol(c)) for c in sorted(wide.columns) if c not in keep]
    return wide.select(*keep, F.concat_ws(";", *counts).alias("counts"))


def _buckets(cube: DataFrame) -> list[Buckets]:
    return leading_buckets(cube, [TYPE, LOCATION], weight="n")


@query("category_frequency", sql("select category, cast(n as bigint) as n from type_freq", "type_freq"))
def category_frequency_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    freq = category_frequency(kept_incidents(spark, sf_dir), TYPE)
    return freq.orderBy(F.desc("n"), "category")


@query("topn_bucket_other", sql("""
select case when k.t is null then null when f.pos <= 20 then k.t else 'OTHER' end as category, cast(count(*) as bigint) as n
from (select nullif(primary_type, 'Brand#13') as t from kept) k
     left join (select t, row_number() over (order by count(*) desc, t) as pos
                from (select nullif(primary_type, 'Brand#13') as t from kept) where t is not null group by t) f on k.t = f.t
group by 1
""", "kept"))
def topn_bucket_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty leading types, the rest as one bucket; one type is made null and stays null."""
    cube = stored_cube(spark, sf_dir).withColumn(TYPE, F.nullif(F.col(TYPE), F.lit("Brand#13")))
    bucketed = bucket_topn(cube, TYPE, weight="n")
    return bucketed.groupBy(F.col(TYPE).alias("category")).agg(F.sum("n").alias("n"))


@query("category_domain", sql("select distinct location as category from bucketed where location is not null", "bucketed"))
def category_domain_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_domain(bucket_topn(stored_cube(spark, sf_dir), LOCATION, weight="n"), LOCATION)


def _pivot_rows(category: str, column: str) -> list[tuple[str, str]]:
    """The ``(date, category, n)`` rows of one pivot, as a common table expression."""
    return [("pivot_rows", f"""
        select cast(date as varchar) as date, {category} as category, count(*) as n
        from bucketed where {column} is not null group by all""")]


def _pivot_sql(category: str, column: str) -> str:
    return sql(counts_text("pivot_rows", "d.date"), "bucketed", extra=_pivot_rows(category, column))


def _pivot(spark: SparkSession, sf_dir: str, dimension: str) -> DataFrame:
    """One row per day, one column per leading category."""
    cube = stored_cube(spark, sf_dir)
    (leading,) = leading_buckets(cube, [dimension], weight="n")
    return shown(daily_pivot(cube.withColumn(dimension, leading.expr()), dimension, leading.domain, "n"))


@query("daily_pivot_by_type", _pivot_sql("primary_type", "primary_type"))
def daily_pivot_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(_pivot(spark, sf_dir, TYPE), [DAY])


@query("daily_pivot_by_location", _pivot_sql("location", "location"))
def daily_pivot_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(_pivot(spark, sf_dir, LOCATION), [DAY])


@query("prefix_columns", _pivot_sql("'Type: ' || primary_type", "primary_type"))
def prefix_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(prefix_columns(_pivot(spark, sf_dir, TYPE), "Type: ", [DAY]), [DAY])


@query("row_total", sql("""
select cast(date as varchar) as date, cast(count(primary_type) as bigint) as "Total Crimes"
from bucketed where primary_type is not null group by date
""", "bucketed"))
def row_total_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pivot = _pivot(spark, sf_dir, TYPE)
    return row_total(pivot, [c for c in pivot.columns if c != DAY])


_WIDE = sql(counts_text("wide_rows", "d.date"), "wide_rows")


@query("join_daily_matrices", _WIDE)
def join_daily_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, types and locations as three tables, joined by day."""
    cube = stored_cube(spark, sf_dir)
    types, locations = _buckets(cube)
    by_type = daily_pivot(cube.withColumn(TYPE, types.expr()), TYPE, types.domain, "n")
    by_location = daily_pivot(cube.withColumn(LOCATION, locations.expr()), LOCATION, locations.domain, "n")
    joined = join_daily(
        row_total(by_type, types.domain),
        prefix_columns(by_type, "Type: ", [DAY]),
        prefix_columns(by_location, "Location: ", [DAY]),
    )
    return as_text(shown(joined), [DAY])


def daily_wide_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole flow from incidents to one wide row per day."""
    cube = stored_cube(spark, sf_dir)
    types, locations = _buckets(cube)
    return shown(daily_wide(cube, types, locations))


@query("daily_wide_table", _WIDE)
def daily_wide_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table; each row's columns are shown as one text."""
    return as_text(daily_wide_frame(spark, sf_dir), [DAY])


@query("daily_long_table", sql("""
select cast(date as varchar) as date, dimension, category, cast(n as bigint) as n from long_counts
""", "long_counts"))
def daily_long_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts as rows, for any number of categories."""
    cube = stored_cube(spark, sf_dir)
    return shown(daily_long(cube, *_buckets(cube)))


@query("unpivot_wide_to_long", sql("""
select cast(t.date as varchar) as date, c.category, cast(coalesce(w.n, 0) as bigint) as n
from totals t cross join (select distinct category from wide_rows) c
     left join wide_rows w on w.date = cast(t.date as varchar) and w.category = c.category
""", "wide_rows"))
def unpivot_wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of the wide table as its own series."""
    return unpivot(daily_wide_frame(spark, sf_dir), DAY)


@query("series_group_select", sql("""
select r_name as grp, cast(l.date as varchar) as date, l.category, cast(l.n as bigint) as n
from long_counts l join nation on l.dimension = 'Location' and l.category = n_name join region on n_regionkey = r_regionkey
""", "long_counts"))
def series_group_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location series in groups, one group per region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    groups = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("category"), F.col("r_name").alias("grp")
    )
    cube = stored_cube(spark, sf_dir)
    long = daily_long(cube, *_buckets(cube)).filter(F.col("dimension") == "Location")
    return shown(select_groups(long, groups).select("grp", DAY, "category", "n"))


@query("join_crime_weather", sql(f"""
select cast(date as varchar) as date, {ROUNDED}, cast(y as bigint) as "Total Crimes" from days
""", "days"))
def join_crime_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observation day is in the table twice; the later copy counts and rows do not multiply."""
    copies = daily_obs(spark, sf_dir).withColumn("written", F.explode(F.array(F.lit(1), F.lit(2))))
    older = {m: F.when(F.col("written") == 1, F.lit(-1.0)).otherwise(F.col(m)) for m in MEASURES}
    weather = one_per_day(copies.withColumns(older), DAY, ["written"])
    joined = join_by_day(crime_totals(spark, sf_dir), weather.drop("written"), DAY)
    return shown(joined.select(DAY, *MEASURES, TOTAL))


@query("overlay_two_series", sql("""
select cast(coalesce(o.date, t.date) as varchar) as date, round(o."Tavg", 6) as "Tavg", cast(t.total as bigint) as "Total Crimes"
from obs o full outer join totals t on o.date = t.date
""", "obs", "totals"))
def overlay_two_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(overlay(daily_obs(spark, sf_dir).select(DAY, "Tavg"), crime_totals(spark, sf_dir), DAY))


@query("sort_by_day", sql("""
select cast(row_number() over (order by date) as bigint) as ordinal, cast(date as varchar) as date, cast(total as bigint) as "Total Crimes"
from totals
""", "totals"))
def sort_by_day_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days in order, with the position that makes the order checkable."""
    totals = materialize(crime_totals(spark, sf_dir), "totals")
    return shown(sort_by_day(with_day_ordinal(totals, DAY), DAY))


@query("preview_limit", sql(f"""
select cast(date as varchar) as date, {ROUNDED}, cast(y as bigint) as "Total Crimes" from days order by date limit 2
""", "days"))
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_by_day(crime_totals(spark, sf_dir), daily_obs(spark, sf_dir), DAY)
    return shown(preview(joined.select(DAY, *MEASURES, TOTAL), [DAY]))
