"""Files in, files out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daytally.operators.cleaning import cast_record_types
from daytally.queries.registry import query, shown
from daytally.scratch import fresh_path, materialize
from daytally.sources.csv_files import read_header_names, read_skip_long_rows
from daytally.sources.generated_tables import table
from daytally.sources.json_docs import forecast_days, history_days, read_json_rows
from daytally.sources.keyed_table import PART, read_table, upsert_parts, write_parts, write_ranges


def write_lines(df: DataFrame, line: Column, header: str, path: str) -> None:
    """Write ready-made CSV lines under a header line."""
    raw = df.select(line.alias(header)).write.option("header", True).option("sep", "\u0001")
    raw.option("quote", "\u0000").option("escapeQuotes", False).option("emptyValue", "").csv(path)


@query("scan_csv_skip_long_rows", """
select o_orderkey, o_custkey,
       case o_orderpriority when '4-NOT SPECIFIED' then null
                            when '2-HIGH' then o_orderstatus || ',' || o_orderstatus
                            else o_orderstatus end as o_orderstatus,
       case when o_orderpriority = '4-NOT SPECIFIED' then null else o_orderpriority end as o_orderpriority
from orders where o_orderpriority <> '5-LOW'
""")
def scan_csv_skip_long_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as ragged lines: surplus (next or further on), short, quoted and trailing-blank ones."""
    orders = table(spark, sf_dir, "orders")
    prio, head = F.col("o_orderpriority"), F.concat_ws(",", "o_orderkey", "o_custkey")
    status = F.col("o_orderstatus")
    line = (
        F.when((prio == "5-LOW") & (F.col("o_custkey") % 2 == 0), F.concat_ws(",", head, status, prio, F.lit("surplus")))
        .when(prio == "5-LOW", F.concat_ws(",", head, status, prio, F.lit(""), F.lit("later")))
        .when(prio == "4-NOT SPECIFIED", head)
        .when(prio == "3-MEDIUM", F.concat(head, F.lit(","), status, F.lit(","), prio, F.lit(",")))
        .when(prio == "2-HIGH", F.concat(head, F.lit(',"'), status, F.lit(","), status, F.lit('",'), prio))
        .otherwise(F.concat_ws(",", head, status, prio))
    )
    path = fresh_path(spark, "ragged-csv")
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    write_lines(orders, line, ",".join(names), path)
    rows = read_skip_long_rows(spark, path, names)
    return cast_record_types(rows, {"o_orderkey": "bigint", "o_custkey": "bigint"}).drop("bad_cells")


@query("scan_csv_multi_file", """
select case when year(o_orderdate) <= 1996 then 'early' when year(o_orderdate) <= 1998 then 'middle' else 'late' end as period,
       cast(count(*) as bigint) as rows,
       cast(sum(o_custkey) as bigint) as custkeys,
       min(o_orderkey) as first_key, max(o_orderkey) as last_key,
       cast(coalesce(sum(case when year(o_orderdate) > 1998 and o_orderstatus = 'O' then 1 end), 0) as bigint) as known_open
from orders group by 1
""")
def scan_csv_multi_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed in three period folders, each with its own order of columns and the last with one more, read as one input."""
    year = F.year("o_orderdate")
    period = F.when(year <= 1996, "early").when(year <= 1998, "middle").otherwise("late")
    orders = table(spark, sf_dir, "orders")
    base = fresh_path(spark, "period-csv")
    landed = {"early": ["o_orderkey", "o_custkey"], "middle": ["o_custkey", "o_orderkey"], "late": ["o_orderstatus", "o_custkey", "o_orderkey"]}
    for name, columns in landed.items():
        orders.filter(period == name).select(columns).write.option("header", True).csv(f"{base}/period={name}")
    rows = read_header_names(spark, [f"{base}/period={name}" for name in landed], source="file")
    rows = rows.withColumn("period", F.regexp_extract("file", "period=([a-z]+)/", 1))
    typed = cast_record_types(rows, {"o_orderkey": "bigint", "o_custkey": "bigint"})
    return typed.groupBy("period").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("o_custkey").alias("custkeys"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
        F.count_if(F.col("o_orderstatus") == "O").alias("known_open"),
    )


@query("scan_csv_header_names", """
select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey,
       cast(c_acctbal as varchar) as c_acctbal, c_mktsegment
from customer
""")
def scan_csv_header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers landed as CSV; names from the header, every cell text."""
    path = fresh_path(spark, "customer-csv")
    table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    return read_header_names(spark, path)


@query("scan_keyed_table", """
select o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) as o_totalprice,
       cast(o_orderdate as varchar) as o_orderdate, o_orderpriority
from orders
""")
def scan_keyed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of a table stored by key."""
    path = fresh_path(spark, "by-key")
    write_ranges(table(spark, sf_dir, "orders"), path, ["o_orderkey"])
    return shown(read_table(spark, path))


_DAY_ORDERS = """
  select cast(o_orderdate as date) as day, o_orderkey as seq, o_custkey as custkey, o_orderstatus as status
  from orders where o_orderstatus {}
"""


@query("sink_upsert_by_key", f"""
with base as (select day, max(seq) as seq, count(*) as rows from ({_DAY_ORDERS.format("<> 'O'")}) group by day),
upd as (select * from (select day, seq, custkey, row_number() over (partition by day order by seq desc) as rn
                       from ({_DAY_ORDERS.format("= 'O'")})) where rn = 1)
select cast(b.day as varchar) as day, b.seq, cast(b.rows as bigint) as rows, 'stored' as origin
from base b where b.day not in (select day from upd)
union all
select cast(day as varchar), seq, custkey, 'update' from upd
""")
def sink_upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily table stored by year, its days replaced by the last open order of each day that has one."""
    orders = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    stored = orders.filter("o_orderstatus <> 'O'").groupBy("day").agg(
        F.max("o_orderkey").alias("seq"), F.count(F.lit(1)).alias("rows"), F.lit("stored").alias("origin")
    )
    path, year = fresh_path(spark, "stored"), F.year("day")
    write_parts(stored, path, "day", year)
    updates = orders.filter("o_orderstatus = 'O'").select(
        "day", F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("rows"), F.lit("update").alias("origin")
    )
    return shown(upsert_parts(spark, path, updates, "day", ["seq"], year).drop(PART))


@query("json_infer_rows", """
select event_id, user_id, event_type, round(value, 6) as value, cast(json_extract(props, '$.k') as bigint) as k
from events
""")
def json_infer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as one document per line and read by their known schema, in one pass."""
    events = table(spark, sf_dir, "events")
    doc = F.to_json(F.struct("event_id", "user_id", "event_type", "value", F.from_json("props", "k bigint").alias("props")))
    path = fresh_path(spark, "event-docs")
    events.select(doc.alias("value")).write.text(path)
    schema = events.select("event_id", "user_id", "event_type", "value").schema.add("props", StructType().add("k", "long"))
    rows = read_json_rows(spark, path, schema)
    return shown(rows.select("event_id", "user_id", "event_type", "value", F.col("props.k").alias("k")))


@query("json_nested_extract", """
select o_orderkey, strftime(o_orderdate, '%m/%d/%Y') as "Date", left(o_orderpriority, 1) as "PrecipTotal",
       cast(o_custkey as varchar) as "Tavg", o_orderstatus as "Tmax", o_orderpriority as "Tmin"
from orders
""")
def json_nested_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History documents made from orders, stored as text and taken apart again."""
    summary = F.struct(
        F.substring("o_orderpriority", 1, 1).alias("precipi"),
        F.col("o_custkey").cast("string").alias("meantempi"),
        F.col("o_orderstatus").alias("maxtempi"),
        F.col("o_orderpriority").alias("mintempi"),
    )
    doc = F.to_json(F.struct(F.struct(F.array(summary, summary).alias("dailysummary")).alias("history")))
    orders = table(spark, sf_dir, "orders")
    docs = orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), doc.alias("doc"))
    docs = materialize(docs, "history-docs")
    return history_days(docs, "doc", F.col("day"), ["o_orderkey"])


@query("json_array_forecast_rows", """
select c_custkey, cast(date '2024-02-26' + cast(c_nationkey as integer) + cast(i as integer) as varchar) as day,
       cast(low as varchar) as "Tmin", cast(high as varchar) as "Tmax",
       cast(cast(floor((low + high) / 2.0) as bigint) as varchar) as "Tavg"
from (select c_custkey, c_nationkey, i, c_nationkey - 20 + i as low, c_nationkey - 17 + 2 * i as high
      from (select c_custkey, c_nationkey, unnest(range(0, 1 + least(c_nationkey, 9))) as i from customer))
where i < 5
""")
def json_array_forecast_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast documents of one to ten days, one per customer."""
    base = F.col("c_nationkey")
    entries = F.transform(
        F.sequence(F.lit(0), F.least(base, F.lit(9))),
        lambda i: F.struct(
            (base - 20 + i).cast("string").alias("low"), (base - 17 + 2 * i).cast("string").alias("high")
        ),
    )
    nested = entries.alias("forecast")
    for name in ("item", "channel", "results", "query"):
        nested = F.struct(nested).alias(name)
    customers = table(spark, sf_dir, "customer")
    asof = F.date_add(F.lit("2024-02-26").cast("date"), F.col("c_nationkey"))
    docs = materialize(customers.select("c_custkey", asof.alias("asof"), F.to_json(F.struct(nested)).alias("doc")), "forecast-docs")
    return shown(forecast_days(docs, "doc", F.col("asof"), 5, ["c_custkey"]))
