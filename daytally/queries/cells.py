"""Weather cells with marks in them, and the rows they reject."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.operators.cleaning import (
    REASON,
    blanks_to_null,
    clean_or_tag,
    reject_missing_rows,
    traces_to_zero,
)
from daytally.queries.registry import query, shown
from daytally.queries.scans import write_lines
from daytally.scratch import fresh_path
from daytally.sources.csv_files import OVERFLOW, read_with_overflow
from daytally.sources.generated_tables import table

CELLS = ["priority", "segment"]


def marked_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priorities and market segments: texts with T, with M, with both and with neither."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), "o_custkey", "o_orderstatus", F.col("o_orderpriority").alias("priority")
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment")
    )
    joined = orders.join(customers, "o_custkey")
    return joined.withColumn("segment", F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("segment")))


CELLS_SQL = """
with cells as (select o_orderkey as key, o_orderstatus as status, o_orderpriority as priority,
                      case when o_orderstatus = 'P' then '' else c_mktsegment end as segment
               from orders join customer on o_custkey = c_custkey)
"""
REJECTED_SQL = "((priority like '%M%' and priority not like '%T%') or (segment like '%M%' and segment not like '%T%'))"
ZERO_SQL = "case when {0} like '%T%' then '0' else {0} end as {0}"


@query("clean_blank_to_null", CELLS_SQL + "select key, priority, nullif(segment, '') as segment from cells")
def clean_blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blanks_to_null(marked_cells(spark, sf_dir), CELLS).select("key", *CELLS)


@query("clean_trace_to_zero", CELLS_SQL + f"select key, {ZERO_SQL.format('priority')}, {ZERO_SQL.format('segment')} from cells")
def clean_trace_to_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traces_to_zero(marked_cells(spark, sf_dir), CELLS).select("key", *CELLS)


@query("reject_missing_rows", CELLS_SQL + f"select key, priority, segment from cells where not {REJECTED_SQL}")
def reject_missing_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_missing_rows(marked_cells(spark, sf_dir), CELLS).select("key", *CELLS)


@query("quarantine_bad_rows", CELLS_SQL + f"""
select reason, cast(count(*) as bigint) as rows, cast(sum(zeros) as bigint) as zeros,
       cast(count(*) - count(segment) as bigint) as blanks
from (select case when {REJECTED_SQL} then 'missing_marker' when status = 'F' then 'surplus_cell'
                  when priority = '2-HIGH' then 'no_key' else 'kept' end as reason,
             case when reason = 'kept' then (case when priority like '%T%' then 1 else 0 end
                                             + case when segment like '%T%' then 1 else 0 end) else 0 end as zeros,
             nullif(segment, '') as segment
      from cells)
group by reason
""")
def quarantine_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines, some with a surplus cell or without a key; rows by what became of them."""
    rows = marked_cells(spark, sf_dir)
    filled = F.col("o_orderstatus") == "F"
    key = F.when(~filled & (F.col("priority") == "2-HIGH"), F.lit("")).otherwise(F.col("key").cast("string"))
    surplus = F.when(filled, F.lit(",x")).otherwise(F.lit(""))
    line = F.concat(key, F.lit(","), F.col("priority"), F.lit(","), F.col("segment"), surplus)
    path = fresh_path(spark, "marked-csv")
    write_lines(rows, line, "key,priority,segment", path)
    raw = read_with_overflow(spark, path, ["key", *CELLS])
    rows = clean_or_tag(raw, ["key", *CELLS], "key", OVERFLOW)
    zeros = sum(F.when(F.col(REASON).isNull() & (F.col(c) == "0"), 1).otherwise(0) for c in CELLS)
    counted = rows.groupBy(F.coalesce(REASON, F.lit("kept")).alias(REASON)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(zeros).alias("zeros"),
        F.count_if(F.nullif(F.col("segment"), F.lit("")).isNull()).alias("blanks"),
    )
    return shown(counted)
