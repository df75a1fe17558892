"""Incidents and daily observations as views over the generated star schema.

``incidents`` plays the raw incident table: a line item is one reported
incident, its part's brand the type, its supplier's nation the location.
``daily_obs`` plays the weather table: one row of measures per order day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.operators.cleaning import filter_day_upto
from daytally.operators.daily import daily_totals, day_cube
from daytally.operators.dedupe import dedupe_keep_first
from daytally.operators.series import MEASURES
from daytally.scratch import materialize

KEYS = ["id", "case_no"]
FIRST_ORDER = [
    "ts", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
LAST_YEAR = 1999
TYPE, LOCATION = "primary_type", "location"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as incidents, before type and location are looked up."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("case_no"),
        F.col("l_shipdate").alias("ts"),
        F.year("l_shipdate").alias("yr"),
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    )


def _looked_up(spark: SparkSession, sf_dir: str, facts: DataFrame) -> DataFrame:
    """Type and location by part and supplier; every line item has both (foreign keys).

    Part and supplier grow with the data, so their joins are left to the
    optimizer; adaptive execution splits a part or supplier that holds a large
    share of the incidents.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias(TYPE))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias(LOCATION))
    # One lookup table at a time: each has a known file size to choose its join by.
    joined = (
        facts.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.select(*facts.columns, TYPE, LOCATION)


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per incident, duplicates included."""
    return _looked_up(spark, sf_dir, _facts(spark, sf_dir))


def first_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first incident of each key, with its type and location.

    Part and supplier are columns of the line, so the lookups cannot change
    which line is first and come after the choice: duplicates do not pass them.
    """
    return _looked_up(spark, sf_dir, dedupe_keep_first(_facts(spark, sf_dir), KEYS, FIRST_ORDER))


def kept_incidents(spark: SparkSession, sf_dir: str, last_year: int = LAST_YEAR) -> DataFrame:
    """Deduplicated incidents up to ``last_year``, with what the day tables need.

    The first incident of a key is the one with the smallest ``ts``, so cutting
    off late rows cannot change which row is first among the rest; the cutoff
    therefore runs before the dedupe and reaches the file scan.  The part and
    the supplier decide type and location, so the columns after them in
    ``FIRST_ORDER`` cannot matter here and are not read, and the lookups come
    after the dedupe: duplicates do not pass them, and the dedupe carries
    three narrow columns.  An incident whose first line has no known part or
    supplier is left out, also where a later line of its key has one.
    """
    facts = filter_day_upto(_facts(spark, sf_dir).select(*KEYS, "ts", "l_partkey", "l_suppkey"), "ts", last_year)
    return _looked_up(spark, sf_dir, dedupe_keep_first(facts, KEYS, ["ts", "l_partkey", "l_suppkey"]))


def incident_cube(spark: SparkSession, sf_dir: str, last_year: int = LAST_YEAR) -> DataFrame:
    """``(date, primary_type, location, n)``."""
    return day_cube(kept_incidents(spark, sf_dir, last_year), "ts", [TYPE, LOCATION])


def stored_cube(spark: SparkSession, sf_dir: str, last_year: int = LAST_YEAR) -> DataFrame:
    """The cube, written once: several jobs read it."""
    return materialize(incident_cube(spark, sf_dir, last_year), "day-cube")


def daily_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of measures per order day.

    Prices are summed as whole cents, so the sums do not depend on the order in
    which tasks finish.
    """
    orders = table(spark, sf_dir, "orders")
    cents = F.floor(F.col("o_totalprice") * 100 + 0.5).cast("bigint")
    per_day = orders.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(cents).alias("cents"),
        F.max("o_totalprice").alias("hi"),
        F.min("o_totalprice").alias("lo"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").alias("low"),
        F.count_if(F.col("o_orderstatus") == "F").alias("f"),
        F.count_if(F.col("o_orderstatus") == "O").alias("o"),
    )
    # Rounded half up on integers: share of low-priority orders in hundredths, mean price in whole units.
    hundredths = F.expr("(200 * low + n) div (2 * n)")
    mean_price = F.expr("(2 * cents + 100 * n) div (200 * n)")
    return per_day.select(
        "date",
        (F.col("f") - F.col("o")).cast("double").alias("Depart"),
        F.col("urgent").cast("double").alias("Heat"),
        (hundredths.cast("double") / 100).alias("PrecipTotal"),
        (mean_price.cast("double") / 1000).alias("Tavg"),
        (F.col("hi") / 1000).alias("Tmax"),
        (F.col("lo") / 1000).alias("Tmin"),
    )


def crime_totals(spark: SparkSession, sf_dir: str, last_year: int = LAST_YEAR) -> DataFrame:
    """``(date, Total Crimes)``."""
    return daily_totals(kept_incidents(spark, sf_dir, last_year), "ts", TYPE, LOCATION)


def day_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with both incidents and observations: date, six measures, total."""
    joined = daily_obs(spark, sf_dir).join(crime_totals(spark, sf_dir), "date")
    return joined.select("date", *MEASURES, "Total Crimes")


def stored_day_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day frame, written once: model fits read it many times."""
    return materialize(day_frame(spark, sf_dir), "day-frame")
