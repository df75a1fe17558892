"""Row documents and nested weather documents in JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daytally.functions.days import format_long_day
from daytally.functions.numbers import midrange_int

HISTORY_SCHEMA = (
    "history struct<dailysummary: array<struct<"
    "precipi: string, meantempi: string, maxtempi: string, mintempi: string>>>"
)
FORECAST_SCHEMA = (
    "query struct<results: struct<channel: struct<item: struct<"
    "forecast: array<struct<low: string, high: string>>>>>>"
)


def read_json_rows(spark: SparkSession, paths, schema=None) -> DataFrame:
    """One row per document; the schema is inferred unless given.

    Inference reads the input once more, so give the schema where it is known.
    Inferred columns come sorted by name: address them by name.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(paths)


def history_days(docs: DataFrame, doc: str, day: Column, keep: list[str] | None = None) -> DataFrame:
    """First daily summary of each history document, with its day."""
    parsed = docs.withColumn("_doc", F.from_json(F.col(doc), HISTORY_SCHEMA))
    first = F.get(F.col("_doc.history.dailysummary"), F.lit(0))
    return parsed.select(
        *(keep or []),
        format_long_day(day).alias("Date"),
        first["precipi"].alias("PrecipTotal"),
        first["meantempi"].alias("Tavg"),
        first["maxtempi"].alias("Tmax"),
        first["mintempi"].alias("Tmin"),
    )


def forecast_days(docs: DataFrame, doc: str, asof: Column, days: int = 5, keep: list[str] | None = None) -> DataFrame:
    """One row per forecast entry; entry *i* is the day ``asof + i``, first ``days`` only."""
    parsed = docs.select(*(keep or []), asof.alias("_asof"), F.from_json(F.col(doc), FORECAST_SCHEMA).alias("_doc"))
    # The array is cut before it is exploded, so later entries never become rows.
    entries = F.slice(F.col("_doc.query.results.channel.item.forecast"), 1, days)
    rows = parsed.select(*(keep or []), "_asof", F.posexplode(entries).alias("_i", "_f"))
    return rows.select(
        *(keep or []),
        F.date_add("_asof", F.col("_i")).alias("day"),
        F.col("_f.low").alias("Tmin"),
        F.col("_f.high").alias("Tmax"),
        midrange_int(F.col("_f.low").try_cast("int"), F.col("_f.high").try_cast("int")).cast("string").alias("Tavg"),
    )


def next_days_by_key(docs: DataFrame, key: str, doc: str, issued: Column, today: Column, days: int = 5) -> DataFrame:
    """The next ``days`` days of each key, ``today`` included, from any number of its forecast documents.

    ``issued`` is the day of a document's first entry.  Where documents
    overlap the one issued last counts (equal days: the larger text of the
    entry, so that every run chooses alike).  Days without a forecast are not
    made up: the next ones that have one are taken.  Documents that cannot be
    read have no entries.

    Each task keeps one entry per key and day before the shuffle and at most
    ``days`` rows per key before the ranking, so a key with a large share of
    all documents is no burden to one task.
    """
    if days < 1:
        raise ValueError(f"days must be at least 1, got {days}")
    parsed = docs.select(F.col(key), issued.alias("_issued"), today.alias("_today"), F.from_json(F.col(doc), FORECAST_SCHEMA).alias("_doc"))
    each = parsed.select(key, "_issued", "_today", F.posexplode("_doc.query.results.channel.item.forecast").alias("_i", "_f"))
    ahead = each.withColumn("day", F.date_add("_issued", F.col("_i"))).where(F.col("day") >= F.col("_today"))
    entry = F.struct("_issued", F.col("_f.low").alias("low"), F.col("_f.high").alias("high"))
    newest = ahead.groupBy(key, "day").agg(F.max(entry).alias("_e"))
    order = Window.partitionBy(key).orderBy("day")
    kept = newest.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= days)
    low, high = F.col("_e.low"), F.col("_e.high")
    return kept.select(
        key,
        "day",
        low.alias("Tmin"),
        high.alias("Tmax"),
        midrange_int(low.try_cast("int"), high.try_cast("int")).cast("string").alias("Tavg"),
    )
