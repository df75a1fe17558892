"""From raw files to the stored daily tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.functions.days import format_day_key, normalize_day_key, parse_day_key, parse_ts_12h
from daytally.names import qcol
from daytally.operators.cleaning import cast_record_types, clean_or_tag, filter_year_upto, split_tagged
from daytally.operators.daily import DAY, LEADING, daily_long, daily_wide, day_cube, leading_buckets
from daytally.operators.dedupe import dedupe_keep_first, keep_last
from daytally.operators.joins import one_per_day
from daytally.operators.series import MEASURES
from daytally.scratch import materialize
from daytally.sources.csv_files import (
    OVERFLOW,
    READ_ORDER,
    missing_to_null,
    read_period_files,
    read_tagged_files,
)
from daytally.sources.keyed_table import read_table, upsert_parts, upsert_to, write_parts, write_table

# Columns of the raw files that the flows use.
INCIDENT_KEY = ["ID", "Case Number"]
INCIDENT_TYPE = "Primary Type"
INCIDENT_LOCATION = "Location Description"
LAST_YEAR = 2014
WEATHER_CELLS = ["Date", *MEASURES]


def clean_incidents(spark: SparkSession, files: list, last_year: int = LAST_YEAR) -> DataFrame:
    """Union, dedupe in file order, year cutoff, timestamp.

    ``files`` lists paths, whose files go by their own headers, or pairs of
    path and column names.
    Only the six columns that the day tables need are parsed and shuffled; the
    other columns of the files are never selected.
    """
    used = [*INCIDENT_KEY, "Date", INCIDENT_TYPE, INCIDENT_LOCATION, "Year"]
    raw = read_period_files(spark, files).select([qcol(c) for c in [*used, *READ_ORDER]])
    raw = missing_to_null(raw, used)
    # The same number written in two ways is one key.
    number = F.col("ID").try_cast("bigint").cast("string")
    raw = raw.withColumn("ID", F.coalesce(number, F.col("ID")))
    # File order, not time, decides which row is first, so the cutoff has to wait for the dedupe.
    first = dedupe_keep_first(raw, INCIDENT_KEY, READ_ORDER)
    typed = first.withColumn("Year", F.col("Year").try_cast("double"))
    kept = filter_year_upto(typed, "Year", last_year)
    return kept.select(
        "ID",
        parse_ts_12h(F.col("Date")).alias("ts"),
        qcol(INCIDENT_TYPE),
        qcol(INCIDENT_LOCATION),
    )


def daily_tables(clean: DataFrame, n: int = LEADING) -> tuple[DataFrame, DataFrame]:
    """Wide and long daily table of cleaned incidents."""
    cube = materialize(day_cube(clean, "ts", [INCIDENT_TYPE, INCIDENT_LOCATION]), "day-cube")
    types, locations = leading_buckets(cube, [INCIDENT_TYPE, INCIDENT_LOCATION], n, "n")
    return daily_wide(cube, types, locations), daily_long(cube, types, locations)


def keyed_records(wide: DataFrame) -> DataFrame:
    """The wide table as records under their text day key."""
    rest = [qcol(c) for c in wide.columns if c != DAY]
    return wide.select(format_day_key(F.col(DAY)).alias("Date"), *rest)


def store_daily(spark: SparkSession, wide: DataFrame, new_path: str, existing_path: str | None = None) -> DataFrame:
    """Store the wide records under their day key, over those of an earlier table if there is one.

    Two days a century apart have the same key; the later day is stored.
    """
    rest = [qcol(c) for c in wide.columns if c != DAY]
    records = wide.select(format_day_key(F.col(DAY)).alias("Date"), F.col(DAY).alias("_day"), *rest)
    if existing_path is None:
        write_table(keep_last(records, ["Date"], ["_day"]).drop("_day"), new_path)
        return read_table(spark, new_path)
    return upsert_to(spark, existing_path, records, "Date", ["_day"], new_path)


def month_of_key(key: str) -> Column:
    """Month of a text day key (``mm/dd/yy``), the part it is stored in."""
    return F.concat(F.substring(qcol(key), 7, 2), F.lit("-"), F.substring(qcol(key), 1, 2))


def update_daily(spark: SparkSession, wide: DataFrame, path: str, new: bool = False) -> DataFrame:
    """Put the wide records into the table in months at ``path``, or start it; only months with new days are written."""
    rest = [qcol(c) for c in wide.columns if c != DAY]
    records = wide.select(format_day_key(F.col(DAY)).alias("Date"), F.col(DAY).alias("_day"), *rest)
    if new:
        write_parts(keep_last(records, ["Date"], ["_day"]).drop("_day"), path, "Date", month_of_key("Date"))
        return read_table(spark, path)
    return upsert_parts(spark, path, records, "Date", ["_day"], month_of_key("Date"))


def update_weather(spark: SparkSession, good: DataFrame, path: str, new: bool = False) -> DataFrame:
    """Put the good days into the table in months at ``path``, or start it; only months with new days are written."""
    if new:
        write_parts(good, path, "date_key", month_of_key("date_key"))
        return read_table(spark, path)
    return upsert_parts(spark, path, good, "date_key", ["day"], month_of_key("date_key"))


def clean_weather(spark: SparkSession, paths, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Typed good days, one row each, and raw rejects of the weather files.

    Columns go by each file's own header; ``columns`` renames them in the
    order of the file where a header is of no use.  The marker tests look at
    every column of the header, and only then the needed ones are picked; one
    that is absent is an error.  Of several good rows of one day the last in
    read order counts.  The files are read once: both results come from a
    stored table of all rows.
    """
    raw = read_tagged_files(spark, paths)
    cells = [c for c in raw.columns if c not in (*READ_ORDER, OVERFLOW)]
    if columns is not None:
        if len(columns) != len(cells):
            raise ValueError(f"{len(columns)} names for {len(cells)} columns: {cells}")
        raw, cells = raw.withColumnsRenamed(dict(zip(cells, columns, strict=True))), list(columns)
    missing = [c for c in WEATHER_CELLS if c not in cells]
    if missing:
        raise ValueError(f"the weather files have no column(s) {missing}; their header: {cells}")
    tagged = materialize(clean_or_tag(raw, cells, "Date", OVERFLOW), "weather")
    good, rejects = split_tagged(tagged, OVERFLOW)
    day = parse_day_key(F.col("Date"))
    good = good.select(*[qcol(c) for c in [*WEATHER_CELLS, *READ_ORDER]], normalize_day_key(F.col("Date")).alias("date_key"), day.alias("day"))
    last = one_per_day(good, "date_key", READ_ORDER).drop(*READ_ORDER)
    typed = cast_record_types(last, {m: "double" for m in MEASURES})
    return typed, rejects.drop(*READ_ORDER)


def store_weather(spark: SparkSession, good: DataFrame, new_path: str, existing_path: str | None = None) -> DataFrame:
    """Store the good days by their key, over those of an earlier table if there is one."""
    if existing_path is None:
        write_table(good, new_path)
        return read_table(spark, new_path)
    return upsert_to(spark, existing_path, good, "date_key", ["day"], new_path)
