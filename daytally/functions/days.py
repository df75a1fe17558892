"""Expressions for days and timestamps.

All of them work on ``date`` and ``timestamp_ntz``, so no result depends on the
session's time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INCIDENT_TS_FORMAT = "MM/dd/yyyy hh:mm:ss a"
MILLIS_PER_DAY = 86_400_000

_INCIDENT_TS_SHAPE = r"^\d{2}/\d{2}/\d{4} (0[1-9]|1[0-2]):[0-5]\d:[0-5]\d (AM|PM)$"
_DAY_KEY_SHAPE = r"^\d{1,2}/\d{1,2}/\d{2}$"


def parse_ts_12h(text: Column) -> Column:
    """12-hour timestamp text; text in another form fails the job."""
    return F.to_timestamp_ntz(text, F.lit(INCIDENT_TS_FORMAT))


def try_parse_ts_12h(text: Column) -> Column:
    """12-hour timestamp text; text in another form gives null."""
    good_day = F.try_to_date(F.substring(text, 1, 10), "MM/dd/yyyy").isNotNull()
    return F.when(text.rlike(_INCIDENT_TS_SHAPE) & good_day, parse_ts_12h(text))


def truncate_to_day(ts: Column) -> Column:
    return ts.cast("date")


def format_day_key(day: Column) -> Column:
    """Padded day key, ``01/05/05``."""
    return F.date_format(day, "MM/dd/yy")


def format_short_day_key(day: Column) -> Column:
    """Unpadded day key, ``1/5/05``."""
    return F.date_format(day, "M/d/yy")


def format_long_day(day: Column) -> Column:
    """Day with a four-digit year, ``01/05/2005``."""
    return F.date_format(day, "MM/dd/yyyy")


def parse_day_key(key: Column) -> Column:
    """Day from a padded or unpadded key; the year is 2000 to 2099; other text gives null."""
    return F.when(key.rlike(_DAY_KEY_SHAPE), F.try_to_date(key, "M/d/yy"))


def normalize_day_key(key: Column) -> Column:
    """``01/05/05`` and ``1/5/05`` both become ``1/5/05``."""
    return format_short_day_key(parse_day_key(key))


def date_parts(day: Column) -> list[Column]:
    """Sort key, year, month and day of month, named as the series queries return them."""
    return [
        yymmdd(day).alias("Date"),
        F.year(day).alias("Year"),
        F.month(day).alias("Month"),
        F.dayofmonth(day).alias("Day"),
    ]


def yymmdd(day: Column) -> Column:
    """Integer sort key, 050105 for 5 January 2005 (as the number 50105)."""
    return (F.year(day) % 100) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def epoch_ms(day: Column) -> Column:
    """Milliseconds from 1970-01-01 to the start of the day, in UTC."""
    return F.unix_date(day).cast("bigint") * F.lit(MILLIS_PER_DAY).cast("bigint")


def in_recent_days(day: Column, asof: Column, days: int = 5) -> Column:
    """True for the last ``days`` days up to and including ``asof``."""
    return day.between(F.date_sub(asof, days - 1), asof)
