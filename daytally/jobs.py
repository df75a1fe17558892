"""Command line for the two loads.

    python -m daytally.jobs daily (--out DIR [--existing DIR] | --start DIR | --into DIR) FILE...
    python -m daytally.jobs weather (--out DIR [--existing DIR] | --start DIR | --into DIR) [--columns A,B,...] FILE...

``--out`` writes a new table, over the records of an existing one if there is
one.  ``--start`` writes a new table in months, and ``--into`` puts records
into such a table, of which it only reads and writes the months that they are in.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from daytally.plans import etl
from daytally.sources.keyed_table import write_table


def load_daily(spark: SparkSession, files: list[str], out: str, existing: str | None, months: str | None) -> None:
    """Wide records to ``out/wide``, over those of ``existing/wide``; counts to ``out/long``.

    With ``months`` (``start`` or ``into``) only the wide records, by month.
    """
    wide, long = etl.daily_tables(etl.clean_incidents(spark, files))
    if months:
        etl.update_daily(spark, wide, out, months == "start")
        return
    etl.store_daily(spark, wide, f"{out}/wide", existing and f"{existing}/wide")
    write_table(long, f"{out}/long", ["dimension"])


def load_weather(spark: SparkSession, files: list[str], out: str, existing: str | None, months: str | None, columns: list[str] | None) -> None:
    """Good days by key to ``out/days``, over those of ``existing/days``; rejected rows to ``out/rejects``.

    With ``months`` (``start`` or ``into``) only the good days, by month.
    """
    good, rejects = etl.clean_weather(spark, files, columns)
    if months:
        etl.update_weather(spark, good, out, months == "start")
        return
    etl.store_weather(spark, good, f"{out}/days", existing and f"{existing}/days")
    write_table(rejects, f"{out}/rejects")


def run(spark: SparkSession, arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="daytally.jobs")
    kinds = parser.add_subparsers(dest="kind", required=True)
    for kind in ("daily", "weather"):
        sub = kinds.add_parser(kind)
        target = sub.add_mutually_exclusive_group(required=True)
        for name in ("--out", "--start", "--into"):
            target.add_argument(name)
        sub.add_argument("--existing", help="an earlier table, with --out")
        sub.add_argument("files", nargs="+")
    kinds.choices["weather"].add_argument("--columns", help="names in the order of the files, instead of their headers")
    args = parser.parse_args(arguments)
    if args.existing and not args.out:
        parser.error("--existing goes with --out")
    months = "start" if args.start else "into" if args.into else None
    target = args.out or args.start or args.into
    if args.kind == "daily":
        load_daily(spark, args.files, target, args.existing, months)
    else:
        load_weather(spark, args.files, target, args.existing, months, args.columns and args.columns.split(","))


if __name__ == "__main__":
    run(SparkSession.builder.appName("daytally").getOrCreate())
