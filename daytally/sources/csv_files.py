"""Headered CSV files, read as text.

Everything comes in as ``string``; typing happens later and explicitly, so a
bad cell is seen by the cleaning step and not swallowed by the reader.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.names import qcol

OVERFLOW = "_overflow"
_RECORD = "_record"

# Position of a row in its input, in the order the files were given.
FILE_RANK = "_file_rank"
FILE_PATH = "_file_path"
BLOCK_START = "_block_start"
ROW_IN_BLOCK = "_row_in_block"
READ_ORDER = [FILE_RANK, FILE_PATH, BLOCK_START, ROW_IN_BLOCK]

# One cell of a raw line, and what makes the cells past the header more than empty ones.
_CELL = '(?:"(?:[^"]|"")*+"|[^,"]*+)'
_FILLED = '[^,"]|(?:^|,)"(?!"(?:,|$))'

# Cell texts that count as missing in the incident files.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]


def _options(multi_line: bool) -> dict:
    # A doubled quote stands for a quote inside a quoted cell.
    return {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "mode": "PERMISSIVE"}


def first_lines(spark: SparkSession, paths) -> list[tuple[str, int, str]]:
    """Path, place among ``paths`` and first line of each file, in the order of ``paths`` and then of the files' paths.

    One job with one task for each file, which reads the head of its file and
    no more.  The driver holds one line per file, beside the list of files that
    it has anyway.  Files without a line that holds something are left out.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    session = spark.newSession()  # its settings put every file into a partition of its own
    for name in ("maxPartitionBytes", "openCostInBytes"):
        session.conf.set(f"spark.sql.files.{name}", str(1 << 50))

    def head(rows: Iterator) -> Iterator:
        return ((r[0], r[1]) for r in [next((r for r in rows if r[1].strip("\ufeff \t\r")), None)] if r)

    lines = session.read.text(paths).select("_metadata.file_path", "value").rdd.mapPartitions(head).collect()
    # the same file may be written with one slash or three after its scheme
    place = {}
    for i, path in enumerate(paths if len(paths) > 1 else []):
        for file in session.read.text(path).inputFiles():
            place.setdefault(file.replace(":///", ":/"), i)
    return sorted(((file, place.get(file.replace(":///", ":/"), 0), line) for file, line in lines), key=lambda x: (x[1], x[0]))


def _as_path(file: str) -> str:
    """A listed file as a path to read: plain characters, and none that would be taken for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def by_header(spark: SparkSession, paths) -> list[tuple[list[str], list[tuple[str, int]]]]:
    """The files behind ``paths`` grouped by their header line: column names, and the files with their places."""
    groups: dict[str, list[tuple[str, int]]] = {}
    for file, place, line in first_lines(spark, paths):
        groups.setdefault(line.strip("\ufeff\r"), []).append((file, place))
    return [(header_columns(spark, _as_path(files[0][0])), files) for files in groups.values()]


def _by_name(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_header_names(spark: SparkSession, paths, multi_line: bool = False, source: str | None = None) -> DataFrame:
    """Field names from the header lines, all columns text, blanks null.

    Every file goes by its own header, whatever the order of its columns; a
    column that a file does not have is null in its rows.  Files of one header
    are one read.  ``source`` names a column for the path of each row's file.
    ``multi_line`` allows line breaks inside quoted cells; such files cannot be
    split between tasks, so it is off by default.
    """
    parts = []
    for columns, files in by_header(spark, paths):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        part = spark.read.options(**_options(multi_line)).schema(schema).csv([_as_path(f) for f, _ in files])
        parts.append(part.select("*", F.col("_metadata.file_path").alias(source)) if source else part)
    return _by_name(parts) if parts else spark.createDataFrame([], T.StructType([T.StructField(source, T.StringType())] if source else []))


def read_with_overflow(spark: SparkSession, paths, columns: list[str], multi_line: bool = False) -> DataFrame:
    """Declared columns plus ``_overflow``, the surplus cells of a line if any of them holds something.

    Short lines are padded with null.  ``_overflow`` is null for lines of the
    right length and for lines whose surplus cells are all empty.  The header
    of every file must have these columns in this order; another header is an
    error and never a silent mix-up (unless a header cell is empty: then names
    cannot be checked).
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _RECORD]])
    unnamed = any(re.fullmatch(r"_c\d+", c) for c in columns)  # names that the reader made up cannot be checked
    options = {**_options(multi_line), "enforceSchema": unnamed, "columnNameOfCorruptRecord": _RECORD}
    df = spark.read.options(**options).schema(schema).csv(paths)
    # the raw line is only kept where the number of cells is wrong
    surplus = F.regexp_extract(F.col(_RECORD), f"(?s)^(?:{_CELL},){{{len(columns)}}}(.*)$", 1)
    # the reader counts the cells of a line only when all columns are asked for, hence the second test, which always
    # holds; only lines that pass the first one come to it
    asked = F.length(F.concat_ws("", *[qcol(c) for c in columns])) >= 0
    overflow = F.when(F.coalesce(surplus.rlike(_FILLED), F.lit(False)) & asked, surplus)
    return df.withColumn(OVERFLOW, overflow).drop(_RECORD)


def read_skip_long_rows(spark: SparkSession, paths, columns: list[str], multi_line: bool = False) -> DataFrame:
    """Drop lines with too many cells, keep and pad the short ones."""
    df = read_with_overflow(spark, paths, columns, multi_line)
    return df.filter(F.col(OVERFLOW).isNull()).drop(OVERFLOW)


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names of one file, in its order."""
    return spark.read.options(**_options(False)).csv(path).columns


def _tag_position(df: DataFrame) -> DataFrame:
    """Add the file's path, the split's offset in the file and the row's place in the split.

    ``monotonically_increasing_id`` only grows inside one task, which is all
    that is needed below the split's offset.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE_PATH),
        F.col("_metadata.file_block_start").alias(BLOCK_START),
        F.monotonically_increasing_id().alias(ROW_IN_BLOCK),
    )


def read_tagged_files(spark: SparkSession, paths, multi_line: bool = False) -> DataFrame:
    """Files read by their own headers, with positions and ``_overflow``; long lines are kept.

    There is one read for each distinct header, whatever the number of files.
    """
    # Positions are taken before any filter so that they do not depend on it.
    groups = by_header(spark, paths)
    if not groups:
        raise ValueError(f"no file behind {paths} has a header")
    parts = [_tag_position(read_with_overflow(spark, [_as_path(f) for f, _ in files], columns, multi_line)) for columns, files in groups]
    rows, places = _by_name(parts), [x for _, files in groups for x in files]
    if len({place for _, place in places}) == 1:
        return rows.withColumn(FILE_RANK, F.lit(places[0][1]))
    # one row per file; the optimizer sees its size
    return rows.join(spark.createDataFrame(places, f"{FILE_PATH} string, {FILE_RANK} int"), FILE_PATH)


def read_period_files(spark: SparkSession, files: list, multi_line: bool = False) -> DataFrame:
    """Several period files as one input, with each row's position in it; long lines are dropped.

    ``files`` lists paths, each file going by its own header, or pairs ``(path,
    column names in that file's order)``; columns are matched by name.  Order
    by ``READ_ORDER`` to get the input order; a folder of files counts in the
    order of their paths, and all files behind the path of a pair must have
    its columns.
    """
    if all(isinstance(f, str) for f in files):
        rows = read_tagged_files(spark, files, multi_line)
    else:
        tagged = [_tag_position(read_with_overflow(spark, path, columns, multi_line)) for path, columns in files]
        rows = _by_name([part.withColumn(FILE_RANK, F.lit(rank)) for rank, part in enumerate(tagged)])
    return rows.filter(F.col(OVERFLOW).isNull()).drop(OVERFLOW)


def missing_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Cells whose whole text is a missing-value token become null."""
    chosen = set(columns or [c for c, t in df.dtypes if t == "string"])

    def cell(c: str) -> Column:
        return F.when(~qcol(c).isin(MISSING_TOKENS), qcol(c)).alias(c)

    return df.select([cell(c) if c in chosen else qcol(c) for c in df.columns])


def provenance() -> Column:
    """Name of the file a row came from."""
    return F.col("_metadata.file_path")
