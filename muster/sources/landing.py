"""Pipe-delimited files to bronze text tables."""

from __future__ import annotations

import csv
import datetime as dt
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.functions.text import CSV_NULL_TOKENS, null_token
from muster.operators.conform import timestamp
from muster.schemas import EMPLOYEE_FILE_COLUMNS, TABLES, TIMESHEET_FILE_COLUMNS
from muster.sources.lines import MAX_RECORD_LINES, OPEN, QUOTED, file_headers, records, stored, stored_lines

log = logging.getLogger(__name__)

_FORMAT = {"sep": "|", "quote": '"', "escape": '"'}

TOO_MANY_FIELDS = "TOO_MANY_FIELDS"
BROKEN_QUOTE = "BROKEN_QUOTE"


def name_glob(pattern: str, ignore_case: bool = False) -> str:
    """Glob for CSV file names that contain ``pattern``."""
    glob = f"*{pattern}*.csv"
    if ignore_case:
        glob = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in glob)
    return glob


@dataclass(frozen=True)
class Landed:
    """Rows of the matching files as text, and the lines that do not fit their header."""

    rows: DataFrame
    malformed: DataFrame


def header_names(header: str) -> tuple[str, ...]:
    """Column names of a header line, trimmed and in lower case."""
    [cells] = csv.reader([header.lstrip("\ufeff")], delimiter="|")
    return tuple(cell.strip().lower() for cell in cells)


def _with_layout(lines: DataFrame, headers: DataFrame, layouts: list[str]) -> DataFrame:
    """Adds the number of the header that a line's file has."""
    if len(layouts) == 1:
        return lines.withColumn("layout", F.lit(0))
    numbered = lines.sparkSession.createDataFrame(list(enumerate(layouts)), "layout int, header string")
    return lines.join(headers.join(numbered, "header").select("path", "layout"), "path")


def malformed_reason(line: Column, width: Column) -> Column:
    """Why a line cannot be a record of ``width`` fields; null if it can.

    A line with fewer fields is a record whose last fields are missing, unless a quote is open at its
    end or it closes one that an earlier line left open: then it is a part of a broken record.
    """
    bare = F.regexp_replace(line, QUOTED, "")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    fields = F.length(bare) - F.length(F.replace(bare, F.lit("|"), F.lit(""))) + 1
    odd = quotes % 2 == 1
    broken = odd & (line.rlike(OPEN) | (fields < width))
    return (
        F.when(quotes == 0, F.when(_plain_fields(line) > width, TOO_MANY_FIELDS))
        .when(broken, BROKEN_QUOTE)
        .when(fields > width, TOO_MANY_FIELDS)
    )


def _plain_fields(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit("|"), F.lit(""))) + 1


def _by_layout(values: Sequence) -> Column:
    """The value that belongs to a line's layout."""
    if len(values) == 1:
        return values[0]
    return F.element_at(F.array(*values), F.col("layout") + 1)


# The reader of records takes this character for the end of its text; it goes in as a pair of others.
_END, _PAIR = "\uffff", (("\x01", "\x01\x02"), ("\uffff", "\x01\x03"))


def _parsed(lines: DataFrame, widest: int) -> DataFrame:
    """``record`` with the fields ``f0, f1, ...`` of each line."""
    fields = [f"f{i}" for i in range(widest)]
    paired, ends = F.col("line"), F.col("line").contains(_END)
    for one, two in _PAIR:
        paired = F.replace(paired, F.lit(one), F.lit(two))
    text = F.when(ends, paired).otherwise(F.col("line"))
    schema = ", ".join(f"{f} string" for f in fields)
    lines = lines.withColumn("record", F.from_csv(text, schema, {**_FORMAT, "mode": "PERMISSIVE"}))

    def single(field: str) -> Column:
        value = F.col(f"record.{field}")
        for one, two in reversed(_PAIR):
            value = F.replace(value, F.lit(two), F.lit(one))
        return value.alias(field)

    return lines.withColumn("record", F.when(ends, F.struct(*map(single, fields))).otherwise(F.col("record")))


def land_split(
    spark: SparkSession,
    path: str,
    table: str,
    columns: Sequence[str],
    pattern: str,
    loaded_at: dt.datetime,
    recursive: bool = False,
    ignore_case: bool = False,
    null_tokens: Sequence[str] = CSV_NULL_TOKENS,
    max_record_lines: int = MAX_RECORD_LINES,
    storage: Mapping[str, str] | None = None,
) -> Landed:
    """All files below ``path`` whose name holds ``pattern``, as one text table, and what did not fit.

    ``path`` may be on any file system Spark can read, with ``storage`` holding the file system's own
    settings. The files are read once, in splits, into a scratch table of lines (see ``lines``). Columns are
    mapped by the header of each file; only the distinct headers come to the driver, and lines find
    theirs by a join on the file. Quoted fields may hold line breaks. A record with more fields than
    its header, or a line with a quote that nothing closes within ``max_record_lines`` lines, goes to
    ``malformed`` with its file, text and reason; every other record is a row. Without a matching file
    both are empty.
    """
    glob, storage = name_glob(pattern, ignore_case), dict(storage or {})
    empty = Landed(
        spark.createDataFrame([], TABLES["bronze", table]),
        spark.createDataFrame([], TABLES["bronze", "malformed_line"]),
    )
    try:
        lines = stored_lines(spark, path, glob, recursive, **storage)
        headers = stored(file_headers(lines), "file-headers")
        layouts = sorted(r.header for r in headers.select("header").distinct().collect())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        layouts = []
    if not layouts:
        log.warning("no file matches %s in %s", glob, path)
        return empty

    names = [header_names(header) for header in layouts]
    widest = max(map(len, names))
    width = _by_layout([F.lit(len(n)) for n in names])
    parsed = _with_layout(records(lines, headers, max_record_lines), headers, layouts)
    reason = malformed_reason(F.col("line"), width)
    good = _parsed(parsed.filter(reason.isNull()), widest)

    def column(name: str) -> Column:
        places = [n.index(name) if name in n else None for n in names]
        missing = F.lit(None).cast("string")
        return _by_layout([missing if p is None else F.col(f"record.f{p}") for p in places])

    named = good.select(*(column(c).alias(c) for c in columns), F.col("file").alias("source_file"))
    rows = named.select(
        *(null_token(c, null_tokens).alias(c) for c in columns),
        "source_file",
        timestamp(loaded_at).alias("loaded_at"),
        # Unique, and fixed once the table is written; nothing relies on the value itself.
        F.monotonically_increasing_id().alias("id"),
    ).select(*TABLES["bronze", table].names)
    malformed = parsed.withColumn("reason", reason).filter("reason is not null").select(
        F.col("file").alias("source_file"), F.col("line").alias("text"), "reason",
        timestamp(loaded_at).alias("loaded_at"),
    )
    return Landed(rows, malformed.select(*TABLES["bronze", "malformed_line"].names))


def land_files(*args, **options) -> DataFrame:
    """The rows of ``land_split``."""
    return land_split(*args, **options).rows


def rows_per_file(landed: DataFrame) -> DataFrame:
    """``source_file, rows`` of a landed table."""
    return landed.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))


def split_employees(
    spark: SparkSession, path: str, loaded_at: dt.datetime, pattern: str = "employee", **options
) -> Landed:
    """Employee files as ``bronze.raw_employee``; options as for ``land_split``."""
    return land_split(
        spark, path, "raw_employee", EMPLOYEE_FILE_COLUMNS, pattern, loaded_at, **options
    )


def split_timesheets(
    spark: SparkSession, path: str, loaded_at: dt.datetime, pattern: str = "timesheet", **options
) -> Landed:
    """Timesheet files as ``bronze.raw_timesheet``; options as for ``land_split``."""
    return land_split(
        spark, path, "raw_timesheet", TIMESHEET_FILE_COLUMNS, pattern, loaded_at, **options
    )


def land_employees(*args, **options) -> DataFrame:
    """The rows of ``split_employees``."""
    return split_employees(*args, **options).rows


def land_timesheets(*args, **options) -> DataFrame:
    """The rows of ``split_timesheets``."""
    return split_timesheets(*args, **options).rows
