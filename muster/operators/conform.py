"""Bronze text tables to typed silver tables, and the dead-letter split."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from muster.functions.attendance import attendance_flags
from muster.functions.dates import parse_date, parse_datetime
from muster.functions.text import (
    clean_columns,
    clean_string,
    overflows,
    parse_bool,
    parse_decimal,
    parse_double,
)
from muster.operators.numbering import Keys
from muster.operators.dimensions import (
    department_key,
    organization_key,
    surrogate_key,
    with_dimension_codes,
)
from muster.schemas import CONTRACTS, EMPLOYEE_FILE_COLUMNS, TABLES, TIMESHEET_FILE_COLUMNS

MISSING_EMPLOYEE = "MISSING_EMPLOYEE_RECORD"
# Ending of a metric's name that counts numbers too large for their column.
OVERFLOW = "|overflow"
_NULL_SPREAD = 4096

_EMPLOYEE_DATES = (
    "job_start_date", "dob", "hire_date", "recent_hire_date", "anniversary_date", "term_date",
)
_SHIFT_TIMES = (
    "punch_in_datetime", "punch_out_datetime", "scheduled_start_datetime", "scheduled_end_datetime",
)


def timestamp(moment: dt.datetime) -> Column:
    """Run time as a zone-free literal."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def spread_nulls(key: Column, row_id: Column) -> Column:
    """Join key whose nulls are spread over many values that match nothing.

    Null keys of an outer or anti join would all land in one shuffle partition.
    Cleaned keys never start with a space, so the filler cannot meet a real key.
    """
    return F.coalesce(key, F.concat(F.lit(" "), F.pmod(row_id, F.lit(_NULL_SPREAD))))


def _parse(
    cleaned: DataFrame,
    parsers: Mapping[str, Column],
    losses: Observation | None,
    sized: Sequence[tuple[str, int, int]] = (),
) -> DataFrame:
    """Replace text columns by their parsed values.

    ``losses`` receives, per column, the number of texts that could not be parsed,
    counted while the rows pass through; and for ``sized`` columns, below a name of
    its own, how many of those are numbers that the column has no room for.
    """
    both = cleaned.withColumns({f"_{c}": parser for c, parser in parsers.items()})
    if losses is not None:
        lost = [
            F.count_if(F.col(c).isNotNull() & F.col(f"_{c}").isNull()).alias(c) for c in parsers
        ]
        lost += [F.count_if(overflows(c, p, s)).alias(f"{c}{OVERFLOW}") for c, p, s in sized]
        both = both.observe(losses, *lost)
    return both.drop(*parsers).withColumnsRenamed({f"_{c}": c for c in parsers})


def conform_employees(
    raw_employee: DataFrame,
    now: dt.datetime,
    losses: Observation | None = None,
    salt: int = 0,
    keys: Keys | None = None,
) -> DataFrame:
    """Typed employees with dimension keys and resolved managers.

    Ids are looked up in ``keys``; without it they are hashes.

    Managers are resolved on the cleaned text, so the two small branches of that
    join read the id columns only and nothing is parsed or counted twice.
    """
    cleaned = resolve_managers(
        with_dimension_codes(
            clean_columns(raw_employee.select(*EMPLOYEE_FILE_COLUMNS), EMPLOYEE_FILE_COLUMNS)
        )
    )
    parsers = {
        "scheduled_weekly_hour": parse_decimal("scheduled_weekly_hour", 5, 2),
        "years_of_experience": parse_double("years_of_experience"),
        **{c: parse_date(c) for c in _EMPLOYEE_DATES},
    }
    typed = _parse(cleaned, parsers, losses, CONTRACTS["employee"].fixed_point).withColumns(
        {
            "is_per_deim": parse_bool("is_per_deim"),
            "active_status": parse_bool("active_status"),
            "created_at": timestamp(now),
            "updated_at": timestamp(now),
        }
    )
    if keys is None:
        typed = typed.withColumns(
            {
                "id": surrogate_key(F.col("client_employee_id"), salt=salt),
                "organization_id": organization_key(F.col("organization_code"), salt),
                "department_id": department_key(F.col("organization_code"), F.col("department_code"), salt),
            }
        )
    else:
        typed = _with_ids(typed, keys)
    return typed.select(*TABLES["silver", "employee"].names)


def _with_ids(typed: DataFrame, keys: Keys) -> DataFrame:
    """Ids of a row, its organization and its department; rows without a key meet nothing, and are spread."""
    looked_up = {
        "organization_id": (keys.organization, {"code": "organization_code"}),
        "department_id": (keys.department, {"organization_code": "organization_code", "code": "department_code"}),
        "id": (keys.employee, {"client_employee_id": "client_employee_id"}),
    }
    for name, (ids, columns) in looked_up.items():
        other = ids.select(F.col("id").alias("_id"), *(F.col(c).alias(f"_{c}") for c in columns))
        spread = F.xxhash64("client_employee_id", "first_name", "last_name")
        met = [spread_nulls(F.col(mine), spread) == F.col(f"_{c}") for c, mine in columns.items()]
        typed = typed.join(other, met, "left").withColumn(name, F.col("_id")).drop(*other.columns)
    return typed


def resolve_managers(employee: DataFrame) -> DataFrame:
    """Keep a manager id only where it is the id of an existing employee.

    Only ids that are both referenced and present reach the final join, a far
    smaller side than the whole master, so the engine can often broadcast it.
    """
    referenced = employee.select(F.col("manager_employee_id").alias("_manager")).distinct()
    known = employee.select(F.col("client_employee_id").alias("_manager"))
    managers = referenced.join(known, "_manager", "left_semi")
    key = spread_nulls(F.col("manager_employee_id"), F.xxhash64("client_employee_id"))
    return (
        employee.withColumn("_key", key)
        .join(managers, F.col("_key") == F.col("_manager"), "left")
        .withColumn("manager_employee_id", F.col("_manager"))
        .drop("_key", "_manager")
    )


def _employee_ids(employee: DataFrame) -> DataFrame:
    return employee.select("client_employee_id")


def _with_clean_id(raw_timesheet: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return raw_timesheet.select(
        "id",
        clean_string("client_employee_id").alias("client_employee_id"),
        *(c for c in columns if c != "client_employee_id"),
    )


def split_timesheets(raw_timesheet: DataFrame, ids: DataFrame) -> DataFrame:
    """Raw shifts with a clean id and ``known``: whether that is an employee's.

    One join serves both sides of the split. ``ids`` is a stored table with each
    ``client_employee_id`` once: read from storage, and not straight from the
    aggregate that made it, it lets the engine split a hot employee. Only the id is
    cleaned before the join; rows without id get keys that match nothing and are spread.
    """
    columns = (*TIMESHEET_FILE_COLUMNS, "source_file")
    known = ids.select(F.col("client_employee_id").alias("_known"))
    return (
        _with_clean_id(raw_timesheet, columns)
        .withColumn("_key", spread_nulls(F.col("client_employee_id"), F.col("id")))
        .join(known, F.col("_key") == F.col("_known"), "left")
        .withColumn("known", F.col("_known").isNotNull())
        .drop("_key", "_known")
    )


def conform_timesheets(
    raw_timesheet: DataFrame,
    employee: DataFrame,
    now: dt.datetime,
    grace_minutes: int = 5,
    losses: Observation | None = None,
) -> DataFrame:
    """Typed, flagged shifts of known employees; ``employee`` has each id once."""
    return conform_split(split_timesheets(raw_timesheet, _employee_ids(employee)), now, grace_minutes, losses)


def accepted_split(split: DataFrame) -> DataFrame:
    """The known shifts of ``split_timesheets`` as cleaned text; rows are cleaned after the split."""
    known = split.filter("known").drop("known")
    return clean_columns(known, (*TIMESHEET_FILE_COLUMNS[1:], "source_file"))


def conform_split(
    split: DataFrame, now: dt.datetime, grace_minutes: int = 5, losses: Observation | None = None
) -> DataFrame:
    """The known shifts of ``split_timesheets``, typed and flagged."""
    return _typed_timesheets(accepted_split(split), now, grace_minutes, losses)


def _typed_timesheets(
    accepted: DataFrame, now: dt.datetime, grace_minutes: int, losses: Observation | None
) -> DataFrame:
    parsers = {
        "punch_apply_date": parse_date("punch_apply_date"),
        "hours_worked": parse_decimal("hours_worked", 6, 2),
        **{c: parse_datetime(c) for c in _SHIFT_TIMES},
    }
    typed = _parse(accepted, parsers, losses, CONTRACTS["timesheet"].fixed_point)
    flags = attendance_flags(*map(F.col, _SHIFT_TIMES), grace_minutes)
    return typed.withColumns({**flags, "created_at": timestamp(now)}).select(
        *TABLES["silver", "timesheet"].names
    )


def rejected_timesheets(raw_timesheet: DataFrame, employee: DataFrame, now: dt.datetime) -> DataFrame:
    """Dead letters: rows whose employee id is missing or unknown; ``employee`` has each id once."""
    return rejected_split(split_timesheets(raw_timesheet, _employee_ids(employee)), now)


def rejected_split(split: DataFrame, now: dt.datetime) -> DataFrame:
    """The other shifts of ``split_timesheets``, as dead letters."""
    return _dead_letters(split.filter("not known"), now)


def _dead_letters(unknown: DataFrame, now: dt.datetime) -> DataFrame:
    kept = ("client_employee_id", "punch_apply_date", "hours_worked", "source_file")
    return clean_columns(unknown.select("id", *kept), kept[1:]).select(
        "id", *kept, F.lit(MISSING_EMPLOYEE).alias("reason"), timestamp(now).alias("rejected_at")
    )
