"""The eleven data-quality checks as one DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.config import Config
from muster.functions.rounding import rate_pct

# Columns that must not be null.
_REQUIRED = {
    "employee": ("client_employee_id", "hire_date", "first_name"),
    "timesheet": ("client_employee_id", "punch_apply_date", "hours_worked"),
}


def _check(name: str, passed: Column, observed: Column, limit: Column, details: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        observed.cast("double").alias("observed"),
        limit.cast("double").alias("threshold"),
        details.alias("details"),
    )


def _count_check(name: str, n: str, text: str, limit: int = 0) -> Column:
    """Check that passes while a count stays at or below ``limit``."""
    details = F.concat(F.col(n).cast("string"), F.lit(" " + text))
    return _check(name, F.col(n) <= limit, F.col(n), F.lit(limit), details)


def _rows(counts: DataFrame, checks: Sequence[Column]) -> DataFrame:
    return counts.select(F.inline(F.array(*checks)))


def _null_counts(table: str) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in _REQUIRED[table]]


def _null_checks(table: str) -> list[Column]:
    return [
        _count_check(f"null_check_{table}_{c}", f"null_{c}", f"rows without {c} in {table}")
        for c in _REQUIRED[table]
    ]


def employee_checks(employee: DataFrame) -> DataFrame:
    """Null and date-order checks in one pass, then repeated ids."""
    late_hire = F.col("hire_date") >= F.col("term_date")
    counts = employee.agg(*_null_counts("employee"), F.count_if(late_hire).alias("dates"))
    repeated = (
        employee.groupBy("client_employee_id")
        .count()
        .filter("count > 1")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _rows(
        counts,
        [
            *_null_checks("employee"),
            _count_check("date_logic_check_hire_date", "dates", "employees hired on or after their term date"),
        ],
    ).unionByName(
        _rows(repeated, [_count_check("duplicate_check_employee_id", "n", "employee ids occur more than once")])
    )


def timesheet_checks(timesheet: DataFrame, flag_max_overlap: int) -> DataFrame:
    """Null, hour-range and flag-overlap checks in one pass."""
    hours = F.col("hours_worked")
    counts = timesheet.agg(
        *_null_counts("timesheet"),
        F.count_if((hours < 0) | (hours > 24)).alias("hours"),
        F.count_if(F.col("is_late_arrival") & F.col("is_early_departure")).alias("overlap"),
    )
    return _rows(
        counts,
        [
            *_null_checks("timesheet"),
            _count_check("hours_worked_check", "hours", "shifts with hours outside 0 to 24"),
            _count_check(
                "attendance_flag_check", "overlap", "shifts both late and left early", flag_max_overlap
            ),
        ],
    )


def orphan_check(
    raw_timesheet: DataFrame, rejected_timesheet: DataFrame, max_pct: float
) -> DataFrame:
    """Share of dead letters, which must stay strictly below ``max_pct``."""

    def tally(df: DataFrame, raw: Column, rejected: Column) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(raw.alias("raw"), rejected.alias("rejected"))

    n, none = F.col("n"), F.lit(0).cast("bigint")
    totals = (
        tally(raw_timesheet, n, none)
        .unionByName(tally(rejected_timesheet, none, n))
        .agg(F.sum("raw").alias("raw"), F.sum("rejected").alias("rejected"))
        .withColumn("rate", rate_pct(F.col("rejected"), F.col("raw")))
    )
    details = F.when(F.col("raw") == 0, F.lit("no raw timesheet rows")).otherwise(
        F.concat(
            F.col("rejected").cast("string"), F.lit(" of "), F.col("raw").cast("string"), F.lit(" rows rejected")
        )
    )
    passed = F.coalesce(F.col("rate") < max_pct, F.lit(False))
    return _rows(totals, [_check("orphan_rate_check", passed, F.col("rate"), F.lit(max_pct), details)])


def quality_checks(
    employee: DataFrame,
    timesheet: DataFrame,
    raw_timesheet: DataFrame,
    rejected_timesheet: DataFrame,
    config: Config,
) -> DataFrame:
    """``check, status, observed, threshold, details``, one row per check."""
    return (
        employee_checks(employee)
        .unionByName(timesheet_checks(timesheet, config.flag_max_overlap))
        .unionByName(orphan_check(raw_timesheet, rejected_timesheet, config.orphan_rate_max_pct))
    )
