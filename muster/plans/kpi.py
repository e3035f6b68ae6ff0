"""The ten KPI plans over silver tables.

Shifts are aggregated per employee, and employees per department key, *before*
they are joined: partial aggregation absorbs hot employees and departments on the
map side, and the joins see one row per key. This relies on ``employee`` holding
one row per ``client_employee_id`` and ``department`` one per ``id``, which their
contracts demand. No join carries a broadcast hint; the engine broadcasts a side
only when its measured size is below the configured threshold.

Rows come back unordered; ``report_order`` adds the order of the report.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.functions.rounding import (
    div_half_up,
    from_hundredths,
    mean_of_hundredths,
    rate_pct,
    to_hundredths,
    years_in_hundredths,
)
from muster.operators.headcount import daily_headcount

_EMPLOYEE = "client_employee_id"


def _n() -> Column:
    return F.count(F.lit(1))


def _with_department(df: DataFrame, department: DataFrame) -> DataFrame:
    """Add ``department_name``; null where there is no department."""
    names = department.select(
        F.col("id").alias("department_id"), F.col("name").alias("department_name")
    )
    return df.join(names, "department_id", "left")


def _per_employee(
    totals: DataFrame, employee: DataFrame, department: DataFrame, *names: str
) -> DataFrame:
    """Join per-employee totals to the employee's names and department."""
    master = employee.select(_EMPLOYEE, "department_id", *names)
    return _with_department(totals.join(master, _EMPLOYEE), department)


def kpi_headcount(employee: DataFrame, as_of: dt.date) -> DataFrame:
    """Active employees per day."""
    return daily_headcount(employee, as_of)


def kpi_turnover(employee: DataFrame, as_of: dt.date) -> DataFrame:
    """Terminations per month against the month's average daily headcount."""

    def monthly(df: DataFrame, day: str, *aggregates: Column) -> DataFrame:
        parts = (F.year(day).cast("bigint").alias("year"), F.month(day).cast("bigint").alias("month"))
        return df.groupBy(*parts).agg(*aggregates)

    terminations = monthly(
        employee.filter(F.col("term_date").isNotNull()), "term_date", _n().alias("terminations")
    )
    headcount = monthly(
        daily_headcount(employee, as_of),
        "snapshot_date",
        div_half_up(F.sum("active_count") * 100, _n()).alias("average"),
    )
    # terminations / (average / 100) in percent, as hundredths
    rate = div_half_up(F.col("terminations") * 1_000_000, F.col("average"))
    return terminations.join(headcount, ["year", "month"]).select(
        "year",
        "month",
        "terminations",
        from_hundredths(F.col("average")).alias("avg_headcount"),
        from_hundredths(rate).alias("turnover_rate_pct"),
    )


def _by_department_name(
    per_key: DataFrame, department: DataFrame, *aggregates: Column
) -> DataFrame:
    """Join totals per department key to names, then merge departments of one name."""
    return _with_department(per_key, department).groupBy("department_name").agg(*aggregates)


def kpi_tenure_by_department(
    employee: DataFrame, department: DataFrame, as_of: dt.date
) -> DataFrame:
    """Average, shortest and longest tenure in years per department name."""
    end = F.coalesce("term_date", F.lit(as_of).cast("date"))
    years = years_in_hundredths(F.datediff(end, "hire_date"))
    per_key = (
        employee.filter(F.col("hire_date").isNotNull())
        .select("department_id", _EMPLOYEE, years.alias("years"))
        .groupBy("department_id")
        .agg(
            F.count(_EMPLOYEE).alias("n"),
            _n().alias("rows"),
            F.sum("years").alias("total"),
            F.min("years").alias("low"),
            F.max("years").alias("high"),
        )
    )
    return _by_department_name(
        per_key,
        department,
        F.sum("n").alias("employee_count"),
        mean_of_hundredths(F.sum("total"), F.sum("rows")).alias("avg_tenure_years"),
        from_hundredths(F.min("low")).alias("min_tenure_years"),
        from_hundredths(F.max("high")).alias("max_tenure_years"),
    )


def daily_hours(timesheet: DataFrame) -> DataFrame:
    """Hours per employee and day, in hundredths."""
    return (
        timesheet.filter(F.col("hours_worked").isNotNull())
        .groupBy(_EMPLOYEE, "punch_apply_date")
        .agg(F.sum(to_hundredths(F.col("hours_worked"))).alias("hundredths"))
    )


def kpi_working_hours(
    timesheet: DataFrame, employee: DataFrame, department: DataFrame
) -> DataFrame:
    """Hours per worked day and per week of five worked days."""
    totals = (
        daily_hours(timesheet)
        .groupBy(_EMPLOYEE)
        .agg(F.count("punch_apply_date").alias("days"), F.sum("hundredths").alias("total"), _n().alias("n"))
    )
    return _per_employee(totals, employee, department, "first_name", "last_name").select(
        _EMPLOYEE,
        "first_name",
        "last_name",
        "department_name",
        F.col("days").alias("total_days_worked"),
        from_hundredths(F.col("total")).alias("total_hours"),
        mean_of_hundredths(F.col("total"), F.col("n")).alias("avg_hours_per_day"),
        mean_of_hundredths(F.col("total") * 5, F.col("days")).alias("avg_hours_per_week"),
    )


def _flagged_shifts(
    timesheet: DataFrame,
    employee: DataFrame,
    department: DataFrame,
    flag: str,
    stem: str,
    **extra: Column,
) -> DataFrame:
    """Employees with at least one flagged shift: shifts, flagged shifts and their rate."""
    count, rate = f"{stem}_count", f"{stem}_rate_pct"
    totals = (
        timesheet.groupBy(_EMPLOYEE)
        .agg(
            _n().alias("total_shifts"),
            F.count_if(flag).alias(count),
            *(column.alias(name) for name, column in extra.items()),
        )
        .filter(F.col(count) > 0)
    )
    return _per_employee(totals, employee, department, "first_name", "last_name").select(
        _EMPLOYEE,
        "first_name",
        "last_name",
        "department_name",
        "total_shifts",
        count,
        *extra,
        rate_pct(F.col(count), F.col("total_shifts")).alias(rate),
    )


def kpi_late_arrivals(
    timesheet: DataFrame, employee: DataFrame, department: DataFrame
) -> DataFrame:
    """Employees who came late, with the share of late shifts."""
    return _flagged_shifts(timesheet, employee, department, "is_late_arrival", "late_arrival")


def kpi_early_departures(
    timesheet: DataFrame, employee: DataFrame, department: DataFrame
) -> DataFrame:
    """Employees who left early, with the share of such shifts."""
    return _flagged_shifts(timesheet, employee, department, "is_early_departure", "early_departure")


def kpi_overtime(timesheet: DataFrame, employee: DataFrame, department: DataFrame) -> DataFrame:
    """Employees with overtime, over shifts with known hours; counts whole shift hours."""
    hours = F.when(F.col("is_overtime"), to_hundredths(F.col("hours_worked"))).otherwise(0)
    return _flagged_shifts(
        timesheet.filter(F.col("hours_worked").isNotNull()),
        employee,
        department,
        "is_overtime",
        "overtime",
        total_overtime_hours=from_hundredths(F.sum(hours)),
    )


def kpi_rolling_hours(
    timesheet: DataFrame, employee: DataFrame, window_rows: int = 7
) -> DataFrame:
    """Hours per worked day and their average over the last ``window_rows`` worked days.

    The window sorts one row per employee and day, so an employee's share of it is
    bounded by the calendar, however many shifts there are.
    """
    recent = (
        Window.partitionBy(_EMPLOYEE)
        .orderBy("punch_apply_date")
        .rowsBetween(1 - window_rows, Window.currentRow)
    )
    rolling = daily_hours(timesheet).select(
        _EMPLOYEE,
        "punch_apply_date",
        from_hundredths(F.col("hundredths")).alias("hours_worked"),
        mean_of_hundredths(
            F.sum("hundredths").over(recent), F.count("hundredths").over(recent)
        ).alias("rolling_avg_7d"),
    )
    names = employee.select(_EMPLOYEE, "first_name", "last_name")
    return rolling.join(names, _EMPLOYEE).select(
        _EMPLOYEE, "first_name", "last_name", "punch_apply_date", "hours_worked", "rolling_avg_7d"
    )


def kpi_early_attrition(
    employee: DataFrame, department: DataFrame, months: int = 6
) -> DataFrame:
    """Share of hires who left within ``months`` of their hire date, per department name."""
    left_early = F.col("term_date") <= F.add_months("hire_date", months)
    per_key = (
        employee.filter(F.col("hire_date").isNotNull())
        .groupBy("department_id")
        .agg(_n().alias("hires"), F.count_if(left_early).alias("early"))
    )
    return _by_department_name(
        per_key,
        department,
        F.sum("hires").alias("total_hires"),
        F.sum("early").alias("early_attrition_count"),
        rate_pct(F.sum("early"), F.sum("hires")).alias("early_attrition_rate_pct"),
    )


def kpi_attendance(timesheet: DataFrame, employee: DataFrame, department: DataFrame) -> DataFrame:
    """Shift and flag counts of every employee with shifts."""
    totals = timesheet.groupBy(_EMPLOYEE).agg(
        _n().alias("total_shifts"),
        F.count_if("is_late_arrival").alias("late_arrival_count"),
        F.count_if("is_early_departure").alias("early_departure_count"),
        F.count_if("is_overtime").alias("overtime_count"),
    )
    return _per_employee(totals, employee, department).select(
        _EMPLOYEE,
        "department_name",
        "total_shifts",
        "late_arrival_count",
        "early_departure_count",
        "overtime_count",
        rate_pct(F.col("late_arrival_count"), F.col("total_shifts")).alias("late_arrival_rate_pct"),
    )


def _down(*columns: str) -> list[Column]:
    return [F.desc_nulls_first(c) for c in columns]


def _up(*columns: str) -> list[Column]:
    return [F.asc_nulls_last(c) for c in columns]


def report_order(kpi: str, df: DataFrame) -> DataFrame:
    """Sort a KPI's rows the way its report lists them; a key breaks ties."""
    orders = {
        "kpi_headcount": _up("snapshot_date"),
        "kpi_turnover": _up("year", "month"),
        "kpi_tenure_by_department": _down("avg_tenure_years") + _up("department_name"),
        "kpi_working_hours": _down("avg_hours_per_day") + _up(_EMPLOYEE),
        "kpi_late_arrivals": _down("late_arrival_count") + _up(_EMPLOYEE),
        "kpi_early_departures": _down("early_departure_count") + _up(_EMPLOYEE),
        "kpi_overtime": _down("overtime_count") + _up(_EMPLOYEE),
        "kpi_rolling_hours": _up(_EMPLOYEE, "punch_apply_date"),
        "kpi_early_attrition": _down("early_attrition_rate_pct") + _up("department_name"),
        "kpi_attendance": _up(_EMPLOYEE),
    }
    return df.orderBy(*orders[kpi])
