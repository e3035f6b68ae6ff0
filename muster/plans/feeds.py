"""Projections for readers: served KPI rows and ordered chart feeds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.plans import kpi


def served_headcount(employee: DataFrame, as_of: dt.date) -> DataFrame:
    """Headcount with the day as text."""
    return kpi.report_order("kpi_headcount", kpi.kpi_headcount(employee, as_of)).select(
        F.col("snapshot_date").cast("string").alias("snapshot_date"), "active_count"
    )


def served_turnover(employee: DataFrame, as_of: dt.date) -> DataFrame:
    return kpi.report_order("kpi_turnover", kpi.kpi_turnover(employee, as_of))


def served_tenure(employee: DataFrame, department: DataFrame, as_of: dt.date) -> DataFrame:
    rows = kpi.kpi_tenure_by_department(employee, department, as_of)
    return kpi.report_order("kpi_tenure_by_department", rows).select(
        "department_name", "employee_count", "avg_tenure_years"
    )


def served_attendance(
    timesheet: DataFrame, employee: DataFrame, department: DataFrame
) -> DataFrame:
    """The late-arrival report."""
    rows = kpi.kpi_late_arrivals(timesheet, employee, department)
    return kpi.report_order("kpi_late_arrivals", rows)


def served_early_attrition(
    employee: DataFrame, department: DataFrame, months: int = 6
) -> DataFrame:
    rows = kpi.kpi_early_attrition(employee, department, months)
    return kpi.report_order("kpi_early_attrition", rows)


def chart_headcount_feed(gold_headcount: DataFrame) -> DataFrame:
    return gold_headcount.select("snapshot_date", "active_count").orderBy("snapshot_date")


def chart_attendance_feed(gold_attendance: DataFrame) -> DataFrame:
    return gold_attendance.select(
        "client_employee_id", "late_arrival_count", "early_departure_count", "overtime_count"
    ).orderBy(F.desc_nulls_first("overtime_count"), F.asc_nulls_last("client_employee_id"))


def chart_tenure_feed(gold_tenure: DataFrame) -> DataFrame:
    return gold_tenure.select("department_name", "avg_tenure_years", "employee_count").orderBy(
        F.desc_nulls_first("avg_tenure_years"), F.asc_nulls_last("department_name")
    )
