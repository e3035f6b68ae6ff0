"""Gold tables: KPI results narrowed to the stored columns and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.config import Config
from muster.operators.conform import timestamp
from muster.plans import kpi
from muster.schemas import TABLES

# What makes a row of each table unique; its hash is the row id.
_KEYS = {
    "kpi_headcount": ("snapshot_date",),
    "kpi_turnover": ("year", "month"),
    "kpi_tenure_by_department": ("department_name",),
    "kpi_attendance": ("client_employee_id",),
    "kpi_rolling_hours": ("client_employee_id", "punch_apply_date"),
    "kpi_early_attrition": ("department_name",),
}


def _stored(table: str, result: DataFrame, config: Config) -> DataFrame:
    extra = {"id": F.xxhash64(*_KEYS[table]), "computed_at": timestamp(config.run_at)}
    if table == "kpi_tenure_by_department":
        extra["department_id"] = F.lit(None)  # grouped by name, which may span departments
    return result.select(
        *(
            extra.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in TABLES["gold", table].fields
        )
    )


def gold_table(
    table: str, employee: DataFrame, department: DataFrame, timesheet: DataFrame, config: Config
) -> DataFrame:
    """One gold table by name."""
    as_of = config.as_of
    builders = {
        "kpi_headcount": lambda: kpi.kpi_headcount(employee, as_of),
        "kpi_turnover": lambda: kpi.kpi_turnover(employee, as_of),
        "kpi_tenure_by_department": lambda: kpi.kpi_tenure_by_department(employee, department, as_of),
        "kpi_attendance": lambda: kpi.kpi_attendance(timesheet, employee, department),
        "kpi_rolling_hours": lambda: kpi.kpi_rolling_hours(
            timesheet, employee, config.rolling_window_rows
        ),
        "kpi_early_attrition": lambda: kpi.kpi_early_attrition(
            employee, department, config.early_attrition_months
        ),
    }
    return _stored(table, builders[table](), config)
