"""Every registered query against its SQL, on the smallest tables."""

import pytest

from verification import oracle
from verification.compare import connect, rows_of_spark, rows_of_sql
from verification.queries import registered

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(registered()) == set(oracle.statements())


@pytest.mark.parametrize("key", sorted(registered()))
def test_query_equals_sql(spark, connection, key):
    df = registered()[key](spark, FOLDER)
    names, expected = rows_of_sql(connection, oracle.statements()[key])
    assert sorted(df.columns) == names
    assert rows_of_spark(df) == expected
    assert expected.total() > 0


ORDERS = {
    "kpi_headcount": "snapshot_date",
    "kpi_turnover": "year, month",
    "kpi_tenure_by_department": "avg_tenure_years desc nulls first, department_name nulls last",
    "kpi_working_hours": "avg_hours_per_day desc nulls first, client_employee_id",
    "kpi_late_arrivals": "late_arrival_count desc nulls first, client_employee_id",
    "kpi_early_departures": "early_departure_count desc nulls first, client_employee_id",
    "kpi_overtime": "overtime_count desc nulls first, client_employee_id",
    "kpi_rolling_hours": "client_employee_id, punch_apply_date",
    "kpi_early_attrition": "early_attrition_rate_pct desc nulls first, department_name nulls last",
    "kpi_attendance": "client_employee_id",
}


@pytest.mark.parametrize("key", ORDERS)
def test_reports_come_in_order(spark, connection, key):
    """Rows in the order of the report, compared one by one."""
    found = registered()[key](spark, FOLDER)
    columns = ", ".join(found.columns)
    sql = f"select {columns} from ({oracle.statements()[key]}) order by {ORDERS[key]}"
    assert [tuple(r) for r in found.collect()] == connection.execute(sql).fetchall()


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(registered()) <= set(driver.queries())
    assert set(oracle.statements()) <= set(driver.oracle_sql()) <= set(driver.queries())
