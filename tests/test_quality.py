from decimal import Decimal as D

import pytest
from helpers import day

from muster.config import Config
from muster.operators.quality import orphan_check, quality_checks, timesheet_checks


def status(df):
    return {r.check: (r.status, r.observed) for r in df.collect()}


@pytest.fixture
def shifts(table):
    def shift(hours, late=False, early=False, on="2024-01-01"):
        return {
            "client_employee_id": "1",
            "hours_worked": hours and D(hours),
            "punch_apply_date": on and day(on),
            "is_late_arrival": late,
            "is_early_departure": early,
        }

    return lambda *kinds: table("silver", "timesheet", *(shift(*k) for k in kinds))


def raw(spark, n):
    return spark.range(n)


def test_all_checks(spark, table, shifts):
    staff = table(
        "silver",
        "employee",
        {"client_employee_id": "1", "first_name": "A", "hire_date": day("2020-01-01"), "term_date": day("2020-01-01")},
        {"client_employee_id": "1", "first_name": None, "hire_date": day("2020-01-01")},
        {"client_employee_id": "2", "first_name": "B", "hire_date": None, "term_date": day("2020-01-01")},
    )
    work = shifts(("24.00",), ("24.01",), ("-1.00",), (None,), ("0.00", True, True, None))
    checks = quality_checks(staff, work, raw(spark, 10), raw(spark, 4), Config())
    assert status(checks) == {
        "null_check_employee_client_employee_id": ("PASS", 0),
        "null_check_employee_hire_date": ("FAIL", 1),
        "null_check_employee_first_name": ("FAIL", 1),
        "null_check_timesheet_client_employee_id": ("PASS", 0),
        "null_check_timesheet_punch_apply_date": ("FAIL", 1),
        "null_check_timesheet_hours_worked": ("FAIL", 1),
        "duplicate_check_employee_id": ("FAIL", 1),
        "date_logic_check_hire_date": ("FAIL", 1),
        "hours_worked_check": ("FAIL", 2),
        "orphan_rate_check": ("PASS", 40.0),
        "attendance_flag_check": ("PASS", 1),
    }


def test_empty_tables(spark, table, shifts):
    checks = status(quality_checks(table("silver", "employee"), shifts(), raw(spark, 0), raw(spark, 0), Config()))
    assert len(checks) == 11
    assert {name for name, (s, _) in checks.items() if s == "FAIL"} == {"orphan_rate_check"}


def test_orphan_limit_is_strict(spark):
    def one(rejected):
        return orphan_check(raw(spark, 1000), raw(spark, rejected), 99.9).collect()[0]

    assert (one(999).status, one(999).observed) == ("FAIL", 99.9)
    assert one(998).status == "PASS"
    assert one(998).details == "998 of 1000 rows rejected"


def test_overlap_limit_is_inclusive(shifts):
    both = ("1.00", True, True)
    for n, expected in ((2, "PASS"), (3, "FAIL")):
        assert status(timesheet_checks(shifts(*[both] * n), 2))["attendance_flag_check"] == (expected, n)
