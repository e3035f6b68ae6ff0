import datetime as dt
import random
from collections import Counter

import pytest
from helpers import day, rows

from muster.operators.headcount import daily_headcount
from muster.plans import kpi

AS_OF = day("2024-03-10")


@pytest.fixture
def department(table):
    return table(
        "silver",
        "department",
        {"id": 1, "code": "A", "name": "Ward", "organization_id": 1},
        {"id": 2, "code": "A", "name": "Ward", "organization_id": 2},
        {"id": 3, "code": "B", "name": "Lab", "organization_id": 1},
    )


def person(number, hire=None, term=None, department=1):
    return {
        "id": number,
        "client_employee_id": f"{number:03}",
        "first_name": f"F{number}",
        "last_name": f"L{number}",
        "hire_date": hire and day(hire),
        "term_date": term and day(term),
        "department_id": department,
        "active_status": term is None,
    }


def employees(table, *people):
    return table("silver", "employee", *(person(*p) for p in people))


def brute_headcount(people, as_of):
    hires = [p.hire_date for p in people if p.hire_date]
    if not hires:
        return {}
    days = (min(hires) + dt.timedelta(n) for n in range((as_of - min(hires)).days + 1))
    return {
        d: sum(
            1
            for p in people
            if p.hire_date and p.hire_date <= d and (p.term_date is None or p.term_date > d)
        )
        for d in days
    }


def test_headcount_interval_is_half_open(table):
    staff = employees(
        table,
        (1, "2024-03-01", "2024-03-04"),
        (2, "2024-03-03"),
        (3, "2024-03-02", "2024-03-02"),  # never active
        (4, None, "2024-03-05"),
        (5, "2024-04-01"),  # after the calendar
        (6, "2024-03-06", "2024-05-01"),
    )
    counts = [n for _, n in rows(kpi.kpi_headcount(staff, AS_OF))]
    assert counts == [1, 1, 2, 1, 1, 2, 2, 2, 2, 2]


def test_empty_interval_opens_the_calendar(table):
    staff = employees(table, (1, "2024-03-08", "2024-03-01"), (2, "2024-03-10"))
    assert [n for _, n in rows(daily_headcount(staff, AS_OF))] == [0, 0, 1]


def test_headcount_of_nobody(table):
    assert rows(daily_headcount(employees(table), AS_OF)) == []
    assert rows(daily_headcount(employees(table, (1, None), (2, "2024-03-11")), AS_OF)) == []


def test_headcount_equals_range_join(table):
    draw = random.Random(3)
    start = day("2023-01-01")
    people = []
    for n in range(400):
        hire = start + dt.timedelta(draw.randint(0, 500))
        term = hire + dt.timedelta(draw.randint(-5, 300)) if draw.random() < 0.6 else None
        people.append((n, str(hire) if draw.random() < 0.95 else None, term and str(term)))
    staff = employees(table, *people)
    assert dict(rows(daily_headcount(staff, AS_OF))) == brute_headcount(staff.collect(), AS_OF)


def test_turnover(table):
    staff = employees(
        table,
        (1, "2024-01-01", "2024-01-16"),
        (2, "2024-01-01"),
        (3, "2024-02-01", "2024-03-10"),
        (4, "2024-02-01", "2024-04-01"),  # left after the calendar
        (5, None, "2024-02-15"),
    )
    # January: 2 x 15 days + 1 x 16 days = 46 / 31
    assert rows(kpi.kpi_turnover(staff, AS_OF)) == [
        (2024, 1, 1, 1.48, 67.57),
        (2024, 2, 1, 3.0, 33.33),
        (2024, 3, 1, 2.9, 34.48),
    ]


def test_turnover_without_headcount_has_no_rate(table):
    staff = employees(table, (1, "2024-03-05", "2024-03-05"))
    assert rows(kpi.kpi_turnover(staff, AS_OF)) == [(2024, 3, 1, 0.0, None)]


def test_tenure_merges_departments_of_one_name(table, department):
    staff = employees(
        table,
        (1, "2023-03-10", None, 1),
        (2, "2022-03-10", "2024-03-10", 2),
        (3, "2024-03-10", None, 3),
        (4, "2023-03-10", None, None),
        (5, None, None, 1),
        (6, "2024-03-10", "2023-03-10", 99),  # unknown department, negative tenure
    )
    # 366 days = 1.00 years, 731 days = 2.00 years
    assert rows(kpi.kpi_tenure_by_department(staff, department, AS_OF)) == [
        (None, 2, 0.0, -1.0, 1.0),
        ("Lab", 1, 0.0, 0.0, 0.0),
        ("Ward", 2, 1.5, 1.0, 2.0),
    ]


def test_early_attrition_is_inclusive(table, department):
    staff = employees(
        table,
        (1, "2023-08-31", "2024-02-29", 1),  # last day of the sixth month
        (2, "2023-08-31", "2024-03-01", 1),
        (3, "2023-01-01", "2022-01-01", 3),  # no lower bound
        (4, "2023-01-01", None, None),
        (5, None, "2023-01-01", 3),
    )
    assert rows(kpi.kpi_early_attrition(staff, department)) == [
        (None, 1, 0, 0.0),
        ("Lab", 1, 1, 100.0),
        ("Ward", 2, 1, 50.0),
    ]
    assert rows(kpi.kpi_early_attrition(staff, department, 7))[2] == ("Ward", 2, 2, 100.0)


def shift(employee, on, hours=None, **flags):
    names = ("late_arrival", "early_departure", "overtime", "unscheduled")
    return {
        "client_employee_id": employee,
        "punch_apply_date": day(on),
        "hours_worked": hours,
        **{f"is_{name}": flags.get(name.split("_")[0], False) for name in names},
    }


@pytest.fixture
def staff(table):
    return employees(table, (1, "2020-01-01", None, 1), (2, "2020-01-01", None, None), (3, "2020-01-01", None, 3))


@pytest.fixture
def shifts(table):
    from decimal import Decimal as D

    return table(
        "silver",
        "timesheet",
        shift("001", "2024-01-01", D("4.00"), late=True),
        shift("001", "2024-01-01", D("4.25"), overtime=True),
        shift("001", "2024-01-20", D("8.00"), late=True, early=True),
        shift("001", "2024-01-21", None, late=True, overtime=True),
        shift("002", "2024-01-05", D("-0.01")),
        shift("002", "2024-01-06", D("0.00"), unscheduled=True),
        shift("999", "2024-01-06", D("8.00"), late=True),
        shift("003", "2024-01-07", None, overtime=True),
    )


def test_flag_reports(shifts, staff, department):
    assert rows(kpi.kpi_late_arrivals(shifts, staff, department)) == [
        ("001", "F1", "L1", "Ward", 4, 3, 75.0)
    ]
    assert rows(kpi.kpi_early_departures(shifts, staff, department)) == [
        ("001", "F1", "L1", "Ward", 4, 1, 25.0)
    ]


def test_overtime_skips_shifts_without_hours(shifts, staff, department):
    assert rows(kpi.kpi_overtime(shifts, staff, department)) == [
        ("001", "F1", "L1", "Ward", 3, 1, 4.25, 33.33)
    ]


def test_attendance_lists_everyone(shifts, staff, department):
    assert rows(kpi.kpi_attendance(shifts, staff, department)) == [
        ("001", "Ward", 4, 3, 1, 2, 75.0),
        ("002", None, 2, 0, 0, 0, 0.0),
        ("003", "Lab", 1, 0, 0, 1, 0.0),
    ]


def test_working_hours(shifts, staff, department):
    # 16.25 hours on two days; -0.01 on two days rounds away from zero
    assert rows(kpi.kpi_working_hours(shifts, staff, department)) == [
        ("001", "F1", "L1", "Ward", 2, 16.25, 8.13, 40.63),
        ("002", "F2", "L2", None, 2, -0.01, -0.01, -0.03),
    ]


def test_rolling_average_counts_worked_days(table, staff):
    from decimal import Decimal as D

    dates = ["2024-01-01", "2024-03-01", *(f"2024-06-{n:02}" for n in range(1, 8))]
    worked = [shift("001", d, D(n)) for n, d in enumerate(dates, 1)]
    random.Random(1).shuffle(worked)
    result = rows(kpi.kpi_rolling_hours(table("silver", "timesheet", *worked), staff))
    assert [r[5] for r in result] == [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, 6.0]
    short = rows(kpi.kpi_rolling_hours(table("silver", "timesheet", *worked), staff, 2))
    assert [r[5] for r in short] == [1.0, 1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 7.5, 8.5]


def test_report_order_puts_nulls_as_the_database_did(table, department, staff, shifts):
    staff2 = employees(table, (1, "2024-03-05", "2024-03-05"), (2, "2023-03-05", "2024-02-05"))
    order = kpi.report_order("kpi_tenure_by_department", kpi.kpi_tenure_by_department(staff2, department, AS_OF))
    assert [r.avg_tenure_years for r in order.collect()] == [0.46]
    attendance = kpi.report_order("kpi_attendance", kpi.kpi_attendance(shifts, staff, department))
    assert [r.client_employee_id for r in attendance.collect()] == ["001", "002", "003"]


def test_flag_counts_agree_between_reports(spark):
    """Conservation laws over the derived test tables."""
    from verification.views import Views

    v = Views(spark, "/root/testdata/sf0.001")
    consolidated = {r.client_employee_id: r for r in kpi.kpi_attendance(v.timesheet, v.employee, v.department).collect()}
    late = {r.client_employee_id: r.late_arrival_count for r in kpi.kpi_late_arrivals(v.timesheet, v.employee, v.department).collect()}
    overtime = Counter({r.client_employee_id: r.overtime_count for r in kpi.kpi_overtime(v.timesheet, v.employee, v.department).collect()})
    assert late == {k: r.late_arrival_count for k, r in consolidated.items() if r.late_arrival_count}
    assert all(r.overtime_count >= overtime[k] for k, r in consolidated.items())
    assert v.timesheet.filter("is_unscheduled and (is_late_arrival or is_early_departure or is_overtime)").isEmpty()
    assert v.timesheet.filter("is_early_departure and is_overtime").isEmpty()
    assert kpi.kpi_headcount(v.employee, AS_OF).filter("active_count < 0").isEmpty()
