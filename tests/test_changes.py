import random
from decimal import Decimal

import pytest
from helpers import NOW, day, moment, rows
from pyspark.sql import functions as F

from muster.config import Config
from muster.operators import changes, reads
from muster.plans.changes import compact_employees, store_changes
from muster.plans.refresh import ContractError
from muster.schemas import TABLES
from muster.sources.tables import Warehouse

AS_OF = day("2026-01-02")


@pytest.fixture
def staff(table):
    return table(
        "silver",
        "employee",
        {"id": 1, "client_employee_id": "A", "first_name": "Ann", "city": "X", "active_status": True, "department_id": 7},
        {"id": 2, "client_employee_id": "B", "first_name": "Bob", "city": "Y", "active_status": False, "department_id": 8},
        {"id": 3, "client_employee_id": "C", "first_name": "Cy", "active_status": True, "years_of_experience": float("nan")},
    )


def test_insert_and_soft_delete(spark, table):
    """A created employee is active; deleting keeps the row and ends the employment."""
    batch = spark.createDataFrame(
        [(1, "TEST99", "Test", "User", True, day("2020-01-01"))],
        "change_seq long, client_employee_id string, first_name string, last_name string, "
        "active_status boolean, hire_date date",
    )
    created = changes.apply_employee_inserts(table("silver", "employee"), batch, NOW)
    assert created.rejected.isEmpty()
    [row] = created.employee.collect()
    assert (row.first_name, row.active_status, row.created_at, row.job_title) == ("Test", True, NOW, None)
    removal = spark.createDataFrame([(1, row.id), (2, 5), (3, None)], "change_seq long, id long")
    removed = changes.apply_employee_terminations(created.employee, removal, AS_OF, NOW)
    [gone] = removed.employee.collect()
    assert (gone.active_status, gone.term_date, gone.hire_date) == (False, AS_OF, day("2020-01-01"))
    assert rows(removed.rejected, "change_seq", "reason") == [
        (2, "EMPLOYEE_NOT_FOUND"),
        (3, "EMPLOYEE_NOT_FOUND"),
    ]


def test_inserts_keep_the_first_of_equal_ids(spark, staff):
    batch = spark.createDataFrame(
        [(5, "D", "late", None), (2, "D", "first", day("2024-01-01")), (3, "A", "known", None), (4, None, "no id", None)],
        "change_seq long, client_employee_id string, first_name string, hire_date date",
    )
    applied = changes.apply_employee_inserts(staff, batch, NOW)
    assert applied.employee.schema.names == TABLES["silver", "employee"].names
    assert rows(applied.employee, "client_employee_id", "first_name", "hire_date", "active_status")[3:] == [
        ("D", "first", day("2024-01-01"), True)
    ]
    assert rows(applied.rejected) == [
        (3, "A", "EMPLOYEE_EXISTS"),
        (4, None, "EMPLOYEE_ID_MISSING"),
        (5, "D", "EMPLOYEE_EXISTS"),
    ]
    with pytest.raises(ValueError, match="hire_date"):
        changes.apply_employee_inserts(staff, batch.drop("hire_date"), NOW)


def test_updates_patch_only_set_fields(spark, staff):
    batch = spark.createDataFrame(
        [
            (1, 1, ["first_name", "client_employee_id"], "Anna", None, "HACK"),
            (3, 1, ["city"], "ignored", None, None),  # explicit null
            (2, 1, ["city"], None, "Z", None),
            (4, 2, [], "ignored", "ignored", None),
            (5, 9, ["city"], None, "Q", None),
            (6, None, ["city"], None, "Q", None),
        ],
        "change_seq long, id long, set_fields array<string>, first_name string, city string, client_employee_id string",
    )
    applied = changes.apply_employee_updates(staff, batch, NOW)
    assert applied.employee.schema.names == staff.schema.names
    assert rows(applied.employee, "client_employee_id", "first_name", "city", "updated_at") == [
        ("A", "Anna", None, NOW),
        ("B", "Bob", "Y", NOW),
        ("C", "Cy", None, None),
    ]
    assert rows(applied.rejected, "change_seq", "id") == [(5, 9), (6, None)]


def test_updates_equal_one_by_one(spark, table):
    """Random batch against a plain replay."""
    draw = random.Random(11)
    people = [
        {"id": n, "client_employee_id": str(n), "first_name": "f", "city": "c", "job_title": None, "active_status": True}
        for n in range(40)
    ]
    fields = ("first_name", "city", "job_title")
    batch = []
    for seq in range(600):
        number = 0 if draw.random() < 0.4 else draw.randint(0, 45)  # one hot id, some unknown
        chosen = [f for f in fields if draw.random() < 0.4]
        batch.append((seq, number, chosen, *(draw.choice([None, "x", "y", "z"]) for _ in fields)))
    expected = {p["id"]: dict(p) for p in people}
    for _, number, chosen, *new in batch:
        if number in expected:
            expected[number].update({f: v for f, v in zip(fields, new) if f in chosen})
    draw.shuffle(batch)
    changed = spark.createDataFrame(
        batch, "change_seq long, id long, set_fields array<string>, first_name string, city string, job_title string"
    ).repartition(7)
    applied = changes.apply_employee_updates(table("silver", "employee", *people), changed, NOW)
    found = {r.id: {f: r[f] for f in fields} for r in applied.employee.collect()}
    assert found == {n: {f: p[f] for f in fields} for n, p in expected.items()}
    assert applied.rejected.count() == sum(1 for c in batch if c[1] >= 40)


def test_inserts_equal_one_by_one(spark, table):
    draw = random.Random(12)
    known = table("silver", "employee", *({"id": n, "client_employee_id": str(n), "active_status": True} for n in range(10)))
    batch = [(seq, str(draw.randint(0, 30)), f"name {seq}", None) for seq in range(200)]
    names = {str(n): None for n in range(10)}
    for _, number, name, _ in batch:
        names.setdefault(number, name)
    draw.shuffle(batch)
    changed = spark.createDataFrame(
        batch, "change_seq long, client_employee_id string, first_name string, hire_date date"
    ).repartition(5)
    applied = changes.apply_employee_inserts(known, changed, NOW)
    assert dict(rows(applied.employee, "client_employee_id", "first_name")) == names
    assert applied.rejected.count() == 200 - (len(names) - 10)


def test_reads(staff, table):
    assert rows(reads.list_employees(staff).items, "client_employee_id") == [("A",), ("C",)]
    assert reads.list_employees(staff, active_only=False).total() == 3
    assert rows(reads.list_employees(staff, False, 8).items, "client_employee_id") == [("B",)]
    assert reads.list_employees(staff, False, 0).total() == 3
    assert rows(reads.by_id(staff, 3), "years_of_experience") == [(None,)]
    with pytest.raises(reads.NotFound):
        reads.require(reads.by_id(staff, 4), "employee 4")


def test_timesheet_reads(staff, table):
    shifts = table(
        "silver",
        "timesheet",
        *({"id": n, "client_employee_id": e, "punch_apply_date": day(d)} for n, (e, d) in enumerate(
            [("A", "2024-01-31"), ("A", "2024-02-01"), ("B", "2024-02-01"), ("Z", "2024-03-01")]
        )),
    )
    period = (day("2024-02-01"), day("2024-03-01"))

    def ids(listing):
        return [i for (i,) in rows(listing.items, "id")]

    assert ids(reads.list_timesheets(shifts)) == [0, 1, 2, 3]
    assert ids(reads.list_timesheets(shifts, "A")) == [0, 1]
    assert ids(reads.list_timesheets(shifts, None, *period)) == [1, 2, 3]
    assert ids(reads.list_timesheets(shifts, None, None, day("2024-01-31"))) == [0]
    assert ids(reads.list_employee_timesheets(staff, shifts, "A", *period)) == [1]
    with pytest.raises(reads.NotFound):
        reads.list_employee_timesheets(staff, shifts, "Z")


def test_values_that_do_not_fit_are_refused(spark, staff, table):
    """Other types, too much text, nulls where a value is required, and keys without a row."""
    department = table("silver", "department", {"id": 7, "code": "c", "name": "n"}, {"id": 8, "code": "d", "name": "m"})
    batch = spark.createDataFrame(
        [
            (1, 1, ["zip", "scheduled_weekly_hour", "term_date"], 12345, 40.125, moment("2024-05-06 10:00"), "x", None, 8),
            (2, 1, ["scheduled_weekly_hour"], None, 123456.789, None, None, None, None),
            (3, 2, ["active_status", "city"], None, None, None, "y" * 101, None, None),
            (4, 2, ["active_status"], None, None, None, None, "maybe", None),
            (5, 3, ["department_id"], None, None, None, None, None, 99),
            (6, 3, ["department_id", "active_status"], None, None, None, "z" * 200, "false", None),
        ],
        "change_seq long, id long, set_fields array<string>, zip int, scheduled_weekly_hour double, term_date timestamp_ntz, "
        "city string, active_status string, department_id int",
    )
    applied = changes.apply_employee_updates(staff, batch, NOW, {"department": department})
    assert applied.employee.schema == staff.schema
    changed = {r.id: r for r in applied.employee.collect()}
    first = changed[1]
    assert (first.zip, first.scheduled_weekly_hour, first.term_date) == ("12345", Decimal("40.13"), day("2024-05-06"))
    assert (changed[2].city, changed[2].active_status, changed[2].updated_at) == ("Y", False, None)
    assert (changed[3].department_id, changed[3].active_status) == (None, False)
    assert rows(applied.rejected, "change_seq", "id", "reason") == [
        (2, 1, "scheduled_weekly_hour: INVALID_VALUE"),
        (3, 2, "active_status: VALUE_REQUIRED; city: TEXT_TOO_LONG"),
        (4, 2, "active_status: INVALID_VALUE"),
        (5, 3, "department_id: UNKNOWN_REFERENCE"),
    ]


def test_inserts_that_do_not_fit_are_refused(spark, staff):
    batch = spark.createDataFrame(
        [(1, "D", "bad day", "x"), (2, "D", "2024-01-02", "late"), (3, "E" * 51, None, None), (4, None, "bad day", None), (5, "F", None, None)],
        "change_seq long, client_employee_id string, hire_date string, first_name string",
    )
    applied = changes.apply_employee_inserts(staff, batch, NOW)
    assert applied.employee.schema == staff.schema
    assert rows(applied.employee.filter("id not in (1, 2, 3)"), "client_employee_id", "first_name", "hire_date") == [
        ("D", "late", day("2024-01-02")),
        ("F", None, None),
    ]
    assert rows(applied.rejected, "change_seq", "reason") == [
        (1, "hire_date: INVALID_VALUE"),
        (3, "client_employee_id: TEXT_TOO_LONG"),
        (4, "EMPLOYEE_ID_MISSING"),
    ]


def test_stored_changes(spark, staff, tmp_path):
    """Each batch is logged once, refused rows add up, and a broken contract changes nothing."""
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    config = Config(as_of=AS_OF, run_at=NOW)
    warehouse.write("silver", "employee", staff.withColumn("department_id", F.lit(None).cast("long")))
    new = spark.createDataFrame(
        [(1, "D", "2024-01-01"), (2, "A", None)], "change_seq long, client_employee_id string, hire_date string"
    )
    assert store_changes(warehouse, "insert", new, config) == {"changed": 2, "refused": 1}
    patch = spark.createDataFrame(
        [(1, 1, ["city", "zip"], "Q", 9), (2, 44, ["city"], "Q", 9)],
        "change_seq long, id long, set_fields array<string>, city string, zip int",
    )
    assert store_changes(warehouse, "update", patch, config) == {"changed": 1, "refused": 1}
    gone = spark.createDataFrame([(1, 3), (2, None)], "change_seq long, id long")
    assert store_changes(warehouse, "terminate", gone, config) == {"changed": 1, "refused": 1}
    before = warehouse.tables()
    for operation, batch in (("insert", new), ("update", patch.orderBy(F.desc("id"))), ("terminate", gone)):
        assert store_changes(warehouse, operation, batch, config) == {"changed": 0, "refused": 0}
    assert warehouse.tables() == before
    assert rows(warehouse.read("bronze", "change_batch"), "operation", "version", "changed", "refused") == [
        ("insert", 1, 2, 1), ("terminate", 3, 1, 1), ("update", 2, 1, 1),
    ]
    logged = warehouse.read("silver", "employee")
    expected = repr(rows(logged))
    assert warehouse.read("silver", "employee_change").count() == 4
    assert compact_employees(warehouse) == 4
    assert warehouse.read("silver", "employee_change").isEmpty()
    stored = warehouse.read("silver", "employee")
    assert repr(rows(stored)) == expected
    assert rows(stored, "client_employee_id", "city", "zip", "active_status", "term_date") == [
        ("A", "Q", "9", True, None), ("B", "Y", None, False, None), ("C", None, None, False, AS_OF),
        ("D", None, None, True, None),
    ]
    assert rows(warehouse.read("bronze", "refused_change"), "operation", "change_seq", "id", "client_employee_id", "reason") == [
        ("insert", 2, None, "A", "EMPLOYEE_EXISTS"),
        ("terminate", 2, None, None, "EMPLOYEE_NOT_FOUND"),
        ("update", 2, 44, None, "EMPLOYEE_NOT_FOUND"),
    ]
    warehouse.write("silver", "employee", staff)
    before = warehouse.tables()
    with pytest.raises(ContractError, match="department_id: reference"):
        store_changes(warehouse, "terminate", spark.createDataFrame([(1, 1)], "change_seq long, id long"), config)
    assert warehouse.tables() == before
    assert warehouse.read("silver", "employee").filter("id = 1").first().active_status


def test_last_version_counts(spark, staff, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    config = Config(as_of=AS_OF, run_at=NOW, fail_on_contract=False)
    warehouse.write("silver", "employee", staff)
    for n in range(9, 12):
        patch = spark.createDataFrame([(1, 1 + n % 2, ["city"], f"C{n}")], "change_seq long, id long, set_fields array<string>, city string")
        store_changes(warehouse, "update", patch, config)
    assert rows(warehouse.read("silver", "employee"), "id", "city") == [(1, "C10"), (2, "C11"), (3, None)]
