"""Declared tables: columns, types and the rules each table must satisfy."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "ts": T.TimestampNTZType(),
    "dec52": T.DecimalType(5, 2),
    "dec62": T.DecimalType(6, 2),
    "measure": T.DecimalType(18, 2),
}


def _table(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


def _text_table(columns: tuple[str, ...]) -> T.StructType:
    return _table(id="long", **dict.fromkeys(columns, "string"), loaded_at="ts", source_file="string")


# Columns of the employee file, in file order.
EMPLOYEE_FILE_COLUMNS = (
    "client_employee_id", "first_name", "middle_name", "last_name", "preferred_name",
    "job_code", "job_title", "job_start_date", "organization_id", "organization_name",
    "department_id", "department_name", "dob", "hire_date", "recent_hire_date",
    "anniversary_date", "term_date", "years_of_experience", "work_email", "address",
    "city", "state", "zip", "country", "manager_employee_id", "manager_employee_name",
    "fte_status", "is_per_deim", "cell_phone", "work_phone", "scheduled_weekly_hour",
    "active_status", "termination_reason", "clinical_level",
)

# Columns of a timesheet file.
TIMESHEET_FILE_COLUMNS = (
    "client_employee_id", "department_id", "department_name", "home_department_id",
    "home_department_name", "pay_code", "punch_in_comment", "punch_out_comment",
    "hours_worked", "punch_apply_date", "punch_in_datetime", "punch_out_datetime",
    "scheduled_start_datetime", "scheduled_end_datetime",
)

TABLES: dict[tuple[str, str], T.StructType] = {
    ("bronze", "raw_employee"): _text_table(EMPLOYEE_FILE_COLUMNS),
    ("bronze", "raw_timesheet"): _text_table(TIMESHEET_FILE_COLUMNS),
    ("bronze", "rejected_timesheet"): _table(
        id="long", client_employee_id="string", punch_apply_date="string", hours_worked="string",
        source_file="string", reason="string", rejected_at="ts",
    ),
    ("bronze", "refused_change"): _table(
        operation="string", change_seq="long", id="long", client_employee_id="string",
        reason="string", refused_at="ts",
    ),
    ("bronze", "change_batch"): _table(
        batch_id="string", operation="string", version="long", changed="long", refused="long",
        stored_at="ts",
    ),
    ("bronze", "malformed_line"): _table(
        source_file="string", text="string", reason="string", loaded_at="ts",
    ),
    ("silver", "organization"): _table(id="long", code="string", name="string"),
    ("silver", "department"): _table(
        id="long", code="string", name="string", organization_id="long",
    ),
    ("silver", "employee"): _table(
        id="long", client_employee_id="string", first_name="string", middle_name="string",
        last_name="string", preferred_name="string", job_code="string", job_title="string",
        job_start_date="date", fte_status="string", scheduled_weekly_hour="dec52",
        clinical_level="string", is_per_deim="bool", dob="date", hire_date="date",
        recent_hire_date="date", anniversary_date="date", term_date="date",
        termination_reason="string", years_of_experience="double", active_status="bool",
        work_email="string", address="string", city="string", state="string", zip="string",
        country="string", cell_phone="string", work_phone="string", organization_id="long",
        department_id="long", manager_employee_id="string", manager_employee_name="string",
        created_at="ts", updated_at="ts",
    ),
    ("silver", "timesheet"): _table(
        id="long", client_employee_id="string", department_id="string", department_name="string",
        home_department_id="string", home_department_name="string", pay_code="string",
        punch_apply_date="date", punch_in_datetime="ts", punch_out_datetime="ts",
        scheduled_start_datetime="ts", scheduled_end_datetime="ts", hours_worked="dec62",
        punch_in_comment="string", punch_out_comment="string", is_late_arrival="bool",
        is_early_departure="bool", is_overtime="bool", is_unscheduled="bool",
        source_file="string", created_at="ts",
    ),
    # Counts and measures of gold tables are wide enough for a key that holds most of the rows.
    ("gold", "kpi_headcount"): _table(
        id="long", snapshot_date="date", active_count="long", computed_at="ts",
    ),
    ("gold", "kpi_turnover"): _table(
        id="long", year="int", month="int", terminations="long", turnover_rate_pct="measure",
        computed_at="ts",
    ),
    ("gold", "kpi_tenure_by_department"): _table(
        id="long", department_id="string", department_name="string", avg_tenure_years="measure",
        employee_count="long", computed_at="ts",
    ),
    ("gold", "kpi_attendance"): _table(
        id="long", client_employee_id="string", department_name="string", total_shifts="long",
        late_arrival_count="long", early_departure_count="long", overtime_count="long",
        late_arrival_rate_pct="measure", computed_at="ts",
    ),
    ("gold", "kpi_rolling_hours"): _table(
        id="long", client_employee_id="string", punch_apply_date="date", hours_worked="measure",
        rolling_avg_7d="measure", computed_at="ts",
    ),
    ("gold", "kpi_early_attrition"): _table(
        id="long", department_name="string", total_hires="long", early_attrition_count="long",
        early_attrition_rate_pct="measure", computed_at="ts",
    ),
}

# The ids that business keys have been given.
TABLES |= {
    ("silver", "organization_key"): _table(id="long", code="string"),
    ("silver", "department_key"): _table(id="long", organization_code="string", code="string"),
    ("silver", "employee_key"): _table(id="long", client_employee_id="string"),
}

# Versions of single employees that batches of changes have made since the table was written.
TABLES["silver", "employee_change"] = T.StructType(
    [T.StructField("version", T.LongType()), *TABLES["silver", "employee"].fields]
)

GOLD_TABLES = tuple(table for layer, table in TABLES if layer == "gold")


@dataclass(frozen=True)
class Contract:
    """Rules of one table.

    ``unique`` lists key column groups; ``references`` holds (column, parent table,
    parent column); ``max_length`` maps a text column to its limit; ``fixed_point``
    maps a decimal column to the (precision, scale) its raw text must fit.
    """

    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()
    max_length: tuple[tuple[str, int], ...] = ()
    fixed_point: tuple[tuple[str, int, int], ...] = ()


CONTRACTS: dict[str, Contract] = {
    "organization": Contract(
        not_null=("id", "code", "name"),
        unique=(("id",), ("code",)),
        max_length=(("code", 50), ("name", 255)),
    ),
    "department": Contract(
        not_null=("id", "code", "name", "organization_id"),
        unique=(("id",), ("code", "organization_id")),
        references=(("organization_id", "organization", "id"),),
        max_length=(("code", 50), ("name", 255)),
    ),
    "employee": Contract(
        not_null=("id", "client_employee_id", "active_status"),
        unique=(("id",), ("client_employee_id",)),
        references=(
            ("organization_id", "organization", "id"),
            ("department_id", "department", "id"),
            ("manager_employee_id", "employee", "client_employee_id"),
        ),
        max_length=(
            ("client_employee_id", 50), ("first_name", 100), ("middle_name", 100),
            ("last_name", 100), ("preferred_name", 100), ("job_code", 50), ("job_title", 255),
            ("fte_status", 50), ("clinical_level", 100), ("termination_reason", 255),
            ("work_email", 255), ("city", 100), ("state", 100), ("zip", 20), ("country", 100),
            ("cell_phone", 50), ("work_phone", 50), ("manager_employee_id", 50),
            ("manager_employee_name", 255),
        ),
        fixed_point=(("scheduled_weekly_hour", 5, 2),),
    ),
    "timesheet": Contract(
        not_null=("id", "client_employee_id", "punch_apply_date"),
        unique=(("id",),),
        references=(("client_employee_id", "employee", "client_employee_id"),),
        max_length=(
            ("client_employee_id", 50), ("department_id", 50), ("department_name", 255),
            ("home_department_id", 50), ("home_department_name", 255), ("pay_code", 100),
            ("punch_in_comment", 100), ("punch_out_comment", 100),
        ),
        fixed_point=(("hours_worked", 6, 2),),
    ),
}

# The id of a gold row is a hash of its key for lookups; its identity is the key itself.
GOLD_CONTRACTS: dict[str, Contract] = {
    "kpi_headcount": Contract(not_null=("snapshot_date", "active_count"), unique=(("snapshot_date",),)),
    "kpi_turnover": Contract(not_null=("year", "month", "terminations"), unique=(("year", "month"),)),
    "kpi_tenure_by_department": Contract(
        unique=(("department_name",),), max_length=(("department_name", 255),)
    ),
    "kpi_attendance": Contract(
        not_null=("client_employee_id",), unique=(("client_employee_id",),),
        max_length=(("client_employee_id", 50), ("department_name", 255)),
    ),
    "kpi_rolling_hours": Contract(
        not_null=("client_employee_id", "punch_apply_date"),
        unique=(("client_employee_id", "punch_apply_date"),), max_length=(("client_employee_id", 50),),
    ),
    "kpi_early_attrition": Contract(
        unique=(("department_name",),), max_length=(("department_name", 255),)
    ),
}

BRONZE_CONTRACTS: dict[str, Contract] = {"rejected_timesheet": Contract(not_null=("reason",))}
