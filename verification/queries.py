"""Registered queries: each takes (spark, folder of the test tables) and gives a DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.config import Config
from muster.functions.attendance import attendance_flags
from muster.functions.dates import parse_date, parse_datetime
from muster.functions.rounding import to_hundredths
from muster.functions.text import (
    clean_columns,
    clean_string,
    finite_columns,
    null_token,
    overflows,
    parse_bool,
    parse_decimal,
    parse_double,
    strip,
)
from muster.operators import changes, conform, contracts, dimensions, intervals, numbering, quality, reads
from muster.plans import feeds, gold, kpi, refresh
from muster.plans.changes import store_changes
from muster.schemas import CONTRACTS, GOLD_TABLES, TABLES
from muster.session import shared_folder
from muster.sources import export, landing
from muster.sources.tables import Warehouse
from verification.views import AS_OF, RUN_AT, Views, case

CONFIG = Config(as_of=AS_OF, run_at=RUN_AT, fail_on_contract=False)
# A department id and an employee that exist at every size of the test data.
DEPARTMENT_ID = 3
EMPLOYEE_ID = 2
TIMESHEET_ID = 42
PERIOD = (dt.date(2024, 1, 8), dt.date(2024, 1, 21))

_REGISTRY: dict[str, Callable[[Views], DataFrame]] = {}


def _query(function: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    """Register a query under its name; a trailing underscore only avoids a clash."""
    _REGISTRY[function.__name__.rstrip("_")] = function
    return function


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(function: Callable[[Views], DataFrame]):
        return lambda spark, folder: function(Views(spark, folder))

    return {name: bound(function) for name, function in _REGISTRY.items()}


def _moment(name: str) -> Column:
    """Moment as text, so that both engines print it alike."""
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


# KPIs


@_query
def kpi_headcount(v: Views) -> DataFrame:
    return kpi.report_order("kpi_headcount", kpi.kpi_headcount(v.employee, AS_OF))


@_query
def kpi_turnover(v: Views) -> DataFrame:
    return kpi.report_order("kpi_turnover", kpi.kpi_turnover(v.employee, AS_OF))


@_query
def kpi_tenure_by_department(v: Views) -> DataFrame:
    rows = kpi.kpi_tenure_by_department(v.employee, v.department, AS_OF)
    return kpi.report_order("kpi_tenure_by_department", rows)


@_query
def kpi_working_hours(v: Views) -> DataFrame:
    rows = kpi.kpi_working_hours(v.timesheet, v.staff, v.department)
    return kpi.report_order("kpi_working_hours", rows)


@_query
def kpi_late_arrivals(v: Views) -> DataFrame:
    rows = kpi.kpi_late_arrivals(v.timesheet, v.staff, v.department)
    return kpi.report_order("kpi_late_arrivals", rows)


@_query
def kpi_early_departures(v: Views) -> DataFrame:
    rows = kpi.kpi_early_departures(v.timesheet, v.staff, v.department)
    return kpi.report_order("kpi_early_departures", rows)


@_query
def kpi_overtime(v: Views) -> DataFrame:
    rows = kpi.kpi_overtime(v.timesheet, v.staff, v.department)
    return kpi.report_order("kpi_overtime", rows)


@_query
def kpi_rolling_hours(v: Views) -> DataFrame:
    return kpi.report_order("kpi_rolling_hours", kpi.kpi_rolling_hours(v.timesheet, v.staff))


@_query
def kpi_early_attrition(v: Views) -> DataFrame:
    rows = kpi.kpi_early_attrition(v.employee, v.department, CONFIG.early_attrition_months)
    return kpi.report_order("kpi_early_attrition", rows)


@_query
def kpi_attendance(v: Views) -> DataFrame:
    rows = kpi.kpi_attendance(v.timesheet, v.staff, v.department)
    return kpi.report_order("kpi_attendance", rows)


# Served projections and chart feeds


@_query
def served_headcount(v: Views) -> DataFrame:
    return feeds.served_headcount(v.employee, AS_OF)


@_query
def served_turnover(v: Views) -> DataFrame:
    return feeds.served_turnover(v.employee, AS_OF)


@_query
def served_tenure(v: Views) -> DataFrame:
    return feeds.served_tenure(v.employee, v.department, AS_OF)


@_query
def served_attendance(v: Views) -> DataFrame:
    return feeds.served_attendance(v.timesheet, v.staff, v.department)


@_query
def served_early_attrition(v: Views) -> DataFrame:
    return feeds.served_early_attrition(v.employee, v.department)


def _gold(v: Views, table: str) -> DataFrame:
    return gold.gold_table(table, v.employee, v.department, v.timesheet, CONFIG)


@_query
def chart_headcount_feed(v: Views) -> DataFrame:
    rows = feeds.chart_headcount_feed(_gold(v, "kpi_headcount"))
    return rows.withColumn("active_count", F.col("active_count").cast("bigint"))


@_query
def chart_attendance_feed(v: Views) -> DataFrame:
    rows = feeds.chart_attendance_feed(_gold(v, "kpi_attendance"))
    counts = ("late_arrival_count", "early_departure_count", "overtime_count")
    return rows.withColumns({c: F.col(c).cast("bigint") for c in counts})


@_query
def chart_tenure_feed(v: Views) -> DataFrame:
    return feeds.chart_tenure_feed(_gold(v, "kpi_tenure_by_department")).withColumns(
        {
            "avg_tenure_years": F.col("avg_tenure_years").cast("double"),
            "employee_count": F.col("employee_count").cast("bigint"),
        }
    )


# Cleaning functions on dirty text


@_query
def null_token_normalize(v: Views) -> DataFrame:
    tokens = {
        0: "[NULL]", 1: "NULL", 2: "", 3: "#N/A", 4: "#N/A N/A", 5: "#NA", 6: "-1.#IND",
        7: "-1.#QNAN", 8: "-NaN", 9: "-nan", 10: "1.#IND", 11: "1.#QNAN", 12: "<NA>", 13: "N/A",
        14: "NA", 15: "NaN", 16: "None", 17: "n/a", 18: "nan", 19: "null", 20: " NULL", 21: "Na",
        22: "NONE", 23: "0",
    }
    field = case("c_nationkey", tokens, F.col("c_name"))
    written = v.table("customer").withColumn("text", field)
    return written.select("c_custkey", null_token("text").alias("value"))


@_query
def clean_string_(v: Views) -> DataFrame:
    field = case(
        "c_mktsegment",
        {"BUILDING": " NaN\t", "MACHINERY": "None ", "FURNITURE": F.concat(F.lit("\xa0\t"), "c_name", F.lit("\n "))},
        F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")),
    )
    written = v.table("customer").withColumn("text", field)
    return written.select("c_custkey", clean_string("text").alias("value"))


def _dated(v: Views) -> DataFrame:
    """Order dates written in the declared formats."""
    formats = {
        "1-URGENT": F.date_format("o_orderdate", "MM/dd/yyyy"),
        "2-HIGH": F.date_format("o_orderdate", "dd/MM/yyyy"),
        "3-MEDIUM": F.date_format("o_orderdate", "yyyyMMdd"),
        "5-LOW": F.concat(F.lit("no date "), F.col("o_orderstatus")),
    }
    iso = F.date_format("o_orderdate", " yyyy-MM-dd 00:00:00.000 ")
    return v.table("orders").select("o_orderkey", case("o_orderpriority", formats, iso).alias("text"))


@_query
def parse_date_(v: Views) -> DataFrame:
    cleaned = clean_columns(_dated(v), ["text"])
    return cleaned.select("o_orderkey", parse_date("text").alias("value"))


@_query
def parse_named_dates(v: Views) -> DataFrame:
    """Order dates with named months, dots and two-digit years; some name no month."""
    formats = ("MMMM d, yyyy", "dd-MMM-yyyy", "d MMM. yyyy HH:mm", "dd.MM.yyyy", "yyyy.MM.dd", "MM/dd/yy")
    written = F.lit("Smarch 1, 1995")
    for n, form in enumerate(formats):
        written = F.when(F.col("o_orderkey") % 7 == n, F.date_format("o_orderdate", form)).otherwise(written)
    return v.table("orders").select("o_orderkey", written.alias("text")).select(
        "o_orderkey", parse_date("text").alias("value")
    )


@_query
def parse_datetime_(v: Views) -> DataFrame:
    cleaned = clean_columns(v.raw_timesheet, ["punch_in_datetime"])
    parsed = cleaned.select(
        F.col("id").alias("event_id"), parse_datetime("punch_in_datetime").alias("value")
    )
    return parsed.select("event_id", _moment("value"))


@_query
def parse_number(v: Views) -> DataFrame:
    field = case(
        "n_regionkey",
        {0: "NaN", 1: "1.0d", 2: F.concat(F.lit(" "), F.col("c_acctbal").cast("string"), F.lit("5 "))},
        F.col("c_acctbal").cast("string"),
    )
    rows = v.table("customer").join(v.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return clean_columns(rows.withColumn("text", field), ["text"]).select(
        "c_custkey",
        parse_double("text").alias("as_double"),
        parse_decimal("text", 5, 2).cast("double").alias("as_decimal"),
        overflows("text", 5, 2).alias("overflow"),
    )


@_query
def parse_bool_(v: Views) -> DataFrame:
    field = case(
        "c_nationkey", {0: "1", 1: " TRUE ", 2: "Yes\n", 3: "0", 4: "no", 5: "y", 6: ""}
    )
    written = v.table("customer").withColumn("text", field)
    return written.select("c_custkey", strip("text").alias("text")).select(
        "c_custkey", parse_bool("text").alias("value")
    )


@_query
def nan_to_null(v: Views) -> DataFrame:
    value = F.col("value")
    dirty = v.table("events").select(
        "event_id",
        case(
            "event_type",
            {"click": float("nan"), "view": float("inf"), "error": -float("inf")},
            value,
        ).alias("value"),
    )
    return finite_columns(dirty)


# Conforming


@_query
def attendance_flags_(v: Views) -> DataFrame:
    flags = attendance_flags(
        F.col("punch_in"), F.col("punch_out"), F.col("planned_start"), F.col("planned_end"), 5
    )
    return v.shifts.select("event_id", *(flag.alias(name) for name, flag in flags.items()))


@_query
def dim_organization(v: Views) -> DataFrame:
    return dimensions.organizations(v.raw_employee).select("code", "name")


def _keys(v: Views) -> numbering.Keys:
    """Ids of all business keys, as in a warehouse that is new."""
    found = (
        numbering.new_ids(v.spark.createDataFrame([], TABLES["silver", table]), rows)
        for table, rows in numbering.business_keys(v.raw_employee).items()
    )
    return numbering.Keys(*found)


@_query
def dense_keys(v: Views) -> DataFrame:
    """Ids of the business keys of two loads: the second, all employees, goes on where the first ends."""
    first = numbering.business_keys(v.raw_employee.filter("id < 100"))
    second = numbering.business_keys(v.raw_employee)
    parts = []
    for table, rows in second.items():
        known = numbering.new_ids(v.spark.createDataFrame([], TABLES["silver", table]), first[table])
        known = known.unionByName(numbering.new_ids(known, rows))
        keys = F.concat_ws("|", *rows.columns)
        parts.append(known.select(F.lit(table).alias("table_name"), keys.alias("business_key"), "id"))
    return reduce(DataFrame.unionByName, parts)


@_query
def dim_department(v: Views) -> DataFrame:
    """Departments with the organization their key leads to."""
    keys = _keys(v)
    organization = dimensions.organizations(v.raw_employee, ids=keys.organization).select(
        F.col("id").alias("organization_id"), F.col("code").alias("organization_code")
    )
    departments = dimensions.departments(
        v.raw_employee, ids=keys.department, organization_ids=keys.organization
    )
    return departments.join(organization, "organization_id", "left").select(
        "organization_code", "code", "name"
    )


@_query
def silver_employee(v: Views) -> DataFrame:
    """Conformed employees with the dimension names their keys lead to."""
    keys = _keys(v)
    employee = conform.conform_employees(v.raw_employee, RUN_AT, keys=keys)
    organization = dimensions.organizations(v.raw_employee, ids=keys.organization).select(
        F.col("id").alias("organization_id"), F.col("name").alias("organization_name")
    )
    department = dimensions.departments(
        v.raw_employee, ids=keys.department, organization_ids=keys.organization
    ).select(
        F.col("id").alias("department_id"), F.col("name").alias("department_name")
    )
    return (
        employee.join(organization, "organization_id", "left")
        .join(department, "department_id", "left")
        .select(
            "client_employee_id", "first_name", "middle_name", "last_name", "job_title",
            "job_start_date", "hire_date", "term_date", "is_per_deim", "active_status",
            F.col("scheduled_weekly_hour").cast("double").alias("scheduled_weekly_hour"),
            "years_of_experience", "organization_name", "department_name", "manager_employee_id",
        )
    )


@_query
def resolve_manager(v: Views) -> DataFrame:
    return conform.resolve_managers(v.employee).select("client_employee_id", "manager_employee_id")


@_query
def silver_timesheet(v: Views) -> DataFrame:
    employee = conform.conform_employees(v.raw_employee, RUN_AT)
    shifts = conform.conform_timesheets(v.raw_timesheet, employee, RUN_AT, CONFIG.grace_minutes)
    return shifts.select(
        "id", "client_employee_id", "pay_code", "punch_apply_date", "punch_in_comment",
        "punch_out_comment", _moment("punch_in_datetime"), _moment("punch_out_datetime"),
        _moment("scheduled_start_datetime"), _moment("scheduled_end_datetime"),
        F.col("hours_worked").cast("double").alias("hours_worked"), "is_late_arrival",
        "is_early_departure", "is_overtime", "is_unscheduled", "source_file",
    )


@_query
def rejected_timesheet(v: Views) -> DataFrame:
    employee = conform.conform_employees(v.raw_employee, RUN_AT)
    return conform.rejected_timesheets(v.raw_timesheet, employee, RUN_AT).select(
        "id", "client_employee_id", "hours_worked", "source_file", "reason"
    )


@_query
def contract_violations(v: Views) -> DataFrame:
    """Rules of the typed tables; shifts still hold their orphans, managers are unresolved."""
    tables = {
        "organization": v.organization,
        "department": v.department,
        "employee": v.employee,
        "timesheet": v.timesheet,
    }
    raw = {"employee": v.raw_employee, "timesheet": v.raw_timesheet}
    return contracts.table_violations(tables, CONTRACTS, raw)


@_query
def contract_breaches(v: Views) -> DataFrame:
    """Every kind of rule on customers, who break each of them."""
    rule = contracts.Contract(
        not_null=("c_custkey", "name"),
        unique=(("c_custkey",), ("c_nationkey", "c_mktsegment")),
        references=(("c_nationkey", "nation", "n_nationkey"),),
        max_length=(("c_mktsegment", 8), ("name", 255)),
        fixed_point=(("balance", 5, 2),),
    )
    customers = v.table("customer").select(
        "c_custkey",
        "c_nationkey",
        "c_mktsegment",
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("name"),
        F.col("c_acctbal").cast("string").alias("balance"),
    )
    parents = {"nation": v.table("nation").filter("n_regionkey < 3")}
    return contracts.contract_violations("customer", customers, rule, parents, customers)


@_query
def duplicate_line_numbers(v: Views) -> DataFrame:
    """The unique rule on a table that breaks it."""
    rule = contracts.Contract(unique=(("l_orderkey", "l_linenumber"),), not_null=("l_orderkey",))
    return contracts.contract_violations("lineitem", v.table("lineitem"), rule)


# Quality


def _split(v: Views) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected typed shifts."""
    ids = v.employee.select("client_employee_id")
    return (
        v.timesheet.join(ids, "client_employee_id", "left_semi"),
        v.timesheet.join(ids, "client_employee_id", "left_anti"),
    )


@_query
def quality_checks(v: Views) -> DataFrame:
    accepted, rejected = _split(v)
    return quality.quality_checks(v.employee, accepted, v.timesheet, rejected, CONFIG)


@_query
def orphan_rate(v: Views) -> DataFrame:
    return quality.orphan_check(v.timesheet, _split(v)[1], CONFIG.orphan_rate_max_pct)


# Reads


def _employee_row(df: DataFrame) -> DataFrame:
    return df.select(
        "id", "client_employee_id", "first_name", "hire_date", "term_date", "active_status",
        "department_id", "years_of_experience",
    )


def _timesheet_row(df: DataFrame) -> DataFrame:
    return df.select("id", "client_employee_id", "pay_code", "punch_apply_date", "is_late_arrival")


@_query
def employees_list(v: Views) -> DataFrame:
    return _employee_row(reads.list_employees(v.employee).items)


@_query
def employees_of_department(v: Views) -> DataFrame:
    return _employee_row(reads.list_employees(v.employee, False, DEPARTMENT_ID).items)


@_query
def employee_by_id(v: Views) -> DataFrame:
    return _employee_row(reads.by_id(v.employee, EMPLOYEE_ID))


@_query
def timesheet_by_id(v: Views) -> DataFrame:
    return _timesheet_row(reads.by_id(v.timesheet, TIMESHEET_ID))


@_query
def timesheets_filter(v: Views) -> DataFrame:
    return _timesheet_row(reads.list_timesheets(v.timesheet, None, *PERIOD).items)


@_query
def timesheets_of_employee(v: Views) -> DataFrame:
    listing = reads.list_employee_timesheets(v.employee, v.timesheet, str(EMPLOYEE_ID), PERIOD[0])
    return _timesheet_row(listing.items)


@_query
def timesheet_pages(v: Views) -> DataFrame:
    """All shifts of a period, page by page: each row with its page and place."""
    shifts = reads.list_timesheets(v.timesheet, None, *PERIOD).items
    return reads.timesheet_pages(shifts, 500).rows.select("page", "place", "shift.id")


@_query
def active_in_months(v: Views) -> DataFrame:
    """Who was active in which month of the calendar, and on which days of it."""
    months = v.spark.range(120).select(
        F.add_months(F.lit("1992-01-01").cast("date"), F.col("id").cast("int")).alias("begin")
    )
    periods = months.select("begin", F.last_day("begin").alias("end"))
    return intervals.active_in_periods(v.employee, periods, AS_OF)


# Changes


def _inserts(v: Views) -> changes.Applied:
    """All customers, then all suppliers, whose ids repeat customer ids."""
    customers = v.table("customer").select(
        F.col("c_custkey").alias("change_seq"),
        F.col("c_custkey").cast("string").alias("client_employee_id"),
        F.col("c_name").alias("first_name"),
        F.lit(None).cast("date").alias("hire_date"),
    )
    suppliers = v.table("supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("change_seq"),
        F.col("s_suppkey").cast("string").alias("client_employee_id"),
        F.col("s_name").alias("first_name"),
        F.lit(AS_OF).cast("date").alias("hire_date"),
    )
    return changes.apply_employee_inserts(v.employee, customers.unionByName(suppliers), RUN_AT)


@_query
def apply_employee_inserts(v: Views) -> DataFrame:
    return _inserts(v).employee.select("client_employee_id", "first_name", "hire_date", "active_status")


@_query
def rejected_employee_inserts(v: Views) -> DataFrame:
    return _inserts(v).rejected


def _updates(v: Views) -> changes.Applied:
    """One change per order of a customer: later ones override, cities may be unset."""
    sets = {
        "1-URGENT": F.array(F.lit("job_title")),
        "2-HIGH": F.array(F.lit("job_title"), F.lit("city")),
        "3-MEDIUM": F.array(F.lit("city")),
        "4-NOT SPECIFIED": F.array(F.lit("term_date")),
    }
    batch = v.table("orders").select(
        F.col("o_orderkey").alias("change_seq"),
        F.col("o_custkey").alias("id"),
        case("o_orderpriority", sets, F.array().cast("array<string>")).alias("set_fields"),
        F.col("o_orderpriority").alias("job_title"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("city"),
        F.col("o_orderdate").cast("date").alias("term_date"),
    )
    return changes.apply_employee_updates(v.employee, batch, RUN_AT)


@_query
def apply_employee_updates(v: Views) -> DataFrame:
    return _updates(v).employee.select(
        "client_employee_id", "first_name", "job_title", "city", "hire_date", "term_date"
    )


@_query
def rejected_employee_updates(v: Views) -> DataFrame:
    return _updates(v).rejected


@_query
def apply_employee_terminations(v: Views) -> DataFrame:
    batch = v.table("supplier").select(
        F.col("s_suppkey").alias("change_seq"), F.col("s_suppkey").alias("id")
    )
    applied = changes.apply_employee_terminations(v.employee, batch, AS_OF, RUN_AT)
    return applied.employee.select("client_employee_id", "hire_date", "term_date", "active_status")


def _checked_updates(v: Views) -> DataFrame:
    """One change per order, in other types than the table's; many do not fit."""
    sets = {
        "1-URGENT": F.array(F.lit("scheduled_weekly_hour")),
        "2-HIGH": F.array(F.lit("department_id")),
        "3-MEDIUM": F.array(F.lit("active_status")),
    }
    status = F.when(F.col("o_orderstatus") == "O", "true").when(F.col("o_orderstatus") == "P", "perhaps")
    return v.table("orders").select(
        F.col("o_orderkey").alias("change_seq"),
        F.col("o_custkey").alias("id"),
        case("o_orderpriority", sets, F.array(F.lit("zip"))).alias("set_fields"),
        (F.col("o_totalprice") / 100).alias("scheduled_weekly_hour"),
        (F.col("o_orderkey") % 40).cast("int").alias("department_id"),
        status.alias("active_status"),
        F.col("o_orderkey").cast("int").alias("zip"),
    )


@_query
def refused_employee_changes(v: Views) -> DataFrame:
    """Changes whose values do not fit, with their reasons, and those of unknown employees."""
    parents = {"department": v.department}
    return changes.apply_employee_updates(v.employee, _checked_updates(v), RUN_AT, parents).rejected


@_query
def stored_employee_changes(v: Views) -> DataFrame:
    """The same batch stored: what the table then holds of the columns it sets."""
    warehouse = Warehouse(v.spark, shared_folder(v.spark, "changes"))
    warehouse.write("silver", "employee", v.employee)
    warehouse.write("silver", "department", v.department)
    for _ in range(2):  # The same batch again changes nothing.
        store_changes(warehouse, "update", _checked_updates(v), CONFIG)
    return warehouse.read("silver", "employee").select(
        "client_employee_id",
        "zip",
        "department_id",
        "active_status",
        (F.col("scheduled_weekly_hour") * 100).cast("long").alias("weekly_hundredths"),
    )


# Files and stored tables


@_query
def malformed_lines(v: Views) -> DataFrame:
    """Rows, and lines that are none by reason: number and sum of the ids they begin with."""
    key = F.col("o_orderkey")
    line = (
        F.when(key % 7 == 0, F.concat(key, F.lit("|A|8|more")))
        .when(key % 7 == 1, F.concat(key, F.lit('|A|"open')))
        .when(key % 7 == 2, F.concat(key, F.lit("|A")))
        .when(key % 7 == 3, F.concat(key, F.lit('|"two\n \nbreaks|'), key, F.lit('\n|""in it"|8')))
        .when(key % 7 == 4, F.concat(key, F.lit("|any\uffff\x01|8")))
        .otherwise(F.concat(key, F.lit('|"a|b"|8')))
    )
    path = shared_folder(v.spark, "malformed-files")
    header = "client_employee_id|pay_code|hours_worked"
    lines = v.table("orders").select(F.explode(F.split(line, "\n")).alias(header))
    whole = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.write.options(sep="\x02", quote="", header=True, **whole).csv(path)
    landed = landing.split_timesheets(v.spark, path, RUN_AT, pattern="part")
    first = F.split_part("text", F.lit("|"), F.lit(1))
    kinds = landed.rows.select(
        F.when(F.col("hours_worked").isNull(), "SHORT")
        .when(F.col("pay_code") == F.concat(F.lit("two\n \nbreaks|"), "client_employee_id", F.lit('\n|"in it')), "BREAKS")
        .when(F.col("pay_code") == "any\uffff\x01", "ANY_CHARACTER")
        .when(F.col("pay_code") == "a|b", "WHOLE")
        .alias("kind"),
        F.col("client_employee_id").alias("number"),
    ).unionByName(landed.malformed.select(F.col("reason").alias("kind"), first.alias("number")))
    return kinds.groupBy("kind").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("number").cast("long")).alias("checksum")
    )


@_query
def land_employees(v: Views) -> DataFrame:
    path = shared_folder(v.spark, "employee-files")
    v.write_employee_file(path)
    landed = landing.land_employees(v.spark, path, RUN_AT, pattern="part")
    return landed.select(
        "client_employee_id", "middle_name", "last_name", "preferred_name", "job_title",
        "organization_name", "department_name", "hire_date", "term_date", "scheduled_weekly_hour",
        "years_of_experience", "active_status",
    )


@_query
def land_timesheets(v: Views) -> DataFrame:
    """Files of two layouts below one folder, found with a pattern of the other case."""
    path = shared_folder(v.spark, "timesheet-files")
    v.write_timesheet_files(path)
    landed = landing.land_timesheets(
        v.spark, path, RUN_AT, pattern="PART", recursive=True, ignore_case=True
    )
    return landed.select(
        "client_employee_id", "pay_code", "hours_worked", "punch_in_comment", "punch_out_comment",
        parse_date("punch_apply_date").alias("punch_day"),
        F.col("scheduled_start_datetime").isNull().alias("no_plan"),
        F.col("source_file").isNull().alias("no_file"),
    )


@_query
def rows_per_source_file(v: Views) -> DataFrame:
    return landing.rows_per_file(v.raw_timesheet)


@_query
def warehouse_roundtrip(v: Views) -> DataFrame:
    """Gold tables written, exported and read back: rows and a checksum per table."""
    warehouse = Warehouse(v.spark, shared_folder(v.spark, "roundtrip"))
    for table in GOLD_TABLES:
        warehouse.write("gold", table, _gold(v, table))
    target = shared_folder(v.spark, "export")
    export.export_gold(warehouse, target)
    measures = {
        "kpi_headcount": F.col("active_count") * 100,
        "kpi_turnover": to_hundredths(F.col("turnover_rate_pct")),
        "kpi_tenure_by_department": to_hundredths(F.col("avg_tenure_years")),
        "kpi_attendance": to_hundredths(F.col("late_arrival_rate_pct")),
        "kpi_rolling_hours": to_hundredths(F.col("rolling_avg_7d")),
        "kpi_early_attrition": to_hundredths(F.col("early_attrition_rate_pct")),
    }
    parts = (
        v.spark.read.parquet(f"{target}/warehouse/{table}.parquet").agg(
            F.lit(table).alias("table_name"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(measures[table]).alias("checksum"),
        )
        for table in GOLD_TABLES
    )
    return reduce(DataFrame.unionByName, parts)


@_query
def refresh_row_counts(v: Views) -> DataFrame:
    """The job from files to the export: rows of every table it stores, and what some of them sum up to."""
    source, target = shared_folder(v.spark, "refresh-files"), shared_folder(v.spark, "refresh-export")
    root = shared_folder(v.spark, "refresh")
    v.write_source_files(source)
    refresh.refresh(v.spark, source, root, CONFIG, export_path=target)
    warehouse = Warehouse(v.spark, root)
    sums = {
        "silver.employee": F.sum(F.date_diff("hire_date", F.lit("1970-01-01"))),
        "silver.timesheet": F.sum(F.col("hours_worked") * 100),
        "gold.kpi_attendance": F.sum(F.col("total_shifts") * 1000 + F.col("late_arrival_count")),
        "gold.kpi_rolling_hours": F.sum(F.col("hours_worked") * 100),
    }
    stored = {
        f"{layer}.{table}": warehouse.read(layer, table)
        for layer, table in TABLES
        if table not in ("refused_change", "change_batch", "employee_change")
    }
    exported = {f"export.{t}": v.spark.read.parquet(f"{target}/warehouse/{t}.parquet") for t in GOLD_TABLES}
    parts = (
        df.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"),
            sums.get(name.replace("export.", "gold."), F.lit(None)).cast("long").alias("checksum"),
        )
        for name, df in {**stored, **exported}.items()
    )
    return reduce(DataFrame.unionByName, parts)
