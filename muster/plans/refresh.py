"""The full refresh: raw files to bronze, silver, checks, gold and export.

Every stage reads the Parquet tables the stage before has written. These cut the
lineage: when executors are lost, at most the running stage is recomputed.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession

from muster.config import Config
from muster.operators.conform import (
    OVERFLOW,
    conform_employees,
    conform_split,
    rejected_split,
    split_timesheets,
)
from muster.operators.contracts import table_violations
from muster.operators.dimensions import departments, organizations
from muster.operators.numbering import Keys, assign_ids, business_keys
from muster.operators.quality import quality_checks
from muster.plans.gold import gold_table
from muster.schemas import BRONZE_CONTRACTS, CONTRACTS, GOLD_CONTRACTS, GOLD_TABLES
from muster.sources import landing as files
from muster.sources.export import export_gold, write_report
from muster.session import scratch
from muster.sources.tables import Warehouse, write_counted

log = logging.getLogger(__name__)


class ContractError(ValueError):
    """Tables break their declared rules."""


class MalformedError(ValueError):
    """Files hold lines that are no records, and the run was told to stop on that."""


class LostValuesError(ValueError):
    """More values of a column could not be parsed than the run was told to bear."""


class QualityError(ValueError):
    """A quality check failed and the run was told to stop on that."""


@dataclass(frozen=True)
class Summary:
    """What each stage reported."""

    extract: dict[str, int] = field(default_factory=dict)
    transform: dict[str, int] = field(default_factory=dict)
    quality: list[dict] = field(default_factory=list)
    postprocess: dict[str, int] = field(default_factory=dict)
    export: dict[str, int] | None = None


def extract(warehouse: Warehouse, source_path: str, config: Config, **landing) -> dict[str, int]:
    """Land both kinds of files, and store the lines that are no records."""
    spark = warehouse.spark
    employees = files.split_employees(spark, source_path, config.run_at, **landing)
    shifts = files.split_timesheets(spark, source_path, config.run_at, **landing)
    with warehouse.transaction() as inner:
        counts = {
            "employees_extracted": inner.write("bronze", "raw_employee", employees.rows),
            "timesheets_extracted": inner.write("bronze", "raw_timesheet", shifts.rows),
            "lines_malformed": inner.write(
                "bronze", "malformed_line", employees.malformed.unionByName(shifts.malformed)
            ),
        }
    if counts["lines_malformed"]:
        found = f"{counts['lines_malformed']} malformed lines, kept in bronze.malformed_line"
        if config.fail_on_malformed:
            raise MalformedError(found)
        log.warning(found)
    return counts


def transform(warehouse: Warehouse, config: Config) -> tuple[dict[str, int], dict[str, dict[str, int]]]:
    """Build the silver tables and the dead letters from bronze.

    The shifts meet the employees once; the split is stored, and both of its sides
    are read from there. Returns the row counts, and per table the numbers that
    were too large for their columns.
    """
    raw_employee = warehouse.read("bronze", "raw_employee")
    named = business_keys(raw_employee)
    assign_ids(partial(warehouse.read, "silver"), partial(warehouse.append, "silver"), named)
    keys = Keys(*(warehouse.read("silver", table) for table in named))
    warehouse.write("silver", "organization", organizations(raw_employee, ids=keys.organization))
    warehouse.write(
        "silver",
        "department",
        departments(raw_employee, ids=keys.department, organization_ids=keys.organization),
    )
    losses = {"employee": Observation(), "timesheet": Observation()}
    employees = warehouse.write(
        "silver",
        "employee",
        conform_employees(raw_employee, config.run_at, losses["employee"], keys=keys),
    )
    employee = warehouse.read("silver", "employee")
    ids = _kept(warehouse, "employee_id", employee.select("client_employee_id").distinct())
    raw_timesheet = warehouse.read("bronze", "raw_timesheet")
    split = _kept(warehouse, "split_timesheet", split_timesheets(raw_timesheet, ids))
    timesheets = warehouse.write(
        "silver",
        "timesheet",
        conform_split(split, config.run_at, config.grace_minutes, losses["timesheet"]),
    )
    rejected = warehouse.write("bronze", "rejected_timesheet", rejected_split(split, config.run_at))
    overflowed = {}
    for table, written in (("employee", employees), ("timesheet", timesheets)):
        # Without rows the engine may drop the observed step, and nothing was lost.
        counts = losses[table].get if written else {}
        overflowed[table] = {
            c.removesuffix(OVERFLOW): n for c, n in counts.items() if c.endswith(OVERFLOW)
        }
        _report_lost(table, {c: n for c, n in counts.items() if n and not c.endswith(OVERFLOW)}, config)
    return {
        "employees_transformed": employees,
        "timesheets_transformed": timesheets,
        "timesheets_rejected": rejected,
    }, overflowed


def _kept(warehouse: Warehouse, name: str, df: DataFrame) -> DataFrame:
    """``df`` stored among the staged tables until the next run."""
    path = warehouse.path("staging", name)
    write_counted(df, path)
    return warehouse.spark.read.schema(df.schema).parquet(path)


def _report_lost(table: str, lost: Mapping[str, int], config: Config) -> None:
    for column, n in lost.items():
        log.warning("%s.%s: %d values could not be parsed and are null", table, column, n)
    limit = config.max_lost_values
    over = [f"{table}.{c}: {n}" for c, n in lost.items() if limit is not None and n > limit]
    if over:
        raise LostValuesError(f"values that could not be parsed: {', '.join(over)}")


def silver_violations(
    warehouse: Warehouse, overflowed: Mapping[str, Mapping[str, int]] | None = None
) -> DataFrame:
    """Contract rows of all silver tables and of the dead letters.

    ``overflowed`` comes from ``transform``. The split has just joined the shifts to
    their employees, so that reference is not checked again.
    """
    contracts = CONTRACTS | {"timesheet": replace(CONTRACTS["timesheet"], references=())} | BRONZE_CONTRACTS
    tables = {table: warehouse.read("silver", table) for table in CONTRACTS}
    tables |= {table: warehouse.read("bronze", table) for table in BRONZE_CONTRACTS}
    counted = {table: (overflowed or {}).get(table, {}) for table in CONTRACTS}
    return table_violations(tables, contracts, overflowed=counted)


def gold_violations(warehouse: Warehouse) -> DataFrame:
    """Contract rows of all gold tables."""
    return table_violations({table: warehouse.read("gold", table) for table in GOLD_CONTRACTS}, GOLD_CONTRACTS)


def enforce(violations: DataFrame) -> None:
    """Stop the run when a table breaks its contract."""
    broken = violations.filter("violations > 0").collect()
    if broken:
        raise ContractError(
            "; ".join(f"{r.table_name}.{r.column_name}: {r.rule} x {r.violations}" for r in broken)
        )


def quality(warehouse: Warehouse, config: Config) -> list[dict]:
    """Run the checks, store the report, and return its rows."""
    checks = quality_checks(
        warehouse.read("silver", "employee"),
        warehouse.read("silver", "timesheet"),
        warehouse.read("bronze", "raw_timesheet"),
        warehouse.read("bronze", "rejected_timesheet"),
        config,
    )
    rows = checks.collect()  # one row per check
    report = warehouse.spark.createDataFrame(rows, checks.schema)
    write_report(report, warehouse.path("logs", "quality"), config.run_at)
    failed = [r.check for r in rows if r.status == "FAIL"]
    if failed and config.fail_on_quality:
        raise QualityError(", ".join(failed))
    return [r.asDict() for r in rows]


def postprocess(warehouse: Warehouse, config: Config) -> dict[str, int]:
    """Write the gold tables."""
    silver = [warehouse.read("silver", table) for table in ("employee", "department", "timesheet")]
    return {
        table: warehouse.write("gold", table, gold_table(table, *silver, config)) for table in GOLD_TABLES
    }


def refresh(
    spark: SparkSession,
    source_path: str,
    warehouse_path: str,
    config: Config | None = None,
    export_path: str | None = None,
    export_storage: Mapping[str, str] | None = None,
    **landing,
) -> Summary:
    """Run all stages in order; ``landing`` holds options of ``land_split``.

    Bronze tables are published when the files are landed. Silver and gold tables are published
    together at the end, if they keep their contracts; until then readers see the old ones. Folders that
    the last two snapshots do not have are deleted, and the run's scratch tables go.
    """
    config = config or Config()
    warehouse = Warehouse(spark, warehouse_path)
    with scratch(spark):
        extracted = extract(warehouse, source_path, config, **landing)
        with warehouse.transaction() as run:
            transformed, overflowed = transform(run, config)
            if config.fail_on_contract:
                enforce(silver_violations(run, overflowed))
            checks = quality(run, config)
            loaded = postprocess(run, config)
            if config.fail_on_contract:
                enforce(gold_violations(run))
    warehouse.expire()
    exported = None
    if export_path is None:
        log.warning("no export path given, export skipped")
    else:
        exported = export_gold(warehouse, export_path, export_storage)
    return Summary(extracted, transformed, checks, loaded, exported)
