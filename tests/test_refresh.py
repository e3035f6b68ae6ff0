import json
import re
from dataclasses import replace
from pathlib import Path

import pytest
from helpers import NOW, day, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from muster.config import Config
from muster.operators import conform
from muster.operators.reads import list_timesheets
from muster.plans import feeds
from muster.plans.refresh import (
    ContractError,
    LostValuesError,
    MalformedError,
    QualityError,
    refresh,
)
from muster.schemas import EMPLOYEE_FILE_COLUMNS, GOLD_TABLES, TABLES, TIMESHEET_FILE_COLUMNS
from muster.sources.export import export_gold
from muster.sources.landing import rows_per_file
from muster.sources.tables import Warehouse

CONFIG = Config(as_of=day("2024-03-31"), run_at=NOW)


def line(columns, **fields):
    return "|".join(fields.get(c, "") for c in columns)


def employee(number, **fields):
    base = {
        "client_employee_id": f'"{number:05}"',
        "first_name": f"F{number}",
        "last_name": "L",
        "organization_id": "Care",
        "organization_name": "Care",
        "department_id": "10",
        "department_name": '"10-Ward, A"',
        "hire_date": '"2024-01-01"',
        "scheduled_weekly_hour": '"40"',
        "active_status": '"1"',
    }
    return line(EMPLOYEE_FILE_COLUMNS, **{**base, **fields})


def shift(number, on, columns=TIMESHEET_FILE_COLUMNS, **fields):
    base = {
        "client_employee_id": number,
        "hours_worked": "8.00",
        "punch_apply_date": on,
        "punch_in_datetime": f"{on} 09:00:00.000",
        "punch_out_datetime": f"{on} 17:30:00.000",
        "scheduled_start_datetime": f"{on} 09:00:00.000",
        "scheduled_end_datetime": f"{on} 17:00:00.000",
    }
    return line(columns, **{**base, **fields})


def write(path, columns, lines):
    Path(path).write_text("\n".join(["|".join(columns), *lines, ""]))


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    staff = [
        employee(1, manager_employee_id="00002"),
        employee(2, term_date="2024-02-10", active_status="0"),
        employee(3, department_id="", hire_date="2024-03-01"),
    ]
    write(folder / "employee_1.csv", EMPLOYEE_FILE_COLUMNS, staff)
    write(folder / "timesheet_1.csv", TIMESHEET_FILE_COLUMNS, [shift("00001", f"2024-01-{n:02}") for n in range(1, 11)])
    back = TIMESHEET_FILE_COLUMNS[::-1]
    write(folder / "timesheet_2.csv", back, [shift("00002", "2024-02-01", back), shift("77777", "2024-02-01", back)])
    return folder


EXPECTED_GOLD = {
    "kpi_headcount": 91,
    "kpi_turnover": 1,
    "kpi_tenure_by_department": 2,
    "kpi_attendance": 2,
    "kpi_rolling_hours": 11,
    "kpi_early_attrition": 2,
}


def test_refresh_twice(spark, source, tmp_path):
    target = str(tmp_path / "export")
    for _ in range(2):
        summary = refresh(spark, str(source), str(tmp_path / "wh"), CONFIG, export_path=target)
        assert summary.extract == {"employees_extracted": 3, "timesheets_extracted": 12, "lines_malformed": 0}
        assert summary.transform == {
            "employees_transformed": 3,
            "timesheets_transformed": 11,
            "timesheets_rejected": 1,
        }
        assert {c["check"] for c in summary.quality if c["status"] == "FAIL"} == set()
        assert summary.postprocess == EXPECTED_GOLD
        assert summary.export == {f"gold.{t}": n for t, n in EXPECTED_GOLD.items()}
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    for (layer, name), schema in TABLES.items():
        stored = warehouse.read(layer, name).drop("punch_month")
        assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in schema]
        if name in ("refused_change", "malformed_line", "change_batch", "employee_change"):
            assert stored.isEmpty()
            continue
        exact = warehouse.spark.read.parquet(warehouse.path(layer, name))
        assert exact.count() == stored.count() > 0
    assert rows(rows_per_file(warehouse.read("bronze", "raw_timesheet"))) == [("timesheet_1.csv", 10), ("timesheet_2.csv", 2)]
    assert warehouse.read("bronze", "raw_employee").filter("source_file is null").isEmpty()
    for table, n in EXPECTED_GOLD.items():
        assert spark.read.parquet(f"{target}/warehouse/{table}.parquet").count() == n
    assert rows(feeds.chart_attendance_feed(warehouse.read("gold", "kpi_attendance"))) == [
        ("00001", 0, 0, 10),
        ("00002", 0, 0, 1),
    ]


def test_settings_document():
    settings = {"etl": {"grace_time_minutes": 9, "orphan_rate_max_pct": 50, "batch_size": 1}, "logging": {}}
    config = Config.from_settings(settings, as_of=CONFIG.as_of)
    assert (config.grace_minutes, config.orphan_rate_max_pct, config.flag_max_overlap) == (9, 50, 2)
    assert config.as_of == CONFIG.as_of


def test_report_document(spark, source, tmp_path):
    refresh(spark, str(source), str(tmp_path / "wh"), CONFIG)
    [file] = (tmp_path / "wh/logs/quality").glob("quality_report_20260102_030405/*.json")
    report = json.loads(file.read_text())
    assert report["run_at"] == NOW.isoformat()
    assert len(report["checks"]) == 11
    assert set(report["checks"][0]) == {"check", "status", "details"}


def test_months_are_pruned(spark, settings, source, tmp_path):
    settings(maxMetadataStringLength="10000")
    refresh(spark, str(source), str(tmp_path / "wh"), CONFIG)
    stored = Warehouse(spark, str(tmp_path / "wh")).read("silver", "timesheet")
    february = list_timesheets(stored, None, day("2024-02-01"), day("2024-02-29")).items
    assert rows(february, "client_employee_id") == [("00002",)]
    plan = february._jdf.queryExecution().executedPlan().toString()
    [filters] = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\]", plan)
    assert "punch_month" in filters[0] and "GreaterThanOrEqual(punch_apply_date,2024-02-01)" in filters[1]


def test_broken_contract_stops_the_run(spark, source, tmp_path):
    write(source / "employee_2.csv", EMPLOYEE_FILE_COLUMNS, [employee(1), employee(9, scheduled_weekly_hour="1000")])
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    warehouse.write("silver", "employee", warehouse.read("silver", "employee"))
    with pytest.raises(ContractError) as error:
        refresh(spark, str(source), str(tmp_path / "wh"), CONFIG)
    # Nothing took the place of the stored tables.
    assert warehouse.read("silver", "employee").isEmpty()
    assert warehouse.read("silver", "timesheet").isEmpty()
    assert "client_employee_id: unique x 1" in str(error.value)
    assert "scheduled_weekly_hour: fixed_point_5_2 x 1" in str(error.value)
    lenient = Config(as_of=CONFIG.as_of, run_at=NOW, fail_on_contract=False)
    assert refresh(spark, str(source), str(tmp_path / "wh"), lenient).extract["employees_extracted"] == 5


def test_failed_checks_do_not_stop_the_run_unless_told(spark, tmp_path):
    empty = tmp_path / "nothing"
    empty.mkdir()
    summary = refresh(spark, str(empty), str(tmp_path / "wh"), CONFIG)
    assert [c["check"] for c in summary.quality if c["status"] == "FAIL"] == ["orphan_rate_check"]
    assert set(summary.postprocess.values()) == {0} and summary.export is None
    strict = Config(as_of=CONFIG.as_of, run_at=NOW, fail_on_quality=True)
    with pytest.raises(QualityError, match="orphan_rate_check"):
        refresh(spark, str(empty), str(tmp_path / "wh"), strict)


def test_refresh_without_shifts(spark, source, tmp_path):
    for file in source.glob("timesheet*"):
        file.unlink()
    summary = refresh(spark, str(source), str(tmp_path / "wh"), CONFIG)
    assert summary.transform["employees_transformed"] == 3
    assert summary.transform["timesheets_transformed"] == 0
    assert summary.postprocess["kpi_attendance"] == 0 and summary.postprocess["kpi_headcount"] == 91


def test_refresh_with_orphans_only(spark, source, tmp_path):
    for file in source.glob("timesheet*"):
        file.unlink()
    write(source / "timesheet.csv", TIMESHEET_FILE_COLUMNS, [shift("4", "2024-01-01"), shift("", "2024-01-01")])
    summary = refresh(spark, str(source), str(tmp_path / "wh"), CONFIG)
    assert summary.transform["timesheets_transformed"] == 0
    assert summary.transform["timesheets_rejected"] == 2
    assert [c["check"] for c in summary.quality if c["status"] == "FAIL"] == ["orphan_rate_check"]


def test_failed_export_counts_zero_and_goes_on(spark, source, tmp_path):
    refresh(spark, str(source), str(tmp_path / "wh"), CONFIG)
    target = tmp_path / "out"
    (target / "warehouse").mkdir(parents=True)
    blocked = target / "warehouse" / "kpi_turnover.parquet"
    blocked.mkdir()
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    # A file that is no Parquet makes the read of this table fail.
    for part in (tmp_path / "wh/gold/kpi_turnover").glob("*/*.parquet"):
        part.write_text("broken")
    for crc in (tmp_path / "wh/gold/kpi_turnover").glob("*/.*.crc"):
        crc.unlink()
    counts = export_gold(warehouse, str(target))
    assert counts["gold.kpi_turnover"] == 0
    assert {t for t in GOLD_TABLES if counts[f"gold.{t}"] == 0} == {"kpi_turnover"}


def test_replace_table_by_rows_of_itself(spark, source, tmp_path):
    refresh(spark, str(source), str(tmp_path / "wh"), CONFIG)
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    staff = warehouse.read("silver", "employee").filter("active_status")
    assert warehouse.write("silver", "employee", staff) == 2
    assert warehouse.read("silver", "employee").count() == 2


def test_other_types_are_not_stored(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    wrong = warehouse.read("silver", "organization").withColumn("id", F.lit("x"))
    with pytest.raises(ValueError, match="silver.organization: id is string, not bigint"):
        warehouse.write("silver", "organization", wrong)


def test_malformed_lines_stop_the_run_unless_told(spark, source, tmp_path):
    with open(source / "timesheet_1.csv", "a") as file:
        file.write("x|" * 20 + "\n")
    with pytest.raises(MalformedError, match="1 malformed"):
        refresh(spark, str(source), str(tmp_path / "wh"), CONFIG)
    lenient = replace(CONFIG, fail_on_malformed=False)
    assert refresh(spark, str(source), str(tmp_path / "wh"), lenient).extract["lines_malformed"] == 1
    kept = Warehouse(spark, str(tmp_path / "wh")).read("bronze", "malformed_line")
    assert rows(kept, "source_file", "text", "reason") == [("timesheet_1.csv", "x|" * 20, "TOO_MANY_FIELDS")]


def test_lost_values_stop_the_run_beyond_a_limit(spark, source, tmp_path):
    write(source / "employee_2.csv", EMPLOYEE_FILE_COLUMNS, [employee(n, hire_date="soon") for n in (8, 9)])
    assert refresh(spark, str(source), str(tmp_path / "wh"), replace(CONFIG, max_lost_values=2))
    with pytest.raises(LostValuesError, match="employee.hire_date: 2"):
        refresh(spark, str(source), str(tmp_path / "wh"), replace(CONFIG, max_lost_values=1))


def test_raw_shifts_are_shuffled_once(spark, settings, source, tmp_path):
    """The stored split is the only plan that joins the raw shifts, and both sides read it."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false", maxMetadataStringLength="10000")
    refresh(spark, str(source), str(tmp_path / "wh"), CONFIG)
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    raw = warehouse.read("bronze", "raw_timesheet")
    ids = spark.read.parquet(warehouse.path("staging", "employee_id"))
    split = conform.split_timesheets(raw, ids)
    text = split._jdf.queryExecution().executedPlan().toString()
    assert text.count("raw_timesheet") == 1 and text.count("Join") == 1
    stored = spark.read.parquet(warehouse.path("staging", "split_timesheet"))
    for side in (conform.conform_split(stored, NOW, 5, Observation()), conform.rejected_split(stored, NOW)):
        assert "Exchange" not in side._jdf.queryExecution().executedPlan().toString()


def test_manager_branches_parse_nothing(spark, settings, source, tmp_path):
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false", maxMetadataStringLength="10000")
    refresh(spark, str(source), str(tmp_path / "wh"), CONFIG)
    raw = Warehouse(spark, str(tmp_path / "wh")).read("bronze", "raw_employee")
    typed = conform.conform_employees(raw, NOW, Observation())
    text = typed._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert len(schemas) == 3 and sum("hire_date" in s for s in schemas) == 1
    assert text.count("CollectMetrics") == 1
