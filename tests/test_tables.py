"""Stored tables: snapshots, transactions, and reads that skip row groups."""

import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from muster.operators.reads import by_id
from muster.schemas import GOLD_TABLES, TABLES
from muster.sources import tables
from muster.sources.tables import Conflict, Warehouse


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def organizations(spark, *names):
    return spark.createDataFrame([(n, str(n), name) for n, name in enumerate(names)], "id long, code string, name string")


def names(warehouse):
    return [r[0] for r in rows(warehouse.read("silver", "organization"), "name")]


def departments(warehouse):
    return [r[0] for r in rows(warehouse.read("silver", "department"), "name")]


def department(spark, name):
    return spark.createDataFrame([(1, "1", name, 1)], "id long, code string, name string, organization_id long")


def test_readers_see_all_tables_of_one_version(spark, warehouse):
    assert names(warehouse) == []
    with warehouse.transaction() as run:
        run.write("silver", "organization", organizations(spark, "a"))
        run.write("silver", "department", department(spark, "x"))
        assert names(run) == ["a"] and names(warehouse) == []
    assert (names(warehouse), departments(warehouse)) == (["a"], ["x"])
    old = warehouse.read("silver", "organization")
    with warehouse.transaction() as run:
        run.write("silver", "organization", run.read("silver", "organization").withColumn("name", F.lit("b")))
        run.append("silver", "organization", organizations(spark, "c"))
        assert departments(run) == ["x"]
    assert names(warehouse) == ["b", "c"]
    # A reader that began before goes on with what it saw.
    assert rows(old, "name") == [("a",)]


class Killed(BaseException):
    """No handler expects it, as none can when a process dies."""


STEPS = ["store 1", "store 2", "create", "half a file"]


@pytest.mark.parametrize("step", STEPS)
def test_a_run_that_dies_leaves_the_old_version(spark, warehouse, monkeypatch, step):
    def run_once(mark):
        with warehouse.transaction() as run:
            run.write("silver", "organization", organizations(spark, mark))
            run.write("silver", "department", department(spark, mark))

    run_once("old")
    calls = []
    write, create = tables.write_counted, tables._Files.create

    def dying_write(*args, **options):
        calls.append(1)
        if step == f"store {len(calls)}":
            raise Killed
        return write(*args, **options)

    def dying_create(files, name, text):
        if step == "create":
            raise Killed
        if step == "half a file":
            create(files, name, text[: len(text) // 2])
            raise Killed
        return create(files, name, text)

    monkeypatch.setattr(tables, "write_counted", dying_write)
    monkeypatch.setattr(tables._Files, "create", dying_create)
    with pytest.raises(Killed):
        run_once("new")
    assert (names(warehouse), departments(warehouse)) == (["old"], ["old"])
    monkeypatch.undo()
    run_once("next")
    assert (names(warehouse), departments(warehouse)) == (["next"], ["next"])


def test_the_second_of_two_runs_on_a_table_fails(spark, warehouse):
    with warehouse.transaction() as other:
        other.write("silver", "department", department(spark, "x"))
        with pytest.raises(Conflict, match="silver/organization"), warehouse.transaction() as run:
            run.write("silver", "organization", organizations(spark, "late"))
            warehouse.write("silver", "organization", organizations(spark, "early"))
    assert (names(warehouse), departments(warehouse)) == (["early"], ["x"])


def test_two_runs_that_write_one_number(spark, warehouse, monkeypatch):
    """The file of a snapshot is created once; the run that comes second takes the next number."""
    warehouse.write("silver", "organization", organizations(spark, "a"))
    seen, log = [], Warehouse._log

    def late(self):
        found = log(self)
        if not seen:
            seen.append(1)
            Warehouse(spark, warehouse.root).write("silver", "department", department(spark, "x"))
        return found

    with warehouse.transaction() as run:
        run.write("silver", "organization", organizations(spark, "b"))
        monkeypatch.setattr(Warehouse, "_log", late)
    assert (names(warehouse), departments(warehouse)) == (["b"], ["x"])


def test_expired_folders_go(spark, warehouse, tmp_path):
    for name in "abcd":
        warehouse.write("silver", "organization", organizations(spark, name))
    warehouse.write("silver", "department", department(spark, "x"))
    with pytest.raises(Killed), warehouse.transaction() as run:
        run.write("silver", "organization", organizations(spark, "dead"))
        raise Killed
    folder = tmp_path / "wh/silver/organization"
    assert len(list(folder.iterdir())) == 5
    assert warehouse.expire(keep=2) == 3
    assert warehouse.expire(keep=2) == 0
    assert len(list(folder.iterdir())) == 2  # the last one, and a recent one of no snapshot
    assert warehouse.expire(keep=1, orphan_hours=0) == 1
    assert (names(warehouse), departments(warehouse)) == (["d"], ["x"])
    [left] = (tmp_path / "wh/_snapshots").glob("*.json")
    assert set(json.loads(left.read_text())["tables"]) == {"silver/organization", "silver/department"}


def _rows_scanned(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    seen, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            seen += node.metrics().apply("numOutputRows").value()
        kids = node.children()
        todo += [kids.apply(n) for n in range(kids.size())]
    return seen


def test_single_rows_are_read_from_few_row_groups(spark, warehouse):
    """Ids in no order, over many files: row groups without the id are skipped by their Bloom filters."""
    schema = TABLES["silver", "employee"]
    ids = spark.range(20_000).select(F.xxhash64("id").alias("id"), F.md5(F.col("id").cast("string")).alias("client_employee_id"))
    columns = (ids[f.name] if f.name in ids.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema)
    warehouse.write("silver", "employee", ids.select(*columns).repartition(100))
    stored = warehouse.read("silver", "employee")
    assert len(stored.inputFiles()) == 100
    wanted = ids.first()
    for found in (by_id(stored, wanted.id), stored.filter(F.col("client_employee_id") == wanted.client_employee_id)):
        assert found.count() == 1
        assert 0 < _rows_scanned(found) <= 2_000
    assert _rows_scanned(stored) == 20_000


def test_tables_without_a_folder_read_as_empty(warehouse):
    for layer, table in TABLES:
        assert warehouse.read(layer, table).isEmpty()
    assert len(GOLD_TABLES) == 6
