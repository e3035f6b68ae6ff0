"""Plans and skew: what must hold when tables are far larger than memory."""

import os
import re

import pytest
from helpers import NOW, day, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from muster.operators import conform
from muster.plans import kpi
from muster.schemas import TABLES
from muster.session import initial_partitions, remove_scratch, shared_folder
from verification.queries import registered

FOLDER = "/root/testdata/sf0.001"
PLANNED = sorted(registered())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", PLANNED)
def test_plan_has_no_unbounded_operator(spark, settings, key):
    """Without size-checked broadcasts every join is a partitioned equi-join, all in the JVM."""
    settings(autoBroadcastJoinThreshold="-1")
    text = plan(registered()[key](spark, FOLDER))
    for operator in ("BroadcastNestedLoopJoin", "CartesianProduct", "BroadcastHashJoin", "Python", "MapInArrow"):
        assert operator not in text
    if "headcount" not in key and "turnover" not in key:
        windows = [w for w in text.split("\n") if re.search(r"\bWindow \[", w)]
        assert all("SinglePartition" not in w for w in windows)


@pytest.fixture
def shifts(spark):
    """Two thirds of the shifts belong to one employee, or to nobody."""

    def build(hot, rows_per_share=20000):
        n = 3 * rows_per_share
        employee = F.when(F.col("n") < 2 * rows_per_share, hot).otherwise(
            F.format_string("%06d", F.col("n") % 500)
        )
        values = {
            "id": F.col("n"),
            "client_employee_id": employee,
            "punch_apply_date": F.date_add(F.lit(day("2024-01-01")), (F.col("n") % 60).cast("int")),
            "hours_worked": F.lit("8.00"),
            "is_late_arrival": F.col("n") % 2 == 0,
        }

        def typed(layer, name):
            return spark.range(n).withColumnRenamed("id", "n").select(
                *(
                    values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                    for f in TABLES[layer, name].fields
                )
            )

        return typed

    return build


@pytest.fixture
def staff(spark):
    ids = spark.range(400).select(F.format_string("%06d", "id").alias("client_employee_id"))
    return ids.select(
        *(
            (F.col(f.name) if f.name == "client_employee_id" else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES["silver", "employee"].fields
        )
    )


def shares(df):
    """Largest partition as a share of all rows."""
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


def test_hot_employee_is_split_in_the_join(spark, settings, shifts, staff):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        shuffle__partitions="16",
    )
    raw = shifts("000001")("bronze", "raw_timesheet").repartition(8)
    observed = Observation()
    ids = staff.select("client_employee_id")
    for accepted in (
        conform.accepted_split(conform.split_timesheets(raw, ids)),
        conform.split_timesheets(raw, ids),
        conform.conform_timesheets(raw, staff, NOW, 5, observed),
    ):
        accepted.collect()
        assert "skew=true" in plan(accepted)
    assert set(observed.get.values()) == {0}
    rejected = conform.rejected_timesheets(raw.withColumn("client_employee_id", F.lit("none such")), staff, NOW)
    assert rejected.count() == raw.count()


def test_missing_ids_are_spread(spark, settings, shifts, staff):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__enabled="false",
        shuffle__partitions="16",
    )
    raw = shifts(None)("bronze", "raw_timesheet")
    rejected = conform.rejected_timesheets(raw, staff, NOW)
    assert shares(rejected) < 0.15
    assert rejected.count() + conform.conform_timesheets(raw, staff, NOW).count() == raw.count()


def test_hot_employee_reaches_the_window_as_one_row_per_day(spark, settings, shifts, staff):
    settings(autoBroadcastJoinThreshold="-1")
    work = shifts("000001")("silver", "timesheet")
    rolling = kpi.kpi_rolling_hours(work, staff)
    text = plan(rolling)
    assert text.index("Window [") < text.index("HashAggregate") < text.index("Range (")
    assert rolling.filter("client_employee_id = '000001'").count() == 60


def test_aggregates_shrink_rows_before_they_are_shuffled(spark, settings, shifts, staff):
    """Every exchange above the shifts carries partial aggregates."""
    settings(autoBroadcastJoinThreshold="-1")
    work = shifts("000001")("silver", "timesheet")
    department = spark.createDataFrame([], TABLES["silver", "department"])
    text = plan(kpi.kpi_attendance(work, staff, department)).split("\n")
    source = next(i for i, row in enumerate(text) if "Range (" in row)
    above = [row for row in text[:source] if "Exchange" in row or "HashAggregate" in row]
    assert "HashAggregate" in above[-1] and "partial_count" in above[-1]
    assert rows(kpi.kpi_attendance(work, staff, department).filter("total_shifts > 40000"))


def test_manager_lookup_spreads_employees_without_manager(spark, settings, staff):
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false", shuffle__partitions="16")
    assert shares(conform.resolve_managers(staff)) < 0.2


def test_shuffles_start_from_the_input_size():
    assert initial_partitions(1 << 30) == 1024
    assert initial_partitions(50 << 40) == 204_800
    assert initial_partitions(1 << 60) == 400_000
    assert initial_partitions(2 << 40) == 8192


def test_scratch_folders_can_be_removed(spark):
    path = shared_folder(spark, "test")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    remove_scratch(spark)
    assert not os.path.exists(path)
