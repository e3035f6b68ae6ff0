"""Overlapping intervals, who was active when, and pages of shifts."""

import datetime as dt
import random

import pytest
from helpers import day, rows
from pyspark.sql import functions as F

from muster.operators.intervals import active_in_periods, overlapping
from muster.operators.reads import timesheet_page, timesheet_pages


def _drawn(draw, n, longest):
    out = []
    for i in range(n):
        begin = dt.date(1969, 11, 1) + dt.timedelta(days=draw.randint(0, 400))
        end = begin + dt.timedelta(days=draw.randint(-3, longest))
        out.append((i, None if draw.random() < 0.05 else begin, None if draw.random() < 0.05 else end))
    return out


@pytest.mark.parametrize("bin_days", [1, 7, 32, 1000])
def test_pairs_equal_brute_force(spark, bin_days):
    draw = random.Random(bin_days)
    one, two = _drawn(draw, 80, 60), _drawn(draw, 60, 5)
    schema = "id int, begin date, end date"
    found = overlapping(spark.createDataFrame(one, schema), spark.createDataFrame(two, schema), bin_days=bin_days)
    expected = [
        (i, j) for i, a, b in one for j, c, d in two
        if None not in (a, b, c, d) and a <= b and c <= d and a <= d and c <= b
    ]
    assert rows(found, "left.id", "right.id") == sorted(expected, key=lambda r: [(True, str(v)) for v in r])
    assert expected


def test_plan_is_an_equi_join_that_splits_a_hot_bin(spark, settings):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        shuffle__partitions="16",
    )
    at = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id").cast("int"))
    begin = F.date_add(F.lit("2000-01-01").cast("date"), at)
    many = spark.range(0, 20_000, 1, 8).select("id", begin.alias("begin"), begin.alias("end"))
    few = many.filter("id % 500 = 3").select("id", "begin", "end")
    found = overlapping(few, many, bin_days=1)
    assert found.count() == found.select("left.id", "right.id").distinct().count() > 50_000
    plan = found.select("left.id", F.col("right.id").alias("other"))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text and "skew=true" in text


def test_active_on_days(table, spark):
    staff = table(
        "silver",
        "employee",
        {"id": 1, "client_employee_id": "a", "hire_date": day("2024-01-10"), "term_date": day("2024-02-01")},
        {"id": 2, "client_employee_id": "b", "hire_date": day("2024-01-31")},
        {"id": 3, "client_employee_id": "c", "hire_date": day("2024-01-05"), "term_date": day("2024-01-05")},
        {"id": 4, "client_employee_id": "d", "term_date": day("2024-01-05")},
        {"id": 5, "client_employee_id": "e", "hire_date": day("2025-01-01")},
    )
    days = [day("2024-01-05"), day("2024-01-31"), day("2024-02-01"), day("2024-06-30"), day("2024-07-01")]
    periods = spark.createDataFrame([(d, d) for d in days], "begin date, end date")
    found = active_in_periods(staff, periods, day("2024-06-30"))
    assert rows(found, "begin", "client_employee_id") == [
        (days[1], "a"), (days[1], "b"), (days[2], "b"), (days[3], "b"),
    ]


def test_pages_join_to_the_whole(spark, table, settings):
    draw = random.Random(3)
    dates = [None, *(day(f"2024-0{m}-0{d}") for m in (1, 2) for d in (1, 2, 3))]
    shifts = [{"id": i, "client_employee_id": "x", "punch_apply_date": draw.choice(dates)} for i in range(100)]
    df = table("silver", "timesheet", *shifts).withColumn("punch_month", F.date_format("punch_apply_date", "yyyy-MM"))
    expected = sorted((s["punch_apply_date"], s["id"]) for s in shifts if s["punch_apply_date"])
    for size in (7, len(expected), 1000):
        pages = list(timesheet_pages(df, size))
        assert [(r.punch_apply_date, r.id) for p in pages for r in p.items] == expected
        assert [len(p.items) for p in pages[:-1]] == [size] * (len(pages) - 1)
    assert timesheet_page(df.limit(0), 5).items == []
    # A shift added before the cursor does not move the next page.
    first = timesheet_page(df, 10)
    more = df.unionByName(df.limit(1).withColumn("id", F.lit(-1).cast("long")).withColumn("punch_apply_date", F.lit(dates[1])))
    assert timesheet_page(more, 10, first.after).items == timesheet_page(df, 10, first.after).items


def _followed(df, size):
    """Ids by page, as the cursors of single pages give them."""
    page = timesheet_page(df, size)
    found = [page.items]
    while page.after:
        page = timesheet_page(df, size, page.after)
        found.append(page.items)
    return [[(r.punch_apply_date, r.id) for r in items] for items in found if items]


@pytest.mark.parametrize("size", [1, 3, 7])
def test_pages_pass_over_what_cursors_pass_over(table, size):
    """Repeated ids, and shifts without an id, across the ends of pages."""
    draw = random.Random(size)
    shifts = [
        {"id": draw.choice([None, None, 1, 2, 3, 4, 5, 6]), "punch_apply_date": day(f"2024-01-0{draw.randint(1, 4)}")}
        for _ in range(50)
    ]
    df = table("silver", "timesheet", *shifts)
    expected = _followed(df, size)
    pages = timesheet_pages(df, size)
    assert [[(r.punch_apply_date, r.id) for r in p.items] for p in pages] == expected
    placed = [(n, k, i) for n, items in enumerate(expected, 1) for k, (_, i) in enumerate(items, 1)]
    assert sorted(map(tuple, pages.rows.select("page", "place", "shift.id").collect()), key=lambda r: r[:2]) == placed
    assert sum(map(len, expected)) < len(shifts)


def test_all_pages_take_no_job_per_page(spark, table):
    df = table("silver", "timesheet", *({"id": i, "punch_apply_date": day("2024-01-01")} for i in range(200)))
    context = spark.sparkContext
    context.setJobGroup("pages", "all pages")
    try:
        pages = list(timesheet_pages(df, 1))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert [r.id for p in pages for r in p.items] == list(range(200))
    assert 0 < len(context.statusTracker().getJobIdsForGroup("pages")) < 60
