"""Pairs of overlapping intervals of days, by an equi-join on bins of days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN_DAYS = 32


def _bin(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day) / days).cast("int")


def _binned(rows: DataFrame, name: str, begin: str, end: str, days: int) -> DataFrame:
    """Each row once per bin that it touches, as a struct; rows that end before they begin have none."""
    first, last = _bin(F.col(begin), days), _bin(F.col(end), days)
    bins = F.when(F.col(begin) <= F.col(end), F.sequence(first, last))
    return rows.select(F.struct("*").alias(name), first.alias(f"_{name}_first"), F.explode(bins).alias("_bin"))


def overlapping(
    left: DataFrame, right: DataFrame, begin: str = "begin", end: str = "end", bin_days: int = BIN_DAYS
) -> DataFrame:
    """``left, right``: all pairs of rows whose intervals of days share a day, each pair once.

    Both sides have the dates ``begin`` and ``end``, both included; a row with a null in either takes no part.
    A row is sent to every bin it touches, and a pair is made only in the first bin that both
    touch: where the later of the two begins. So there is no comparison of all with all, no later removal of
    repeated pairs, and adaptive execution can split a bin that very many rows touch. A row costs
    as many entries as it touches bins: for long intervals take wide bins, for many short ones narrow bins.
    """
    if bin_days < 1:
        raise ValueError("a bin has a day at least")
    one, two = _binned(left, "left", begin, end, bin_days), _binned(right, "right", begin, end, bin_days)
    pairs = one.join(two, "_bin").filter(F.col("_bin") == F.greatest("_left_first", "_right_first"))
    shared = (F.col(f"left.{begin}") <= F.col(f"right.{end}")) & (F.col(f"right.{begin}") <= F.col(f"left.{end}"))
    return pairs.filter(shared).select("left", "right")


def employment(employee: DataFrame, as_of: dt.date) -> DataFrame:
    """``id, client_employee_id, begin, end``: the days on which an employee is active, up to ``as_of``.

    The term date is no such day. Employees without hire date, or hired later, have none.
    """
    today = F.lit(as_of).cast("date")
    end = F.least(F.date_sub(F.coalesce("term_date", F.date_add(today, 1)), 1), today)
    days = employee.select("id", "client_employee_id", F.col("hire_date").alias("begin"), end.alias("end"))
    return days.filter(F.col("begin") <= F.col("end"))


def active_in_periods(
    employee: DataFrame, periods: DataFrame, as_of: dt.date, bin_days: int = BIN_DAYS
) -> DataFrame:
    """``begin, end, client_employee_id, first_day, last_day``: who was active in which period, and when in it.

    ``periods`` has ``begin`` and ``end``; a period of one day tells who was active on that day.
    """
    met = overlapping(periods.select("begin", "end"), employment(employee, as_of), bin_days=bin_days)
    return met.select(
        "left.begin",
        "left.end",
        "right.client_employee_id",
        F.greatest("left.begin", "right.begin").alias("first_day"),
        F.least("left.end", "right.end").alias("last_day"),
    )
