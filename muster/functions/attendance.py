"""Attendance flags of one shift."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def attendance_flags(
    punch_in: Column,
    punch_out: Column,
    scheduled_start: Column,
    scheduled_end: Column,
    grace_minutes: int = 5,
) -> dict[str, Column]:
    """The four flags by name.

    A shift without both schedule bounds is unscheduled and carries no other flag.
    Deviations of exactly the grace time do not count, and a missing punch never counts.
    """
    grace = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(grace_minutes), F.lit(0))
    scheduled = scheduled_start.isNotNull() & scheduled_end.isNotNull()

    def flag(condition: Column) -> Column:
        return F.coalesce(scheduled & condition, F.lit(False))

    return {
        "is_late_arrival": flag(punch_in > scheduled_start + grace),
        "is_early_departure": flag(punch_out < scheduled_end - grace),
        "is_overtime": flag(punch_out > scheduled_end + grace),
        "is_unscheduled": ~scheduled,
    }
