"""Active headcount per day from employment intervals [hire, term)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_headcount(employee: DataFrame, as_of: dt.date) -> DataFrame:
    """``snapshot_date, active_count`` for every day from the first hire to ``as_of``.

    A calendar-to-employee range join costs days x employees. Here each employee
    adds +1 on the hire date and -1 on the term date; the sums per date leave at
    most one row per calendar day, whatever the number of employees, and only
    these rows meet in the unpartitioned window. Days without a change are filled
    in by stretching each count up to the next change.
    """
    end = F.lit(as_of).cast("date")
    employed = F.col("term_date").isNull() | (F.col("term_date") > F.col("hire_date"))
    changes = (
        employee.filter(F.col("hire_date") <= end)
        # An interval that is empty still opens the calendar on its hire date, with no count.
        .select(
            F.inline(
                F.array(
                    F.struct(F.col("hire_date").alias("day"), employed.cast("bigint").alias("delta")),
                    F.struct(
                        F.when(employed, F.col("term_date")).alias("day"),
                        F.lit(-1).cast("bigint").alias("delta"),
                    ),
                )
            )
        )
        .filter(F.col("day") <= end)
        .groupBy("day")
        .agg(F.sum("delta").alias("delta"))
    )
    by_day = Window.orderBy("day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.date_sub(F.lead("day").over(by_day), 1), end)
    steps = changes.select(
        "day", until.alias("until"), F.sum("delta").over(so_far).alias("active_count")
    )
    return steps.select(
        F.explode(F.sequence("day", "until")).alias("snapshot_date"), "active_count"
    )
