"""Numbers without gaps for rows in an order, and the lasting ids of business keys that they give."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from muster.functions.text import clean_columns
from muster.operators.dimensions import with_dimension_codes
from muster.schemas import TABLES
from muster.sources.lines import stored

_PLACE = (1 << 33) - 1


def numbered(rows: DataFrame, *order: str, start: int = 0) -> DataFrame:
    """``rows`` with ``number``: ``start`` + 1 and on, without gaps, in the order of the columns ``order``.

    Rows are dealt by ranges and sorted inside them. Counts per range, one row each, give where the numbers
    of a range begin; so no task sees more than its range. Dealt rows are stored, since their ranges come
    from a sample and another run of the plan could cut them elsewhere. Rows equal in ``order`` get
    numbers in any order; nulls come first. Empty table: no rows.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = stored(dealt.select("*", F.spark_partition_id().alias("_range"), place.alias("_place")), "numbered")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    begins = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_begin"))
    # As many rows as the shuffle has partitions; no range is larger than a task can hold.
    number = F.lit(start) + F.col("_begin") + F.col("_place") + 1
    return dealt.join(begins, "_range").select(*rows.columns, number.alias("number"))


@dataclass(frozen=True)
class Keys:
    """The id of each business key: (id, code), (id, organization_code, code), (id, client_employee_id)."""

    organization: DataFrame
    department: DataFrame
    employee: DataFrame


def business_keys(raw_employee: DataFrame) -> dict[str, DataFrame]:
    """The distinct business keys of an employee file, by the table that holds their ids."""
    columns = (
        "client_employee_id", "organization_id", "organization_name", "department_id", "department_name",
    )
    members = with_dimension_codes(clean_columns(raw_employee.select(*columns), columns))
    organization = F.col("organization_code").alias("code")
    department = F.col("department_code").alias("code")
    return {
        "organization_key": members.select(organization).dropna().distinct(),
        "department_key": members.select("organization_code", department).dropna().distinct(),
        "employee_key": members.select("client_employee_id").dropna().distinct(),
    }


def new_ids(known: DataFrame, keys: DataFrame) -> DataFrame:
    """Ids for the ``keys`` that ``known`` does not have, from its largest id on."""
    start = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    fresh = keys.join(known, keys.columns, "left_anti")
    found = numbered(fresh, *keys.columns, start=start)
    return found.select(F.col("number").alias("id"), *keys.columns)


def assign_ids(
    read: Callable[[str], DataFrame], append: Callable[[str, DataFrame], int], keys: dict[str, DataFrame]
) -> None:
    """Give each new business key of the named tables an id, and add it to its table.

    A key keeps its id for good, whatever else is loaded: ids are unique since each comes from a count,
    and no two keys can share one.
    """
    for table, rows in keys.items():
        append(table, new_ids(read(table), rows).select(*TABLES["silver", table].names))
