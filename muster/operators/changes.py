"""Batches of employee changes, applied as joins.

Each change row carries ``change_seq``, a number that orders the batch; the
outcome equals applying the rows one after another. Rows of one hot id are folded
by aggregates, so no id has to fit into one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.operators.conform import spread_nulls, timestamp
from muster.operators.dimensions import surrogate_key
from muster.schemas import CONTRACTS, TABLES

EMPLOYEE_EXISTS = "EMPLOYEE_EXISTS"
EMPLOYEE_ID_MISSING = "EMPLOYEE_ID_MISSING"
EMPLOYEE_NOT_FOUND = "EMPLOYEE_NOT_FOUND"
# Reasons that follow a column's name.
INVALID_VALUE = "INVALID_VALUE"
TEXT_TOO_LONG = "TEXT_TOO_LONG"
VALUE_REQUIRED = "VALUE_REQUIRED"
UNKNOWN_REFERENCE = "UNKNOWN_REFERENCE"

_SCHEMA, _CONTRACT = TABLES["silver", "employee"], CONTRACTS["employee"]
_SYSTEM_COLUMNS = ("id", "client_employee_id", "created_at", "updated_at")
UPDATABLE = tuple(c for c in _SCHEMA.names if c not in _SYSTEM_COLUMNS)


@dataclass(frozen=True)
class Applied:
    """The employee table after a batch, and the change rows that were refused."""

    employee: DataFrame
    rejected: DataFrame


def _typed(
    changes: DataFrame, fields: Sequence[str], is_set: Callable[[str], Column],
    parents: Mapping[str, DataFrame] | None,
) -> DataFrame:
    """The batch with its fields in their declared types, and ``reason``: why a row cannot be applied.

    Only set values count. A value must fit its type, text its length, a required column may not
    become null, and with ``parents`` a key must exist in its table. A row that breaks several rules
    names them all, in the order of the columns.
    """
    lengths, kinds = dict(_CONTRACT.max_length), {f.name: f.dataType for f in _SCHEMA.fields}
    rules: dict[str, list[tuple[Column, str]]] = {c: [] for c in fields}
    values = {}
    for c in fields:
        raw, typed = F.col(c), F.col(c).try_cast(kinds[c])
        values[c] = typed
        rules[c].append((raw.isNotNull() & typed.isNull(), INVALID_VALUE))
        if c in lengths:
            rules[c].append((F.length(typed) > lengths[c], TEXT_TOO_LONG))
        if c in _CONTRACT.not_null:
            rules[c].append((raw.isNull(), VALUE_REQUIRED))
    rows = changes
    for column, parent, parent_column in _CONTRACT.references:
        if column not in fields or parent not in (parents or {}):
            continue
        known = parents[parent].select(F.col(parent_column).alias(f"_{column}")).distinct()
        # Rows that set no key meet nothing, and are spread instead of sharing one partition.
        key = values[column].cast("string")
        asked = spread_nulls(F.when(is_set(column), key), F.col("change_seq"))
        rows = rows.join(known, asked == F.col(f"_{column}").cast("string"), "left")
        dangling = values[column].isNotNull() & F.col(f"_{column}").isNull()
        rules[column].append((dangling, UNKNOWN_REFERENCE))
    broken = [
        F.when(is_set(c) & condition, F.lit(f"{c}: {name}"))
        for c in fields
        for condition, name in rules[c]
    ]
    reason = F.concat_ws("; ", *broken) if broken else F.lit("")
    judged = rows.withColumn("reason", F.nullif(reason, F.lit("")))
    return judged.select(
        *(values[c].alias(c) if c in values else F.col(c) for c in changes.columns if c != "reason"),
        "reason",
    )


def apply_employee_inserts(
    employee: DataFrame,
    changes: DataFrame,
    now: dt.datetime,
    parents: Mapping[str, DataFrame] | None = None,
    salt: int = 0,
    ids: DataFrame | None = None,
) -> Applied:
    """Add employees whose id is new; of several valid rows with one id the first counts.

    ``ids`` has (id, client_employee_id) of all; without it ids are hashes.

    ``hire_date`` must be a column of the batch, though its values may be null.
    ``active_status`` defaults to true. Other absent columns become null. Values are
    cast to the declared types; a row whose values do not fit is refused, not the batch.
    """
    if "hire_date" not in changes.columns:
        raise ValueError("inserted employees need a hire_date column")
    key = "client_employee_id"
    fields = [c for c in (key, *UPDATABLE) if c in changes.columns]
    if "active_status" in fields:
        changes = changes.withColumn("active_status", F.coalesce(F.col("active_status").cast("string"), F.lit("true")))
    typed = _typed(changes, fields, lambda c: F.lit(c != key) | F.col(key).isNotNull(), parents)
    reason = F.when(F.col(key).isNull(), EMPLOYEE_ID_MISSING).otherwise(F.col("reason"))
    typed = typed.withColumn("reason", reason)
    # The first row of an id is carried through the aggregation that finds it.
    firsts = (
        typed.filter("reason is null")
        .groupBy(key)
        .agg(
            F.min("change_seq").alias("change_seq"),
            F.min_by(F.struct(*(c for c in fields if c != key)), "change_seq").alias("row"),
        )
        .join(employee.select(key), key, "left_anti")
    )
    values = {
        "id": surrogate_key(F.col(key), salt=salt) if ids is None else F.col("_id"),
        key: F.col(key),
        "active_status": F.col("row.active_status") if "active_status" in fields else F.lit(True),
        "created_at": timestamp(now),
        "updated_at": timestamp(now),
    } | {c: F.col(f"row.{c}") for c in fields if c not in (key, "active_status")}
    new = firsts if ids is None else firsts.join(ids.select(key, F.col("id").alias("_id")), key)
    added = new.select(
        *(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in _SCHEMA.fields)
    )
    invalid = typed.filter("reason is not null").select("change_seq", key, "reason")
    # The key (id, change_seq) is unique, so this join has no hot key.
    repeated = (
        typed.filter("reason is null")
        .select("change_seq", key)
        .join(firsts.select(key, "change_seq"), [key, "change_seq"], "left_anti")
        .select("change_seq", key, F.lit(EMPLOYEE_EXISTS).alias("reason"))
    )
    return Applied(employee.unionByName(added), invalid.unionByName(repeated))


def apply_employee_updates(
    employee: DataFrame,
    changes: DataFrame,
    now: dt.datetime,
    parents: Mapping[str, DataFrame] | None = None,
) -> Applied:
    """Patch employees by ``id``.

    ``set_fields`` names the columns a change row sets; these overwrite, also with
    null, and all others stay. The last valid row that sets a column wins. Values are
    cast to the declared types, so the result has the table's own; a row that sets a
    value that does not fit, or a required one to null, is refused as a whole.
    """
    fields = [c for c in UPDATABLE if c in changes.columns]
    typed = _typed(changes, fields, lambda c: F.array_contains("set_fields", c), parents)
    valid = typed.filter("reason is null")

    def last_set(name: str) -> Column:
        # Wrapped, so that "set to null" differs from "not set".
        when_set = F.when(F.array_contains("set_fields", name), F.col("change_seq"))
        return F.max_by(F.struct(F.col(name).alias("value")), when_set).alias(f"_{name}")

    patches = valid.groupBy("id").agg(F.lit(True).alias("_patched"), *map(last_set, fields))

    def patched(name: str) -> Column:
        if name in fields:
            new = F.col(f"_{name}")
            return F.when(new.isNotNull(), new["value"]).otherwise(F.col(name)).alias(name)
        if name == "updated_at":
            return F.when(F.col("_patched"), timestamp(now)).otherwise(F.col(name)).alias(name)
        return F.col(name)

    result = employee.join(patches, "id", "left").select(*map(patched, employee.columns))
    invalid = typed.filter("reason is not null").select("change_seq", "id", "reason")
    return Applied(result, _unknown(employee, valid).unionByName(invalid))


def apply_employee_terminations(
    employee: DataFrame, changes: DataFrame, as_of: dt.date, now: dt.datetime
) -> Applied:
    """Soft-delete employees by ``id``: inactive, term date set, row kept."""
    gone = changes.select("id").distinct().withColumn("_gone", F.lit(True))
    ends = {
        "active_status": F.lit(False),
        "term_date": F.lit(as_of).cast("date"),
        "updated_at": timestamp(now),
    }
    result = employee.join(gone, "id", "left").select(
        *(
            F.when(F.col("_gone"), ends[c]).otherwise(F.col(c)).alias(c) if c in ends else F.col(c)
            for c in employee.columns
        )
    )
    return Applied(result, _unknown(employee, changes))


def _unknown(employee: DataFrame, changes: DataFrame) -> DataFrame:
    """Change rows whose id is missing or not an employee's.

    Null ids go straight to the refused side instead of into one join partition.
    """
    rows = changes.select("change_seq", "id")
    missing = rows.filter(F.col("id").isNull())
    unknown = rows.filter(F.col("id").isNotNull()).join(employee.select("id"), "id", "left_anti")
    return missing.unionByName(unknown).withColumn("reason", F.lit(EMPLOYEE_NOT_FOUND))
