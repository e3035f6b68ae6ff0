"""Batches of employee changes, stored as a log of row versions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.config import Config
from muster.operators import changes as operators
from muster.operators.conform import timestamp
from muster.operators.contracts import table_violations
from muster.operators.numbering import new_ids
from muster.plans.refresh import enforce
from muster.schemas import CONTRACTS, TABLES
from muster.sources.tables import Warehouse

INSERT, UPDATE, TERMINATE = "insert", "update", "terminate"


def _operation(name: str, config: Config, parents: dict) -> Callable[[DataFrame, DataFrame], operators.Applied]:
    return {
        INSERT: lambda staff, batch: operators.apply_employee_inserts(
            staff, batch, config.run_at, parents, ids=parents["employee_key"]
        ),
        UPDATE: lambda staff, batch: operators.apply_employee_updates(staff, batch, config.run_at, parents),
        TERMINATE: lambda staff, batch: operators.apply_employee_terminations(
            staff, batch, config.as_of, config.run_at
        ),
    }[name]


def batch_digest(operation: str, batch: DataFrame) -> str:
    """Name of a batch by what it holds, whatever the order of its rows."""
    row = F.to_json(F.struct(*sorted(batch.columns)), {"ignoreNullFields": "false"})
    sums = [F.sum(F.conv(F.substring(F.md5(row), n, 8), 16, 10).cast("decimal(38,0)")) for n in (1, 9, 17, 25)]
    found = batch.agg(F.sha2(F.concat_ws(",", F.lit(operation), F.count(F.lit(1)), *sums), 256).alias("digest"))
    return found.first().digest


def store_changes(
    warehouse: Warehouse, operation: str, batch: DataFrame, config: Config, batch_id: str | None = None
) -> dict[str, int]:
    """Log what a batch makes of the stored employees, and keep the rows that were refused.

    Only employees that the batch names are read and written: their new rows go to
    ``silver.employee_change`` with a version, and a read of ``silver.employee`` takes the last version of each.
    The new rows must keep the table's contract; else nothing changes and the batch fails. Refused rows
    are added to ``bronze.refused_change``, and the batch to the ledger ``bronze.change_batch``, all published at
    once. A batch whose id (by default a digest of its rows) is in the ledger changes nothing.
    """
    batch_id = batch_id or batch_digest(operation, batch)
    with warehouse.transaction() as run:
        ledger = run.read("bronze", "change_batch")
        if not ledger.filter(F.col("batch_id") == batch_id).isEmpty():
            return {"changed": 0, "refused": 0}
        version = (ledger.agg(F.max("version")).first()[0] or 0) + 1
        before = run.read("silver", "employee")
        parents = {t: run.read("silver", t) for t in ("organization", "department")} | {"employee": before}
        if operation == INSERT:
            fresh = batch.select(F.col("client_employee_id").cast("string")).dropna().distinct()
            known = run.read("silver", "employee_key").unionByName(before.select("id", "client_employee_id"))
            run.append("silver", "employee_key", new_ids(known, fresh))
        parents["employee_key"] = run.read("silver", "employee_key")
        key = "client_employee_id" if operation == INSERT else "id"
        named = before.join(batch.select(key).distinct(), key, "left_semi").select(before.columns)
        applied = _operation(operation, config, parents)(named, batch)
        changed = applied.employee.withColumn("version", F.lit(version).cast("long"))
        counts = {"changed": run.append("silver", "employee_change", changed)}
        if config.fail_on_contract:
            enforce(_violations(run, version, parents))
        schema = TABLES["bronze", "refused_change"]
        known = {"operation": F.lit(operation), "refused_at": timestamp(config.run_at)}
        known |= {c: F.col(c) for c in applied.rejected.columns}
        refused = applied.rejected.select(
            *(known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields)
        )
        counts["refused"] = run.append("bronze", "refused_change", refused)
        entry = (batch_id, operation, version, counts["changed"], counts["refused"], config.run_at)
        run.append("bronze", "change_batch", batch.sparkSession.createDataFrame([entry], TABLES["bronze", "change_batch"]))
    return counts


def _violations(run: Warehouse, version: int, parents: dict[str, DataFrame]) -> DataFrame:
    """The contract of the rows of a version, and of those that share a key with them."""
    after = run.read("silver", "employee")
    new = run.read("silver", "employee_change").filter(F.col("version") == version)
    keys = [key for key, *more in CONTRACTS["employee"].unique if not more]
    near = [after.join(new.select(key).distinct(), key, "left_semi").select(after.columns) for key in keys]
    rows = near[0]
    for more in near[1:]:
        rows = rows.unionAll(more)
    tables = {**parents, "employee": after, "changed employee": rows.distinct()}
    del tables["employee_key"]
    return table_violations(tables, {"changed employee": CONTRACTS["employee"]})


def compact_employees(warehouse: Warehouse) -> int:
    """Write the employees anew with all logged changes, and empty the log; their number."""
    return warehouse.write("silver", "employee", warehouse.read("silver", "employee"))
