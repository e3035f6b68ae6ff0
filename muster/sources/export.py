"""Export of gold tables and of the quality report."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.schemas import GOLD_TABLES
from muster.sources.tables import Warehouse, write_counted

log = logging.getLogger(__name__)


def export_gold(
    warehouse: Warehouse, target: str, storage: Mapping[str, str] | None = None
) -> dict[str, int]:
    """Copy each gold table to ``<target>/warehouse/<table>.parquet``; rows per table.

    A table that storage fails on is logged and counts 0; the others are still exported.
    Other errors are not caught.
    """
    summary = {}
    for table in GOLD_TABLES:
        path = f"{target.rstrip('/')}/warehouse/{table}.parquet"
        try:
            summary[f"gold.{table}"] = write_counted(
                warehouse.read("gold", table), path, storage=storage
            )
        except (PySparkException, Py4JError) as error:
            if not _storage_failed(error):
                raise
            log.exception("export of %s failed", table)
            summary[f"gold.{table}"] = 0
    return summary


def _storage_failed(error: Exception) -> bool:
    """Whether reading or writing files lies at the bottom of an error."""
    text = str(error)
    return any(name in text for name in ("IOException", "FAILED_READ_FILE", "FileNotFound", "AccessDenied"))


def write_report(checks: DataFrame, folder: str, run_at: dt.datetime) -> str:
    """Write the check rows as one JSON document ``{run_at, checks: [...]}``; its folder.

    The report holds one row per check, so gathering it into one document is safe.
    """
    path = f"{folder.rstrip('/')}/quality_report_{run_at:%Y%m%d_%H%M%S}"
    document = checks.agg(
        F.lit(run_at.isoformat()).alias("run_at"),
        F.sort_array(F.collect_list(F.struct("check", "status", "details"))).alias("checks"),
    )
    document.coalesce(1).write.mode("overwrite").json(path)
    return path
