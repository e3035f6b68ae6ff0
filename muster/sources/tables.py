"""Stored tables, published together by snapshots.

A write makes a new folder ``<root>/<layer>/<table>/<version>`` and changes nothing else. What readers see is
told by the last whole file of the log ``<root>/_snapshots``: for each table the folders that it is made of.
A snapshot is one small file, created last and never changed, so a run that dies between any two steps
leaves all tables as they were, and a table is never seen with a part of another run's.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.schemas import TABLES


def bloom_filters(*columns: str) -> dict[str, str]:
    """Writer options that store what values of a column a row group has.

    A read by one value then skips the other row groups, also where values are in no order. Their size
    follows from the number of values found.
    """
    options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return options | {"parquet.bloom.filter.adaptive.enabled": "true"} if columns else {}


# Columns by which single rows are read.
_READ_BY = {
    ("silver", "employee"): ("id", "client_employee_id"),
    ("silver", "timesheet"): ("id", "client_employee_id"),
    ("gold", "kpi_attendance"): ("client_employee_id",),
    ("gold", "kpi_rolling_hours"): ("client_employee_id",),
}


def write_counted(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    storage: Mapping[str, str] | None = None,
    mode: str = "overwrite",
) -> int:
    """Write a Parquet folder and return the row count seen while writing."""
    observed = Observation()
    counted = df.observe(observed, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(mode).options(**(storage or {}))
    writer.partitionBy(*partition_by).parquet(path)
    return observed.get.get("rows", 0)


def clustered_timesheets(timesheet: DataFrame) -> DataFrame:
    """Layout of stored shifts: month folders, sorted by employee and day inside a file.

    The rebalance step gathers a month before it is written, so tasks do not each
    leave a small file in every month, and it splits a month that is too large for
    one task. Sorting is local and keeps the min/max statistics of an employee's
    row groups narrow.
    """
    return (
        timesheet.withColumn("punch_month", F.date_format("punch_apply_date", "yyyy-MM"))
        .hint("rebalance", "punch_month")
        .sortWithinPartitions("punch_month", "client_employee_id", "punch_apply_date")
    )


def latest(rows: DataFrame, log: DataFrame) -> DataFrame:
    """``rows`` with the last version of each ``id`` in ``log`` in place of its own.

    The log is small beside the table until it is compacted: it is aggregated by id first, and the table
    only meets the ids.
    """
    last = log.groupBy("id").agg(F.max_by(F.struct(*rows.columns), "version").alias("row"))
    return rows.join(last.select("id"), "id", "left_anti").select(rows.columns).unionAll(last.select("row.*"))


# Digits of a snapshot's number in its file name, so that names sort as numbers do.
_DIGITS = 12


class Conflict(RuntimeError):
    """Another run has published since this one began."""


class _Files:
    """The file system of a folder, through Hadoop."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._files = self.path(root).getFileSystem(conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def times(self, folder: str) -> list[tuple[str, float]]:
        """Names in a folder, and when each was changed last, in seconds."""
        if not self._files.exists(self.path(folder)):
            return []
        listed = self._files.listStatus(self.path(folder))
        return sorted((f.getPath().getName(), f.getModificationTime() / 1000) for f in listed)

    def names(self, folder: str) -> list[str]:
        return [name for name, _ in self.times(folder)]

    def text(self, name: str) -> str:
        stream = self._files.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Writes a new file; false if there is one of that name."""
        try:
            stream = self._files.create(self.path(name), False)
        except Py4JJavaError as error:
            if self._files.exists(self.path(name)):
                return False
            raise error
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def delete(self, name: str) -> None:
        self._files.delete(self.path(name), True)


class Warehouse:
    """The layered tables below one root folder, as its last snapshot has them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._files = _Files(spark, self.root)

    # Snapshots

    def _log(self) -> list[str]:
        names = self._files.names(f"{self.root}/_snapshots")
        return [n for n in names if n.endswith(".json") and n[:-5].isdigit()]

    def _snapshot(self, name: str) -> dict[str, list[str]] | None:
        """Folders by table; null for a file whose writer died before its end."""
        try:
            return json.loads(self._files.text(f"{self.root}/_snapshots/{name}"))["tables"]
        except ValueError:
            return None

    def tables(self) -> dict[str, list[str]]:
        """Folders of each stored table, by ``layer/table``."""
        for name in reversed(self._log()):
            found = self._snapshot(name)
            if found is not None:
                return found
        return {}

    def _publish(self, before: Mapping[str, list[str]], after: Mapping[str, list[str]]) -> None:
        """Makes ``after`` the last snapshot, if the tables that it changes are still those of ``before``."""
        changed = {t: f for t, f in after.items() if f != before.get(t)}
        while True:
            names = self._log()
            last = self.tables()
            if any(last.get(t) != before.get(t) for t in changed):
                raise Conflict(f"{self.root}: {', '.join(sorted(changed))} changed meanwhile")
            number = int(names[-1][:-5]) + 1 if names else 1
            text = json.dumps({"tables": {**last, **changed}}, sort_keys=True)
            # Of two runs that write the same number one fails to create it, and looks again.
            if self._files.create(f"{self.root}/_snapshots/{number:0{_DIGITS}}.json", text):
                return

    @contextmanager
    def transaction(self) -> Iterator[Transaction]:
        """Tables written inside are published all at once at its end, or not at all."""
        inner = Transaction(self)
        yield inner
        inner.publish()

    def expire(self, keep: int = 2, orphan_hours: float = 48) -> int:
        """Delete what none of the last ``keep`` snapshots has; the number of folders.

        These are folders of older snapshots, and folders of no snapshot that are older than
        ``orphan_hours``: runs that died have left them. Readers of a kept snapshot go on reading it.
        """
        known = {n: found for n in self._log() if (found := self._snapshot(n)) is not None}
        kept = sorted(known)[-keep:]
        old = {f for n in known if n not in kept for folders in known[n].values() for f in folders}
        held = {f for n in kept for folders in known[n].values() for f in folders}
        before = time.time() - orphan_hours * 3600
        gone = 0
        for layer in sorted({layer for layer, _ in TABLES}):
            for table in self._files.names(f"{self.root}/{layer}"):
                for version, changed in self._files.times(f"{self.root}/{layer}/{table}"):
                    folder = f"{layer}/{table}/{version}"
                    if folder not in held and (folder in old or changed < before):
                        self._files.delete(f"{self.root}/{folder}")
                        gone += 1
        for name in self._log():
            if kept and name < kept[0]:
                self._files.delete(f"{self.root}/_snapshots/{name}")
        return gone

    # Tables

    def path(self, layer: str, table: str) -> str:
        """A folder for what is no table; for a table the folder of its last version."""
        folders = self.tables().get(f"{layer}/{table}")
        return f"{self.root}/{folders[-1] if folders else f'{layer}/{table}'}"

    def read(self, layer: str, table: str) -> DataFrame:
        """A stored table; one that was never written reads as empty."""
        return self._read(layer, table, self.tables())

    def _read(self, layer: str, table: str, tables: Mapping[str, list[str]]) -> DataFrame:
        rows = self._parts(layer, table, tables)
        log = f"{table}_change"
        if not tables.get(f"{layer}/{log}"):
            return rows
        return latest(rows, self._parts(layer, log, tables))

    def _parts(self, layer: str, table: str, tables: Mapping[str, list[str]]) -> DataFrame:
        schema = TABLES[layer, table]
        if table == "timesheet":
            schema = T.StructType([*schema.fields, T.StructField("punch_month", T.StringType())])
        parts = [
            self.spark.read.schema(schema).parquet(f"{self.root}/{folder}")
            for folder in tables.get(f"{layer}/{table}", ())
        ]
        return reduce(DataFrame.unionAll, parts) if parts else self.spark.createDataFrame([], schema)

    def write(self, layer: str, table: str, df: DataFrame) -> int:
        """Replace a table as a whole; the return value is its row count. ``df`` may read the table itself."""
        with self.transaction() as inner:
            return inner.write(layer, table, df)

    def append(self, layer: str, table: str, df: DataFrame) -> int:
        """Add rows to a table; the return value is their number."""
        with self.transaction() as inner:
            return inner.append(layer, table, df)

    def _store(self, layer: str, table: str, df: DataFrame) -> tuple[str, int]:
        """Writes a new version; its folder below the root and its row count."""
        df = self._declared(layer, table, df)
        folder = f"{layer}/{table}/{uuid.uuid4().hex}"
        options = bloom_filters(*_READ_BY.get((layer, table), ()))
        months = ("punch_month",) if table == "timesheet" else ()
        df = clustered_timesheets(df) if months else df
        return folder, write_counted(df, f"{self.root}/{folder}", months, options)

    @staticmethod
    def _declared(layer: str, table: str, df: DataFrame) -> DataFrame:
        """The declared columns; other types than the declared ones could not be read back."""
        schema = TABLES[layer, table]
        df = df.select(*schema.names)
        other = [
            f"{have.name} is {have.dataType.simpleString()}, not {want.dataType.simpleString()}"
            for have, want in zip(df.schema, schema, strict=True)
            if have.dataType != want.dataType
        ]
        if other:
            raise ValueError(f"{layer}.{table}: {'; '.join(other)}")
        return df


class Transaction(Warehouse):
    """A warehouse as one run sees it: the tables at its begin, and what it has written since."""

    def __init__(self, warehouse: Warehouse):
        super().__init__(warehouse.spark, warehouse.root)
        self._before = super().tables()
        self._after = dict(self._before)

    def tables(self) -> dict[str, list[str]]:
        return self._after

    def write(self, layer: str, table: str, df: DataFrame) -> int:
        folder, rows = self._store(layer, table, df)
        # The rows are the table now, with all changes that they hold.
        log = {f"{layer}/{table}_change": []} if (layer, f"{table}_change") in TABLES else {}
        self._after = {**self._after, **log, f"{layer}/{table}": [folder]}
        return rows

    def clear(self, layer: str, table: str) -> None:
        """Leave a table without rows."""
        self._after = {**self._after, f"{layer}/{table}": []}

    def append(self, layer: str, table: str, df: DataFrame) -> int:
        folder, rows = self._store(layer, table, df)
        name = f"{layer}/{table}"
        if rows or not self._after.get(name):
            self._after = {**self._after, name: [*self._after.get(name, []), folder]}
        return rows

    def publish(self) -> None:
        if self._after != self._before:
            Warehouse(self.spark, self.root)._publish(self._before, self._after)
            self._before = self._after
