"""Workforce tables derived with Spark from the star-schema test tables.

Customers outside one market segment play the employees, nations the departments,
regions the organizations, and events the shifts; events of the left-out customers
are the orphans. ``raw_*`` are the text tables a landing would produce, with the
same people and shifts written in mixed formats and with dirty fields.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from muster.functions.attendance import attendance_flags
from muster.operators.conform import timestamp
from muster.schemas import EMPLOYEE_FILE_COLUMNS, TABLES, TIMESHEET_FILE_COLUMNS

AS_OF = dt.date(2002, 1, 1)
RUN_AT = dt.datetime(2002, 1, 1, 6, 0)

_SCHEMAS: dict[str, StructType] = {}


def case(key: str, values: dict, default=None) -> Column:
    """CASE expression over one column."""
    expr = F
    for match, value in values.items():
        expr = expr.when(F.col(key) == match, value)
    return expr.otherwise(default)


def _as_table(df: DataFrame, layer: str, table: str, **values: Column) -> DataFrame:
    """Select the declared columns; those not given are null."""

    def column(name: str, kind: str) -> Column:
        if name in values:
            return values[name].cast(kind).alias(name)
        return F.expr(f"cast(null as {kind}) as {name}")

    schema = TABLES[layer, table]
    return df.select(*(column(f.name, f.dataType.simpleString()) for f in schema.fields))


@dataclass(frozen=True)
class Views:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        """A test table; its schema is looked up in the file only once."""
        path, reader = f"{self.folder}/{name}.parquet", self.spark.read
        if path in _SCHEMAS:
            reader = reader.schema(_SCHEMAS[path])
        df = reader.parquet(path)
        _SCHEMAS[path] = df.schema
        return df

    @cached_property
    def people(self) -> DataFrame:
        """Customers with nation and region."""
        customer = self.table("customer").filter("c_mktsegment <> 'BUILDING'")
        return customer.join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))

    @cached_property
    def employed(self) -> DataFrame:
        """People with their first order day and, for some, the next order day."""
        by_customer = Window.partitionBy("o_custkey")
        days = self.table("orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("d"))
        employment = (
            days.distinct()
            .withColumn("hire_date", F.min("d").over(by_customer))
            .groupBy("o_custkey", "hire_date")
            .agg(F.min(F.when(F.col("d") > F.col("hire_date"), F.col("d"))).alias("next_date"))
        )
        return self.people.join(
            employment, F.col("o_custkey") == F.col("c_custkey"), "left"
        ).withColumn("term_date", F.when(F.col("c_acctbal") < 1000, F.col("next_date")))

    @cached_property
    def employee(self) -> DataFrame:
        """Employees with all their columns."""
        return self._employees(
            self.employed,
            hire_date=F.col("hire_date"),
            term_date=F.col("term_date"),
            active_status=F.col("term_date").isNull(),
        )

    @cached_property
    def staff(self) -> DataFrame:
        """Employees for the shift reports, which read no employment dates."""
        return self._employees(self.people)

    @staticmethod
    def _employees(people: DataFrame, **dates: Column) -> DataFrame:
        col = F.col
        return _as_table(
            people,
            "silver",
            "employee",
            **dates,
            id=col("c_custkey"),
            client_employee_id=col("c_custkey"),
            first_name=col("c_name"),
            last_name=col("c_mktsegment"),
            organization_id=col("n_regionkey"),
            department_id=F.when(col("c_acctbal") >= 0, col("c_nationkey")),
            manager_employee_id=col("c_custkey") * 2,
            scheduled_weekly_hour=F.when(F.abs("c_acctbal") < 999, col("c_acctbal")),
            years_of_experience=col("c_acctbal"),
            created_at=timestamp(RUN_AT),
            updated_at=timestamp(RUN_AT),
        )

    @cached_property
    def organization(self) -> DataFrame:
        return _as_table(
            self.table("region"),
            "silver",
            "organization",
            id=F.col("r_regionkey"),
            code=F.col("r_name"),
            name=F.col("r_name"),
        )

    @cached_property
    def department(self) -> DataFrame:
        return _as_table(
            self.table("nation"),
            "silver",
            "department",
            id=F.col("n_nationkey"),
            code=F.col("n_name"),
            name=F.col("n_name"),
            organization_id=F.col("n_regionkey"),
        )

    @cached_property
    def shifts(self) -> DataFrame:
        """Events as shifts with plan and punches."""
        hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
        planned = F.col("event_type") != "error"
        seconds = F.floor(F.col("value") * 60)

        def later(c: Column, hours=0, seconds=0) -> Column:
            zero = F.lit(0)
            return c + F.make_dt_interval(zero, F.lit(hours), zero, F.lit(seconds))

        return self.table("events").select(
            "event_id",
            "user_id",
            "event_type",
            "value",
            "props",
            F.col("ts").alias("punch_in"),
            (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).alias("punch_out"),
            F.when(planned, hour).alias("planned_start"),
            F.when(planned, later(hour, hours=1)).alias("planned_end"),
        )

    @cached_property
    def timesheet(self) -> DataFrame:
        """Typed shifts, orphans included."""
        col = F.col
        moments = {
            "punch_in_datetime": col("punch_in"),
            "punch_out_datetime": col("punch_out"),
            "scheduled_start_datetime": col("planned_start"),
            "scheduled_end_datetime": col("planned_end"),
        }
        return _as_table(
            self.shifts,
            "silver",
            "timesheet",
            id=col("event_id"),
            client_employee_id=col("user_id"),
            pay_code=col("event_type"),
            punch_apply_date=col("punch_in"),
            hours_worked=F.when(col("event_type") != "signup", col("value")),
            source_file=F.concat(F.lit("timesheet_"), "event_type", F.lit(".csv")),
            created_at=timestamp(RUN_AT),
            **moments,
            **attendance_flags(*moments.values()),
        )

    @cached_property
    def raw_employee(self) -> DataFrame:
        """Employees as dirty text."""
        col, iso = F.col, "yyyy-MM-dd"
        hire = {
            "HOUSEHOLD": F.date_format("hire_date", iso),
            "MACHINERY": F.date_format("hire_date", "MM/dd/yyyy"),
            "FURNITURE": F.date_format("hire_date", "yyyyMMdd"),
        }
        padded = F.concat(F.lit(" "), col("c_custkey").cast("string"), F.lit("\t"))
        return _as_table(
            self.employed,
            "bronze",
            "raw_employee",
            id=col("c_custkey"),
            client_employee_id=case("c_mktsegment", {"HOUSEHOLD": padded}, col("c_custkey").cast("string")),
            first_name=col("c_name"),
            middle_name=case("n_regionkey", {0: "NULL", 1: " nan ", 2: " M ", 3: ""}),
            last_name=F.concat(F.lit("\t"), "c_mktsegment"),
            job_title=case("n_regionkey", {4: "None"}, col("n_name")),
            job_start_date=F.date_format("hire_date", "dd/MM/yyyy"),
            organization_id=col("r_name"),
            organization_name=F.when(col("c_acctbal") >= -500, F.concat_ws(" ", "r_name", "c_mktsegment")),
            department_id=col("c_mktsegment"),
            department_name=F.when(col("c_acctbal") > 9500, "null").otherwise(col("n_name")),
            hire_date=case("c_mktsegment", hire, F.concat(F.date_format("hire_date", iso), F.lit(" 00:00:00"))),
            term_date=F.when(col("c_acctbal") < -900, "not a date").otherwise(
                F.date_format("term_date", iso)
            ),
            years_of_experience=case("n_regionkey", {0: "abc", 1: "NaN"}, col("c_acctbal").cast("string")),
            manager_employee_id=(col("c_custkey") * 2).cast("string"),
            is_per_deim=case("n_regionkey", {0: "YES", 1: " true ", 2: "0", 3: "x"}),
            scheduled_weekly_hour=F.concat(F.lit(" "), col("c_acctbal").cast("string")),
            active_status=F.when(col("term_date").isNull(), "1").otherwise(" False "),
            loaded_at=timestamp(RUN_AT),
            source_file=F.concat(F.lit("employee_"), F.lower("r_name"), F.lit(".csv")),
        )

    @cached_property
    def raw_timesheet(self) -> DataFrame:
        """Shifts as dirty text; some carry no employee id."""
        col = F.col

        def written(name: str) -> Column:
            formats = {
                "view": F.date_format(name, "MM/dd/yyyy HH:mm:ss"),
                "click": F.date_format(name, "MM/dd/yyyy hh:mm:ss a"),
            }
            return case("event_type", formats, col(name).cast("string"))

        user = col("user_id").cast("string")
        return _as_table(
            self.shifts,
            "bronze",
            "raw_timesheet",
            id=col("event_id"),
            client_employee_id=F.when(col("event_type") == "purchase", F.concat(F.lit(" "), user)).when(
                col("value") >= 1, user
            ),
            pay_code=col("event_type"),
            punch_in_comment=F.lit("null"),
            punch_out_comment=col("props"),
            hours_worked=case("event_type", {"signup": "NULL"}, col("value").cast("string")),
            punch_apply_date=written("punch_in"),
            punch_in_datetime=written("punch_in"),
            punch_out_datetime=written("punch_out"),
            scheduled_start_datetime=written("planned_start"),
            scheduled_end_datetime=written("planned_end"),
            loaded_at=timestamp(RUN_AT),
            source_file=F.concat(F.lit("timesheet_"), "event_type", F.lit(".csv")),
        )

    def write_employee_file(self, path: str) -> None:
        self._write_csv(self.raw_employee.select(*EMPLOYEE_FILE_COLUMNS), path)

    def write_timesheet_files(self, path: str) -> None:
        """Two sets of files whose columns are in opposite order."""
        planned = F.col("pay_code") != "error"
        rows = self.raw_timesheet
        self._write_csv(rows.filter(planned).select(*TIMESHEET_FILE_COLUMNS), f"{path}/planned")
        self._write_csv(
            rows.filter(~planned).select(*reversed(TIMESHEET_FILE_COLUMNS)), f"{path}/unplanned"
        )

    def write_source_files(self, path: str) -> None:
        """All files in one folder, named as a refresh looks for them."""
        self.write_employee_file(f"{path}/parts/employee")
        self.write_timesheet_files(f"{path}/parts/timesheet")
        jvm = self.spark._jvm
        name = jvm.org.apache.hadoop.fs.Path
        files = name(path).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        for kind, parts in (("employee", "employee"), ("timesheet", "timesheet/planned"), ("timesheet", "timesheet/unplanned")):
            for found in files.globStatus(name(f"{path}/parts/{parts}/part*.csv")):
                part = found.getPath()
                files.rename(part, name(f"{path}/{kind}_{parts.split('/')[-1]}_{part.getName()}"))

    @staticmethod
    def _write_csv(df: DataFrame, path: str) -> None:
        df.write.options(
            sep="|",
            header=True,
            escape='"',
            nullValue="[NULL]",
            emptyValue="",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        ).csv(path)
