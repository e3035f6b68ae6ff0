"""Compare every registered query with its SQL: python -m verification.compare [folder] [key ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from muster.session import build_session
from verification import oracle
from verification.queries import registered


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of_spark(df: DataFrame) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple(_plain(v) for v in row) for row in df.select(*names).collect())


def rows_of_sql(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())
    return sorted(names), rows


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def main(folder: str = "/root/testdata/sf0.01", *keys: str) -> int:
    spark = build_session("compare", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    connection, statements, bad = connect(folder), oracle.statements(), 0
    for key, function in registered().items():
        if keys and key not in keys:
            continue
        start = time.perf_counter()
        try:
            df = function(spark, folder)
            ours = rows_of_spark(df)
            seconds = time.perf_counter() - start
            names, theirs = rows_of_sql(connection, statements[key])
        except Exception as error:  # report and go on with the next query
            print(f"ERROR {key}: {str(error)[:600]}")
            bad += 1
            continue
        same = sorted(df.columns) == names and ours == theirs
        print(f"{'ok' if same else 'DIFF'} {key}: {ours.total()} rows, {seconds:.2f} s")
        if not same:
            bad += 1
            print("  columns", sorted(df.columns), names)
            print("  only ours  ", list((ours - theirs).items())[:3])
            print("  only theirs", list((theirs - ours).items())[:3])
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
