"""Numbers without gaps, and ids of business keys."""

import pytest
from pyspark.sql import functions as F

from muster.operators.numbering import new_ids, numbered


@pytest.mark.parametrize("rows, start", [(0, 0), (1, 5), (5000, 0), (5000, 10**12)])
def test_numbers_are_dense_and_in_order(spark, settings, rows, start):
    settings(shuffle__partitions="7", adaptive__coalescePartitions__enabled="false")
    df = spark.range(rows).select(F.md5(F.col("id").cast("string")).alias("key"), F.col("id").alias("other")).repartition(5)
    found = numbered(df, "key", start=start)
    got = sorted((r.number, r.key) for r in found.collect())
    assert [n for n, _ in got] == list(range(start + 1, start + rows + 1))
    assert [k for _, k in got] == sorted(k for _, k in got)
    if rows > 1:
        assert found.select(F.spark_partition_id()).distinct().count() > 1


def test_equal_and_missing_values_get_numbers_of_their_own(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",), (None,)], "key string")
    got = sorted((r.number, r.key) for r in numbered(df, "key").collect())
    assert got == [(1, None), (2, None), (3, "a"), (4, "b"), (5, "b")]


def test_keys_keep_their_ids(spark):
    known = spark.createDataFrame([(1, "x"), (7, "m")], "id long, code string")
    keys = spark.createDataFrame([("m",), ("z",), ("a",), ("x",)], "code string")
    assert sorted(map(tuple, new_ids(known, keys).collect())) == [(8, "a"), (9, "z")]
    assert new_ids(known, keys.filter("code in ('x', 'm')")).isEmpty()
