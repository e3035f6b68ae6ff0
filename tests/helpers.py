"""Helpers of the tests; under this name no other folder of tests has a module."""

import datetime as dt

NOW = dt.datetime(2026, 1, 2, 3, 4, 5)


def day(text):
    return dt.date.fromisoformat(text)


def moment(text):
    return dt.datetime.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def values(spark, texts, make):
    """Function of a column name applied to a list of texts, in order."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.v for r in df.select("i", make("t").alias("v")).orderBy("i").collect()]
