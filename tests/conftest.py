import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from muster.schemas import TABLES  # noqa: E402
from muster.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[8]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set SQL options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def table(spark):
    """Rows of a declared table from dicts; columns not given are null."""

    def build(layer, name, *rows):
        schema = TABLES[layer, name]
        for row in rows:
            assert set(row) <= set(schema.names), set(row) - set(schema.names)
        return spark.createDataFrame([[row.get(c) for c in schema.names] for row in rows], schema)

    return build
