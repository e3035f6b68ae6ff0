"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What the plans rely on: AQE re-plans joins from measured sizes, splits skewed
# join partitions, and coalesces small shuffle partitions, so the shuffle count
# is an upper bound and not a tuning knob per query.
_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Wide cleaning projections compile into methods that the JVM would only
    # interpret; above this size the engine splits them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}

# On a cluster AQE merges shuffle partitions up to the advisory size, which is also the
# size of a rebalanced write. Larger scan splits keep the task count of a full scan in
# bounds.
_PARTITION_BYTES = 256 << 20
_CLUSTER_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_PARTITION_BYTES),
    "spark.sql.files.maxPartitionBytes": str(_PARTITION_BYTES),
}
# Merging only goes one way, so shuffles start from one partition per advisory size of
# the input; more than the upper bound would cost the driver more than it saves a task.
_FEWEST, _MOST = 1024, 400_000


def initial_partitions(input_bytes: int) -> int:
    """Shuffle partitions to start from, so that none exceeds the advisory size if all input is shuffled."""
    return min(_MOST, max(_FEWEST, -(-input_bytes // _PARTITION_BYTES)))


def build_session(
    app: str = "muster",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    input_bytes: int = 2 << 40,
    **extra: str,
) -> SparkSession:
    """Session with the settings above; ``master`` only for local runs.

    On a cluster ``input_bytes``, the size of what a job reads, sets how many partitions
    its shuffles start from.
    """
    builder = SparkSession.builder.appName(app)
    settings = dict(_SETTINGS)
    if master:
        builder = builder.master(master)
    else:
        settings.update(_CLUSTER_SETTINGS)
        start = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        settings[start] = str(initial_partitions(input_bytes))
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_MADE: list[str] = []


@functools.cache
def _local_scratch() -> str:
    """Folder of a local process, which goes when the process ends."""
    base = tempfile.mkdtemp(prefix="muster-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """New folder below the cluster's shared scratch space.

    The space is the one named by ``spark.checkpoint.dir``. Only a local session,
    where driver and executors share one disk, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the executors")
        base = _local_scratch()
    _MADE.append(f"{base.rstrip('/')}/muster-{purpose}-{uuid.uuid4().hex}")
    return _MADE[-1]


def remove_scratch(spark: SparkSession, first: int = 0) -> None:
    """Delete the shared folders of this process, from the ``first`` on; results that read them must be
    stored before."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    while len(_MADE) > first:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Shared folders that are made inside go at its end, also if it fails."""
    first = len(_MADE)
    try:
        yield
    finally:
        remove_scratch(spark, first)
