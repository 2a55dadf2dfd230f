"""Intermediate tables in the folder shared by all executors.

A table that several jobs read is written once and read back, which cuts its
lineage: a lost executor costs the re-reading of a file, not a retraining. The
shuffles that a table came from go as soon as it is written.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from threading import Lock

from pyspark.sql import DataFrame, Row, SparkSession

# Spark's setting by which a query's shuffle files go at its end, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folders: dict[str, str] = {}
_open: ContextVar[list[str] | None] = ContextVar("open", default=None)
# Sessions within ``passing_shuffles``: how often, and what was set before.
_inside: dict[SparkSession, list] = {}
_lock = Lock()


def workspace(spark: SparkSession) -> str:
    """The shared folder of the cluster, as ``spark.checkpoint.dir`` names it.

    Only a local session may go without: it has one machine, so that a
    temporary folder is shared by definition.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors can reach.")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="perplexis-")
    return _local_folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries begun within delete their shuffle files as they end: for those whose frame isn't run a second time."""
    with _lock:
        before = _inside.setdefault(spark, [0, spark.conf.get(CLEANUP, None)])
        before[0] += 1
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            before[0] -= 1
            if not before[0]:
                del _inside[spark]
                spark.conf.unset(CLEANUP) if before[1] is None else spark.conf.set(CLEANUP, before[1])


def first_row(df: DataFrame) -> Row | None:
    """The first row, without leaving shuffle files behind."""
    with passing_shuffles(df.sparkSession):
        return df.first()


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet and read back; within ``cleared`` until that ends, unless it has a path of its own."""
    passing = _open.get()
    if path is None:
        path = new_path(df.sparkSession, name)
        if passing is not None:
            passing.append(path)
    with passing_shuffles(df.sparkSession):
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what is stored within, but for tables stored under a path given to them.

    Nothing that is read later may depend on the others.
    """
    paths: list[str] = []
    token = _open.set(paths)
    try:
        yield
    finally:
        _open.reset(token)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


# Inputs up to this size are dealt out over all cores before work begins.
SMALL_BYTES = 256 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Spark's estimate of the table's size, from its files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def task_bytes(df: DataFrame) -> int:
    """About how many bytes of a stored table Spark gives to one task."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return min(int(conf.filesMaxPartitionBytes()), estimated_bytes(df) // df.sparkSession.sparkContext.defaultParallelism)


def spread(df: DataFrame) -> DataFrame:
    """A small input, which may be a single split, dealt out evenly over the cores.

    Splits follow row groups, so that a small file may be one task. An input of
    more than ``SMALL_BYTES`` stays as it is, whatever the cluster: its text
    never shuffles.
    """
    if estimated_bytes(df) > SMALL_BYTES:
        return df
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)
