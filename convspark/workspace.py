"""Where intermediate tables go: the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: A table of counts is broadcast up to this many rows, a few dozen megabytes at most.
BROADCAST_ROWS = 200_000

_local_roots: dict[str, str] = {}
_scopes: list[list[str]] = []


def work_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, visible to every executor.

    The setting of the session wins. Only a session in local mode, where the driver's disk *is* the
    shared disk, gets a folder of its own when nothing is set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/") + "/convspark"
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="convspark-")
    return _local_roots[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below :func:`work_dir`."""
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, as Spark's own readers and writers see them."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


@contextmanager
def job_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are deleted at the end, so results must be written inside, too.

    Scopes may be nested; each deletes its own tables. After an error the tables are deleted as well.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            target, filesystem = hadoop_path(spark, path)
            filesystem.delete(target, True)


def materialise(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a table and return a scan of it.

    Cuts the lineage of iterative jobs, survives lost executors, and gives the optimiser the real
    size, so that a later join broadcasts the table only when it is small enough.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Mark a table of known size for broadcast, or leave the join to the optimiser beyond the limit."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def materialise_counting(
    df: DataFrame, label: str, condition: Column | None = None, compression: str = "snappy"
) -> tuple[DataFrame, int]:
    """:func:`materialise`, and the number of rows (that meet the condition), from the same job."""
    counted = Observation()
    counter = F.count(F.lit(1)) if condition is None else F.count_if(condition)
    table = materialise(df.observe(counted, counter.alias("n")), label, compression)
    return table, counted.get.get("n", 0)
