"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths of the run that is going on, the oldest first; None outside of any.
_RUN: ContextVar[list[str] | None] = ContextVar("run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset, a folder of our own is set in local mode, in which driver
    and executors are one process; anywhere else it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        folder = f"{tempfile.gettempdir()}/tickloom-{spark.sparkContext.applicationId}"
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: lineage ends here.

    The files go when a run says so (``scratch``), else when the driver exits.
    They are packed by zstd, whose buffers are heap arrays: those of snappy lie
    off the heap until some late collection, beyond what an executor's heap bounds.
    """
    spark = df.sparkSession
    target = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(target)
    path, system = _path(spark, target)
    system.deleteOnExit(path)
    written = _RUN.get()
    if written is not None:
        written.append(target)
    return spark.read.schema(df.schema).parquet(target)


@contextmanager
def scratch() -> Iterator[list[str]]:
    """The paths that ``stored`` writes meanwhile, in this run alone."""
    written: list[str] = []
    token = _RUN.set(written)
    try:
        yield written
    finally:
        _RUN.reset(token)


def sweep(spark: SparkSession, written: list[str]) -> None:
    """Delete a run's tables but the last; call it once nothing older of it is read any more."""
    while len(written) > 1:
        path, system = _path(spark, written.pop(0))
        system.delete(path, True)
