"""Session helpers: where intermediate tables live and how they are written.

Jobs that need a result twice write it once as Parquet under the folder the
cluster names in ``spark.checkpoint.dir``. A written table survives the loss of
any executor and is read back with column pruning, which a checkpointed RDD is
not.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_dir: str | None = None
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own.
    """
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="corploom-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/corploom/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a reader over the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if (mine := _staged.get()) is not None:
        mine.append(path)
    df.write.parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    read._staged = path
    return read


def discard(*staged: DataFrame) -> None:
    """Delete tables that :func:`stage` returned, once nothing reads them any more."""
    for df in staged:
        delete(df.sparkSession, df._staged)


SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs inside give back the disk of their shuffles when each ends, not when the driver's memory is cleaned."""
    before = spark.conf.get(SHUFFLES, None)
    spark.conf.set(SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES) if before is None else spark.conf.set(SHUFFLES, before)


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Delete the tables staged inside the block when it ends, for jobs whose
    result has been written elsewhere by then. Jobs in other threads keep
    theirs."""
    mine: list[str] = []
    outer = _staged.set(mine)
    try:
        yield
    finally:
        _staged.reset(outer)
        for name in mine:
            delete(spark, name)


def delete(spark: SparkSession, name: str) -> None:
    """Delete a folder, if it is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
