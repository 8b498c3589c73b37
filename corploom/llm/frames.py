"""Small helpers the operators share: columns of an Arrow batch, checked names,
folders the cluster shares and files in them."""

from __future__ import annotations

import io
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.functions.workers import frugal, give_back  # noqa: F401
from corploom.session import stage

BATCH_BYTES = 4 << 20
BLANKS = " \t\n\x0b\x0c\r"
"""The characters of ``[\\x20\\x09-\\x0D]``."""


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under names no other column can clash with."""
    return df.select(*[F.col(f"`{name}`").alias(alias) for alias, name in columns.items()])


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns renamed ``c0``, ``c1`` and so on, so that columns added to it
    cannot clash, and the new name of each."""
    names = {name: f"c{i}" for i, name in enumerate(df.columns)}
    return df.select(*[F.col(f"`{name}`").alias(new) for name, new in names.items()]), names


def restored(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of :func:`numbered` under their own names, without others."""
    return df.select(*[F.col(new).alias(name) for name, new in names.items()])


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs inside send texts to Python in batches of ``BATCH_BYTES``, so that a worker's
    memory does not follow the length of the documents."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stage_small(df: DataFrame, label: str) -> DataFrame:
    """:func:`stage` with :func:`small_batches`."""
    with small_batches(df.sparkSession):
        return stage(df, label)


def text_of(column: str = "text") -> Column:
    """Null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def table(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def texts(batch: pa.RecordBatch, column: int) -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def in_parts(values: Iterator, size: int) -> Iterator[list]:
    part: list = []
    for value in values:
        part.append(value)
        if len(part) >= size:
            yield part
            part = []
    if part:
        yield part


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a folder every executor reaches (a path, file:,
    hdfs:, s3: or gs:)."""
    uri = re.sub(r"^file:/*", "/", uri)
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, name: str, data: bytes) -> None:
    system, root = file_system(uri)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/{name}", compression=None) as out:
        out.write(data)


def read_file(uri: str, name: str, offset: int = 0, size: int | None = None) -> bytes:
    system, root = file_system(uri)
    with system.open_input_file(f"{root}/{name}") as file:
        if size is None:
            return file.read()
        return file.read_at(size, offset)


def buffered(uri: str, name: str) -> io.BufferedReader:
    system, root = file_system(uri)
    return io.BufferedReader(system.open_input_stream(f"{root}/{name}", compression=None), 1 << 20)
