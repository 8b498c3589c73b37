"""Text files of any size as blocks, so that many tasks share a file.

A file is cut into byte ranges, each range is moved on to the next place where the tokenizer
may be cut, and reading goes on past its end to the place where the following one begins. Each
task finds both places by itself, so ranges fit together without gaps and no text is moved. Ranges
are dealt to tasks in the order of paths, about ``TASK_BYTES`` each, whatever the sizes of the files.

Where to cut depends on the tokenizer (its ``cuts``): ``blank``, before white space that follows an ASCII
letter or sign, where no word or part goes across; ``char``, between characters; ``None``, nowhere,
and files stay whole. A file without such a place is one block.

Files are read through Arrow's file systems (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import islice
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.operators.ordering import MAX_SLOTS, key_cuts, slot_of
from corploom.session import stage

BLOCK_BYTES = 16 << 20
TASK_BYTES = 64 << 20
STEP = 1 << 16
BATCH_BYTES = 1 << 20
PACKED = {"gz": "gzip", "bz2": "bz2", "zst": "zstd"}
LISTED = 10_000  # files of a listing that are handed on at once
CUTS = {"blank": re.compile(rb"(?<=[\x21-\x7e])[ \t\n\r]"), "char": re.compile(rb"[\x00-\x7f\xc0-\xff]")}
BLOCK = "file_path string, file_block_start bigint, is_last boolean, text binary"


def open_file(path: str) -> pa.NativeFile:
    """A file of Spark's listing, by its plain path or URI."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    parts = urlsplit(path)
    if not parts.scheme:
        return pafs.LocalFileSystem().open_input_file(path)
    system, inner = pafs.FileSystem.from_uri(f"{parts.scheme}://{parts.netloc}{quote(path.split(parts.netloc, 1)[1])}")
    return system.open_input_file(inner)


def next_cut(file: pa.NativeFile, at: int, size: int, cut: re.Pattern) -> int:
    """The first place from ``at`` on where the file may be cut, or its end."""
    if at <= 0 or at >= size:
        return max(0, min(at, size))
    before = at - 1  # this byte says whether a cut may be right after it
    while before + 1 < size:
        held = file.read_at(min(STEP, size - before), before)
        if found := cut.search(held, 1):
            return before + found.start()
        before += len(held) - 1
    return size


def read_block(path: str, start: int, end: int, size: int, cut: re.Pattern | None) -> bytes:
    with open_file(path) as file:
        low, high = (start, end) if cut is None else (next_cut(file, start, size, cut), next_cut(file, end, size, cut))
        return file.read_at(high - low, low) if low < high else b""


def unpacked(path: str, data: bytes) -> bytes:
    """As Spark's scans have it, by the end of the name."""
    if codec := PACKED.get(path.rsplit("/", 1)[-1].rpartition(".")[2]):
        with pa.CompressedInputStream(pa.BufferReader(data), codec) as file:
            return file.read()
    return data


FILE = "file_path string, path string, length bigint, is_folder boolean"
ARROW_SCHEMES = {"file", "hdfs", "viewfs", "s3", "gs"}


def hidden(name: str) -> bool:
    """As Spark's scans have it."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name and not name.startswith(("_metadata", "_common_metadata")))


def _entries(uri: str) -> Iterator[tuple]:
    """``FILE`` rows of what a folder holds."""
    head = URI_HEAD.match(uri).group()
    if head.startswith("file:"):
        system, folder = pafs.LocalFileSystem(), uri[len(head) - 1 :]
    else:
        system, folder = pafs.FileSystem.from_uri(f"{head}{quote(uri[len(head) :])}")
    for info in system.get_file_info(pafs.FileSelector(folder)):
        is_folder = info.type == pafs.FileType.Directory
        if not hidden(info.base_name) and (is_folder or info.size > 0):
            path = f"{uri.rstrip('/')}/{info.base_name}"
            yield as_uri(path), path, None if is_folder else info.size, is_folder


URI_HEAD = re.compile(r"[a-z][a-z0-9+.-]*:(//[^/]*)?/*", re.I)
QUOTED = re.compile(r"[\x00-\x20\x7f-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\"#%<>?\[\\\]^`{|}]")


def as_uri(path: str) -> str:
    """A path of Hadoop's as Spark's ``_metadata.file_path`` has it: other letters than ASCII stand for themselves."""
    head = URI_HEAD.match(path).group()
    return head + QUOTED.sub(lambda c: quote(c.group()), path[len(head) :])


def _listed_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types, names = [pa.string(), pa.string(), pa.int64(), pa.bool_()], ["file_path", "path", "length", "is_folder"]
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            entries = _entries(folder)
            while rows := list(islice(entries, LISTED)):
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names)


def _hadoop(spark: SparkSession, folder: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def arrow_reads(spark: SparkSession, folder: str) -> bool:
    return _hadoop(spark, folder)[0].getScheme() in ARROW_SCHEMES


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(file_path, path, length)`` of the files below a folder (or of a file, or what a pattern names) that are not empty. Each level's
    folders are listed by a few tasks for each core and written, so that no file's name comes to the driver but those
    the pattern names itself. File systems that Arrow does not know are listed by Spark, in the driver."""
    system, where = _hadoop(spark, folder)
    if system.getScheme() not in ARROW_SCHEMES:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        return files.select(F.col("_metadata.file_path").alias("file_path"), "path", "length")
    top = list(system.globStatus(where) or ())
    if not top:
        raise AnalysisException(f"[PATH_NOT_FOUND] Path does not exist: {folder}.")
    found = [(one.getPath().toString(), one.getLen(), one.isDirectory()) for one in top if one.isDirectory() or not hidden(one.getPath().getName())]
    levels = [spark.createDataFrame([(as_uri(p), p, n, False) for p, n, is_folder in found if not is_folder and n > 0], FILE)]
    folders = spark.createDataFrame([(p,) for p, _, is_folder in found if is_folder], "path string")
    tasks = 8 * spark.sparkContext.defaultParallelism
    while n := folders.count():
        level = stage(folders.repartition(min(n, tasks)).mapInArrow(_listed_entries, FILE), "text-files")
        levels.append(level.where("not is_folder"))
        folders = level.where("is_folder").select("path")
    return reduce(DataFrame.unionByName, levels).select("file_path", "path", "length")


def scan_text_blocks(
    spark: SparkSession, folder: str, cuts: str | None = "blank", block: int = BLOCK_BYTES, files: DataFrame | None = None, unpack: bool = False
) -> DataFrame:
    """``(file_path, file_block_start, is_last, text)``: the blocks of a folder's files, in the order of paths
    and places along tasks. A block's ``text`` may be empty. Spark
    scans no empty files, so these have no block. The
    listing is staged; the caller's job deletes it. ``files`` are some of :func:`list_files`, else all. ``unpack`` is for whole files."""
    files = list_files(spark, folder) if files is None else files
    step = block if cuts else 1 << 62
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(step).cast("bigint"))
    ranges = files.withColumn("start", F.explode(starts)).withColumn("end", F.least(F.col("start") + step, "length"))
    ranges = ranges.withColumn("key", F.concat("file_path", F.lit("\0"), F.lpad(F.col("start").cast("string"), 20, "0")))
    listing = stage(ranges.withColumn("bytes", F.col("end") - F.col("start")), "text-ranges")
    sums = listing.agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes")).first()
    wanted = max(-(-(sums.bytes or 0) // TASK_BYTES), min(2 * spark.sparkContext.defaultParallelism, sums.rows))
    slots = max(1, min(MAX_SLOTS, wanted))
    at = key_cuts(listing, "key", slots, sums.rows, "bytes")
    dealt = listing.repartitionById(len(at) + 1, slot_of("key", at)).sortWithinPartitions("key")
    cut = CUTS[cuts] if cuts else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.bool_(), pa.binary()]
        names = ["file_path", "file_block_start", "is_last", "text"]
        for batch in batches:
            rows, held = [], 0  # small files go on together
            for name, path, start, end, size in zip(*(column.to_pylist() for column in batch.columns)):
                text = read_block(path, start, end, size, cut)
                rows.append((name, start, end == size, unpacked(path, text) if unpack else text))
                held += len(rows[-1][-1])
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names)

    blocks = dealt.select("file_path", "path", "start", "end", "length").mapInArrow(read, BLOCK)
    return blocks.withColumn("text", F.col("text").cast("string"))
