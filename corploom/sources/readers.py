"""Scans: JSON lines, text folders, named datasets, prepared shards, logs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.session import stage
from corploom.sources.text_blocks import arrow_reads, list_files, scan_text_blocks

BAD_RECORD = "_bad_record"


def scan_jsonl(
    spark: SparkSession,
    path: str,
    text_col: str = "text",
    id_cols: str = "doc_id bigint",
    bad_records: str = "keep",
) -> DataFrame:
    """JSON-lines corpus with a declared schema, so no pass is spent inferring.

    ``bad_records``: ``keep`` lines that do not parse in ``_bad_record`` (null for
    good lines), ``fail``, or ``drop`` them.
    """
    fields = ", ".join(f for f in (id_cols, f"{text_col} string") if f)
    modes = {"drop": "DROPMALFORMED", "keep": "PERMISSIVE", "fail": "FAILFAST"}
    reader = spark.read.option("mode", modes[bad_records])
    if bad_records == "keep":
        fields += f", {BAD_RECORD} string"
        reader = reader.option("columnNameOfCorruptRecord", BAD_RECORD)
    return reader.schema(fields).json(path)


def scan_order(df: DataFrame) -> DataFrame:
    """Where each row of a file scan comes from: ``file_path``, ``file_block_start`` and
    ``position``, which grows along a block. Rows are in this order in every task."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
        F.monotonically_increasing_id().alias("position"),
    )


def fix_scan_order(df: DataFrame, out: str = "ord") -> DataFrame:
    """Give rows without an id an order, fixed once by writing it; the caller
    deletes the table.

    File, then block within the file, then position within the block.
    """
    order = F.concat_ws(
        ":",
        "file_path",
        F.lpad(F.col("file_block_start").cast("string"), 16, "0"),
        F.lpad(F.col("position").cast("string"), 20, "0"),
    )
    rows = scan_order(df).withColumn(out, order).drop("file_path", "file_block_start", "position")
    return stage(rows, "ordered-scan")


def scan_text(spark: SparkSession, folder: str) -> DataFrame:
    """Text folder, one row per file: ``(file_path, text)``. Files are listed and read by tasks, however many they are; Spark
    reads those of file systems Arrow does not know and the few kinds packed as Arrow cannot unpack them. The
    listing is staged; the caller's job deletes it."""
    if not arrow_reads(spark, folder):
        return _wholetext(spark, [folder])
    files = list_files(spark, folder)
    other = F.col("path").rlike(r"\.(deflate|lz4|snappy)$")
    rows = scan_text_blocks(spark, folder, None, files=files.where(~other), unpack=True).select("file_path", "text")
    rest = [re.sub(r"([\\*?\[\]{}])", r"\\\1", r.path) for r in files.where(other).select("path").collect()]
    return rows.unionByName(_wholetext(spark, rest)) if rest else rows


def _wholetext(spark: SparkSession, paths: list[str]) -> DataFrame:
    rows = spark.read.option("recursiveFileLookup", "true").text(paths, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text"))


def scan_dataset(
    spark: SparkSession, root: str, subset: str | None = None, splits: tuple[str, ...] = ()
) -> DataFrame:
    """Parquet dataset partitioned by ``subset`` and ``split``; both prune folders."""
    rows = spark.read.parquet(root)
    if subset is not None:
        rows = rows.where(F.col("subset") == subset)
    if splits:
        rows = rows.where(F.col("split").isin(*splits))
    return rows


def scan_instructions(spark: SparkSession, root: str, split: str) -> DataFrame:
    """Instruction records of one split."""
    return scan_dataset(spark, root, splits=(split,))


MANIFEST = (
    "n_samples bigint, n_tokens bigint, seq_len int, tokenizer string, eos_id int, n_shards int, n_bad bigint, split string"
)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row per split, each written with its split."""
    return spark.read.schema(MANIFEST).parquet(f"{root}/_manifest")


def scan_shards(
    spark: SparkSession,
    root: str,
    split: str,
    tokenizer: str | None = None,
    seq_len: int | None = None,
) -> DataFrame:
    """One split of prepared shards, after checking the manifest.

    A split that was never written, or shards made with another tokenizer or
    length than asked for, are an error rather than an empty or wrong table.
    """
    known = {r.split: r for r in read_manifest(spark, root).collect()}  # one row per split
    if split not in known:
        raise ValueError(f"split {split!r} is not in {root}; written: {sorted(known)}")
    entry = known[split]
    if tokenizer is not None and entry.tokenizer != tokenizer:
        raise ValueError(f"shards were made with tokenizer {entry.tokenizer!r}, not {tokenizer!r}")
    if seq_len is not None and entry.seq_len != seq_len:
        raise ValueError(f"shards hold {entry.seq_len} tokens per sample, not {seq_len}")
    return spark.read.parquet(root).where(F.col("split") == split)


def scan_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Log lines so far: ``(file_path, line)``."""
    return spark.read.text(folder).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("line")
    )


def follow_logs(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Log lines as they arrive."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("line")
    )


def preview(df: DataFrame, n: int = 10, order_by: str | Column | None = None) -> DataFrame:
    """First ``n`` rows; ordered, each task keeps only its own ``n``."""
    return (df if order_by is None else df.orderBy(order_by)).limit(n)
