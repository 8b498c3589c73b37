"""Sinks: compressed shards with a manifest, indexed tokens, pairs, namespaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.functions.tokenizers import tokenizer as find_tokenizer
from corploom.sources.readers import read_manifest


def ensure_namespace(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database if absent. The catalog is the session's
    ``spark.sql.catalog.*`` setting and a volume is a path."""
    name = database.replace("`", "``")
    at = " LOCATION '{}'".format(location.replace("\\", "\\\\").replace("'", "\\'")) if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{at}")


def manifest(
    spark: SparkSession,
    root: str,
    split: str,
    seq_len: int | None = None,
    tok=None,
    tokens: bool = True,
    n_bad: int | None = None,
) -> DataFrame:
    """The row of one split, counted from the files written."""
    chosen = find_tokenizer(tok) if tok is not None else None
    return spark.read.parquet(f"{root}/split={split}").agg(
        F.count("*").alias("n_samples"),
        (F.sum("n_tokens") if tokens else F.lit(None)).cast("bigint").alias("n_tokens"),
        F.lit(seq_len).cast("int").alias("seq_len"),
        F.lit(chosen.name if chosen else None).cast("string").alias("tokenizer"),
        F.lit(chosen.eos_id if chosen else None).cast("int").alias("eos_id"),
        F.count_distinct("_metadata.file_path").cast("int").alias("n_shards"),
        F.lit(n_bad).cast("bigint").alias("n_bad"),
    )


def _written(spark: SparkSession, root: str) -> dict:
    """Manifest rows by split; one row per split, none before the first write."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/_manifest")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {r.split: r for r in read_manifest(spark, root).collect()} if system.exists(path) else {}


def _writes(spark: SparkSession, root: str) -> set:
    """Splits and the marks of the writes that made their files, which a write's files share."""
    mark = F.regexp_extract("_metadata.file_name", r"^part-\d+-([0-9a-f-]{36})", 1).alias("mark")
    rows = spark.read.parquet(root).select(F.col("split").cast("string").alias("split"), mark).distinct()
    return {(r.split, r.mark) for r in rows.collect()}


def write_shards(
    df: DataFrame,
    root: str,
    tok=None,
    seq_len: int | None = None,
    split: str | None = None,
    copies: tuple[str, ...] = (),
    compression: str = "zstd",
    rows_per_shard: int | None = None,
    mode: str = "errorifexists",
    n_bad: int | None = None,
) -> DataFrame:
    """Write samples below ``root``, one folder per split, and a manifest row for
    each split that this call wrote; other splits' rows stay as they are.

    Without ``split`` the rows' own ``split`` column decides. Rows stay in the
    tasks that made them: packing leaves samples clustered by number, so no
    shuffle is spent here, and a single split is written without the sort that
    a partitioned write needs. ``copies`` writes the same samples under other
    names, read back from the first. ``rows_per_shard`` bounds file size. A split
    that was written with another tokenizer or length is refused, not mixed.
    Returns the manifest.
    """
    spark = df.sparkSession
    has_tokens = "tokens" in df.columns
    if has_tokens:  # kept beside the array so that counting reads one narrow column
        df = df.withColumn("n_tokens", F.size("tokens"))
    name = find_tokenizer(tok).name if tok is not None else None
    known = _written(spark, root)
    for other in known.values() if split is None else [known[s] for s in (split, *copies) if s in known]:
        if mode != "overwrite" and (other.tokenizer, other.seq_len) != (name, seq_len):
            raise ValueError(f"split {other.split!r} holds {other.tokenizer!r}, {other.seq_len}; not {name!r}, {seq_len}")

    def save(rows: DataFrame, to: str, *partition: str) -> None:
        writer = rows.write.mode(mode).option("compression", compression)
        if rows_per_shard:
            writer = writer.option("maxRecordsPerFile", rows_per_shard)
        writer.partitionBy(*partition).parquet(to)

    if split is None:
        before = _writes(spark, root) if known else set()
        save(df, root, "split")
        done = sorted({name for name, _ in _writes(spark, root) - before})
    else:
        first, done = f"{root}/split={split}", [split, *copies]
        save(df.drop("split"), first)
        for other in copies:
            save(spark.read.parquet(first), f"{root}/split={other}")
    for one in done:
        row = manifest(spark, root, one, seq_len, tok, has_tokens, n_bad)
        row.coalesce(1).write.mode("overwrite").parquet(f"{root}/_manifest/split={one}")
    return read_manifest(spark, root)


def write_indexed(df: DataFrame, path: str, compression: str = "zstd", mode: str = "errorifexists") -> DataFrame:
    """Document-indexed tokens from :func:`with_offsets` output.

    Its tasks hold consecutive documents, so files come out clustered by
    ``doc_ord`` and a range of documents prunes to a few row groups.
    """
    cols = ["doc_ord", "tok_offset", "n_tokens", "tokens"]
    df.select(*cols).write.mode(mode).option("compression", compression).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_pairs(df: DataFrame, root: str, split: str | None = None, mode: str = "errorifexists") -> DataFrame:
    """Formatted prompt/response pairs as raw text, one folder per split."""
    return write_shards(df, root, split=split, mode=mode)
