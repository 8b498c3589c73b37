"""Corpus jobs: raw text to packed shards, or to an indexed token table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.functions.arrays import append_eos
from corploom.functions.tokenizers import tokenize, tokenizer, tokens_of
from corploom.operators.ordering import in_scan_order, with_offsets
from corploom.operators.packing import concat_order, pack, pack_in_order
from corploom.operators.splits import split_weighted
from corploom.session import releasing, stage
from corploom.sources.readers import BAD_RECORD, scan_dataset, scan_jsonl, scan_order, scan_shards
from corploom.sources.text_blocks import BLOCK_BYTES, scan_text_blocks
from corploom.sources.writers import write_indexed, write_shards


def build_corpus(
    docs: DataFrame,
    key: str,
    tok="words",
    concat_tokens: int | None = None,
    eos_text: str | None = None,
    use_tokenizer_eos: bool = False,
    slots: int | None = None,
) -> DataFrame:
    """Packed samples of a document table in ``key`` order, or its raw texts
    if ``concat_tokens`` is not given."""
    if concat_tokens is None:
        return concat_order(docs, key)
    tokens = tokenize(docs.select(key, "text"), "text", tok)
    if eos_text or use_tokenizer_eos:
        tokens = append_eos(tokens, tok, eos_text, use_tokenizer_eos)
    return pack_in_order(tokens, key, concat_tokens, slots=slots)


SCAN_ORDER = ("file_path", "file_block_start", "position")


def _jsonl_tokens(spark: SparkSession, path: str, key: str | None, tok, **end) -> tuple[DataFrame, DataFrame]:
    """``(rows, bad)`` from one pass over the lines: ended tokens with their order, written
    once, and the lines that do not parse. With a ``key`` the rows are in no order yet
    and have ``n_tokens``; without one they are placed in the order of the scan."""
    lines = scan_jsonl(spark, path, id_cols=f"{key} bigint" if key else "")
    lines = lines if key else scan_order(lines)
    text = F.when(F.col(BAD_RECORD).isNull(), F.col("text"))
    tokens = lines.select(*((key,) if key else SCAN_ORDER), BAD_RECORD, tokens_of(text, tok).alias("tokens"))
    tokens = append_eos(tokens, tok, **end)
    if key is None:
        rows = in_scan_order(tokens)
        written = rows._scanned
    else:
        written = stage(tokens.withColumn("n_tokens", F.coalesce(F.size("tokens"), F.lit(0))), "tokens")
        rows = written.where("tokens is not null")
    return rows.drop(BAD_RECORD), written.where(F.col(BAD_RECORD).isNotNull()).select(BAD_RECORD)


def _keep_bad(bad: DataFrame, out: str) -> int:
    """Write lines that do not parse beside the output; their number."""
    n = bad.count()
    if n:
        bad.write.text(f"{out}/_bad_lines")
    return n


def jsonl_to_shards(
    spark: SparkSession,
    path: str,
    out_root: str,
    seq_len: int,
    tok="words",
    eos_text: str = "<|end_of_text|>",
    split_names: tuple[str, ...] = ("train",),
    key: str | None = "doc_id",
) -> DataFrame:
    """JSON-lines corpus to packed shards; every named split gets a full copy.

    In the order of ``key``, or with ``key=None`` in the order of the files and their
    lines, which moves no tokens but those at the ends of blocks. Lines that do not
    parse (also those whose key is no number) are written to ``_bad_lines`` and
    counted in the manifest.
    """
    with releasing(spark):
        rows, bad = _jsonl_tokens(spark, path, key, tok, eos_text=eos_text)
        samples = pack(rows, seq_len) if key is None else pack_in_order(rows, key, seq_len, written=True)
        done = write_shards(samples, out_root, tok, seq_len, split_names[0], split_names[1:], n_bad=bad.count())
        _keep_bad(bad, out_root)
        return done


def jsonl_to_raw_shards(
    spark: SparkSession,
    path: str,
    out_root: str,
    split_names: tuple[str, ...] = ("train",),
    key: str | None = "doc_id",
) -> DataFrame:
    """JSON-lines corpus to unpacked compressed shards: one text per document."""
    lines = scan_jsonl(spark, path, id_cols=f"{key} bigint" if key else "")
    bad = lines.where(F.col(BAD_RECORD).isNotNull())  # with all columns: a line is bad for any of them
    good = lines.where(F.col(BAD_RECORD).isNull())
    docs = concat_order(good, key) if key else good.where(F.col("text").isNotNull()).select("text")
    with releasing(spark):
        bad = stage(bad, "bad-lines").select(BAD_RECORD)
        done = write_shards(docs, out_root, split=split_names[0], copies=split_names[1:], n_bad=bad.count())
        _keep_bad(bad, out_root)
        return done


def text_to_shards(
    spark: SparkSession,
    folder: str,
    out_root: str,
    seq_len: int,
    tok="words",
    split_names: tuple[str, ...] = ("train",),
    block: int = BLOCK_BYTES,
) -> DataFrame:
    """Text folder to packed shards, documents in file-path order, in the order of the scan: large files
    are read in blocks by many tasks, and no tokens are moved but those at the ends of blocks."""
    with releasing(spark):
        blocks = scan_text_blocks(spark, folder, getattr(tokenizer(tok), "cuts", None), block)
        tokens = blocks.select("file_path", "file_block_start", "is_last", tokens_of("text", tok).alias("tokens"))
        ended = append_eos(tokens.withColumn("open", F.col("tokens")), tok, use_tokenizer_eos=True)
        ended = ended.withColumn("tokens", F.when(F.col("is_last"), F.col("tokens")).otherwise(F.col("open")))
        samples = pack(in_scan_order(ended.drop("open", "is_last")), seq_len)
        return write_shards(samples, out_root, tok, seq_len, split_names[0], split_names[1:])


def dataset_to_shards(
    spark: SparkSession,
    root: str,
    out_root: str,
    seq_len: int,
    subset: str | None,
    splits: tuple[str, ...],
    tok="words",
    eos_text: str = "<|end_of_text|>",
    key: str = "doc_id",
) -> DataFrame:
    """Named dataset to packed shards; each split is packed on its own, all in one
    pass: the split's number is a group of the running sums."""
    names = F.array(*[F.lit(name) for name in splits])
    docs = scan_dataset(spark, root, subset, splits)
    number = (F.array_position(names, F.col("split")) - 1).cast("int")
    with releasing(spark):
        tokens = tokenize(docs.select(key, "text", number.alias("group")), "text", tok)
        tokens = append_eos(tokens, tok, eos_text)
        samples = pack_in_order(tokens, key, seq_len, group="group", groups=len(splits))
        samples = samples.withColumn("split", names[F.col("group")]).drop("group")
        return write_shards(samples, out_root, tok, seq_len)


def jsonl_to_indexed(
    spark: SparkSession,
    path: str,
    out: str,
    tok="words",
    weights=(949, 50, 1),
    names=("train", "valid", "test"),
    key: str | None = "doc_id",
) -> DataFrame:
    """JSON-lines corpus to the indexed token table, labelled by weighted split; order
    and bad lines as in :func:`jsonl_to_shards`."""
    with releasing(spark):
        rows, bad = _jsonl_tokens(spark, path, key, tok, use_tokenizer_eos=True)
        indexed = write_indexed(rows if key is None else with_offsets(rows, key, written=True), out)
        _keep_bad(bad, out)
    return split_weighted(indexed, weights, names, "doc_ord", F.lit(indexed.count()).cast("bigint"))


def shards_to_samples(spark: SparkSession, root: str, split: str, tok: str, seq_len: int) -> DataFrame:
    """Shards for a run, refused if tokenizer or length disagree with it."""
    return scan_shards(spark, root, split, tok, seq_len)
