"""Registered queries: every operator run over whole tables.

Arrays are returned as space-separated text so that results compare by value.
"""

from __future__ import annotations

from dataclasses import replace
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from corploom.functions import arrays
from corploom.functions.durations import duration_batches_col
from corploom.functions.tokenizers import register_tokenizer, tokenize, tokenizer
from corploom.operators import batching, feistel, instructions, ordering, packing, splits
from corploom.operators import sample_index as samples_by_index
from corploom.plans import corpus, finetune, training
from corploom.plans.recipe import Recipe
from corploom.session import scratch_path
from corploom.sources import readers, seals, writers
from corploom.streaming import follow, metrics, rolling_state

SEQ_LEN = 256
PAIR_LEN = 128
SPLITS = ("train", "val")

PRETRAIN = Recipe(
    max_seq_len=SEQ_LEN, global_batch=64, max_duration="3ep", seed=17, shuffle=True,
    drop_last=True, devices=8, micro_size=2, eval_interval=5, save_interval=10,
)
FINETUNE = Recipe(
    max_seq_len=PAIR_LEN, global_batch=16, max_duration="2ep", seed=17, shuffle=True,
    drop_last=True, devices=4, micro_size=2, eval_interval=4, save_interval=6, eval_first=True,
)

register_tokenizer("bpe", fx.small_bpe)
register_tokenizer("pieces", fx.small_unigram)


def text_of(col: Column | str) -> Column:
    """Array as text."""
    col = F.col(col) if isinstance(col, str) else col
    return F.array_join(col.cast("array<string>"), " ")


def docs_of(spark: SparkSession, sf: str) -> DataFrame:
    return fx.spread(fx.table(spark, sf, "documents").select("doc_id", "text"))


def sample_text(samples: DataFrame, *more: str) -> DataFrame:
    return samples.select(
        "sample_id",
        F.size("tokens").alias("n_tokens"),
        F.element_at("tokens", 1).alias("first_token"),
        F.element_at("tokens", -1).alias("last_token"),
        text_of("tokens").alias("tokens"),
        *more,
    )


def token_text(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.size("tokens").alias("n_tokens"), text_of("tokens").alias("tokens"))


# Scans


def scan_jsonl(spark, sf):
    rows = readers.scan_jsonl(spark, fx.documents_jsonl(spark, sf))
    return rows.select("doc_id", "text", F.length("text").cast("bigint").alias("n_chars"))


def scan_jsonl_bad_lines(spark, sf):
    rows = readers.scan_jsonl(spark, fx.mixed_jsonl(spark, sf), bad_records="keep")
    return rows.select("doc_id", F.coalesce("text", readers.BAD_RECORD).alias("content"))


def scan_order(spark, sf):
    """Documents without an id, ranked in the order of their files and lines."""
    rows = readers.scan_jsonl(spark, fx.plain_jsonl(spark, sf), id_cols="")
    ranked = ordering.with_rank(readers.fix_scan_order(rows), "ord", written=True)
    return ranked.select("rank", "text")


def doc_of_path(path: str) -> Column:
    return F.regexp_extract(path, r"/doc=(\d+)-[^/]*$", 1).cast("bigint")


def scan_text_folder(spark, sf):
    rows = readers.scan_text(spark, fx.text_folder(spark, sf))
    return rows.select(doc_of_path("file_path").alias("doc_id"), "text")


def scan_dataset(spark, sf):
    rows = readers.scan_dataset(spark, fx.named_dataset(spark, sf), "en", ("train_small", "val_small"))
    return rows.select("doc_id", "subset", "split", "text")


def scan_instructions(spark, sf):
    rows = readers.scan_instructions(spark, fx.instruction_dataset(spark, sf), "train")
    return rows.select("sample_id", "instruction", "context", "response", "split")


def scan_shards(spark, sf):
    root = packed_root(spark, sf)
    rows = readers.scan_shards(spark, root, "val", tokenizer="words", seq_len=SEQ_LEN)
    return sample_text(rows, "split")


def line_counts(lines: DataFrame) -> DataFrame:
    """Lines without the two fields whose number format is the engine's."""
    line = F.regexp_replace("line", '"loss":[^,]*,"lr":[^,]*,', "")
    return lines.groupBy(line.alias("line")).agg(F.count("*").alias("n"))


def scan_logs(spark, sf):
    return line_counts(readers.scan_logs(spark, fx.log_folder(spark, sf)))


def follow_logs(spark, sf):
    lines = readers.follow_logs(spark, fx.log_folder(spark, sf)).select("line")
    return line_counts(followed(spark, lines, "follow-logs"))


def preview(spark, sf):
    docs = fx.table(spark, sf, "documents")
    return readers.preview(docs.select("doc_id", "lang", "n_chars"), 10, "doc_id")


# Sinks


def packed(spark, sf, tok="words", eos_id=True):
    eos = {"use_tokenizer_eos": True} if eos_id else {"eos_text": "<|end_of_text|>"}
    return corpus.build_corpus(docs_of(spark, sf), "doc_id", tok, SEQ_LEN, **eos)


@fx._once
def packed_root(spark, sf, out):
    writers.write_shards(packed(spark, sf), out, "words", SEQ_LEN, SPLITS[0], SPLITS[1:])


def write_shards(spark, sf):
    out = scratch_path(spark, "shards")
    writers.write_shards(packed(spark, sf), out, "words", SEQ_LEN, split="train", rows_per_shard=100)
    return sample_text(readers.scan_shards(spark, out, "train"), "split")


def write_split_folders(spark, sf):
    """Rows carry their split; the write makes one folder of each."""
    out = scratch_path(spark, "folders")
    writers.write_shards(splits.split_copy(packed(spark, sf), list(SPLITS)), out, "words", SEQ_LEN)
    return sample_text(spark.read.parquet(out), "split")


def split_manifests(spark, sf):
    """Two splits of different tokenizers and lengths under one root, each read back
    through the check; reading one as the other is refused."""
    out = scratch_path(spark, "two-splits")
    tokens = arrays.append_eos(tokenize(docs_of(spark, sf), "text", "bytes"), "bytes", use_tokenizer_eos=True)
    writers.write_shards(packed(spark, sf), out, "words", SEQ_LEN, split="train")
    writers.write_shards(packing.pack_in_order(tokens, "doc_id", 512), out, "bytes", 512, split="val")
    for split, tok, seq_len in (("train", "bytes", 512), ("val", "words", SEQ_LEN)):
        try:
            readers.scan_shards(spark, out, split, tok, seq_len)
        except ValueError:
            continue
        raise AssertionError(f"{split} was read as {tok}, {seq_len}")
    train = readers.scan_shards(spark, out, "train", "words", SEQ_LEN)
    val = readers.scan_shards(spark, out, "val", "bytes", 512)
    both = train.unionByName(val).groupBy("split").agg(F.count("*").alias("n_read"))
    return both.join(readers.read_manifest(spark, out), "split").select(
        "split", "n_read", "n_samples", "n_tokens", "seq_len", "tokenizer", "eos_id"
    )


def content_seals(spark, sf):
    """Two splits sealed and checked."""
    out = scratch_path(spark, "sealed")
    writers.write_shards(packed(spark, sf), out, "words", SEQ_LEN, SPLITS[0], SPLITS[1:])
    for split in SPLITS:
        seals.write_seals(spark, out, split)
        seals.check_seals(spark, out, split)
    return seals.total(seals.read_seals(spark, out))


def ensure_namespace(spark, sf):
    """A table made in a fresh namespace, read back by name."""
    path = scratch_path(spark, "namespace")
    name = "ns_" + path[-12:]
    writers.ensure_namespace(spark, name, path)
    writers.ensure_namespace(spark, name, path)
    fx.table(spark, sf, "documents").select("doc_id", "lang").write.saveAsTable(f"{name}.docs")
    return spark.table(f"{name}.docs").groupBy("lang").agg(F.count("*").alias("n"))


def write_indexed(spark, sf):
    tokens = arrays.append_eod(tokenize(docs_of(spark, sf)), "words")
    placed = ordering.with_offsets(tokens, "doc_id")
    table = writers.write_indexed(placed, scratch_path(spark, "indexed"))
    return table.select("doc_ord", "tok_offset", "n_tokens", text_of("tokens").alias("tokens"))


def indexed_of(spark, sf) -> DataFrame:
    tokens = arrays.append_eod(tokenize(docs_of(spark, sf)), "words")
    return writers.write_indexed(ordering.with_offsets(tokens, "doc_id"), scratch_path(spark, "indexed"))


def sample_index(spark, sf):
    return samples_by_index.sample_index(indexed_of(spark, sf), SEQ_LEN)


def read_by_index(spark, sf):
    """Every sample through the index."""
    indexed = indexed_of(spark, sf)
    return sample_text(samples_by_index.read_samples(indexed, samples_by_index.sample_index(indexed, SEQ_LEN), SEQ_LEN))


def pairs_of(spark, sf) -> DataFrame:
    rows = instructions.instruction_rows(fx.table(spark, sf, "conversations"))
    return instructions.format_instructions(rows.withColumn("sample_id", fx.pair_key()))


def write_pairs(spark, sf):
    out = scratch_path(spark, "pairs")
    writers.write_pairs(pairs_of(spark, sf), out, split="train")
    return readers.scan_shards(spark, out, "train").select("sample_id", "prompt", "response", "split")


def manifest(spark, sf):
    rows = readers.read_manifest(spark, packed_root(spark, sf))
    return rows.select(
        "split", "n_samples", "n_tokens", "seq_len", "tokenizer", "eos_id",
        (F.col("n_shards") > 0).alias("has_shards"),
    )


# Tokens


def tokenize_with(name, spark, sf):
    return token_text(tokenize(docs_of(spark, sf), "text", name))


def append_eos_text(spark, sf):
    return token_text(arrays.append_eos_text(tokenize(docs_of(spark, sf)), "words"))


def append_eos_id(spark, sf):
    return token_text(arrays.append_eos(tokenize(docs_of(spark, sf)), "words", use_tokenizer_eos=True))


def append_eod(spark, sf):
    tokens = tokenize(docs_of(spark, sf), "text", "bytes")
    return token_text(arrays.append_eod(tokens, "bytes"))


def raw_text_corpus(spark, sf):
    return corpus.build_corpus(docs_of(spark, sf), "doc_id", concat_tokens=None)


# Instruction samples


def format_instructions(spark, sf):
    return pairs_of(spark, sf).select("sample_id", "prompt", "response")


def preprocessor_by_path(spark, sf):
    rows = instructions.instruction_rows(fx.table(spark, sf, "conversations"))
    named = instructions.format_instructions(
        rows.withColumn("sample_id", fx.pair_key()), "corploom.operators.instructions:default_template"
    )
    return named.select("sample_id", "prompt", "response")


def joined_row(row: dict) -> dict:
    return {
        "sample_id": row["sample_id"],
        "prompt": f"{row['context']}|{row['instruction']}",
        "response": row["response"],
    }


def preprocessor_by_row(spark, sf):
    rows = instructions.instruction_rows(fx.table(spark, sf, "conversations"))
    return instructions.format_instructions(
        rows.withColumn("sample_id", fx.pair_key()),
        "checks.queries:joined_row",
        schema="sample_id bigint, prompt string, response string",
    )


def pair_ids(spark, sf) -> DataFrame:
    return finetune.pair_samples(pairs_of(spark, sf), Recipe(max_seq_len=1 << 30))


def arrays_text(df: DataFrame, *more: str) -> DataFrame:
    cols = ("input_ids", "labels", "attention_mask")
    return df.select("sample_id", *more, *[text_of(c).alias(c) for c in cols])


def decoder_only(spark, sf):
    return arrays_text(pair_ids(spark, sf))


def truncate(spark, sf):
    return arrays_text(arrays.truncate(pair_ids(spark, sf), PAIR_LEN))


def pad_full(spark, sf):
    rows = arrays.truncate(pair_ids(spark, sf), PAIR_LEN)
    return arrays_text(arrays.pad(rows, PAIR_LEN, tokenizer("words").eos_id))


def pad_longest(spark, sf):
    rows = arrays.truncate(pair_ids(spark, sf), PAIR_LEN)
    batched = batching.assign_batches(
        ordering.with_rank(rows, "sample_id"), 16, drop_last=False, rows=0
    ).withColumn("epoch", F.lit(0))
    return arrays_text(arrays.pad(batched, PAIR_LEN, 0, trim=True), "batch")


def duration_batches(spark, sf):
    """Document lengths read as durations, the bad ones included."""
    unit = F.element_at(F.array(F.lit("ba"), F.lit("ep"), F.lit("tok")), (F.col("doc_id") % 3 + 1).cast("int"))
    rows = fx.table(spark, sf, "documents").withColumn("duration", F.concat("n_chars", unit))
    return rows.select("doc_id", "duration", duration_batches_col("duration", 31).alias("batches"))


# Splits, order, batches


def keep_splits(spark, sf):
    rows = spark.read.parquet(fx.named_dataset(spark, sf))
    kept = splits.keep_splits(rows, "val_small")
    return kept.groupBy("subset", "split").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


def keep_subset(spark, sf):
    rows = spark.read.parquet(fx.named_dataset(spark, sf))
    return splits.keep_subset(rows, "fr").select("doc_id", "subset", "split")


def token_offsets(spark, sf):
    tokens = arrays.append_eos(tokenize(docs_of(spark, sf)), "words", use_tokenizer_eos=True)
    placed = ordering.with_offsets(tokens, "doc_id")
    return placed.select("doc_id", "doc_ord", "tok_offset", "n_tokens", "n_docs")


def pack_samples(spark, sf):
    return sample_text(packed(spark, sf))


def pack_keep_tail(spark, sf):
    tokens = arrays.append_eos_text(tokenize(docs_of(spark, sf)), "words")
    placed = ordering.with_offsets(tokens, "doc_id")
    return sample_text(packing.pack(placed, 1000, keep_tail=True))


def pack_bytes(spark, sf):
    samples = packed(spark, sf, "bytes")
    weighed = F.transform("tokens", lambda x, i: x.cast("bigint") * (i + 1))
    return samples.select(
        "sample_id",
        F.size("tokens").alias("n_tokens"),
        F.aggregate(weighed, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("weighed_sum"),
        F.element_at("tokens", 1).alias("first_token"),
    )


def shuffle_epochs(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id")
    return ordering.shuffled_rank(docs, "doc_id", seed=17, epochs=3)


def feistel_epochs(spark, sf):
    """Packed samples in a new order each epoch, by their numbers alone."""
    samples = readers.scan_shards(spark, packed_root(spark, sf), "train").select("sample_id")
    return feistel.feistel_epochs(samples, "sample_id", samples.count(), PRETRAIN.seed, 3)


def ordered_rank(spark, sf):
    lines = fx.table(spark, sf, "events").select("event_id", "user_id")
    return ordering.with_rank(lines, "event_id")


def rank_in_run(spark, sf):
    events = fx.table(spark, sf, "events").select("user_id", "ts", "event_id")
    ranked = ordering.rank_in_group(events, "user_id", ["ts", "event_id"], F.to_date("ts"))
    return ranked.select("user_id", "event_id", "rank")


def split_weighted(spark, sf):
    docs = ordering.with_rank(fx.table(spark, sf, "documents").select("doc_id"), "doc_id", "doc_ord")
    total = fx.table(spark, sf, "documents").count()
    return splits.split_weighted(docs, total=F.lit(total).cast("bigint"))


def split_copy(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "lang")
    return splits.split_copy(docs, list(SPLITS))


def samples_of(spark, sf) -> DataFrame:
    return readers.scan_shards(spark, packed_root(spark, sf), "train")


def assign_batches(spark, sf):
    ids = samples_of(spark, sf).select("sample_id")
    ranked = ordering.with_rank(ids, "sample_id")
    return batching.assign_batches(ranked, 64, drop_last=False, rows=0)


def drop_last(spark, sf):
    ids = samples_of(spark, sf).select("sample_id")
    ranked = ordering.with_rank(ids, "sample_id")
    return batching.assign_batches(ranked, 100, drop_last=True, rows=ids.count())


def assign_devices(spark, sf):
    ids = samples_of(spark, sf).select("sample_id")
    ranked = ordering.shuffled_rank(ids, "sample_id", 17)
    return batching.assign_devices(ranked, 48, devices=8, micro_size=4)


def epoch_plan(spark, sf):
    plan = training.epoch_plan(samples_of(spark, sf), PRETRAIN)
    return plan.select("epoch", "rank", "batch", "global_batch", "sample_id")


def batch_limited_plan(spark, sf):
    """A run that ends after a number of batches, within an epoch."""
    recipe = Recipe(global_batch=64, max_duration="40ba")
    plan = training.epoch_plan(samples_of(spark, sf), recipe)
    return plan.select("epoch", "rank", "batch", "global_batch", "sample_id")


def unshuffled_epochs(spark, sf):
    recipe = Recipe(global_batch=64, max_duration="2ep", shuffle=False, drop_last=False)
    plan = training.epoch_plan(samples_of(spark, sf), recipe)
    return plan.select("epoch", "rank", "batch", "global_batch", "sample_id")


def plan_markers(spark, sf):
    plan = training.epoch_plan(samples_of(spark, sf), PRETRAIN)
    marked = batching.with_markers(plan, 5, 10, eval_first=True)
    return marked.select("sample_id", "epoch", "global_batch", "is_eval", "is_save")


def eval_subset(spark, sf):
    recipe = Recipe(drop_last=False, eval_subset_batches=7)
    return training.evaluation_plan(samples_of(spark, sf), recipe, batch_size=8)


def evaluation_plan_devices(spark, sf):
    recipe = Recipe(devices=4, micro_size=2, eval_batch=24)
    return training.evaluation_reads(samples_of(spark, sf), recipe)


def eval_every_epoch(spark, sf):
    recipe = replace(PRETRAIN, eval_interval="1ep", save_interval="12ba")
    return training.training_plan(samples_of(spark, sf), recipe)


def plan_stats(spark, sf):
    rows = finetune.finetune_plan(pairs_of(spark, sf), FINETUNE)
    return batching.plan_stats(rows)


def run_totals(spark, sf):
    return batching.run_totals(finetune.finetune_plan(pairs_of(spark, sf), FINETUNE))


# Run metrics


def metrics_of(spark, sf) -> DataFrame:
    return metrics.metric_rows(readers.scan_logs(spark, fx.log_folder(spark, sf)))


def parse_metrics(spark, sf):
    rows = metrics.parse_metrics(readers.scan_logs(spark, fx.log_folder(spark, sf)))
    return rows.withColumn("ts_us", F.unix_micros("ts")).drop("ts")


def speed_columns(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "run_id", "batch", F.unix_micros("ts").alias("ts_us"), "tokens",
        "tokens_per_sec", "batches_per_sec", *more,
    )


def rolling_speed(spark, sf):
    return speed_columns(metrics.rolling_speed(metrics_of(spark, sf), block=16))


def lr_series(spark, sf):
    return metrics.lr_series(metrics_of(spark, sf))


def memory_peak(spark, sf):
    return metrics.memory_peak(metrics_of(spark, sf))


def eta(spark, sf):
    return speed_columns(metrics.eta(metrics_of(spark, sf), 1000), "eta_sec")


def console_interval(spark, sf):
    return batching.console_batches(metrics.memory_peak(metrics_of(spark, sf)), 5)


def followed(spark, stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over what is there, to its end, and read its sink."""
    out = scratch_path(spark, label)
    query = follow.follow_to(stream, out, scratch_path(spark, f"{label}-checkpoint"), available_now=True)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def followed_log(spark, sf) -> DataFrame:
    """The log as it grows, a step for each trigger."""
    log = fx.growing_log(spark, sf)
    return readers.follow_logs(spark, log, files_per_trigger=fx.files_per_step(spark, log))


def follow_metrics(spark, sf):
    """Followed file by file; the windows still open at the end are there too."""
    rows = metrics.metric_rows(followed_log(spark, sf))
    out = scratch_path(spark, "follow-metrics")
    follow.follow_windows(rows, out, f"{out}-checkpoint", "6 hours", available_now=True).awaitTermination()
    done = follow.read_windows(spark, out)
    return done.withColumn("window_us", F.unix_micros("window_start")).drop("window_start")


def follow_rolling(spark, sf):
    """Followed file by file, with batches cut by the ends of files."""
    rows = metrics.metric_rows(followed_log(spark, sf))
    out = scratch_path(spark, "follow-rolling")
    query = follow.follow_rolling(
        rows, out, f"{out}-state", f"{out}-checkpoint", available_now=True
    )
    query.awaitTermination()
    follow.finish_rolling(spark, out, f"{out}-state")
    return speed_columns(spark.read.parquet(out))


def rolling_in_state(spark, sf):
    """The rates of a followed log that grows by quarters, from the state store."""
    rows = metrics.metric_rows(followed_log(spark, sf))
    out = scratch_path(spark, "rolling-in-state")
    rolling_state.follow_rolling_state(rows, out, f"{out}-checkpoint", available_now=True).awaitTermination()
    return speed_columns(rolling_state.read_rolling(spark, out))


def stop_following(spark, sf):
    """Stop after the files so far; the sink holds each line once."""
    lines = readers.follow_logs(spark, fx.log_folder(spark, sf)).select("line")
    out = scratch_path(spark, "stopped")
    query = follow.follow_to(lines, out, f"{out}-checkpoint")
    query.processAllAvailable()
    follow.stop(query)
    rows = spark.read.schema(lines.schema).parquet(out)
    return rows.agg(F.count("*").alias("n_lines"), F.lit(query.isActive).alias("active"))


# Jobs


def jsonl_to_shards(spark, sf):
    out = scratch_path(spark, "jsonl-job")
    corpus.jsonl_to_shards(spark, fx.documents_jsonl(spark, sf), out, SEQ_LEN, split_names=SPLITS)
    return sample_text(spark.read.parquet(out), "split")


def jsonl_no_id_to_shards(spark, sf):
    out = scratch_path(spark, "jsonl-no-id-job")
    corpus.jsonl_to_shards(spark, fx.plain_jsonl(spark, sf), out, SEQ_LEN, split_names=SPLITS, key=None)
    return sample_text(spark.read.parquet(out), "split")


def jsonl_no_id_to_indexed(spark, sf):
    out = scratch_path(spark, "indexed-no-id-job")
    rows = corpus.jsonl_to_indexed(spark, fx.plain_jsonl(spark, sf), out, "bpe", key=None)
    return rows.select("doc_ord", "tok_offset", "n_tokens", text_of("tokens").alias("tokens"), "split")


def jsonl_to_raw_shards(spark, sf):
    out = scratch_path(spark, "raw-job")
    corpus.jsonl_to_raw_shards(spark, fx.documents_jsonl(spark, sf), out, split_names=SPLITS)
    return readers.scan_shards(spark, out, "val").select("doc_id", "text", "split")


def text_to_shards(spark, sf):
    out = scratch_path(spark, "text-job")
    corpus.text_to_shards(spark, fx.text_folder(spark, sf), out, SEQ_LEN)
    return sample_text(readers.scan_shards(spark, out, "train"), "split")


def text_blocks_to_shards(spark, sf):
    """Files of many documents, each cut into many blocks."""
    out = scratch_path(spark, "text-blocks-job")
    corpus.text_to_shards(spark, fx.large_text(spark, sf), out, SEQ_LEN, block=1 << 16)
    return sample_text(readers.scan_shards(spark, out, "train"), "split")


def dataset_to_shards(spark, sf):
    out = scratch_path(spark, "dataset-job")
    corpus.dataset_to_shards(
        spark, fx.named_dataset(spark, sf), out, SEQ_LEN, "en", ("train_small", "val_small")
    )
    return sample_text(spark.read.parquet(out), "split")


def instructions_to_pairs(spark, sf):
    out = scratch_path(spark, "pairs-job")
    finetune.instructions_to_pairs(spark, fx.instruction_dataset(spark, sf), out)
    return readers.scan_shards(spark, out, "train").select("sample_id", "prompt", "response", "split")


def jsonl_to_indexed(spark, sf):
    out = scratch_path(spark, "indexed-job")
    rows = corpus.jsonl_to_indexed(spark, fx.documents_jsonl(spark, sf), out, "bpe")
    return rows.select("doc_ord", "tok_offset", "n_tokens", text_of("tokens").alias("tokens"), "split")


def training_plan(spark, sf):
    samples = corpus.shards_to_samples(spark, packed_root(spark, sf), "train", "words", SEQ_LEN)
    return training.training_plan(samples, PRETRAIN)


def finetune_plan(spark, sf):
    rows = finetune.finetune_plan(pairs_of(spark, sf), FINETUNE)
    return rows.select(
        *training.PLAN_COLUMNS, "n_tokens",
        *[text_of(c).alias(c) for c in ("input_ids", "labels", "attention_mask")],
    )


def plan_arrays(rows: DataFrame, *columns: str) -> DataFrame:
    arrays_ = [text_of(c).alias(c) for c in ("input_ids", "labels", "attention_mask")]
    return rows.select(*columns, "n_tokens", "n_padded", *arrays_)


@fx._once
def pair_shards(spark, sf, out):
    writers.write_pairs(pairs_of(spark, sf), out, split="train")


def finetune_from_shards(spark, sf):
    rows = finetune.finetune_from_shards(spark, pair_shards(spark, sf), "train", FINETUNE)
    return plan_arrays(rows, *training.PLAN_COLUMNS)


def finetune_trimmed(spark, sf):
    recipe = replace(FINETUNE, allow_pad_trimming=True)
    rows = finetune.finetune_from_shards(spark, pair_shards(spark, sf), "train", recipe)
    return plan_arrays(rows, *training.PLAN_COLUMNS)


def finetune_evaluation_plan(spark, sf):
    recipe = replace(FINETUNE, eval_batch=12)
    rows = finetune.finetune_evaluation(pairs_of(spark, sf), recipe)
    return plan_arrays(rows, "batch", "device", "micro", "pos", "sample_id")


def run_metrics(spark, sf):
    rows = metrics.run_metrics(metrics_of(spark, sf), 1000)
    return speed_columns(rows, "eta_sec", "lr", "peak_bytes")


QUERIES = {
    f.__name__: f
    for f in (
        scan_jsonl, scan_jsonl_bad_lines, scan_order, scan_text_folder, scan_dataset,
        scan_instructions, scan_shards, scan_logs, follow_logs, preview,
        write_shards, write_split_folders, split_manifests, content_seals, ensure_namespace, write_indexed, write_pairs, manifest,
        sample_index, read_by_index,
        append_eos_text, append_eos_id, append_eod, raw_text_corpus,
        format_instructions, preprocessor_by_path, preprocessor_by_row,
        decoder_only, truncate, pad_full, pad_longest, duration_batches,
        keep_splits, keep_subset, token_offsets, pack_samples, pack_keep_tail, pack_bytes,
        shuffle_epochs, feistel_epochs, ordered_rank, rank_in_run, split_weighted, split_copy,
        assign_batches, drop_last, assign_devices, epoch_plan, batch_limited_plan, unshuffled_epochs, plan_markers,
        eval_subset, evaluation_plan_devices, eval_every_epoch, plan_stats, run_totals,
        parse_metrics, rolling_speed, lr_series, memory_peak, eta, console_interval,
        follow_metrics, follow_rolling, rolling_in_state, stop_following,
        jsonl_to_shards, text_to_shards, text_blocks_to_shards, dataset_to_shards, instructions_to_pairs,
        jsonl_to_indexed, training_plan, finetune_plan, run_metrics,
        jsonl_no_id_to_shards, jsonl_no_id_to_indexed, jsonl_to_raw_shards,
        finetune_from_shards, finetune_trimmed, finetune_evaluation_plan,
    )
}
QUERIES |= {f"tokenize_{name}": partial(tokenize_with, name) for name in ("words", "bytes", "bpe", "pieces")}
