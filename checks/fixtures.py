"""Inputs of the registered queries, derived by Spark from the given tables.

The jobs read JSON lines, text folders, partitioned datasets and logs; these
functions write the whole tables in those forms, once per session and folder.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import wraps

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.functions.tokenizers import BpeTokenizer, byte_symbols
from corploom.functions.unigram import UnigramTokenizer
from corploom.llm.frames import file_system
from corploom.operators.instructions import instruction_rows
from corploom.operators.ordering import rank_in_group
from corploom.session import scratch_path, stage
from corploom.streaming.metrics import TIME_FORMAT

# A small hand-made merge list for the byte-level BPE checks.
SMALL_MERGES = """
Ġ t
h e
i n
e r
Ġ a
o n
r e
Ġt he
e n
a t
n d
o u
i t
e s
Ġ s
in g
Ġa nd
Ġ o
t h
Ġ w
e d
i on
a n
l e
u e
c h
Ã ©
d e
q ue
e in
Ġo f
Ġ in
t ion
Ġ d
Ġd e
. Ċ
""".split("\n")[1:-1]

# A small hand-made list of pieces, the likeliest first.
SMALL_PIECES = """
▁
▁the
▁de
▁la
▁und
s
ing
▁a
er
en
tion
▁s
e
n
t
on
in
▁of
qu
ent
re
▁der
a
i
o
r
th
▁in
ou
l
d
u
c
m
p
é
ion
es
▁re
ü
""".split("\n")[1:-1]

_made: dict[tuple, str] = {}


def _once(write):
    """Write a fixture at most once per session and table folder."""

    @wraps(write)
    def path(spark: SparkSession, sf: str) -> str:
        at = (spark.sparkContext.applicationId, sf, write.__name__)
        if at not in _made:
            out = scratch_path(spark, write.__name__)
            write(spark, sf, out)
            _made[at] = out
        return _made[at]

    return path


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The given tables are single files; share their rows between the cores. A table with a file for
    each core is read as it lies, so that its texts are not shuffled only to be spread."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores)


@_once
def documents_jsonl(spark, sf, out):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    docs.write.json(out)


DOCS_PER_RANGE = 10_000


@_once
def plain_jsonl(spark, sf, out):
    """Lines without an id; files and lines are in the order of ``doc_id``."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    files = max(4, -(-docs.count() // DOCS_PER_RANGE))
    docs.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id").select("text").write.json(out)


@_once
def mixed_jsonl(spark, sf, out):
    good = table(spark, sf, "documents").select(F.to_json(F.struct("doc_id", "text")).alias("value"))
    bad = table(spark, sf, "benchmark").select(F.col("text").alias("value"))
    spread(good.union(bad)).write.text(out)


FILES_PER_FOLDER = 1000


def text_file(doc_id: int) -> tuple[str, str]:
    """Folder and first part of the name of a document's file; paths are in the order of ``doc_id``."""
    return f"part={doc_id // FILES_PER_FOLDER:012d}", f"doc={doc_id:012d}"


@_once
def text_folder(spark, sf, out):
    """A file of each document, written by the tasks themselves: Spark's writer would make a folder
    for each and move them one by one at the end. A task that runs again writes the same names."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(out)
        task, made, n = TaskContext.get().partitionId(), set(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folder, name = ("part=none", "doc=none") if doc_id is None else text_file(doc_id)
                if folder not in made:
                    system.create_dir(f"{root}/{folder}", recursive=True)
                    made.add(folder)
                with system.open_output_stream(f"{root}/{folder}/{name}-{task}-{n}.txt", compression=None) as file:
                    file.write(f"{text or ''}\n".encode())
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    docs.mapInArrow(write, "n bigint").agg(F.sum("n")).collect()


DOCS_PER_FILE = 400


@_once
def large_text(spark, sf, out):
    """A file of each ``DOCS_PER_FILE`` identifiers, a document a line or more."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    part = F.lpad(F.expr(f"doc_id div {DOCS_PER_FILE}").cast("string"), 12, "0").alias("part")
    rows = docs.select("doc_id", "text", part).repartition("part").sortWithinPartitions("part", "doc_id")
    rows.select("part", "text").write.partitionBy("part").text(out)


@_once
def named_dataset(spark, sf, out):
    docs = table(spark, sf, "documents")
    docs.select(
        "doc_id",
        "text",
        F.col("lang").alias("subset"),
        F.when(F.col("doc_id") % 10 == 0, "val_small").otherwise("train_small").alias("split"),
    ).write.partitionBy("subset", "split").parquet(out)


@_once
def instruction_dataset(spark, sf, out):
    rows = instruction_rows(table(spark, sf, "conversations"))
    rows.withColumn("sample_id", pair_key()).withColumn("split", F.lit("train")).write.partitionBy(
        "split"
    ).parquet(out)


def pair_key():
    """Unique id of a pair in (conversation, turn) order."""
    return F.col("conv_id") * (1 << 20) + F.col("turn")


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One line per event, with its place in time: a user is a run, two events make
    a batch, errors are plain text and so leave gaps."""
    events = table(spark, sf, "events").withColumn("at", F.col("ts").cast("timestamp"))
    ranked = rank_in_group(events, "user_id", ["ts", "event_id"], F.to_date("ts"))
    tokens = F.floor(F.col("value") * 100).cast("bigint")
    batch = F.expr("rank div 2")
    metric = F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("run_id"),
            batch.alias("batch"),
            F.date_format("at", TIME_FORMAT).alias("ts"),
            (F.col("event_id") % 8).cast("int").alias("device"),
            tokens.alias("tokens"),
            F.col("value").alias("loss"),
            (F.lit(1.0) / (batch + 1) * (1 + F.col("rank") % 2)).alias("lr"),
            (F.col("event_id") * 1024 + tokens).alias("mem_bytes"),
        )
    )
    note = F.concat(F.lit("error user="), "user_id", F.lit(" event="), "event_id")
    return ranked.select(F.when(F.col("event_type") == "error", note).otherwise(metric).alias("value"), "ts", "event_id")


LINES_PER_FILE = 2_000_000


@_once
def growing_log(spark, sf, out):
    """The log in four steps, one after the other in time, wherever that cuts a batch: a file each, or as many
    in each as the longest needs."""
    lines = stage(log_lines(spark, sf), "log-lines")
    edges = lines.select(F.expr("percentile_approx(unix_micros(cast(ts AS timestamp)), array(0.25, 0.5, 0.75))")).first()[0]
    part = sum((F.unix_micros(F.col("ts").cast("timestamp")) > e).cast("int") for e in edges)
    steps = lines.groupBy(part.alias("step")).count().collect()
    files = max(1, *(-(-r["count"] // LINES_PER_FILE) for r in steps)) if steps else 1
    for i in range(4):
        rows = lines.where(part == i).repartition(files).sortWithinPartitions("ts", "event_id")
        rows.select("value").write.mode("append").text(out)


def files_per_step(spark: SparkSession, log: str) -> int:
    """How many files of a :func:`growing_log` came at once."""
    return max(1, len(spark.read.text(log).inputFiles()) // 4)


@_once
def log_folder(spark, sf, out):
    log_lines(spark, sf).select("value").write.text(out)


def small_bpe() -> BpeTokenizer:
    """Byte symbols, the merges above, then the end mark."""
    vocab = {s: b for b, s in enumerate(byte_symbols())}
    for i, pair in enumerate(SMALL_MERGES):
        vocab[pair.replace(" ", "")] = 256 + i
    vocab["<|endoftext|>"] = 256 + len(SMALL_MERGES)
    return BpeTokenizer(json.dumps(vocab), "\n".join(SMALL_MERGES))


def small_merge_ids() -> list[tuple[int, int, int]]:
    """(left id, right id, merged id) in merge order."""
    vocab = json.loads(small_bpe().vocab_json)
    return [(vocab[a], vocab[b], vocab[a + b]) for a, b in (m.split(" ") for m in SMALL_MERGES)]


def small_unigram() -> UnigramTokenizer:
    """Control pieces, the bytes, then the pieces above with falling scores; letters beyond them are bytes."""
    lines = ["<unk>\t0", "<s>\t0", "</s>\t0", *(f"<0x{b:02X}>\t0" for b in range(256))]
    lines += [f"{piece}\t{-2 - rank / 8}" for rank, piece in enumerate(SMALL_PIECES)]
    return UnigramTokenizer("\n".join(lines))
