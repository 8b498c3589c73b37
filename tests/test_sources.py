"""Scans, shards, manifests, instruction records and whole jobs."""

import json

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from corploom.operators import instructions
from corploom.operators.splits import keep_splits, split_copy
from corploom.plans import corpus, finetune
from corploom.session import scratch_path, shared_dir, stage
from corploom.sources import readers, writers

from .conftest import docs_frame


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    df = stage(spark.range(10).withColumn("r", F.rand()), "fixed")
    assert sorted(df.collect()) == sorted(df.collect())


def write_lines(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_bad_json_lines(spark, tmp_path):
    good = [json.dumps({"doc_id": i, "text": f"t{i}"}) for i in range(3)]
    path = write_lines(tmp_path / "c.jsonl", [good[0], "{broken", good[1], "plain text", good[2]])
    dropped = readers.scan_jsonl(spark, path, bad_records="drop")
    assert dropped.count() == 3 and {r.text for r in dropped.collect()} == {"t0", "t1", "t2"}
    kept = readers.scan_jsonl(spark, path, bad_records="keep").collect()
    assert sorted(r._bad_record for r in kept if r._bad_record) == ["plain text", "{broken"]
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        readers.scan_jsonl(spark, path, bad_records="fail").collect()


def test_scan_order_without_ids(spark, tmp_path):
    for f in range(3):
        write_lines(tmp_path / f"{f}.jsonl", [json.dumps({"text": f"{f}-{i:02d}"}) for i in range(20)])
    rows = readers.scan_jsonl(spark, str(tmp_path), id_cols="")
    texts = [r.text for r in readers.fix_scan_order(rows).orderBy("ord").collect()]
    assert texts == sorted(texts) and len(texts) == 60


def test_text_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "sub" / "b.txt").write_text("three")
    rows = {r.file_path.rsplit("/", 1)[1]: r.text for r in readers.scan_text(spark, str(tmp_path)).collect()}
    assert rows == {"a.txt": "one\ntwo\n", "b.txt": "three"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_splits_and_subsets_prune_folders(spark, sf):
    root = fx.named_dataset(spark, sf)
    plan = plan_of(readers.scan_dataset(spark, root, "en", ("val_small",)).select("doc_id"))
    assert "PartitionFilters: [" in plan and "(subset" in plan.split("PartitionFilters")[1]
    assert "ReadSchema: struct<doc_id:bigint>" in plan
    assert keep_splits(spark.read.parquet(root), "none").count() == 0


def test_shards_and_manifest(spark, tmp_path):
    docs = docs_frame(spark, [f"w{i} " * (i + 1) for i in range(40)])
    samples = corpus.build_corpus(docs, "doc_id", "words", 16, use_tokenizer_eos=True)
    root = str(tmp_path / "out")
    written = writers.write_shards(split_copy(samples, ["train", "val"]), root, "words", 16, rows_per_shard=5)
    total = samples.count()
    for row in written.collect():
        assert (row.n_samples, row.n_tokens, row.seq_len) == (total, total * 16, 16)
        assert (row.tokenizer, row.eos_id) == ("words", 50_000) and row.n_shards >= total / 5
    assert readers.scan_shards(spark, root, "val", "words", 16).count() == total
    with pytest.raises(ValueError, match="'test' is not in"):
        readers.scan_shards(spark, root, "test")
    with pytest.raises(ValueError, match="tokenizer"):
        readers.scan_shards(spark, root, "train", tokenizer="bytes")
    with pytest.raises(ValueError, match="per sample"):
        readers.scan_shards(spark, root, "train", seq_len=32)
    names = {p.suffixes[-2] for p in (tmp_path / "out" / "split=train").glob("*.parquet")}
    assert names == {".zstd"}
    with pytest.raises(Exception, match="exists"):
        writers.write_shards(samples, root, "words", 16, split="train")


def test_files_of_the_index_are_in_document_order(spark, tmp_path):
    docs = docs_frame(spark, ["a b c"] * 500).repartition(7)
    from corploom.functions.tokenizers import tokenize
    from corploom.operators.ordering import with_offsets

    table = writers.write_indexed(with_offsets(tokenize(docs), "doc_id", slots=4), str(tmp_path / "ix"))
    spans = table.groupBy("_metadata.file_path").agg(F.min("doc_ord").alias("a"), F.max("doc_ord").alias("b"))
    ranges = sorted((r.a, r.b) for r in spans.collect())
    assert len(ranges) == 4
    assert all(left[1] < right[0] for left, right in zip(ranges, ranges[1:]))


def test_preview_keeps_only_n_per_task(spark):
    df = spark.range(1000).repartition(8)
    assert [r.id for r in readers.preview(df, 3, "id").collect()] == [0, 1, 2]
    assert "TakeOrderedAndProject" in plan_of(readers.preview(df, 3, "id"))


TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_instruction_records(spark):
    turns = [
        (1, 0, "system", "sys"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"),
        (2, 0, "user", "q3"), (2, 1, "assistant", "a3"), (2, 2, "user", "q4"), (2, 3, "user", "q5"),
        (2, 4, "assistant", "a5"), (3, 0, "system", "  "), (3, 1, "user", "q6"), (3, 2, "assistant", "a6"),
    ]
    rows = instructions.instruction_rows(spark.createDataFrame(turns, TURNS))
    got = {(r.conv_id, r.turn): (r.instruction, r.context, r.response) for r in rows.collect()}
    assert got == {
        (1, 1): ("q1", "sys", "a1"), (2, 0): ("q3", "", "a3"), (2, 3): ("q5", "", "a5"), (3, 1): ("q6", "  ", "a6"),
    }
    whole = {(r.conv_id, r.turn): r.prompt for r in instructions.format_instructions(rows).collect()}
    assert whole[1, 1] == "### Instruction:\nq1\n\n### Context:\nsys\n\n### Response:\n"
    assert whole[3, 1] == "### Instruction:\nq6\n\n### Response:\n"


@pytest.mark.parametrize("chunk", [7, 1024])
def test_hot_conversation(spark, chunk):
    """A third of all turns in one conversation, its context in every record."""
    turns = [(0, 0, "system", "ctx")]
    turns += [(0, t, "user" if t % 2 else "assistant", f"x{t}") for t in range(1, 401)]
    turns += [(c, t, ("user", "assistant")[t], "y") for c in range(1, 401) for t in range(2)]
    rows = instructions.instruction_rows(spark.createDataFrame(turns, TURNS), chunk).collect()
    hot = {(r.turn, r.instruction, r.context, r.response) for r in rows if r.conv_id == 0}
    assert hot == {(t, f"x{t}", "ctx", f"x{t + 1}") for t in range(1, 400, 2)}
    assert sum(r.conv_id > 0 and r.context == "" for r in rows) == 400


def test_preprocessor_paths(spark):
    with pytest.raises(ValueError, match="module:function"):
        instructions.resolve("no_colon")
    assert instructions.resolve("corploom.operators.instructions:resolve") is instructions.resolve


def test_pairs_are_refused_for_a_missing_split(spark, sf):
    out = scratch_path(spark, "pairs")
    finetune.instructions_to_pairs(spark, fx.instruction_dataset(spark, sf), out, ("train",))
    assert readers.scan_shards(spark, out, "train").count() > 0
    with pytest.raises(ValueError, match="'val' is not in"):
        readers.scan_shards(spark, out, "val")


def test_finished_jobs_leave_nothing_staged(spark, sf, tmp_path):
    from pathlib import Path

    path = fx.documents_jsonl(spark, sf)
    kept = Path(shared_dir(spark)) / "corploom"
    before = {p.name for p in kept.iterdir()}
    made = corpus.jsonl_to_shards(spark, path, str(tmp_path / "o"), 64, split_names=("train", "val"))
    assert {p.name for p in kept.iterdir()} == before
    counts = {r.split: r.n_samples for r in made.collect()}
    assert counts["train"] == counts["val"] > 0
    with pytest.raises(Exception, match="exists"):
        corpus.jsonl_to_shards(spark, path, str(tmp_path / "o"), 64)


def test_jobs_side_by_side_keep_their_tables(spark):
    from concurrent.futures import ThreadPoolExecutor

    from corploom.session import releasing

    with releasing(spark), ThreadPoolExecutor(1) as other:
        theirs = other.submit(stage, spark.range(5), "theirs").result()
        mine = stage(spark.range(3), "mine")
        assert mine.count() == 3
    assert theirs.count() == 5
    with pytest.raises(Exception, match="(?i)not.exist|PATH_NOT_FOUND"):
        mine.count()


def test_malformed_lines_are_kept_and_counted(spark, tmp_path):
    """200 good lines; 100 with good text and a string for a number."""
    lines = [json.dumps({"doc_id": i if i % 3 else f"x{i}", "text": f"text {i}"}) for i in range(300)]
    path = write_lines(tmp_path / "c.jsonl", lines)
    made = corpus.jsonl_to_shards(spark, path, str(tmp_path / "packed"), 8, "bytes").collect()
    assert [r.n_bad for r in made] == [100]
    kept = (tmp_path / "packed" / "_bad_lines").glob("part-*")
    assert sorted(x for p in kept for x in p.read_text().splitlines()) == sorted(x for x in lines if '"x' in x)
    assert corpus.jsonl_to_indexed(spark, path, str(tmp_path / "indexed"), "bytes").count() == 200
    assert (tmp_path / "indexed" / "_bad_lines").exists()
    made = corpus.jsonl_to_raw_shards(spark, path, str(tmp_path / "raw")).collect()
    assert [(r.n_bad, r.n_samples) for r in made] == [(100, 200)]


def test_a_split_keeps_its_manifest(spark, tmp_path):
    samples = spark.createDataFrame([(i, [1] * 8) for i in range(5)], "sample_id bigint, tokens array<int>")
    root = str(tmp_path / "shards")
    writers.write_shards(samples, root, "words", 8, split="train")
    writers.write_shards(samples, root, "bytes", 4, split="val")
    rows = {r.split: (r.tokenizer, r.seq_len, r.n_samples) for r in readers.read_manifest(spark, root).collect()}
    assert rows == {"train": ("words", 8, 5), "val": ("bytes", 4, 5)}
    assert readers.scan_shards(spark, root, "train", "words", 8).count() == 5
    with pytest.raises(ValueError, match="made with tokenizer"):
        readers.scan_shards(spark, root, "train", "bytes", 4)
    with pytest.raises(ValueError, match="holds"):
        writers.write_shards(samples, root, "bytes", 4, split="train", mode="append")


def test_locations_are_quoted(spark, tmp_path):
    writers.ensure_namespace(spark, "quoted", str(tmp_path / "it's"))
    assert "it's" in spark.sql("DESCRIBE DATABASE quoted").where("info_name = 'Location'").first().info_value
    spark.sql("DROP DATABASE quoted")
