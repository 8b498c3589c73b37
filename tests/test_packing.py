"""Offsets and packing against a plain sequential loop."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corploom.functions.arrays import append_eos
from corploom.functions.tokenizers import tokenize
from corploom.operators import ordering
from corploom.operators.packing import _cut, pack, pack_in_order
from corploom.operators.splits import split_weighted, weight_bounds

from .conftest import docs_frame

L = 8


def byte_docs(sizes):
    return ["".join(chr(97 + (i + j) % 26) for j in range(n)) for i, n in enumerate(sizes)]


def sequential(texts, seq_len, eos=256):
    stream = []
    for text in texts:
        if text is not None:
            stream += list(text.encode()) + [eos]
    full = len(stream) // seq_len * seq_len
    return [stream[i : i + seq_len] for i in range(0, full, seq_len)], stream[full:]


def packed(spark, texts, seq_len=L, slots=None, keep_tail=False, parts=3, by="job"):
    docs = docs_frame(spark, texts).repartition(parts)
    tokens = append_eos(tokenize(docs, "text", "bytes"), "bytes", use_tokenizer_eos=True)
    if by == "job":
        out = pack_in_order(tokens, "doc_id", seq_len, keep_tail, slots=slots)
    else:
        out = pack(ordering.with_offsets(tokens, "doc_id", slots=slots), seq_len, keep_tail)
    rows = out.collect()
    assert len({r.sample_id for r in rows}) == len(rows)
    return {r.sample_id: list(r.tokens) for r in rows}


# one below, at and above a sample with its end mark, one over several samples,
# empty, null, multibyte
EDGES = byte_docs([L - 2, L - 1, L, 5 * L + 3, 0, 1]) + [None, "", "é漢🙂", None] + byte_docs([3, 40])


@pytest.mark.parametrize("by", ["job", "rows"])
@pytest.mark.parametrize("slots", [1, 2, 5, 12])
def test_edge_documents(spark, slots, by):
    want, tail = sequential(EDGES, L)
    assert packed(spark, EDGES, slots=slots, by=by) == dict(enumerate(want))
    kept = packed(spark, EDGES, slots=slots, keep_tail=True, by=by)
    assert kept == dict(enumerate(want + ([tail] if tail else [])))


def test_corpus_shorter_than_a_sample(spark):
    assert packed(spark, ["abc"]) == {}
    assert packed(spark, ["abc"], keep_tail=True) == {0: [97, 98, 99, 256]}


@pytest.mark.parametrize("seq_len, slots", [(1, 4), (7, 30), (64, 30), (1000, 30), (33, 3)])
def test_slots_smaller_and_larger_than_samples(spark, seq_len, slots):
    """Samples over many slots, slots over many samples, and ends that meet."""
    texts = byte_docs([(i * 29) % 41 for i in range(120)])
    want, tail = sequential(texts, seq_len)
    got = packed(spark, texts, seq_len, slots=slots, keep_tail=True)
    assert got == dict(enumerate(want + ([tail] if tail else [])))


def test_one_document_holds_most_tokens(spark):
    texts = byte_docs([5] * 20 + [50_000] + [7] * 20)
    want, _ = sequential(texts, 100)
    assert packed(spark, texts, 100, slots=6) == dict(enumerate(want))


@pytest.mark.parametrize("partitions", ["1", "8", "50"])
def test_partitions_do_not_matter(spark, partitions):
    texts = byte_docs([(i * 37) % 90 for i in range(200)])
    want, _ = sequential(texts, 64)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert packed(spark, texts, 64, parts=int(partitions)) == dict(enumerate(want))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rows_out_of_order(spark):
    """Packing does not rely on the layout that makes it fast."""
    texts = byte_docs([(i * 13) % 30 for i in range(60)])
    want, _ = sequential(texts, 16)
    tokens = append_eos(tokenize(docs_frame(spark, texts), "text", "bytes"), "bytes", use_tokenizer_eos=True)
    mixed = ordering.with_offsets(tokens, "doc_id").repartition(5, F.rand(3))
    rows = pack(mixed, 16).collect()
    assert {r.sample_id: list(r.tokens) for r in rows} == dict(enumerate(want))


@settings(max_examples=200, deadline=None)
@given(
    sizes=st.lists(st.integers(0, 40), max_size=30),
    seq_len=st.integers(1, 17),
    first=st.integers(0, 50),
    batch=st.integers(1, 7),
)
def test_cut_keeps_every_token_once(sizes, seq_len, first, batch):
    starts = first + np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64)
    docs = [np.arange(s, s + n, dtype=np.int32) for s, n in zip(starts, sizes)]
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array(starts[i : i + batch], pa.int64()), pa.array(docs[i : i + batch], pa.list_(pa.int32()))],
            ["tok_offset", "tokens"],
        )
        for i in range(0, len(docs), batch)
    ]
    seen = []
    for kind, at, values in _cut(iter(batches), seq_len):
        if kind == "whole":
            assert values.shape[1] == seq_len
            at, values = at * seq_len, values.ravel()
        else:
            assert 0 < values.size < seq_len
            assert at // seq_len == (at + values.size - 1) // seq_len
        assert (values == np.arange(at, at + values.size)).all()
        seen += values.tolist()
    assert sorted(seen) == list(range(first, first + sum(sizes)))


def test_offsets_match_a_single_window(spark):
    texts = byte_docs([(i * 7) % 23 for i in range(300)])
    tokens = tokenize(docs_frame(spark, texts).repartition(4), "text", "bytes")
    rows = ordering.with_offsets(tokens, "doc_id", slots=9).orderBy("doc_id").collect()
    at = 0
    for i, r in enumerate(rows):
        assert (r.doc_ord, r.tok_offset, r.n_tokens, r.n_docs) == (i, at, len(texts[i]), 300)
        at += len(texts[i])


def test_string_keys(spark):
    names = [f"file-{i:03d}é" for i in range(50)]
    df = spark.createDataFrame([(n,) for n in names], "k string")
    rows = ordering.with_rank(df, "k", slots=6).collect()
    assert {r.k: r["rank"] for r in rows} == {n: i for i, n in enumerate(sorted(names))}


def test_repeated_key_is_an_error(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k bigint")
    with pytest.raises(Exception, match="not unique"):
        ordering.with_rank(df, "k", slots=2).collect()


def test_null_key_is_an_error(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "k bigint")
    with pytest.raises(Exception, match="null"):
        ordering.with_rank(df, "k", slots=2).collect()


@pytest.mark.parametrize("total", [0, 1, 7, 1000, 1234])
def test_weighted_split(spark, total):
    ranks = spark.range(total).withColumnRenamed("id", "doc_ord")
    labelled = split_weighted(ranks, total=F.lit(total).cast("bigint")).collect()
    bounds = [(2 * total * c + 1000) // 2000 for c in (949, 999, 1000)]
    assert bounds[-1] == total
    for r in labelled:
        name = "train" if r.doc_ord < bounds[0] else "valid" if r.doc_ord < bounds[1] else "test"
        assert r.split == name
    assert len(weight_bounds((949, 50, 1), total)) == 3


def test_plan_moves_tokens_once(spark):
    """One exchange carries token arrays to their slots; no other shuffle,
    cross join or single-task sort sees them."""
    texts = byte_docs([20] * 100)
    tokens = append_eos(tokenize(docs_frame(spark, texts), "text", "bytes"), "bytes", use_tokenizer_eos=True)
    out = pack_in_order(tokens, "doc_id", 16, slots=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if " Exchange " in x or ":- Exchange" in x or "+- Exchange" in x]
    by_slot = [x for x in exchanges if "direct_shuffle_partition_id" in x]
    assert len(by_slot) == 2  # the same exchange seen from both branches, run once
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    rows = out.groupBy().count()
    rows.collect()
    final = rows._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final


@pytest.mark.parametrize("keys", [[1, None, 3], [None, None], [None], [*range(300), None], [None] * 300])
def test_null_keys_fail_at_every_size(spark, keys):
    df = spark.createDataFrame([(k, [1, 2]) for k in keys], "k bigint, tokens array<int>")
    with pytest.raises(Exception, match="null"):
        ordering.with_rank(df, "k").collect()
    with pytest.raises(Exception, match="null"):
        ordering.with_offsets(df, "k").collect()


def test_slots_are_cut_by_tokens(spark, monkeypatch):
    monkeypatch.setattr(ordering, "TOKENS_PER_SLOT", 1000)
    rows = [(i, [7] * (900 if i < 40 else 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "k bigint, tokens array<int>")
    got = ordering.placed(df, "k").collect()
    assert max(r.slot_to - r.slot_from for r in got) <= 4000  # 11 documents a slot would be 9,900
    assert [r.tok_offset for r in sorted(got)] == [sum(len(t) for _, t in rows[:i]) for i in range(400)]


def test_scan_order_moves_no_tokens(spark, tmp_path):
    """Without an id the only exchange under token rows is that of the end pieces."""
    import json

    from corploom.plans.corpus import jsonl_to_shards
    from corploom.sources.readers import scan_jsonl, scan_order

    texts = [f"document {i} " + "word " * (i % 50) for i in range(300)]
    for part in range(3):
        lines = [json.dumps({"text": t}) for t in texts[part * 100 : (part + 1) * 100]]
        (tmp_path / f"{part}.jsonl").write_text("\n".join(lines) + "\n")
    tokens = tokenize(scan_order(scan_jsonl(spark, str(tmp_path / "*.jsonl"), id_cols="")), "text", "bytes", drop_text=True)
    rows = ordering.in_scan_order(tokens.select("file_path", "file_block_start", "position", "tokens"))
    plan = rows.select("tok_offset", "tokens")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionBy" not in plan and "Sort" not in plan.split("Relation")[0]
    want, at = [], 0
    for i, t in enumerate(texts):
        want.append((i, at))
        at += len(t.encode())
    assert sorted((r.doc_ord, r.tok_offset) for r in rows.collect()) == want
    out = str(tmp_path / "out")
    jsonl_to_shards(spark, str(tmp_path / "*.jsonl"), out, 64, "bytes", key=None)
    eos = list("<|end_of_text|>".encode())
    stream = [b for t in texts for b in [*t.encode(), *eos]]
    got = sorted((r.sample_id, list(r.tokens)) for r in spark.read.parquet(out).collect())
    assert got == [(i, stream[i * 64 : (i + 1) * 64]) for i in range(len(stream) // 64)]
