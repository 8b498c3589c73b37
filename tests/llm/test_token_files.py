import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given as draw
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corploom.llm import token_store
from corploom.llm.encode import Encoder
from corploom.llm.perfect_hash import PerfectHash, fingerprint
from corploom.llm.queries import op4_token_store, op5_slack_packing
from corploom.llm.slack_packing import minimum_slack, pack_slack, sequences
from corploom.llm.token_store import TokenStore, find_keys, read_tokens, write_tokens
from corploom.session import scratch_path
from tests.conftest import DATA
from tests.llm.cases import edge, empty, given

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "b", "é", "É", "ß", "×", " ", "  ", "\n", "\n\n", ".", ",", "!", "'", "'s", "'LL", "1", "23", " ", " ", "“", "—"]
PARTS += ["́", "漢", "\t", "\r\n", "\x1c", "\x85", "<|endoftext|>", "İ", "ſ", "Σ", " .", " \n", "-", "_", "word", "\U0001f600", "\x00"]


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", (BYTES, WORDS))
def test_parts_give_the_ids_of_whole_texts(path):
    codec, whole = Encoder(path), library(path)
    assert codec.cuts

    @settings(max_examples=60, deadline=None)
    @draw(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=40))
    def check(texts):
        ids, edges = codec.encode(pa.array(texts), 2)
        assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [whole(t) + [2] for t in texts]

    check()
    texts = [t for _, t in given()] + [None, "", "x" * 9000]
    ids, edges = codec.encode(pa.array(texts), 2)
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [whole(t) + [2] for t in texts]


@pytest.mark.parametrize("path", (BYTES, WORDS))
def test_added_tokens_in_a_text_are_those_tokens(path):
    import corploom.llm.encode as module

    codec, library = module.encoder(path), Tokenizer.from_file(path)
    assert codec.cuts
    odd = ["<|startoftext|>", "<|endoftext|", ">", "<", "<|ENDOFTEXT|>", "|>", "oftext"]

    @settings(max_examples=100, deadline=None)
    @draw(st.lists(st.lists(st.sampled_from(PARTS + 6 * ["<|endoftext|>"] + odd), max_size=12).map("".join), min_size=1, max_size=20))
    def check(texts):
        ids, edges = codec.encode(pa.array(texts), 2)
        want = [library.encode(t, add_special_tokens=False).ids + [2] for t in texts]
        assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == want

    check()
    ids, _ = codec.encode(pa.array(["a <|endoftext|> b"]), 2)
    assert {BYTES: 50256, WORDS: 49407}[path] in ids.tolist()


def test_added_tokens_in_the_store(spark):
    root, text = scratch_path(spark, "store"), "a <|endoftext|> b"
    write_tokens(spark.createDataFrame([(1, text), (2, "next")], "doc_id bigint, text string"), root, BYTES, end_id=2)
    rows = {r.doc_id: r for r in read_tokens(spark.createDataFrame([(1,), (2,)], "doc_id bigint"), root).collect()}
    assert np.frombuffer(rows[1].ids, "<u4").tolist() == [64, 220, 50256, 275, 2] and rows[2].start == 5


def test_a_full_memo_changes_nothing(monkeypatch):
    import corploom.llm.encode as module

    monkeypatch.setattr(module, "PARTS_KEPT", 3)
    codec, whole = Encoder(BYTES), library(BYTES)
    for _, text in given()[:20]:
        ids, _ = codec.encode(pa.array([text, text]), 2)
        assert ids.tolist() == 2 * (whole(text) + [2])
    assert len(codec.memo) <= 3


@pytest.mark.parametrize("n", (0, 1, 2, 63, 1000, 50_000))
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2))
    hash_ = PerfectHash.build(a, b)
    assert sorted(hash_.lookup(a, b).tolist()) == list(range(n))
    assert hash_.words.size * 64 < 8 * n + 1000
    if n > 1:  # other keys are told by their prints
        other = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        slots, prints = hash_.lookup(other, b), np.empty(n, np.uint64)
        prints[hash_.lookup(a, b)] = fingerprint(a, b)
        assert not ((slots >= 0) & (prints[slots] == fingerprint(other, b))).any()


def test_store_of_given_documents(spark):
    whole, want, at = library(BYTES), [], 0
    for key, text in sorted(given()):
        ids = np.array(whole(text) + [2], "<u4")
        want.append((key, at, ids.size, zlib.crc32(ids)))
        at += ids.size
    assert sorted(map(tuple, op4_token_store(spark, DATA).collect())) == want


def test_store_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(token_store, "KEYS_PER_BUCKET", 4)
    docs, whole = edge(spark), library(BYTES)
    root = scratch_path(spark, "store")
    write_tokens(docs, root, BYTES, end_id=2)
    got = read_tokens(docs.select("doc_id"), root).collect()
    assert len(got) == docs.count()
    want = sorted((r.doc_id is not None, r.doc_id or 0, np.array(whole(r.text) + [2], "<u4").tobytes()) for r in docs.collect())
    mine = sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.ids)) for r in got)
    assert mine == want
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == sorted((r.doc_id for r in got), key=lambda k: (k is not None, k or 0))
    assert [r.start for r in in_order] == [sum(r.n_tokens for r in in_order[:i]) for i in range(len(in_order))]
    # keyed access, also of keys that are not there
    store = TokenStore(spark, root)
    assert store.get(99) == [] and len(store.files) > 1
    assert sorted(x.tobytes() for x in store.get(8)) == sorted(bytes(r.ids) for r in got if r.doc_id == 8)
    assert len(store.get(None)) == 2 and store.get(4)[0].tolist() == whole("one") + [2]
    keys = spark.createDataFrame([(4,), (99,), (4,)], "doc_id bigint")
    assert find_keys(keys, root).count() == 1
    root = scratch_path(spark, "store")
    write_tokens(empty(spark), root, BYTES, end_id=2)
    assert read_tokens(docs.select("doc_id"), root).collect() == []
    assert TokenStore(spark, root).get(1) == []


def test_one_key_over_many_shards(spark):
    rows = [(5, f"text number {i}") for i in range(400)] + [(i, "other") for i in range(20) if i != 5]
    root = scratch_path(spark, "store")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"), root, BYTES, end_id=2)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert find_keys(spark.createDataFrame([(5,)], "doc_id bigint"), root).count() > 1
    assert len(TokenStore(spark, root).get(5)) == 400


def packed_right(rows, docs, capacity, whole, end):
    pieces = sorted((r.doc_id is not None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want, total = [], 0
    for key, text in docs:
        ids = whole(text) + [end]
        total += len(ids)
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            want.append((key is not None, key or 0, piece, at, part.size, zlib.crc32(part)))
    assert pieces == sorted(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= capacity
    return len(bins), -(-total // capacity)


def test_packing_of_given_documents(spark):
    rows = op5_slack_packing(spark, DATA).collect()
    bins, least = packed_right(rows, given(), 4096, library(WORDS), 1)
    assert bins <= least + 1


def test_packing_edge_rows(spark):
    docs, whole = edge(spark), library(WORDS)
    packed = pack_slack(docs, WORDS, end_id=1, capacity=50)
    own = [(r.doc_id, r.text) for r in docs.collect()]
    packed_right(packed.collect(), own, 50, whole, 1)
    made = sequences(packed).collect()
    assert sum(r.length for r in made) == sum(len(whole(t)) + 1 for _, t in own)
    assert all(len(r.ids) == 2 * r.length for r in made)
    assert pack_slack(empty(spark), WORDS, end_id=1).collect() == []


def fullest_by_hand(counts, room):
    best = {0}
    for length, n in counts.items():
        for _ in range(n):
            best |= {b + length for b in best if b + length <= room}
    return max(best)


@pytest.mark.parametrize("seed", range(20))
def test_bins_are_as_full_as_can_be(seed):
    rng = random.Random(seed)
    capacity = rng.choice((20, 64, 100))
    counts = {n: rng.randrange(1, 6) for n in rng.sample(range(1, capacity + 1), rng.randrange(1, 12))}
    left = dict(counts)
    for copies, repeats in minimum_slack(counts, capacity):
        longest = max(n for n, c in left.items() if c)
        for _ in range(repeats):
            if longest == max((n for n, c in left.items() if c), default=0):
                rest = dict(left)
                rest[longest] -= 1
                assert sum(n * c for n, c in copies.items()) == longest + fullest_by_hand(rest, capacity - longest)
            for n, c in copies.items():
                left[n] -= c
    assert not any(left.values())
