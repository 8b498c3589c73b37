"""Tokenizers against plain Python, and the array steps."""

import base64
import hashlib
import json
import re

import pytest

from checks.fixtures import SMALL_MERGES, small_bpe
from corploom.functions import arrays
from corploom.functions.durations import duration_batches_col
from corploom.functions.tokenizers import (
    BpeTokenizer,
    byte_symbols,
    literal_ids,
    register_tokenizer,
    tokenize,
    tokenizer,
)

from .conftest import docs_frame

TEXTS = [
    "the thing  in\tthe\n\nend", "", "  lead and trail  ", "\n", "it's we'll don't", "a1 22 3.5 --- !!",
    "é漢字 🙂 naïve x", "x  y", "tab\t\tnl\r\n  z", "\x0b\x0c page", "the the the", "   ",
]


def encoded(spark, texts, tok):
    rows = tokenize(docs_frame(spark, texts).repartition(3), "text", tok).collect()
    return {r.doc_id: list(r.tokens) for r in rows}


def test_words(spark):
    def ids(text):
        parts = [w for w in re.split("[ \t\n\r]+", text) if w]
        return [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 50_000 for w in parts]

    assert encoded(spark, TEXTS, "words") == {i: ids(t) for i, t in enumerate(TEXTS)}


def test_bytes(spark):
    assert encoded(spark, TEXTS, "bytes") == {i: list(t.encode()) for i, t in enumerate(TEXTS)}


def slow_bpe(text):
    """Merge the first listed pair, leftmost first, until none is left."""
    import regex

    form = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    symbols = byte_symbols()
    ranks = {tuple(m.split(" ")): i for i, m in enumerate(SMALL_MERGES)}
    vocab = json.loads(small_bpe().vocab_json)
    out = []
    for part in regex.findall(form, text):
        units = [symbols[b] for b in part.encode()]
        while True:
            pairs = [(ranks[p], i) for i, p in enumerate(zip(units, units[1:])) if p in ranks]
            if not pairs:
                break
            _, i = min(pairs)
            units[i : i + 2] = [units[i] + units[i + 1]]
        out += [vocab[u] for u in units]
    return out


def test_small_bpe(spark, sf):
    more = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = TEXTS + more
    assert encoded(spark, texts, small_bpe()) == {i: slow_bpe(t) for i, t in enumerate(texts)}


def test_full_vocabulary_against_another_library(spark, sf):
    public = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    model = json.load(open(public.path("byte_bpe_50k.json")))["model"]
    merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    vocab = model["vocab"] | {"<|endoftext|>": 50256}
    mine = BpeTokenizer(json.dumps(vocab), "#version: 0.2\n" + "\n".join(merges))
    lines = open(public.path("byte_bpe_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    other = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts = [t for t in TEXTS if "\x0b" not in t] + docs
    assert encoded(spark, texts, mine) == {i: other.encode_ordinary(t) for i, t in enumerate(texts)}
    assert mine.eos_id == 50256


def test_bpe_from_files(spark, tmp_path):
    small = small_bpe()
    (tmp_path / "vocab.json").write_text(small.vocab_json, encoding="utf-8")
    (tmp_path / "merges.txt").write_text(small.merges_text, encoding="utf-8")
    read = BpeTokenizer.from_files(str(tmp_path / "vocab.json"), str(tmp_path / "merges.txt"))
    assert encoded(spark, TEXTS, read) == encoded(spark, TEXTS, small)


def test_registry(spark):
    register_tokenizer("mine", small_bpe)
    assert tokenizer("mine").name == "bpe"
    with pytest.raises(KeyError, match="unknown tokenizer"):
        tokenizer("nobody")


def test_null_text_is_dropped_and_empty_text_kept(spark):
    docs = docs_frame(spark, ["a", None, ""])
    rows = arrays.append_eos(tokenize(docs, "text", "bytes"), "bytes", use_tokenizer_eos=True)
    assert {r.doc_id: list(r.tokens) for r in rows.collect()} == {0: [97, 256], 2: [256]}


def test_end_marks(spark):
    docs = tokenize(docs_frame(spark, ["a"]), "text", "bytes")
    marked = arrays.append_eos_text(docs, "bytes", "<e>").first()
    assert list(marked.tokens) == list(b"a<e>")
    assert literal_ids(spark, "<e>", "bytes") == list(b"<e>")
    for wrong in ({}, {"eos_text": "x", "use_tokenizer_eos": True}):
        with pytest.raises(ValueError, match="either"):
            arrays.append_eos(docs, "bytes", **wrong)


def pair(spark, p, r):
    df = spark.createDataFrame([(p, r)], "prompt_ids array<int>, response_ids array<int>")
    return arrays.to_decoder_only(df)


def lists(row):
    return list(row.input_ids), list(row.labels), list(row.attention_mask)


def test_decoder_sample(spark):
    df = pair(spark, [1, 2], [3, 4, 5])
    assert lists(df.first()) == ([1, 2, 3, 4, 5], [-100, -100, 3, 4, 5], [1] * 5)
    cut = arrays.truncate(df, 3)
    assert lists(cut.first()) == ([1, 2, 3], [-100, -100, 3], [1] * 3)
    full = arrays.pad(cut, 5, 9)
    assert lists(full.first()) == ([1, 2, 3, 9, 9], [-100, -100, 3, -100, -100], [1, 1, 1, 0, 0])
    assert lists(arrays.pad(df, 3, 9).first())[0] == [1, 2, 3, 4, 5]


def test_pad_to_longest(spark):
    rows = [(0, 0, [1, 2]), (0, 0, [1, 2, 3]), (0, 1, [1])]
    df = spark.createDataFrame(rows, "epoch int, batch int, input_ids array<int>")
    got = sorted(list(r.input_ids) for r in arrays.pad(df, 8, 0, trim=True).collect())
    assert got == [[1], [1, 2, 0], [1, 2, 3]]


def test_duration_column(spark):
    rows = [("30ba",), ("2ep",), ("7tok",), ("ep",), (None,)]
    df = spark.createDataFrame(rows, "d string")
    got = [r.b for r in df.select(duration_batches_col("d", 10).alias("b")).collect()]
    assert got == [30, 20, None, None, None]
