"""Tokenizer registry and the tokenize step.

Spark cuts a text into parts with a built-in regular expression. An Arrow UDF
then finds the distinct parts of the batch, has the tokenizer encode only those,
and lays the ids back out with array operations, so Python sees each distinct
part of a batch once rather than every word of every row.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from typing import ClassVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.functions.workers import frugal, in_slices

# Fixed values.
WORD_VOCAB = 50_000  # ids of the "words" tokenizer are below this; its EOS id is this
BYTES_EOS = 256
DEFAULT_EOS_TEXT = "<|end_of_text|>"
BLANKS = r"[ \t\n\r]+"
BPE_PARTS = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

CACHE_LIMIT = 100_000  # distinct words a worker remembers before it starts over


def _lists(lengths, values, nulls) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    mask = pa.array(nulls) if nulls.any() else None
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()), mask=mask)


def _null_mask(rows) -> np.ndarray:
    return rows.is_null().to_numpy(zero_copy_only=False)


def _encode_parts(rows: pa.ListArray, encode) -> pa.ListArray:
    """Ids of each row's parts; ``encode`` maps distinct parts to id lists."""
    parts = rows.flatten().dictionary_encode()
    coded = encode(parts.dictionary.cast(pa.binary()).to_pylist()).take(parts.indices)
    part_ends = np.concatenate([[0], np.cumsum(coded.value_lengths().to_numpy(), dtype=np.int64)])
    sizes = rows.value_lengths().fill_null(0).to_numpy()
    row_ends = part_ends[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]
    return _lists(np.diff(row_ends), coded.flatten(), _null_mask(rows))


class _WordIds(dict):
    """word bytes -> id, filled on first sight."""

    def __init__(self, vocab: int):
        super().__init__()
        self.vocab = vocab

    def __missing__(self, word: bytes) -> int:
        found = int(hashlib.md5(word).hexdigest()[:8], 16) % self.vocab
        self[word] = found
        return found


@dataclass(frozen=True)
class WordTokenizer:
    """Runs of non-blank characters, each hashed to an id. Blanks are space,
    tab, newline and carriage return."""

    vocab: int = WORD_VOCAB
    name: str = "words"
    cuts: ClassVar[str] = "blank"

    @property
    def eos_id(self) -> int:
        return self.vocab

    def parts(self, text: Column) -> Column:
        return F.split(text, BLANKS)

    def encoder(self):
        ids = _WordIds(self.vocab)

        def distinct(words: list[bytes]) -> pa.ListArray:
            if len(ids) > CACHE_LIMIT:
                ids.clear()
            # blanks at either end of a text leave an empty part, which has no id
            lengths = np.fromiter((1 if w else 0 for w in words), np.int32, len(words))
            values = np.fromiter((ids[w] for w in words if w), np.int32, int(lengths.sum()))
            return _lists(lengths, values, np.zeros(len(words), bool))

        return lambda rows: _encode_parts(rows, distinct)


@dataclass(frozen=True)
class ByteTokenizer:
    """The UTF-8 bytes of the text."""

    name: str = "bytes"
    eos_id: int = BYTES_EOS
    cuts: ClassVar[str] = "char"

    def parts(self, text: Column) -> Column:
        return F.encode(text, "UTF-8")

    def encoder(self):
        def encode(rows: pa.BinaryArray) -> pa.ListArray:
            raw = pc.fill_null(rows, b"")
            lengths = pc.binary_length(raw).to_numpy(zero_copy_only=False)
            values = np.frombuffer(b"".join(raw.to_pylist()), dtype=np.uint8)
            return _lists(lengths, values.astype(np.int32), _null_mask(rows))

        return encode


@dataclass(frozen=True)
class BpeTokenizer:
    """Byte-level BPE from a vocabulary (JSON word -> id) and ordered merges.

    Holds the contents of the two files, a few MB at most, so that executors
    need no file of their own; each task builds one encoder.
    """

    vocab_json: str
    merges_text: str
    eos_token: str = "<|endoftext|>"
    name: str = "bpe"
    cuts: ClassVar[str] = "blank"

    @classmethod
    def from_files(cls, vocab: str, merges: str, **kwargs) -> "BpeTokenizer":
        with open(vocab, encoding="utf-8") as v, open(merges, encoding="utf-8") as m:
            return cls(v.read(), m.read(), **kwargs)

    @property
    def eos_id(self) -> int:
        return json.loads(self.vocab_json)[self.eos_token]

    def parts(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(BPE_PARTS), F.lit(0))

    def encoder(self):
        vocab = json.loads(self.vocab_json)
        lines = [m for m in self.merges_text.splitlines() if m and not m.startswith("#version")]
        ranks = {tuple(m.split(" ")): rank for rank, m in enumerate(lines)}
        symbols = dict(enumerate(byte_symbols()))

        def distinct(parts: list[bytes]) -> pa.ListArray:
            spelled = [p.decode("latin-1").translate(symbols) for p in parts]
            return pa.array([[vocab[s] for s in merged(p, ranks)] for p in spelled], pa.list_(pa.int32()))

        return lambda rows: _encode_parts(rows, distinct)


def merged(part: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """The symbols of a part after all merges, the earliest merge first, from left to right.

    Symbols are linked and pairs wait in a heap by rank and place, so a part of n
    letters takes n log n steps. Pairs that a merge makes wait until its rank is done.
    """
    symbols: list[str | None] = list(part)
    after = list(range(1, len(symbols) + 1))
    before = list(range(-1, len(symbols) - 1))
    heap = [(ranks[pair], i) for i, pair in enumerate(zip(symbols, symbols[1:])) if pair in ranks]
    heapq.heapify(heap)

    def pair_at(i: int) -> tuple | None:
        return (symbols[i], symbols[after[i]]) if symbols[i] is not None and after[i] < len(symbols) else None

    while heap:
        rank, places = heap[0][0], []
        while heap and heap[0][0] == rank:
            places.append(heapq.heappop(heap)[1])
        for i in places:  # in order; what an earlier merge has changed is skipped
            pair = pair_at(i)
            if pair is None or ranks.get(pair) != rank:
                continue
            gone = after[i]
            symbols[i], symbols[gone] = pair[0] + pair[1], None
            after[i] = after[gone]
            if after[i] < len(symbols):
                before[after[i]] = i
            for j in (before[i], i):
                if j >= 0 and (fresh := ranks.get(pair_at(j))) is not None:
                    heapq.heappush(heap, (fresh, j))
    return [s for s in symbols if s is not None]


def byte_symbols() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the code points from 256 on, in byte order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


_registry = {"words": WordTokenizer, "bytes": ByteTokenizer}


def register_tokenizer(name: str, factory) -> None:
    """Make ``factory()`` available to :func:`tokenizer` under ``name``."""
    _registry[name] = factory


def tokenizer(name_or_obj):
    """Look a tokenizer up by name; objects pass through."""
    if not isinstance(name_or_obj, str):
        return name_or_obj
    if name_or_obj not in _registry:
        raise KeyError(f"unknown tokenizer {name_or_obj!r}; known: {sorted(_registry)}")
    return _registry[name_or_obj]()


def tokens_of(text: Column | str, tok="words") -> Column:
    """Token-id array of a text column; null text gives null."""
    chosen = tokenizer(tok)
    text = F.col(text) if isinstance(text, str) else text

    def encode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = chosen.encoder()  # once per task; vocabularies travel with the task binary
        for rows in batches:
            yield pa.concat_arrays([encode(few) for few in in_slices(rows)])

    return F.arrow_udf(frugal(encode_batches), "array<int>")(chosen.parts(text))


def literal_ids(spark: SparkSession, text: str, tok="words") -> list[int]:
    """Ids of one short text, such as an end mark."""
    return list(spark.range(1).select(tokens_of(F.lit(text), tok).alias("ids")).first().ids)


def tokenize(
    df: DataFrame, text_col: str = "text", tok="words", out: str = "tokens", drop_text: bool = True
) -> DataFrame:
    """Add the token array of ``text_col``; rows with null text are dropped.

    The text leaves the plan right here, so nothing later shuffles it.
    """
    kept = df.where(F.col(text_col).isNotNull())
    done = kept.withColumn(out, tokens_of(F.col(text_col), tok))
    return done.drop(text_col) if drop_text and out != text_col else done
