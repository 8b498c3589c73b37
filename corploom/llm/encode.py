"""Ids of whole texts from a public tokenizer file, a batch at a time.

Texts are cut where no token reaches across: before a space that a letter or sign
follows, between a letter and a sign, around a single line end. The cuts are found
on the bytes of the batch, equal parts are found by Arrow, and the library encodes
each distinct part once for as long as the worker remembers it.
"""

from __future__ import annotations

import json
import re
import sys
import types
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from tokenizers import Tokenizer

from corploom.llm.frames import give_back

PARTS_KEPT = 400_000
LONGEST_KEPT = 64
BATCH_BYTES = 5 << 20

_OTHER, _LETTER, _SIGN, _DIGIT, _BLANK = range(5)


_WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _symbols() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the
    code points from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


_SYMBOLS = _symbols()


def _kinds() -> np.ndarray:
    """Kind of each byte; blanks are what any tokenizer takes for white space."""
    kind = np.full(256, _OTHER, np.uint8)
    for b in range(33, 127):
        c = chr(b)
        kind[b] = _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _OTHER if c == "'" else _SIGN
    kind[[9, 10, 11, 12, 13, 32]] = _BLANK
    return kind


_KIND = _kinds()


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which parts begin, given where the texts begin and end."""
    n = data.size
    kind = _KIND[data]
    # the two bytes of an accented Latin letter; other bytes beyond ASCII stay unknown
    lead = data == 0xC3
    tail = np.zeros(n, bool)
    tail[1:] = lead[:-1] & (data[1:] != 0x97) & (data[1:] != 0xB7)
    kind[tail] = _LETTER
    solid = (kind == _LETTER) | (kind == _SIGN) | (kind == _DIGIT) | lead
    inner = np.unique(offsets[(offsets > 0) & (offsets < n)])
    before, after = np.empty(n, np.uint8), np.empty(n, bool)
    before[0:1], before[1:] = _BLANK, kind[:-1]
    after[-1:], after[:-1] = False, solid[1:]
    before[inner], after[inner - 1] = _BLANK, False
    ended = (before == _LETTER) | (before == _SIGN) | (before == _DIGIT)
    line = data == 10
    at = (data == 32) & after
    at |= line & ended
    at |= (kind == _SIGN) & (before == _LETTER)
    at[1:] |= (line & ended & after)[:-1]  # after a line end that is a run of blanks by itself
    at[offsets[offsets < n]] = True
    return np.flatnonzero(at)


class Encoder:
    """``encode`` gives ids as unsigned integers of ``width`` bytes, 2 where all fit. With
    ``special`` the string of an added token in a text is that token, as the library
    has it by default; without, it is ordinary text."""

    def __init__(self, path: str, special: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        spec = json.loads(self.tokenizer.to_str())
        # special tokens are ordinary text without ``special``, other added tokens never are
        added = [t for t in spec["added_tokens"] if special or not t["special"]]
        plain = not any(t[name] for t in added for name in ("normalized", "lstrip", "rstrip", "single_word"))
        self.cuts = can_cut(spec) and plain
        names = sorted((t["content"].encode() for t in added if t["content"]), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, names))) if names else None
        self.folds = bool(spec.get("normalizer"))
        self.model = Tokenizer(self.tokenizer.model)  # what is left of a word without its preparation
        self.memo: dict[str, bytes] = {}

    def batches(self, batch: pa.RecordBatch, column: int, end_id: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """Slices of a batch with the ids of their texts, one after the other, each
        ended by ``end_id``, and where each text's ids begin and end."""
        texts = batch.column(column)
        sizes = np.cumsum(pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            so_far = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, so_far + BATCH_BYTES, side="right")))
            yield batch.slice(at, to - at), *self.encode(texts.slice(at, to - at), end_id)
            at = to
        give_back()

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(texts)
        texts = texts.cast(pa.string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1]
        first, last = int(offsets[0]), int(offsets[-1])
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[first:last] if last > first else np.empty(0, np.uint8)
        starts = (offsets - first).astype(np.int64)
        if self.cuts and data.size:
            tokens = self._tokens(data, starts)
            begins = cuts(data, np.concatenate([starts[:-1], *tokens]))
            # an added token stays whole
            last_token = np.searchsorted(tokens[0], begins, side="left") - 1
            begins = begins[(last_token < 0) | (begins >= np.append(tokens[1], 0)[last_token])]
        else:
            begins = np.unique(starts[:-1][starts[:-1] < data.size])
        edges = np.append(begins, data.size).astype(np.int32)
        parts = pa.StringArray.from_buffers(len(begins), pa.py_buffer(edges), pa.py_buffer(data))
        found = parts.dictionary_encode()
        flat, where, size = self._known(found.dictionary.to_pylist(), end_id)
        # the end id is one more part, after the parts of its text
        of_text = np.searchsorted(begins, starts[1:])
        codes = np.insert(found.indices.to_numpy(), of_text, len(size) - 1)
        counts = size[codes]
        ends = np.cumsum(counts, dtype=np.int32)  # a slice is small, or one text
        take = np.repeat(where[codes] - (ends - counts), counts)
        take += np.arange(take.size, dtype=np.int32)
        closed = of_text + np.arange(1, n + 1)
        return flat[take], np.concatenate([[0], ends[closed - 1]]).astype(np.int64)

    def _tokens(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where strings of added tokens begin and end: the library splits a text there
        before anything else, the leftmost and longest first."""
        found: list[tuple[int, int]] = []
        raw = data.tobytes() if self.added else b""
        if self.added and self.added.search(raw):
            for a, b in zip(starts.tolist(), starts[1:].tolist()):
                found += [m.span() for m in self.added.finditer(raw, a, b)]
        spans = np.array(found, np.int64).reshape(-1, 2)
        return spans[:, 0], spans[:, 1]

    def _known(self, parts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct parts and of the end, and where each one's are."""
        memo = self.memo
        new = [p for p in parts if p not in memo]
        memo.update(self._encoded(new))
        ids = [memo[p] for p in parts]
        ids.append(end_id.to_bytes(self.width, "little"))
        # what is met first is mostly what is met often, so the newest goes
        for part in new if len(memo) > PARTS_KEPT else [p for p in new if len(p) > LONGEST_KEPT]:
            del memo[part]
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // self.width
        return np.frombuffer(b"".join(ids), self.dtype), np.cumsum(size, dtype=np.int32) - size, size

    def _encoded(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of new parts. A part that is one word of Latin letters needs no splitting
        or normalising but lower case, so it goes to the library's model as it is."""
        words, others = [], []
        for part in parts:
            word = self.cuts and _WORD.fullmatch(part) and not (self.added and self.added.search(part.encode()))
            (words if word else others).append(part)
        if self.folds:
            spelled = [w.strip().lower() for w in words]
        else:
            spelled = words
        spelled = [w.encode().decode("latin-1").translate(_SYMBOLS) for w in spelled]
        done = dict(zip(words, self._library(self.model, spelled)))
        done.update(zip(others, self._library(self.tokenizer, others)))
        return done

    def _library(self, tokenizer: Tokenizer, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 1000):  # the library's own objects are large
            ids = [e.ids for e in tokenizer.encode_batch_fast(texts[at : at + 1000], add_special_tokens=False)]
            raw = np.fromiter(chain.from_iterable(ids), self.dtype).tobytes()
            ends = np.cumsum([0, *map(len, ids)]) * self.width
            out += [raw[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]
        return out


def can_cut(spec: dict) -> bool:
    """Whether the file's tokens stay inside words (with the space before them), runs
    of signs and runs of blanks."""
    pre, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return not normal
    if pre.get("type") == "Sequence":
        first = pre["pretokenizers"][0]
        dropped = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
        kinds = {n["type"] for n in (normal or {}).get("normalizers", [])}
        words = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        return bool(dropped and first["pattern"].get("Regex", "").endswith(words) and kinds <= {"NFC", "Replace", "Lowercase"})
    return False


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file, kept with its memo from task to task. The code of
    this package comes anew with every task, so the encoder is kept in a module of
    the worker process."""
    kept = sys.modules.setdefault("_corploom_encoders", types.ModuleType("_corploom_encoders")).__dict__
    if path not in kept:
        pa.set_memory_pool(pa.system_memory_pool())
        kept[path] = Encoder(path, special=True)
    return kept[path]


def vocabulary_width(path: str) -> int:
    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4
