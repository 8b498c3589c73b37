"""A tokenizer of scored pieces: the best path through a text, bytes where no piece fits.

A piece file has a line ``piece<TAB>score`` for each id. Blanks are written as ``▁`` and a
text begins with one. Of all ways to cut a text into pieces the one of the highest sum of scores
is taken; of equal ones, the one whose last piece is the longest, and so on towards the front. A
character that no piece covers alone may stand for itself at ``UNKNOWN`` below the lowest score and gives
its UTF-8 bytes, the pieces ``<0x00>`` to ``<0xFF>``. Scores are kept to six decimals, as integers, so
sums are exact.

Texts are not split beforehand unless that cannot change the best path: where no piece has a ``▁`` past
its first character, no piece goes across one, and Spark cuts there. Then a batch's distinct
parts are looked at once. Null text gives null, empty text no ids.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from typing import ClassVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from corploom.functions.tokenizers import _encode_parts

BLANK = "▁"
UNKNOWN = 10.0  # what an uncovered character costs below the lowest score
SCALE = 1_000_000


def scaled(score: str | float) -> int:
    return round(float(score) * SCALE)


def best_path(text: str, pieces: dict[str, tuple[int, int]], longest: int, floor: int) -> list[tuple[int, int, int | None]]:
    """``(start, end, id)`` of the best path; the id is null where a character stands for its bytes.

    ``pieces`` maps a piece to its id and score; none is longer than ``longest``.
    """
    n = len(text)
    sums, starts, ids = [0] * (n + 1), [0] * (n + 1), [None] * (n + 1)
    for end in range(1, n + 1):
        best = None
        for start in range(max(0, end - longest), end):
            found = pieces.get(text[start:end])
            if found is None and start == end - 1:
                found = (None, floor)
            if found is not None and (best is None or sums[start] + found[1] > best):
                best, starts[end], ids[end] = sums[start] + found[1], start, found[0]
        sums[end] = best
    path, end = [], n
    while end:
        path.append((starts[end], end, ids[end]))
        end = starts[end]
    return path[::-1]


@dataclass(frozen=True)
class UnigramTokenizer:
    """Holds the content of the piece file, so executors need no file of their own."""

    pieces_text: str
    eos_piece: str = "</s>"
    unused: tuple[str, ...] = ("<unk>", "<s>", "</s>", "<pad>")  # control pieces, never found in a text
    name: str = "pieces"
    cuts: ClassVar[None] = None

    @classmethod
    def from_file(cls, path: str, **kwargs) -> UnigramTokenizer:
        with open(path, encoding="utf-8", newline="\n") as file:
            return cls(file.read(), **kwargs)

    @cached_property
    def _lines(self) -> list[tuple[str, int]]:
        lines = (line.rpartition("\t") for line in self.pieces_text.split("\n") if line)
        return [(piece, scaled(score)) for piece, _, score in lines]

    @cached_property
    def bytes_from(self) -> int:
        """The id of ``<0x00>``; the other bytes follow it."""
        at = [piece for piece, _ in self._lines]
        first = at.index("<0x00>")
        if at[first : first + 256] != [f"<0x{b:02X}>" for b in range(256)]:
            raise ValueError("the pieces <0x00> to <0xFF> have to follow one another")
        return first

    @cached_property
    def pieces(self) -> dict[str, tuple[int, int]]:
        apart = {*self.unused, *(f"<0x{b:02X}>" for b in range(256))}
        found: dict[str, tuple[int, int]] = {}
        for number, (piece, score) in enumerate(self._lines):
            if piece and piece not in apart:
                found.setdefault(piece, (number, score))
        return found

    @property
    def floor(self) -> int:
        """What a character without a piece scores."""
        return min((score for _, score in self.pieces.values()), default=0) - scaled(UNKNOWN)

    @property
    def eos_id(self) -> int:
        return [piece for piece, _ in self._lines].index(self.eos_piece)

    def parts(self, text: Column) -> Column:
        blank = F.when(F.length(text) > 0, BLANK).otherwise("")
        spelled = F.concat(blank, F.translate(text, " ", BLANK))
        if any(BLANK in piece[1:] for piece in self.pieces):
            return F.when(text.isNotNull(), F.array(spelled))
        return F.regexp_extract_all(spelled, F.lit(f"{BLANK}?[^{BLANK}]+|{BLANK}"), F.lit(0))

    def encoder(self):
        pieces, floor, bytes_from = self.pieces, self.floor, self.bytes_from
        longest = max(map(len, pieces), default=1)

        def ids(part: bytes) -> list[int]:
            text, out = part.decode("utf-8"), []
            for start, end, number in best_path(text, pieces, longest, floor):
                out.extend((number,) if number is not None else (bytes_from + b for b in text[start:end].encode("utf-8")))
            return out

        def distinct(parts: list[bytes]) -> pa.ListArray:
            found = [ids(p) for p in parts]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            values = np.fromiter((i for row in found for i in row), np.int32, int(ends[-1]))
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))

        return lambda rows: _encode_parts(rows, distinct)

    def decode(self, ids: list[int]) -> str:
        """The text that ids came from."""
        lines, first, out = self._lines, self.bytes_from, b""
        for number in ids:
            byte = first <= number < first + 256
            out += bytes((number - first,)) if byte else lines[number][0].encode("utf-8")
        return out.decode("utf-8", "replace").replace(BLANK, " ").removeprefix(" ")
