"""Secret scan with a recursive decoding worklist.

Every text is scanned as it is; then encoded layers in it (percent escapes,
Unicode escapes and compatibility letters, base64, and compressed data inside
base64) are unwrapped, and each layer is scanned and unwrapped in turn until no
new layer turns up. A layer whose content was seen at the same place ends the
branch, so self-reproducing data cannot loop. Findings in a layer are mapped
through all layers above to code points of the document. Base64 is read from each of four
letters on, as text and, where it may be compressed, unpacked as well; bytes that are
not UTF-8 do not hide the rest. A reading without findings of which under three quarters
are letters or signs is not counted as a layer.

Null text counts as empty and has no findings; each row is scanned by itself, so
repeated rows give repeated results; columns other than the two named are not
read. A compressed layer is unwrapped in overlapping windows of ``WINDOW`` code
points, so memory stays bounded whatever it unpacks to.
"""

from __future__ import annotations

import base64
import bisect
import bz2
import codecs
import hashlib
import lzma
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from corploom.llm.frames import in_parts, pick, texts

KINDS = ("assign", "access", "hex")
WINDOW = 1 << 22
OVERLAP = 1 << 16
SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}"
    r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+"
)
_ONE_ESCAPE = re.compile(r"\\[uUx]\{?([0-9A-Fa-f]+)\}?|&#([0-9]+);|&#[xX]([0-9A-Fa-f]+);")
_WIDE = re.compile("[\uff01-\uff5e\U0001d400-\U0001d7ff]")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_WRAPPED = re.compile(r"(?:[A-Za-z0-9+/]{60,80}\r?\n)+[A-Za-z0-9+/]{2,80}={0,2}")
_URL_SAFE = str.maketrans("-_", "+/")
# the two bytes a zlib stream begins with: method 8, a window of up to 32 KB, a check, no dictionary
_ZLIB = [bytes((c, f)) for c in range(0x08, 0x80, 0x10) for f in range(256) if (c << 8 | f) % 31 == 0 and not f & 32]
_PACKED = re.compile(
    rb"(?=\x1f\x8b|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|" + b"|".join(map(re.escape, _ZLIB)) + rb")", re.S
)

Up = Callable[[int, int], tuple[int, int]]


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the plain secrets of one layer."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _substituted(text: str, runs: list[tuple[int, int, str]]) -> tuple[str, Up]:
    """``text`` with each run replaced, and the way back. Where a run gives one
    letter for each equal share of it, its letters map singly, else all of them
    map to the whole run."""
    parts, at, size = [], 0, 0
    here: list[int] = []  # where a replaced run starts in the new text
    there: list[tuple[int, int, int]] = []  # its length there, its source start and end
    for start, end, new in runs:
        parts.append(text[at:start])
        size += start - at
        here.append(size)
        there.append((len(new), start, end))
        parts.append(new)
        size += len(new)
        at = end
    parts.append(text[at:])

    def place(i: int, last: bool) -> int:
        k = bisect.bisect_right(here, i) - 1
        if k < 0:
            return i + last
        length, start, end = there[k]
        into = i - here[k]
        if into >= length:
            return end + into - length + last
        if length and (end - start) % length == 0:
            step = (end - start) // length
            return start + (into + last) * step
        return end if last else start

    return "".join(parts), lambda s, e: (place(s, False), place(e - 1, True))


def _unpercent(run: str) -> str:
    raw = bytes.fromhex(run.replace("%", ""))
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _unescape(run: str) -> str | None:
    points = [int(m[1] or m[3] or "0", 16) if m[2] is None else int(m[2]) for m in _ONE_ESCAPE.finditer(run)]
    if any(p > 0x10FFFF for p in points):
        return None
    try:  # pairs of surrogates make one letter
        return "".join(map(chr, points)).encode("utf-16", "surrogatepass").decode("utf-16")
    except UnicodeDecodeError:
        return None


def _unpacker(head: bytes) -> Callable | None:
    """What makes an unpacker for data that begins with ``head``; None if it is not compressed."""
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return lambda: zstandard.ZstdDecompressor().decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor
    return (lambda: zlib.decompressobj(47)) if _PACKED.match(head) else None


def _unpacked(make: Callable, chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Unpacks little by little, member after member; damaged data ends it."""
    unpacker = None
    for chunk in chunks:
        for at in range(0, len(chunk), 1024):
            part = chunk[at : at + 1024]
            while len(part):
                unpacker = unpacker or make()
                try:
                    out = unpacker.decompress(part)
                except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError):
                    return
                if out:
                    yield out
                if not getattr(unpacker, "eof", False):
                    break
                part, unpacker = unpacker.unused_data, None


def _windows(source: Callable[[], Iterator[bytes]], seen: frozenset = frozenset()) -> Iterator[str]:
    """Unpacked text in overlapping windows; what may be compressed again is read as text
    and then unpacked on, from ``source`` anew, unless it is the same as a layer above."""
    head, digest = b"", hashlib.md5()
    decoder, held = codecs.getincrementaldecoder("utf-8")("replace"), ""
    for chunk in source():
        head += chunk[: 8 - len(head)]
        digest.update(chunk)
        held += decoder.decode(chunk)
        while len(held) > WINDOW:
            yield held[:WINDOW]
            held = held[WINDOW - OVERLAP :]
    yield held + decoder.decode(b"", True)
    make, mark = _unpacker(head), digest.digest()
    if make is not None and mark not in seen:
        yield from _windows(lambda: _unpacked(make, source()), seen | {mark})


def _from_base64(run: str) -> Iterator[tuple[int, bytes]]:
    """What ``run`` gives from each of its first four letters on: base64 may follow
    letters, slashes, dashes and underscores, and reads in one of the four."""
    run = run.rstrip("=").translate(_URL_SAFE)
    for offset in range(4):
        body = run[offset : len(run) - ((len(run) - offset) % 4 == 1)]
        yield offset, base64.b64decode(body + "=" * (-len(body) % 4))


def _reads(text: str) -> bool:
    """Whether most of a layer are letters or signs, so that it is one and not chance."""
    good = sum(map(str.isprintable, text[:WINDOW])) + sum(map(text[:WINDOW].count, "\t\n\r")) - text[:WINDOW].count("\ufffd")
    return 4 * good >= 3 * len(text[:WINDOW])


def _inside(start: int, end: int, text: str) -> Up:
    """Way back from base64 at ``start``: four letters hold three bytes."""
    if text.isascii():
        return lambda s, e: (start + s * 4 // 3, min(end, start - (-e * 4 // 3)))
    return lambda s, e: (
        start + len(text[:s].encode("utf-8", "surrogateescape")) * 4 // 3,
        min(end, start - (-len(text[:e].encode("utf-8", "surrogateescape")) * 4 // 3)),
    )


def _in_base64(run: str, start: int, end: int, straight: bool) -> Iterator[tuple[str, Up]]:
    """Every reading of a run of base64: as text, whatever bytes are between, and
    unpacked from each place where compressed data may begin."""
    for offset, data in _from_base64(run):
        inner = data.decode("utf-8", "surrogateescape")  # one code point for each odd byte
        yield inner, _inside(start + offset, end, inner) if straight else lambda s, e: (start, end)
        for m in _PACKED.finditer(data):
            at = start + offset + m.start() * 4 // 3 if straight else start
            packed = memoryview(data)[m.start() :]
            make = _unpacker(bytes(packed[:8]))
            for window in _windows(lambda: _unpacked(make, iter((packed,)))):
                yield window, lambda s, e, at=at: (at, end)


def layers(text: str) -> Iterator[tuple[str, Up]]:
    """The layers one step inside ``text``, each with the way back to it."""
    if "%" in text and (runs := [(m.start(), m.end(), _unpercent(m[0])) for m in _PERCENT.finditer(text)]):
        yield _substituted(text, runs)
    if "\\" in text or "&#" in text:
        found = ((m.start(), m.end(), _unescape(m[0])) for m in _ESCAPE.finditer(text))
        if runs := [r for r in found if r[2] is not None]:
            yield _substituted(text, runs)
    if not text.isascii():
        plain = ((m.start(), m.end(), unicodedata.normalize("NFKC", m[0])) for m in _WIDE.finditer(text))
        if runs := [r for r in plain if len(r[2]) == 1]:
            yield _substituted(text, runs)
    for pattern, straight in ((_BASE64, True), (_WRAPPED, False)):
        for m in pattern.finditer(text):
            run = m[0] if straight else re.sub(r"\s", "", m[0])
            yield from _in_base64(run, m.start(), m.end(), straight)


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int]:
    """Base findings, all findings, and the number of layers under the text."""
    base = find(text)
    spans = set(base)
    seen = {(hashlib.md5(text.encode("utf-8", "surrogatepass")).digest(), 0, len(text))}
    work: list[tuple[str, Up]] = [(text, lambda s, e: (s, e))]
    depth = 0
    while work:
        outer, up = work.pop()
        for inner, step in layers(outer):
            if not inner:
                continue
            place = up(*step(0, len(inner)))
            mark = (hashlib.md5(inner.encode("utf-8", "surrogatepass")).digest(), *place)
            if mark in seen:
                continue
            seen.add(mark)
            root: Up = lambda s, e, up=up, step=step: up(*step(s, e))
            found = find(inner)
            for start, kind, end in found:
                a, b = root(start, end)
                spans.add((a, kind, b))
            depth += bool(found) or _reads(inner)
            work.append((inner, root))
    return base, sorted(spans), depth


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, base, spans, n_layers)`` per row: findings in the text as it is, all
    findings, and how many layers were unwrapped. ``kind`` numbers ``KINDS``."""
    source = pick(docs, id=id_col, text=text_col)
    fields = source.schema["id"].dataType.simpleString()
    spans = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), texts(batch, 1))
            for part in in_parts(((key, *scan(text)) for key, text in rows), 2000):
                ids, base, every, depth = zip(*part)
                named = [[{"start": s, "kind": k, "end": e} for s, k, e in r] for r in base]
                found = [[{"start": s, "kind": k, "end": e} for s, k, e in r] for r in every]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, batch.column(0).type),
                        pa.array(named, spans),
                        pa.array(found, spans),
                        pa.array(depth, pa.int64()),
                    ],
                    ["id", "base", "spans", "n_layers"],
                )

    return source.mapInArrow(run, f"id {fields}, base {SPANS}, spans {SPANS}, n_layers bigint").withColumnRenamed(
        "id", id_col
    )
