"""WARC archives: written a capture at a time, read back and put together again.

A capture is a ``response`` (or, where another capture has the same payload, a
``revisit`` of it) with a ``request`` and a ``metadata`` record that name it in
``WARC-Concurrent-To``. Each record is a gzip member of its own, as the format
advises. Reading streams an archive record by record; what belongs together is
then joined through the concurrent-to identifiers into one nested row.

Null payloads count as empty, a null address is written as ``about:blank`` and read
back as that. A null page number is written as none. Of equal payloads the
capture with the largest page number is the response; rows that share that number
and the payload are all responses. If no row of a group has a number, all are
responses. Other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corploom.llm.frames import file_system, pick
from corploom.session import stage

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "file string, record_id string, type string, concurrent_to string, target_uri string, date string, "
    "content_type string, refers_to_uri string, payload_digest string, payload_bytes bigint, "
    "fields map<string,string>, payload binary"
)
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in headers if value is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}", "", ""])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _uri(url: str | None) -> str:
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"


def _capture(name: str, number: int, page, url, payload: bytes, sha256: str, refers_to_uri, revisit) -> bytes:
    """The members of one capture."""
    ids = [f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}/{number}/{k}')}>" for k in ("main", "request", "meta")]
    uri, digest = _uri(url), sha1_base32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri)]
    main = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", ids[0]), *common]
    main += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit:
        main += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To-Target-URI", _uri(refers_to_uri)),
            ("WARC-Refers-To-Date", DATE),
        ]
    parts = urlsplit(uri) if "[" not in uri else None  # a bracket may be no address
    host, path = (parts.netloc, parts.path or "/") if parts else ("", "/")
    asked = f"GET {path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    told = f"page-id: {page}\r\npayload-sha256: {sha256}\r\n" if page is not None else f"payload-sha256: {sha256}\r\n"
    side = lambda kind, own, content: [
        ("WARC-Type", kind),
        ("WARC-Record-ID", own),
        *common,
        ("WARC-Concurrent-To", ids[0]),
        ("Content-Type", content),
    ]
    return (
        _member(side("request", ids[1], "application/http;msgtype=request"), asked)
        + _member(main, http.encode() + (b"" if revisit else payload))
        + _member(side("metadata", ids[2], "application/warc-fields"), told.encode())
    )


def write_warc(
    pages: DataFrame,
    root: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 0,
) -> None:
    """Write ``root``/``*.warc.gz`` and the table ``root``/``archives`` of the files that
    count. Payloads of fewer than ``min_revisit_bytes`` bytes are never revisits."""
    source = pick(pages, page=id_col, url=url_col, text=payload_col).select(
        "page", "url", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("payload")
    )
    keyed = source.withColumn("sha256", F.sha2("payload", 256))
    long = F.octet_length("payload") >= min_revisit_bytes
    keepers = keyed.where(long & F.col("page").isNotNull()).groupBy("sha256").agg(
        F.max(F.struct("page", "url")).alias("keeper")
    )
    # a payload shared by very many pages is one key of this join; its rows are
    # on the side that Spark splits
    rows = keyed.join(keepers, "sha256", "left").select(
        F.col("page").cast("string"),
        "url",
        "payload",
        "sha256",
        F.col("keeper.url").alias("keeper_url"),
        (F.col("keeper.page").isNotNull() & ~F.col("page").eqNullSafe(F.col("keeper.page"))).alias("revisit"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, out, number, size = f"captures-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", None, 0, 0
        system, folder = file_system(root)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for page, url, payload, sha256, keeper_url, revisit in zip(*columns):
                if out is None:
                    system.create_dir(folder, recursive=True)
                    out = system.open_output_stream(f"{folder}/{name}", compression=None)
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>")]
                    info += [("WARC-Date", DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
                    out.write(_member(info, b"format: WARC File Format 1.1\r\n"))
                members = _capture(name, number, page, url, payload, sha256, keeper_url, revisit)
                out.write(members)
                number, size = number + 1, size + len(members)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([number], pa.int64()), pa.array([size], pa.int64())],
                ["file", "captures", "bytes"],
            )

    rows.mapInArrow(write, "file string, captures bigint, bytes bigint").write.parquet(f"{root}/archives")


def records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an unpacked archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        headers = _header_lines(stream)
        yield headers, stream.read(int(headers["content-length"]))


def _header_lines(stream: BinaryIO) -> dict[str, str]:
    headers: dict[str, str] = {}
    last = None
    while (line := stream.readline().rstrip(b"\r\n")) != b"":
        if line[:1] in b" \t" and last:  # a folded line goes on
            headers[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, _, value = line.decode("utf-8", "replace").partition(":")
        last = name.strip().lower()
        headers[last] = value.strip()
    return headers


def _row(file: str, headers: dict[str, str], block: bytes, payloads: bool) -> tuple:
    kind, fields, payload, size = headers.get("warc-type"), {}, None, None
    digest = headers.get("warc-payload-digest", "").rpartition(":")[2] or None
    if kind in ("response", "revisit") and headers.get("content-type", "").startswith("application/http"):
        body = io.BytesIO(block)
        status = body.readline()
        fields = _header_lines(body)
        fields["status"] = status.decode("latin-1").strip()
        payload = body.read()
        if kind == "response":
            size, here = len(payload), sha1_base32(payload)
            if digest and digest != here:
                raise ValueError(f"{headers.get('warc-record-id')} in {file}: payload does not match its digest")
            digest = here
        else:
            size, payload = int(fields["content-length"]) if "content-length" in fields else None, None
    elif headers.get("content-type") == "application/warc-fields":
        fields = _header_lines(io.BytesIO(block))
    elif kind == "request":
        fields = {"request": block.split(b"\r\n", 1)[0].decode("latin-1")}
    return (
        file,
        headers.get("warc-record-id"),
        kind,
        headers.get("warc-concurrent-to"),
        headers.get("warc-target-uri"),
        headers.get("warc-date"),
        headers.get("content-type"),
        headers.get("warc-refers-to-target-uri"),
        digest,
        size,
        fields,
        payload if payloads else None,
    )


def read_records(spark: SparkSession, root: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives that ``root``/``archives`` names. Payloads are
    read, measured and checked against their digests either way."""
    files = spark.read.parquet(f"{root}/archives").select("file")
    text, long = pa.string(), pa.int64()
    types = [text] * 9 + [long, pa.map_(text, text), pa.binary()]
    names = [c.split()[0] for c in RECORD.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(root)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                raw = system.open_input_stream(f"{folder}/{file}", compression=None)
                rows, held = [], 0
                with gzip.GzipFile(fileobj=io.BufferedReader(raw, 1 << 20)) as unpacked:
                    for headers, block in records(io.BufferedReader(unpacked, 1 << 20)):
                        rows.append(_row(file, headers, block, payloads))
                        held += len(block) if payloads else 500
                        if held > 8 << 20:
                            yield _batch(rows, types, names)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, types, names)

    n = max(1, files.count())
    return files.repartition(n).mapInArrow(read, RECORD)


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    columns[10] = [list(f.items()) for f in columns[10]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def captures(found: DataFrame) -> DataFrame:
    """One nested row per capture from the staged rows of :func:`read_records`: the
    main record's columns, ``requests`` and ``metadata`` (arrays of the records that
    are concurrent to it), ``page_id`` and ``payload_sha256`` from the metadata."""

    def beside(kind: str, name: str) -> DataFrame:
        own = F.struct("record_id", "target_uri", "date", "content_type", F.map_entries("fields").alias("fields"))
        mine = found.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
        return mine.groupBy(F.col("concurrent_to").alias("record_id")).agg(
            F.array_sort(F.collect_list(own)).alias(name)
        )

    def told(field: str):
        """Of the first metadata record that has it."""
        every = F.flatten(F.transform("metadata", lambda m: m["fields"]))
        return F.get(F.filter(every, lambda e: e["key"] == field), F.lit(0))["value"]

    main = found.where(F.col("type").isin("response", "revisit")).drop("concurrent_to")
    return (
        main.join(beside("request", "requests"), "record_id", "left")
        .join(beside("metadata", "metadata"), "record_id", "left")
        .withColumn("page_id", told("page-id").cast("bigint"))
        .withColumn("payload_sha256", told("payload-sha256"))
    )


def resolve(whole: DataFrame) -> DataFrame:
    """Adds ``refers_to`` to staged captures: for a revisit the page number of the
    response with its payload."""
    answered = whole.where((F.col("type") == "response") & F.col("payload_sha256").isNotNull())
    answered = answered.groupBy("payload_sha256").agg(F.max("page_id").alias("response_page"))
    return whole.join(answered, "payload_sha256", "left").withColumn(
        "refers_to", F.when(F.col("type") == "revisit", F.col("response_page"))
    ).drop("response_page")


def read_captures(spark: SparkSession, root: str, payloads: bool = True) -> DataFrame:
    """The archives as one nested row per capture. Records and captures are staged;
    the caller's job deletes them."""
    found = stage(read_records(spark, root, payloads), "warc-records")
    return resolve(stage(captures(found), "warc-captures"))
