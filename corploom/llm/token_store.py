"""Token ids in raw shards with a minimal perfect hash index over document keys.

A folder of this format holds

- ``shard-*.ids``: the ids of consecutive documents, nothing between them, as
  little-endian unsigned integers (2 bytes where the vocabulary allows, else 4),
- ``shard-*.len``: the number of ids of each document, 4 bytes each,
- ``index-*.npz``: for a bucket of keys the perfect hash, a 64-bit fingerprint for
  each key, and where its documents lie (shard, number in the shard, offset, size),
- ``entries``, ``shards`` and ``buckets``: Parquet tables of the above; only files
  they name count, so what a lost task left behind is never read.

Documents lie in ascending order of their identifier (null first; rows that share
one by a hash of their text). A key's documents are found with one hash,
one probe and one ranged read. Null text is empty and has the end id alone. Other
columns are not read. An empty table gives tables without rows.
"""

from __future__ import annotations

import hashlib
import io
import uuid
from array import array
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corploom.llm.encode import encoder, vocabulary_width
from corploom.llm.frames import file_system, pick, read_file, small_batches, text_of, write_file
from corploom.llm.perfect_hash import PerfectHash, fingerprint, halves

KEYS_PER_BUCKET = 250_000
READ_BYTES = 8 << 20
_NO_KEY = "\x00"


def _digest(key: Column) -> Column:
    return F.md5(F.coalesce(key.cast("string"), F.lit(_NO_KEY)).cast("binary"))


def _bucket(digest: Column, buckets: int) -> Column:
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def write_tokens(
    docs: DataFrame, root: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every document, end it with ``end_id`` and write the folder ``root``.

    The texts are shuffled once, into ranges of the identifier (and of a hash of
    the text, so that a repeated identifier does not end up in one task).
    """
    spark, width = docs.sparkSession, vocabulary_width(tokenizer)
    source = pick(docs, id=id_col, text=text_col).select("id", text_of().alias("text"))
    source = source.withColumn("tie", F.xxhash64("text"))
    ordered = source.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    kind = ordered.schema["id"].dataType

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part = encoder(tokenizer), TaskContext.get().partitionId()
        name = f"shard-{part:06d}-{uuid.uuid4().hex}"
        system, folder = file_system(root)
        out, sizes, offset = None, array("I"), 0
        entry = None  # documents of one identifier make one entry
        fields = ["id", "part", "name", "row", "rows", "offset", "tokens"]
        for batch in batches:
            done: list[list] = []
            for few, ids, edges in codec.batches(batch, 1, end_id):
                if out is None:
                    system.create_dir(folder, recursive=True)
                    out = system.open_output_stream(f"{folder}/{name}.ids")
                out.write(ids.tobytes())
                for key, n in zip(few.column(0).to_pylist(), np.diff(edges).tolist()):
                    if entry is None or key != entry[0]:
                        if entry is not None:
                            done.append(entry)
                        entry = [key, part, name, len(sizes), 0, offset, 0]
                    entry[4] += 1
                    entry[6] += n
                    sizes.append(n)
                    offset += n
            yield _entries(done, fields, batch.schema.field(0).type)
        if out is not None:
            out.close()
            write_file(root, f"{name}.len", np.array(sizes, "<u4").tobytes())
            yield _entries([entry], fields, batch.schema.field(0).type)

    ids = kind.simpleString()
    columns = f"id {ids}, part int, name string, row bigint, rows bigint, offset bigint, tokens bigint"
    with small_batches(spark):
        ordered.mapInArrow(write, columns).write.parquet(f"{root}/entries")

    entries = spark.read.parquet(f"{root}/entries")
    sums = entries.groupBy("part", "name").agg(F.sum("rows").alias("rows"), F.sum("tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    sums.select(
        "*", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"), F.lit(width).alias("width")
    ).write.parquet(f"{root}/shards")
    _write_index(entries, root)


def _entries(rows: list[list], names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    types = [kind, pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _write_index(entries: DataFrame, root: str) -> None:
    spark = entries.sparkSession
    buckets = max(1, -(-entries.count() // KEYS_PER_BUCKET))
    keyed = entries.withColumn("digest", _digest(F.col("id"))).select(
        _bucket(F.col("digest"), buckets).alias("bucket"), F.unhex("digest").alias("digest"), *entries.columns[1:]
    )
    placed = keyed.drop("name").repartitionById(buckets, F.col("bucket"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in groupby(_rows(batches), key=lambda r: r[0]):
            digests, firsts, counts, places = [], [], [], []
            for digest, own in groupby(rows, key=lambda r: r[1]):
                own = [r[2:] for r in own]
                digests.append(digest)
                firsts.append(len(places))
                counts.append(len(own))
                places += own
            a, b = halves(digests)
            hash_ = PerfectHash.build(a, b)
            slots = hash_.lookup(a, b)
            order = np.argsort(slots)
            data = io.BytesIO()
            np.savez(
                data,
                sizes=hash_.sizes,
                words=hash_.words,
                prints=fingerprint(a, b)[order],
                first=np.array(firsts, np.int64)[order],
                count=np.array(counts, np.int64)[order],
                places=np.array(places, np.int64).reshape(-1, 5),
            )
            name = f"index-{bucket:06d}-{uuid.uuid4().hex}.npz"
            write_file(root, name, data.getvalue())
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([name]), pa.array([len(digests)], pa.int64())],
                ["bucket", "file", "keys"],
            )

    files = placed.sortWithinPartitions("bucket", "digest", "part", "row").mapInArrow(
        build, "bucket int, file string, keys bigint"
    )
    files.withColumn("buckets", F.lit(buckets)).write.parquet(f"{root}/buckets")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


class Bucket:
    """One loaded index file."""

    def __init__(self, root: str, name: str):
        data = np.load(io.BytesIO(read_file(root, name)))
        self.hash = PerfectHash(data["sizes"], data["words"])
        self.prints, self.first, self.count = data["prints"], data["first"], data["count"]
        self.places = data["places"]

    def find(self, digests: list[bytes]) -> list[np.ndarray]:
        """For each key its places (shard, row, rows, offset, tokens); none if unknown."""
        a, b = halves(digests)
        slots, prints = self.hash.lookup(a, b), fingerprint(a, b)
        known = (slots >= 0) & (self.prints[slots] == prints) if self.prints.size else np.zeros(a.size, bool)
        none = self.places[:0]
        return [
            self.places[self.first[s] : self.first[s] + self.count[s]] if k else none for s, k in zip(slots, known)
        ]


def find_keys(keys: DataFrame, root: str, id_col: str = "doc_id") -> DataFrame:
    """Where each key's documents lie: ``(id, part, row, rows, offset, tokens)``; keys
    that are not in the store give no row."""
    spark = keys.sparkSession
    files = spark.read.parquet(f"{root}/buckets")
    buckets = (files.agg(F.max("buckets")).first() or [None])[0] or 1
    source = pick(keys, id=id_col).distinct().withColumn("digest", _digest(F.col("id")))
    source = source.select(
        _bucket(F.col("digest"), buckets).alias("bucket"), F.unhex("digest").alias("digest"), "id"
    )
    # one row a bucket of a quarter of a million keys
    named = source.join(F.broadcast(files.select("bucket", "file")), "bucket")
    named = named.select("bucket", "file", "digest", "id").repartitionById(buckets, F.col("bucket"))
    kind = keys.schema[id_col].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, bucket = None, None
        for batch in batches:
            file_names, digests = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            edges = [0, *(i for i in range(1, len(digests)) if file_names[i] != file_names[i - 1]), len(digests)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if file_names[lo] != name:
                    name, bucket = file_names[lo], Bucket(root, file_names[lo])
                places = bucket.find(digests[lo:hi])
                take = np.repeat(np.arange(lo, hi), [len(p) for p in places])
                cells = np.concatenate(places) if places else np.empty((0, 5), np.int64)
                ids = batch.column(3).take(pa.array(take, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(cells[:, i]) for i in range(5))], ["id", "part", "row", "rows", "offset", "tokens"]
                )

    columns = f"id {kind}, part bigint, row bigint, rows bigint, offset bigint, tokens bigint"
    return named.sortWithinPartitions("bucket").mapInArrow(find, columns)


def read_tokens(keys: DataFrame, root: str, id_col: str = "doc_id") -> DataFrame:
    """The documents of ``keys`` from the files: ``id``, ``start`` (ids of all documents
    before it), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit)."""
    spark = keys.sparkSession
    shards = spark.read.parquet(f"{root}/shards")
    n = max(1, shards.count())
    found = find_keys(keys, root, id_col)
    # one row a shard
    named = found.join(F.broadcast(shards.select("part", "name", "base", "width")), "part")
    named = named.select("id", "part", "name", "base", "width", "row", "rows", "offset", "tokens")
    ordered = named.repartitionById(n, F.col("part").cast("int")).sortWithinPartitions("part", "row")
    kind = keys.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(root)
        name, file, sizes = None, None, None
        ids, starts, counts, raws, held = [], [], [], [], 0
        kind = None

        def flush():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, kind),
                    pa.array(starts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(raws, pa.binary()),
                ],
                ["id", "start", "n_tokens", "ids"],
            )

        for batch in batches:
            kind = batch.schema.field(0).type
            for key, _, shard, base, width, row, rows, offset, _ in _rows([batch]):
                if shard != name:
                    name, file = shard, system.open_input_file(f"{folder}/{shard}.ids")
                    sizes = np.frombuffer(read_file(root, f"{shard}.len"), "<u4")
                    window, at = b"", 0
                for size in sizes[row : row + rows].tolist():
                    lo, hi = offset * width - at, (offset + size) * width - at
                    if lo < 0 or hi > len(window):  # rows come in file order: read on
                        at, window = offset * width, file.read_at(max(READ_BYTES, size * width), offset * width)
                        lo, hi = 0, size * width
                    raw = np.frombuffer(window[lo:hi], f"<u{width}").astype("<u4").tobytes()
                    ids.append(key)
                    starts.append(base + offset)
                    counts.append(size)
                    raws.append(raw)
                    offset += size
                    held += len(raw)
                    if held > READ_BYTES:
                        yield flush()
                        ids, starts, counts, raws, held = [], [], [], [], 0
        if ids:
            yield flush()

    columns = f"id {kind}, start bigint, n_tokens bigint, ids binary"
    return ordered.mapInArrow(read, columns).withColumnRenamed("id", id_col)


class TokenStore:
    """Keyed access from one process: a hash, a probe, a ranged read."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root
        # one row a bucket and one a shard; neither table grows with a shard's documents
        rows = spark.read.parquet(f"{root}/buckets").collect()
        self.files, self.buckets = {r.bucket: r.file for r in rows}, max([1, *(r.buckets for r in rows)])
        self.shards = {r.part: (r.name, r.width) for r in spark.read.parquet(f"{root}/shards").collect()}
        self.loaded: dict[int, Bucket] = {}

    def get(self, key) -> list[np.ndarray]:
        """The ids of each document with this key; empty if there is none."""
        digest = hashlib.md5((_NO_KEY if key is None else str(key)).encode())
        bucket = int(digest.hexdigest()[:8], 16) % self.buckets
        if bucket not in self.files:
            return []
        if bucket not in self.loaded:
            self.loaded[bucket] = Bucket(self.root, self.files[bucket])
        out = []
        for part, row, rows, offset, _ in self.loaded[bucket].find([digest.digest()])[0].tolist():
            name, width = self.shards[part]
            for size in np.frombuffer(read_file(self.root, f"{name}.len", row * 4, rows * 4), "<u4").tolist():
                raw = read_file(self.root, f"{name}.ids", offset * width, size * width)
                out.append(np.frombuffer(raw, f"<u{width}").astype(np.uint32))
                offset += size
        return out
