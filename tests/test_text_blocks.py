"""Text files in blocks, block starts in parts, the sample index, merges by heap."""

import random
import time

import pytest
from pyspark.sql import functions as F

from checks.fixtures import small_bpe
from corploom.functions.tokenizers import merged, tokenizer, tokens_of
from corploom.operators import ordering
from corploom.operators.packing import pack, pack_in_order
from corploom.operators.sample_index import read_samples, sample_index
from corploom.plans.corpus import text_to_shards
from corploom.sources.readers import scan_shards
from corploom.sources.text_blocks import scan_text_blocks


def texts():
    rng = random.Random(1)
    words = ["the", "naïve", "漢字", "don't", "x" * 70, "a b", "\U0001f600", "end."]
    blanks = [" ", "\n", "  ", "\t", "\r\n", " 　", "  "]
    return {
        "a b/1.txt": "".join(rng.choice(words) + rng.choice(blanks) for _ in range(3000)),
        "a b/2.txt": "z",
        "b.txt": "   leading and no end",
        "c.txt": "漢字" * 2000,  # nowhere to cut but between characters
        "d é.txt": " " * 5000 + "word" + "\n" * 700,
        "e.txt": "y" * 9000 + " z",
    }


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("texts")
    for name, text in texts().items():
        (root / name).parent.mkdir(exist_ok=True)
        (root / name).write_bytes(text.encode())
    (root / "empty.txt").touch()
    return str(root)


@pytest.mark.parametrize("cuts", ("blank", "char", None))
@pytest.mark.parametrize("block", (7, 100, 1 << 20))
def test_blocks_make_the_files(spark, folder, cuts, block):
    rows = scan_text_blocks(spark, folder, cuts, block).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.file_path, r.file_block_start)):
        found.setdefault(r.file_path, []).append(r)
    assert [("".join(r.text for r in v)) for _, v in sorted(found.items())] == [t for _, t in sorted(texts().items())]
    assert all([r.is_last for r in v] == [False] * (len(v) - 1) + [True] for v in found.values())
    if cuts == "char" and block == 100:
        assert max(len(r.text.encode()) for r in rows) <= 103
    if block == 7 and cuts == "blank":
        assert len([r for r in rows if r.text]) > 1000


@pytest.mark.parametrize("tok", ("words", "bytes", "bpe"))
def test_blocks_give_the_tokens_of_the_whole(spark, folder, tok):
    tok = small_bpe() if tok == "bpe" else tok
    whole = spark.createDataFrame([(k, t) for k, t in texts().items()], "name string, text string")
    whole = {r["name"]: r["tokens"] for r in whole.select("name", tokens_of("text", tok).alias("tokens")).collect()}
    blocks = scan_text_blocks(spark, folder, tokenizer(tok).cuts, 64).select("file_path", "file_block_start", tokens_of("text", tok).alias("t"))
    found = {}
    for r in sorted(blocks.collect(), key=lambda r: (r.file_path, r.file_block_start)):
        found.setdefault(r.file_path, []).extend(r.t)
    assert [v for _, v in sorted(found.items())] == [v for _, v in sorted(whole.items())]


def test_job_over_blocks(spark, folder, tmp_path):
    done = []
    for block in (50, 1 << 20):
        out = str(tmp_path / str(block))
        text_to_shards(spark, folder, out, 16, "words", block=block)
        done.append(sorted((r.sample_id, r.tokens) for r in scan_shards(spark, out, "train").collect()))
    eos, words = tokenizer("words").eos_id, tokenizer("words").encoder()
    stream = []
    for _, text in sorted(texts().items()):
        import pyarrow as pa
        import re

        stream += words(pa.array([[w for w in re.split(r"[ \t\n\r]+", text)]], pa.list_(pa.string())))[0].as_py() + [eos]
    want = [(i, stream[16 * i : 16 * i + 16]) for i in range(len(stream) // 16)]
    assert done == [want, want]


def test_starts_of_many_blocks_move_no_tokens(spark, monkeypatch):
    monkeypatch.setattr(ordering, "MAX_SLOTS", 3)
    rows = [(f"f{i:02}", 100 * b, [i] * (b + 1)) for i in range(9) for b in range(4)]
    frame = spark.createDataFrame(rows, "file_path string, file_block_start bigint, tokens array<int>").repartition(5)
    placed = ordering.in_scan_order(frame.sortWithinPartitions("file_path", "file_block_start"))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and plan.count("BroadcastExchange") >= 12
    got = sorted((r.file_path, r.file_block_start, r.doc_ord, r.tok_offset, r.n_docs) for r in placed.collect())
    want, at = [], 0
    for k, (f, b, t) in enumerate(rows):
        want.append((f, b, k, at, 36))
        at += len(t)
    assert got == want


@pytest.mark.parametrize("seq_len", (1, 7, 64, 5000))
@pytest.mark.parametrize("keep_tail", (False, True))
def test_sample_index(spark, seq_len, keep_tail):
    rng = random.Random(seq_len)
    docs = [(i, [rng.randrange(99) for _ in range(rng.choice([0, 1, 3, 20, 400]))]) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id bigint, tokens array<int>")
    for slots in (1, 9):
        indexed = ordering.with_offsets(frame, "doc_id", slots=slots)
        index = sample_index(indexed, seq_len, keep_tail)
        stream = [(d, k) for d, t in docs for k in range(len(t))]
        want = []
        for s in range(0, len(stream), seq_len):
            if keep_tail or s + seq_len <= len(stream):
                (d, k), (e, last) = stream[s], stream[min(s + seq_len, len(stream)) - 1]
                want.append((s // seq_len, d, k, e, last + 1))
        assert sorted(tuple(r) for r in index.collect()) == want
        packed = sorted((r.sample_id, r.tokens) for r in pack_in_order(frame, "doc_id", seq_len, keep_tail).collect())
        assert sorted((r.sample_id, r.tokens) for r in read_samples(indexed, index, seq_len, keep_tail).collect()) == packed
        some = index.where("sample_id in (0, 2)")
        assert sorted((r.sample_id, r.tokens) for r in read_samples(indexed, some, seq_len, keep_tail).collect()) == [p for p in packed if p[0] in (0, 2)]


def test_index_reads_no_tokens(spark, tmp_path):
    frame = spark.range(50).select("id", F.array_repeat(F.lit(1), 9).alias("tokens"))
    path = str(tmp_path / "indexed")
    ordering.with_offsets(frame, "id").write.parquet(path)
    plan = sample_index(spark.read.parquet(path), 16)._jdf.queryExecution().executedPlan().toString()
    assert "tokens" not in plan.split("ReadSchema:")[1].split(">")[0].replace("n_tokens", "")
    assert pack(spark.read.parquet(path), 16).count() == sample_index(spark.read.parquet(path), 16).count()


def merged_slowly(part, ranks):
    symbols = list(part)
    while len(symbols) > 1:
        pair = min(zip(symbols, symbols[1:]), key=lambda p: ranks.get(p, len(ranks)))
        if pair not in ranks:
            break
        out, i = [], 0
        while i < len(symbols):
            both = tuple(symbols[i : i + 2]) == pair
            out.append("".join(pair) if both else symbols[i])
            i += 2 if both else 1
        symbols = out
    return symbols


def test_merges_by_heap():
    rng = random.Random(3)
    for _ in range(300):
        pool = ["a", "b", "c"]
        ranks = {}
        for _ in range(rng.randrange(1, 25)):  # in any order, also pairs that a later merge makes
            pair = (rng.choice(pool), rng.choice(pool))
            ranks.setdefault(pair, len(ranks))
            pool.append("".join(pair))
        order = list(ranks)
        rng.shuffle(order)
        ranks = {p: i for i, p in enumerate(order)}
        part = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 60)))
        assert merged(part, ranks) == merged_slowly(part, ranks)


def test_a_long_part_is_quick():
    rng = random.Random(4)
    pool, ranks = list("abcdefgh"), {}
    while len(ranks) < 50_000:
        pair = (rng.choice(pool), rng.choice(pool))
        if pair not in ranks and len(pair[0]) + len(pair[1]) < 12:
            ranks[pair] = len(ranks)
            pool.append("".join(pair))
    start = time.perf_counter()
    merged("".join(rng.choice("abcdefgh") for _ in range(100_000)), ranks)
    assert time.perf_counter() - start < 4


def test_a_text_folder_has_few_folders(spark, tmp_path):
    """A folder for each file made listing and moving them the whole job."""
    from checks import fixtures, queries
    from corploom.sources.readers import scan_text

    rows = [(i, f"text {i}") for i in range(0, 2100, 7)] + [(7, "text 7"), (7, "other"), (14, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    root = fixtures.text_folder(spark, str(tmp_path))
    read = scan_text(spark, root)
    got = read.select(queries.doc_of_path("file_path").alias("doc_id"), "text", "file_path").collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted((i, f"{t or ''}\n") for i, t in rows)
    assert len({r.file_path.rsplit("/", 1)[0] for r in got}) == 3
    assert [r.doc_id for r in sorted(got, key=lambda r: r.file_path)] == sorted(i for i, _ in rows)


def test_files_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """As Spark lists and reads them, but no name comes to the driver."""
    import gzip

    from corploom.sources import text_blocks as at
    from corploom.sources.readers import scan_text

    names = ("a.txt", "b c.txt", "é%41.txt", "x=1&[y]{z}.txt", "_hidden", ".dot", "_k=v", "漢　.txt", "n._COPYING_")
    for folder in ("", "p=1", "p=1/q r", "_no", "é"):
        (tmp_path / folder).mkdir(exist_ok=True, parents=True)
        for name in names:
            (tmp_path / folder / name).write_text(f"{folder} {name}\nline\r\n ü")
    (tmp_path / "empty.txt").touch()
    (tmp_path / "p.txt.gz").write_bytes(gzip.compress(b"one\n") + gzip.compress(b"two"))
    (tmp_path / "nothing.gz").write_bytes(gzip.compress(b""))
    folder = str(tmp_path)
    spark_files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    want = spark_files.where("length > 0").select(F.col("_metadata.file_path").alias("file_path"), "path", "length").collect()
    monkeypatch.setattr(at, "LISTED", 2)
    files = at.list_files(spark, folder)
    assert sorted(files.collect()) == sorted(want) and len(want) == 4 * 6 + 2
    assert "mapInArrow" not in files._jdf.queryExecution().toString() and not any(name.endswith(".txt") for name in files.inputFiles())
    whole = spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True)
    rows = scan_text(spark, folder)
    assert sorted(rows.collect()) == sorted(whole.select("_metadata.file_path", "value").collect())
    assert not any(name.endswith((".txt", ".gz")) for name in rows.inputFiles())
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_text(spark, f"{folder}/none")
