"""What a task or a worker holds does not grow with the tables."""

import glob

import pyarrow as pa
from pyspark.sql import functions as F

from checks import fixtures, queries
from corploom.functions.tokenizers import ByteTokenizer, tokens_of
from corploom.functions.workers import PART_BYTES, in_slices


class Watched(ByteTokenizer):
    """Refuses to encode much at once."""

    def encoder(self):
        encode = super().encoder()

        def checked(rows):
            if rows.nbytes > 2 * PART_BYTES:
                raise ValueError(f"{rows.nbytes} bytes at once")
            return encode(rows)

        return checked


def test_texts_are_encoded_a_few_at_a_time(spark):
    texts = spark.range(0, 400, 1, 1).select("id", F.repeat(F.lit("ab c "), 20_000).alias("text"))
    sizes = texts.select(F.size(tokens_of("text", Watched())).alias("n")).distinct().collect()
    assert [r.n for r in sizes] == [100_000]


def test_slices_hold_all_rows():
    rows = pa.array([["a" * i] * (i % 3) for i in range(50)] + [None])
    for size in (1, 100, 1 << 20):
        assert pa.concat_arrays(list(in_slices(rows, size))).equals(rows)
    assert [len(s) for s in in_slices(rows.slice(0, 0))] == [0]


def test_plain_lines_have_more_files_for_more_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "DOCS_PER_RANGE", 10)
    rows = [(i * 37 % 101, f"text {i * 37 % 101}") for i in range(101)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = fixtures.plain_jsonl(spark, str(tmp_path))
    assert len(glob.glob(f"{out}/part-*")) > 6
    read = queries.scan_order(spark, str(tmp_path)).orderBy("rank").collect()
    assert [r.text for r in read] == [f"text {i}" for i in range(101)]


def test_a_log_grows_by_more_files_and_the_rates_stay(spark, sf, monkeypatch):
    monkeypatch.setattr(fixtures, "LINES_PER_FILE", 100)
    monkeypatch.setattr(fixtures, "_made", {})
    assert fixtures.files_per_step(spark, fixtures.growing_log(spark, sf)) > 1
    got = queries.follow_rolling(spark, sf)
    want = queries.rolling_speed(spark, sf)
    key = ["run_id", "batch"]
    assert sorted(r[:5] for r in got.select(*key, "ts_us", "tokens", "tokens_per_sec").fillna(-1).collect()) == sorted(
        r[:5] for r in want.select(*key, "ts_us", "tokens", "tokens_per_sec").fillna(-1).collect()
    )
