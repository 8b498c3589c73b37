"""Rows that operators must not stumble over, and the given tables as Python rows."""

import duckdb

from tests.conftest import DATA

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, row int, tie string, "
    "part int, run int, kept string, score string, _id string, node string, page string, bucket string, `a.b` int"
)
WORDS = "the quick brown fox jumps over the lazy dog and runs away into deep dark woods tonight".split()


def long_text(n):
    return " ".join(f"{WORDS[i % len(WORDS)]}{i % 977}" for i in range(n))


TEXTS = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \n\t ", None),
    (4, "one", None),
    (5, "The same text\nin two rows", "b"),
    (6, "the same text in two rows", "b"),
    (7, "The same  text\nin two rows", "b"),
    (8, long_text(120), "a"),
    (8, long_text(120), "a"),
    (9, long_text(119) + " changed", "c"),
    (10, long_text(40_000), "c"),
    (None, "no identifier here at all", "c"),
    (None, None, None),
    (11, "x" * 70_000, "c"),
    (12, "naïve café “quoted” — 漢字 ́ \U0001f600 \x00 end ", "b"),
    (13, "The same text\nin two rows", "b"),
]


def edge(spark, texts=TEXTS):
    rows = [(i, t, "en", s, 0, "x", 1, "y", 2, 3, "no", "z", "q", "n", "p", "b", 4) for i, t, s in texts]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def given(table="documents", columns="doc_id, text"):
    return duckdb.sql(f"SELECT {columns} FROM '{DATA}/{table}.parquet'").fetchall()
