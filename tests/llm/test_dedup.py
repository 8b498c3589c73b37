import hashlib
import random
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest

from corploom.llm import exact_dedup, near_dedup
from corploom.llm.components import components
from corploom.llm.exact_dedup import dedup_exact, keep_exact
from corploom.llm.near_dedup import dedup_near, keep_near
from corploom.llm.shingles import Words
from tests.llm.cases import TEXTS, edge, empty, long_text

BLANKS = " \t\n\x0b\x0c\r"


def norm(text):
    return "".join(c for c in text or "" if c not in BLANKS)


def exact_by_hand(rows):
    """id -> (keep_id, group size), the kept rows counted by group."""
    out = []
    for key, group in groupby(sorted(rows, key=lambda r: norm(r[1])), key=lambda r: norm(r[1])):
        group = list(group)
        best = min(group, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(r[0], best[0], len(group), hashlib.sha256(key.encode()).hexdigest()) for r in group]
    return sorted(out, key=str)


def test_exact_edge_rows(spark):
    got = dedup_exact(edge(spark)).collect()
    rows = [(i, t) for i, t, _ in TEXTS]
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == exact_by_hand(rows)
    assert sum(r.kept for r in got) == len({norm(t) for _, t in rows})
    kept = keep_exact(edge(spark))
    assert kept.columns == edge(spark).columns
    assert sorted(norm(r.text) for r in kept.collect()) == sorted({norm(t) for _, t in rows})
    assert dedup_exact(empty(spark)).collect() == [] and keep_exact(empty(spark)).collect() == []


def test_one_text_over_many_partitions(spark):
    """A third of the rows are one text: its run goes through whole partitions."""
    rows = [(i, "shared text of all" if i % 3 else f"own text {i}") for i in range(3000)]
    random.Random(1).shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = dedup_exact(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == exact_by_hand(rows)
    assert sum(r.kept for r in got) == 1001


def test_equal_digest_is_not_enough(spark, monkeypatch):
    """Neighbours are compared in full."""
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: exact_dedup.F.lit("same"))
    monkeypatch.setattr(exact_dedup, "HEAD", 1)
    rows = [(i, f"x{i // 2}") for i in range(200)]
    got = dedup_exact(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(i, i - i % 2, 2) for i, _ in rows}


def words(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for b in BLANKS[1:]:
        text = text.replace(b, " ")
    return [w for w in text.split(" ") if w]


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def near_by_hand(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    members = {}
    for i, (key, _) in enumerate(rows):
        members.setdefault(find(i), []).append(key)
    least = {r: min([k for k in ks if k is not None], default=None) for r, ks in members.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=str), len(members)


def changed(rng, text, every):
    w = text.split(" ")
    for i in range(rng.randrange(every), len(w), every):
        w[i] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("seed", range(2))
def test_near_groups(spark, seed):
    """Chains, copies and many near copies of one text, with similarities on both sides
    of the limit."""
    rng = random.Random(seed)
    rows = []
    for g in range(12):
        text = " ".join(f"w{rng.randrange(4000)}" for _ in range(rng.randrange(6, 300)))
        for _ in range(rng.choice((1, 2, 6, 40 if g == 0 else 3))):
            rows.append((len(rows), text))
            text = changed(rng, text, rng.choice((25, 40, 60))) if rng.random() < 0.5 else text
            rows.append((len(rows), changed(rng, text, rng.choice((20, 30, 35, 45, 80)))))
    rng.shuffle(rows)
    want, groups = near_by_hand(rows)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = dedup_near(frame).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and sum(r.kept for r in got) == groups
    assert len(keep_near(frame).collect()) == groups


def test_near_edge_rows(spark):
    rows = [(i, t) for i, t, _ in TEXTS]
    want, _ = near_by_hand(rows)
    # rows without words are alone, whatever else has their identifier
    got = dedup_near(edge(spark)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert keep_near(edge(spark)).columns == edge(spark).columns
    assert dedup_near(empty(spark)).collect() == [] and keep_near(empty(spark)).collect() == []


def test_open_buckets_are_compared(spark, monkeypatch):
    """With buckets that hold everything, the first member links few; the rest has to
    be found by the second comparison."""
    monkeypatch.setattr(near_dedup, "band_keys", lambda low: np.array([7], np.int64))
    rng = random.Random(5)
    rows = []
    for _ in range(15):
        text = " ".join(f"w{rng.randrange(9000)}" for _ in range(80))
        rows += [(len(rows), text), (len(rows) + 1, changed(rng, text, 79))]
    want, _ = near_by_hand(rows)
    got = dedup_near(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want


def test_signature_is_circulant():
    members = np.arange(1, 200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    low = near_dedup.signature(members)
    first = near_dedup.mix(members ^ near_dedup._SHUFFLE)
    for k in (0, 1, 77, near_dedup.ROWS * near_dedup.BANDS - 1):
        assert low[k] == near_dedup.mix((first - np.uint64(k)) ^ near_dedup._SHIFTED).min()
    other = np.append(members[:150], members[:50] + np.uint64(3))
    agree = (low == near_dedup.signature(np.unique(other))).mean()
    assert abs(agree - 150 / 249) < 0.2


def test_word_hashes_tell_words_apart():
    texts = ["Aa bB\tc\x0bd", None, "", "aA Bb c d", "漢 字 x", " lead", long_text(50)]
    found = Words(pa.array(texts), lower=True)
    seen = {}
    for i, text in enumerate(texts):
        own = found.hashes[found.begins[i] : found.begins[i + 1]].tolist()
        assert len(own) == len(words(text))
        for h, w in zip(own, words(text)):
            assert seen.setdefault(h, w) == w
    assert len(seen) == len(set(seen.values()))


@pytest.mark.parametrize("n", (1, 2, 60))
def test_components_of_paths_and_stars(spark, n):
    links = [(i, i + 1) for i in range(n)] + [(1000, 1000 + i) for i in range(1, n)] + [(5000 + n, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000 + i: 1000 for i in range(n) if n > 1} | {5000: 5000, 5000 + n: 5000}
