"""Prefix trie, Merkle manifest and URL filter against plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from corploom.llm import prefix_trie as pt
from corploom.llm.merkle import folded, leaf_of, manifest, proof_hash
from corploom.llm.queries import RULES
from corploom.llm.ranks import ranked
from corploom.llm.url_filter import bloom, canonical, judge_urls, may_hold
from tests.llm.cases import edge, empty

TURNS = "conv_id bigint, turn bigint, role string, text string, n bigint, depth string, key int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sequences(rows):
    """Turns by conversation, in order."""
    out = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = h(f"{len(role.encode())}:{role}{text}")
            out.setdefault(c, []).append(((turn is not None, turn or 0, tie), (role, text)))
    return {c: [t for _, t in sorted(v)] for c, v in out.items()}


def put_together(of):
    out = {}
    for c, own in of.items():
        n = zlib.crc32(str(c).encode()) % 9
        out[c] = of.get(c - c % 5, [])[:n] + own[n:]
    return out


def trie_by_hand(of):
    members = {}
    for c, turns in of.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = {}
    for way in sorted(members, key=len, reverse=True):
        kids = [k for k in members if len(k) == len(way) + 1 and k[:-1] == way]
        leaves = sum(out[k][5] for k in kids) or 1
        cost = (len(members[way]) - 1) * len(way[-1][1].encode()) if way else 0
        saved = cost + sum(out[k][6] for k in kids)
        ends = ",".join(str(c) for c in sorted(members[way]) if len(of[c]) == len(way))
        up = min(members[way[:-1]]) if way else None
        out[way] = (min(members[way]), len(way), up, len(members[way]), len(kids), leaves, saved, h(ends))
    return sorted(map(str, out.values()))


def got(trie):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256")
    return sorted(str(tuple(r)) for r in pt.with_ends(trie).select(*columns).collect())


def conversations(seed, n=60, letters=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.choice([1, 2, 3, 5, 9])):
            rows.append((c, turn, rng.choice(["user", "assistant"]) if rng.random() < 0.3 else "user", rng.choice("aéb"[:letters]) * rng.randrange(1, 3), 0, "x", 1))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", (2, 7, 1000))
def test_trie(spark, limit):
    rows = conversations(limit)
    frame = spark.createDataFrame(rows, TURNS).repartition(5)
    assert got(pt.build(pt.turns_of(frame), limit)) == trie_by_hand(sequences(rows))


def test_trie_over_chunks(spark, monkeypatch):
    """Conversations that share several chunks, end with one, or are a part of another."""
    monkeypatch.setattr(pt, "CHUNK", 4)
    texts = [["a"] * 11, ["a"] * 11, ["a"] * 8, ["a"] * 8 + ["b"], ["a"] * 4, ["b"] * 4, ["b"] * 5, ["c"] * 20]
    rows = [(c, t, "user", x, 0, "x", 1) for c, turns in enumerate(texts) for t, x in enumerate(turns)]
    for limit in (3, 100):
        assert got(pt.build(pt.turns_of(spark.createDataFrame(rows, TURNS)), limit)) == trie_by_hand(sequences(rows))


def test_rebuilt_trie_and_edge_rows(spark):
    rows = conversations(9, 40)
    rows += [(41, None, None, "late", 0, "x", 1), (41, 3, "user", None, 0, "x", 1), (41, None, "user", "", 0, "x", 1)]
    rows += [(42, 1, "user", "same", 0, "x", 1)] * 3 + [(None, 1, "user", "of nobody", 0, "x", 1), (-7, 0, "user", "x" * 70_000, 0, "x", 1)]
    of = sequences(rows)
    frame = spark.createDataFrame(rows, TURNS)
    assert got(pt.build(pt.turns_of(frame), 5)) == trie_by_hand(of)
    # -7 % 5 is -2 in SQL
    want = put_together({c: t for c, t in of.items() if c >= 0})
    assert got(pt.build(pt.rebuilt(pt.turns_of(frame.where("conv_id >= 0 or conv_id is null"))), 5)) == trie_by_hand(want)
    assert any(not t for t in want.values())
    assert pt.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []


def test_pieces_of_many_ends(spark, monkeypatch):
    monkeypatch.setattr(pt, "PIECE", 7)
    rows = [(1, 2, c) for c in range(-30, 200)] + [(5, 1, 5)]
    out = {(r.conv_id, r.depth): r.ends_sha256 for r in pt.ends_hash(spark.createDataFrame(rows, pt.END).repartition(4)).collect()}
    assert out == {(1, 2): h(",".join(map(str, range(-30, 200)))), (5, 1): h("5")}


def test_ranks_of_a_hot_group(spark):
    rows = [("a", i % 3, i) for i in range(900)] + [(None, 0, 0)] * 4 + [("b", None, 1), ("b", 2, 2)]
    frame = spark.createDataFrame(rows, "g string, v int, i int").repartition(7)
    out = ranked(frame, "g", ["v", "i"], "test-ranks").collect()
    assert sorted(r.idx for r in out if r.g == "a") == list(range(900)) and {r.n for r in out if r.g == "a"} == {900}
    assert [r.i for r in sorted((r for r in out if r.g == "a"), key=lambda r: r.idx)] == [i for _, _, i in sorted(rows[:900], key=lambda r: r[1:])]
    assert sorted(r.idx for r in out if r.g is None) == [0, 1, 2, 3]
    assert {r.v: r.idx for r in out if r.g == "b"} == {None: 0, 2: 1}


# Merkle


def one(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes, arity):
    """Levels of hashes from below."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h("".join(now[i : i + arity])) for i in range(0, len(now), arity)])
    return levels


def siblings(levels, at, arity):
    out = []
    for level in levels[:-1]:
        run = at - at % arity
        out.append(("".join(level[run:at]), "".join(level[at + 1 : run + arity])))
        at //= arity
    return out


def manifest_by_hand(rows, arity):
    """Rows ``(id, group, fields)``."""
    groups = {}
    for i, g, fields in rows:
        groups.setdefault(g, []).append((i is not None, i or 0, h("".join(map(one, fields)))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    low = {g: climb([leaf for *_, leaf in sorted(groups[g])], arity) for g in order}
    high = climb([low[g][-1][0] for g in order], arity)
    out = []
    for k, g in enumerate(order):
        for at, (known, i, leaf) in enumerate(sorted(groups[g])):
            proof = siblings(low[g], at, arity) + siblings(high, k, arity)
            out.append((i if known else None, leaf, low[g][-1][0], high[-1][0], h("".join(a + b for a, b in proof)), high[-1][0]))
    return sorted(map(str, out))


@pytest.mark.parametrize("arity", (2, 3, 5))
def test_manifest(spark, arity):
    rng = random.Random(arity)
    rows = [(i, rng.choice(["en", "en", "en", "de", None, "é", "Z"]), rng.choice([None, "", "text é", "x" * 99])) for i in range(83)]
    rows += [(None, "en", "no id"), (7, "en", "twice"), (7, "en", "twice"), (None, None, None), (500, "alone", "long " * 20_000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    for extra in ("tree", "idx", "n", "hash", "leaf", "root"):
        frame = frame.withColumn(extra, F.lit(1))
    found = manifest(frame.repartition(6), ["doc_id", "lang", "text"], arity=arity)
    found = found.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("proof")).alias("p"), folded(F.col("claimed"), F.col("proof")).alias("f"))
    assert sorted(str(tuple(r)) for r in found.collect()) == manifest_by_hand([(i, g, (i, g, t)) for i, g, t in rows], arity)


def test_a_changed_leaf_is_found(spark):
    frame = spark.createDataFrame([(i, "en", f"t{i}") for i in range(9)], "doc_id bigint, lang string, text string")
    other = F.when(F.col("f0") == 4, leaf_of([F.col("f0"), F.lit("changed")])).otherwise(leaf_of([F.col("f0"), F.col("f1")]))
    found = manifest(frame, ["doc_id", "text"], claimed=other)
    rows = found.select("doc_id", (folded(F.col("claimed"), F.col("proof")) == F.col("root")).alias("right")).collect()
    assert {r.doc_id for r in rows if not r.right} == {4} and len(rows) == 9
    assert manifest(frame.limit(0), ["doc_id", "text"]).collect() == []
    assert manifest(empty(spark), ["doc_id", "text"]).collect() == []
    assert len(manifest(edge(spark), ["doc_id", "text"], group="source").collect()) == 16


# URLs


URLS = [
    (1, "https://www.Example.org/en/12/"), (2, "http://example.org/en/12.html?utm_source=a&b=2&a=1#top"), (3, "https://example.org:443//en//12?a=1&b=2"),
    (4, None), (5, ""), (6, "example.org/en/1"), (7, "://"), (8, "http://a.example.org/es/x"), (9, "http://example.org"), (10, "x://EN.org?path=/"),
    (11, "http://badexample.org/es/"), (12, "http://a.com/fr/1"), (13, "http://a.com/de/1"), (14, "http://a.com/fr"), (15, "http://com/fr/"),
    (16, "http://l.net/" + "y" * 70_000), (17, "http://u@l.net:80/index.html"), (18, "http://l.net/"), (18, "http://l.net/"), (None, "ftp://L.net#x://org/"),
]


def verdict_by_hand(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    best = None
    for verdict, rule in RULES:
        name, slash, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + start) and len(rule) > len(best[1] if best else ""):
            best = (verdict, rule)
    return host, path, best[1] if best else None, best[0] if best else "block" if listed else "allow"


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "x", "y", 1) for i, u in URLS], "page_id bigint, url string, host string, name string, words int")
    listed = spark.createDataFrame([("https://l.net",), ("https://l.net",), (None,), ("nothing",), ("http://gone.net/1",)], "url string")
    for given, bad in ((listed, {17, 18, None}), (listed.limit(0), set())):
        rows = judge_urls(pages, given, RULES).collect()
        assert sorted(str((r.page_id, r.host, r.path, r.rule, r.verdict)) for r in rows) == sorted(
            str((i, *verdict_by_hand(u, i in bad))) for i, u in URLS
        )
        assert {r.page_id for r in rows if r.listed} == bad
    assert judge_urls(pages.limit(0), listed, RULES).collect() == []
    with pytest.raises(ValueError):
        judge_urls(pages, listed, [("block", "/x")])
    names = {r.u for r in pages.where("page_id <= 3").select(canonical(F.col("url")).alias("u")).collect()}
    assert names == {"example.org/en/12", "example.org/en/12?a=1&b=2"}


@pytest.mark.parametrize("blocks", (1 << 21, 4))
def test_filter_never_loses_a_key(spark, monkeypatch, blocks):
    from corploom.llm import url_filter

    monkeypatch.setattr(url_filter, "MAX_BLOCKS", blocks)
    monkeypatch.setattr(url_filter, "SEGMENT", 16)
    keys = spark.range(20_000).select("id", F.xxhash64("id").alias("key"))
    segments, n = bloom(keys.where("id < 2000"), 2000)
    rows = may_hold(keys, F.col("key"), segments, n, "maybe").groupBy((F.col("id") < 2000).alias("there"), "maybe").count().collect()
    out = {(r["there"], r["maybe"]): r["count"] for r in rows}
    assert n == (4 if blocks == 4 else 128) and out[True, True] == 2000 and (True, False) not in out
    if blocks > 4:
        assert out[False, True] < 0.02 * 18_000
