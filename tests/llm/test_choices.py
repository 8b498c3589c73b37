"""Toxicity, quality and mixing."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corploom.llm import quality, toxicity
from corploom.llm.mixing import mix, mixed_rows
from corploom.llm.quality import judge
from corploom.llm.queries import op3_toxicity, op9_quality_rules, op10_mixing
from corploom.llm.toxicity import Model, drop_toxic, score_toxicity, sentence_scores
from tests.conftest import DATA
from tests.llm.cases import TEXTS, edge, empty, given

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# toxicity


def test_held_out_documents_are_judged_right(spark):
    import zlib

    labels = dict(given("labels", "doc_id, toxic"))
    rows = op3_toxicity(spark, DATA).collect()
    assert len(rows) == len(given())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    known = [r for r in rows if r.doc_id in labels and r.held_out]
    assert sum(r.predicted == labels[r.doc_id] for r in known) >= 0.9 * len(known)


def corpus(spark, n=400):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        said = [" ".join(f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(8)) for _ in range(rng.randrange(1, 12))]
        toxic = i % 4 == 0
        if toxic:
            said[rng.randrange(len(said))] += f" {rng.choice(['zorg', 'zorgish', 'blat'])} you"
        rows.append((i, ". ".join(said) + ".", "x", 1.0))
        if i % 10:
            labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id string, score double")
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_sentences_are_found_from_document_labels(spark):
    docs, labels = corpus(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in score_toxicity(docs, labels).collect():
        assert r.predicted == (r.doc_id % 4 == 0)
        if r.predicted:
            (s,) = r.offending
            assert re.search("zorg|blat", texts[r.doc_id][s.start : s.end])
            assert not re.search("zorg|blat", texts[r.doc_id][: s.start] + texts[r.doc_id][s.end :])
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 300


def test_noisy_or():
    model = Model({"bad$": 3.0, "bad": 1.0, "wors": 2.0}, -2.0)
    n, score, worst = sentence_scores("Bad. fine here! Worst? ", model)
    p = [1 / (1 + math.exp(-z)) for z in (2.0, -2.0, 0.0)]
    assert n == 3 and score == pytest.approx(1 - math.prod(1 - x for x in p))
    assert [(a, b) for a, b, _ in worst] == [(0, 4), (15, 22)]
    assert sentence_scores("", model) == sentence_scores(" \n", model) == (0, 0.0, [])
    assert sentence_scores("İ bad", model)[0] == 1  # lower case is longer here


def test_training_follows_the_gradient():
    rows = [type("R", (), {"toxic": t, "weight": 1.0, "n": n, "hits": h}) for t, n, h in [(1, 3, [[0], [1]]), (0, 5, [[1]]), (1, 1, [[0]]), (0, 2, [])]]
    weights, bias = toxicity.train(rows, 2)
    assert weights[0] + bias > 1 > -1 > weights[1] + bias and bias < -1


def test_labels_that_say_nothing(spark):
    docs, labels = corpus(spark, 40)
    none = score_toxicity(docs, labels.where("false")).collect()
    assert len(none) == 40 and all(r.score == 0 for r in none)
    odd = labels.withColumn("toxic", F.lit(None).cast("int")).unionByName(spark.createDataFrame([(None, 1)], labels.schema))
    assert all(r.score == 0 for r in score_toxicity(docs, odd).collect())


def test_toxicity_edge_rows(spark):
    _, labels = corpus(spark)
    rows = score_toxicity(edge(spark), labels.unionByName(labels)).collect()
    assert len(rows) == len(TEXTS) and all(r.held_out for r in rows if r.doc_id is None)
    assert all(r.score == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert score_toxicity(empty(spark), labels).collect() == []
    assert drop_toxic(edge(spark), labels).columns == edge(spark).columns


# quality


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def test_counts_of_given_documents(spark):
    got = {r.doc_id: tuple(r)[1:7] for r in op9_quality_rules(spark, DATA).collect()}
    assert got == {key: by_hand(text) for key, text in given()}


def test_quality_edge_rows(spark):
    rows = [(t, "x") for t in ("a a a a", "a b a b a b", "x y z\nx y z\n\n \nx y z ", "p q r p q s p q r")]
    docs = edge(spark, TEXTS + [(100 + i, t, s) for i, (t, s) in enumerate(rows)])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = Counter((r.doc_id, *[r[n] for n in names]) for r in judge(docs).collect())
    assert got == Counter((r.doc_id, *by_hand(r.text)) for r in docs.collect())
    assert judge(empty(spark)).collect() == []


def test_rules_agree_with_labels(spark):
    labels = dict(given("labels", "doc_id, quality"))
    rows = [r for r in op9_quality_rules(spark, DATA).collect() if r.doc_id in labels and not r.base_failed]
    assert all(r.kept for r in rows if labels[r.doc_id] == 1)


def em(patterns):
    """The same estimate in plain Python."""
    model = quality.start()
    for _ in range(quality.ROUNDS):
        sums = defaultdict(float)
        for votes, n in patterns.items():
            weight = {}
            for c in quality.CLASSES:
                weight[c] = model[f"share/{c}"]
                for rule, vote in zip(quality.RULES, votes):
                    bad, good = model[f"{c}/{rule}/bad"], model[f"{c}/{rule}/good"]
                    weight[c] *= bad if vote == -1 else good if vote == 1 else 1 - bad - good
            total = sum(weight.values())
            sums["n"] += n
            for c in quality.CLASSES:
                p = n * weight[c] / total
                sums[f"n_{c}"] += p
                for (rule, (good, _)), vote in zip(quality.RULES.items(), votes):
                    sums[f"{c}/{rule}/bad"] += p * (vote == -1)
                    if good != "false":
                        sums[f"{c}/{rule}/good"] += p * (vote == 1)
        model = quality._updated(dict(sums))
    return model


def test_estimate_is_that_of_plain_python(spark):
    voted = quality.votes(quality.statistics(spark.read.parquet(f"{DATA}/documents.parquet")))
    patterns = voted.groupBy(*quality.RULES).agg(F.count("*").alias("n"))
    mine = quality.fit(patterns)
    want = em({tuple(r)[:-1]: r.n for r in patterns.collect()})
    assert mine == pytest.approx(want, rel=1e-9)


def test_a_defect_shared_by_many_is_found(spark):
    """Documents with one defect each, of 3 to 8 percent, and clean ones."""
    rng = random.Random(2)
    clean = lambda: "\n".join(" ".join(f"w{rng.randrange(5000)}" for _ in range(12)) + "." for _ in range(12))
    clean = lambda f=clean: re.sub(r"\d", lambda m: "abcdefghij"[int(m[0])], f())
    rows, bad = [], set()
    for i in range(600):
        text = clean()
        if i % 15 == 0:
            text = text.replace(" ", "### ")
        elif i % 15 == 1 and i % 2:
            text = text.upper().replace(".", "!").replace(" ", "! ")
        if i % 15 == 0 or (i % 15 == 1 and i % 2):
            bad.add(i)
        rows.append((i, text))
    got = judge(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id for r in got if not r.kept} == bad


# mixing


def filled(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, open_, left = {}, list(names), sum(sizes.values())
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * share >= 3 * sizes[s]]
        if not over:
            target |= {s: weight[s] * share for s in open_}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_budgets(spark, seed):
    rng = random.Random(seed)
    sources = ["é", "Z", "a", None, "zz", ""][: 2 + 2 * seed]
    rows = [(i, " ".join("w" * rng.randrange(1, 60)), rng.choices(sources, range(1, 2 + 2 * seed + 1))[0]) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mix(frame).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text))
    want, taken = filled(sizes), Counter()
    for r in got:
        assert r.size == len(WORD.findall(rows[r.doc_id][1])) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size <= 3 * r.size
        assert r.copies - math.floor(r.target / r.source_size) in (0, 1)
        taken[r.source] += r.taken
    for source, goal in want.items():
        assert abs(taken[source] - goal) <= 30
    again = mix(frame.repartition(11)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert Counter(r.doc_id for r in mixed_rows(frame).collect()) == Counter({r.doc_id: r.copies for r in got if r.copies})


def test_better_documents_come_first(spark):
    rows = [(i, "one two three four five" + (" ###" if i % 2 else " six"), "a" if i < 1000 else "b") for i in range(2000)]
    got = mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    part = [r for r in got if r.source == "a"]
    assert sum(r.copies for r in part if r.doc_id % 2 == 0) > 1.5 * sum(r.copies for r in part if r.doc_id % 2)


def test_mixing_edge_rows(spark):
    got = mix(edge(spark)).collect()
    assert len(got) == len(TEXTS) and {r.source for r in got} == {"a", "b", "c", None}
    assert all(r.taken == 0 for r in got if r.size == 0)
    rows = mixed_rows(edge(spark))
    assert rows.columns == edge(spark).columns and rows.count() == sum(r.copies for r in got)
    assert mix(empty(spark)).collect() == [] and mixed_rows(empty(spark)).collect() == []
    silent = edge(spark, [(1, None, None), (2, " ", "a")])
    assert all(r.target == 0 and r.taken == 0 for r in mix(silent).collect())


def test_given_sources_meet_their_targets(spark):
    rows = op10_mixing(spark, DATA).collect()
    by_target = defaultdict(list)
    for r in rows:
        by_target[(r.target, r.source_size)].append(r)
    for (target, _), own in by_target.items():
        assert abs(sum(r.taken for r in own) - target) <= np.ceil(max(r.size for r in own) / 2) * len(own)
