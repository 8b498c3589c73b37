import math
from collections import Counter

import corpus_pipeline as pipeline
from corploom.session import stage
from tests.conftest import DATA
from tests.llm.cases import edge, empty, given
from tests.llm.test_choices import WORD, filled
from tests.llm.test_dedup import near_by_hand, norm
from tests.llm.test_token_files import WORDS, library, packed_right


def test_stages_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "exact_dedup", "minhash_near_dedup", "mixing", "packing"]
    assert pipeline.ORACLE_SQL is None


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, tables = docs.columns, []
    for name, step in pipeline.STAGES:
        docs = stage(step(spark, docs, DATA), "test-stage")
        tables.append(docs.collect())
        assert name == "packing" or docs.columns == columns
    safe, exact, near, mixed, packed = tables

    everything = {i: t for i, t in given()}
    toxic = dict(given("labels", "doc_id, toxic"))
    gone = set(everything) - {r.doc_id for r in safe}
    right = [toxic[i] == (i in gone) for i in everything if i in toxic]
    assert sum(right) >= 0.95 * len(right)

    best = {}
    for r in safe:
        key = norm(r.text)
        best[key] = min(best.get(key, (0, 0)), (-len(r.text), r.doc_id)) if key in best else (-len(r.text), r.doc_id)
    assert sorted(r.doc_id for r in exact) == sorted(i for _, i in best.values())

    groups, n = near_by_hand([(r.doc_id, r.text) for r in exact])
    assert sorted(r.doc_id for r in near) == sorted({c for _, _, c in groups}) and len(near) == n

    size = {r.doc_id: len(WORD.findall(r.text)) for r in near}
    of_source = Counter()
    for r in near:
        of_source[r.source] += size[r.doc_id]
    goals, copies, taken = filled(of_source), Counter(r.doc_id for r in mixed), Counter()
    assert set(copies) <= set(size)
    for r in near:
        epochs = math.floor(goals[r.source] / of_source[r.source])
        assert copies[r.doc_id] - epochs in (0, 1) and copies[r.doc_id] <= 3
        taken[r.source] += copies[r.doc_id] * size[r.doc_id]
    for source, goal in goals.items():
        assert abs(taken[source] - goal) <= max(size[r.doc_id] for r in near if r.source == source) / 2 + 1

    bins, least = packed_right(packed, [(r.doc_id, r.text) for r in mixed], 4096, library(WORDS), 1)
    assert bins <= least + 1


def test_run_gives_the_same(spark):
    rows = [sorted(map(str, pipeline.run(spark, DATA).drop("sequence_id", "offset").collect())) for _ in range(2)]
    assert rows[0] == rows[1]


def test_edge_rows(spark):
    for docs in (edge(spark), empty(spark)):
        columns = docs.columns
        for name, step in pipeline.STAGES:
            docs = stage(step(spark, docs, DATA), "test-stage")
            assert name == "packing" or docs.columns == columns
