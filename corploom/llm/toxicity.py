"""Toxicity by multiple-instance learning.

A document is a bag of sentences and is toxic if any of them is: a sentence has the
probability ``sigmoid(bias + weights of its features)`` and the document the noisy-or of
its sentences, ``1 - prod(1 - p)``. Only documents are labelled; the weights are trained on
their labels through the noisy-or, and afterwards point at the sentences.

Features are words and word beginnings of 3 to 7 letters, chosen by how unevenly
they occur in toxic and clean documents (``FEATURES`` of them; a count over all training
documents). The classifier is fitted on at most ``PER_CLASS`` labelled documents of
each label, the first by a hash of the identifier; clean ones weigh as many as they
stand for. What is collected for it is, per document, the number of sentences and
the features of those that have any, ``FEATURES`` numbers a sentence at most.

Null and empty texts have no sentence and score 0. A label that is null, or of a
document that is not there, is not used; of several labels of one identifier the
toxic one counts. A null identifier has no label. Repeated rows score alike. Without
a training label of each kind every score is 0. Scores come from the text alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corploom.llm.frames import frugal, numbered, pick, restored, text_of, texts
from corploom.llm.shingles import slices
from corploom.session import stage

PER_CLASS = 3_000
FEATURES = 800
BEGINNINGS = (3, 4, 5, 6, 7)
STEPS, RATE, DECAY = 500, 0.1, 1e-5
FOLDS = 5
SCORE = "n_sentences bigint, score double, offending array<struct<start:bigint,end:bigint,score:double>>"

_SENTENCE = re.compile(r"[^.!?\n]*[^.!?\s][^.!?\n]*[.!?]*")
_WORD = re.compile(r"[^\W\d_]+")


class Model(NamedTuple):
    weights: dict[str, float]
    bias: float


def features_of(word: str) -> list[str]:
    """The word itself (with a mark at its end) and its beginnings."""
    return [word + "$", *[word[:n] for n in BEGINNINGS if len(word) > n - 1]]


def held_out(key: Column) -> Column:
    """Every fifth document by a checksum of its identifier is never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(text, toxic, weight)`` of the bounded sample."""
    marked = pick(labels, id=id_col, toxic="toxic").where("id is not null and toxic is not null")
    marked = marked.where(~held_out(F.col("id"))).groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    # the sample is found among identifiers; only its own texts are ever moved
    keys = stage(pick(docs, id=id_col).join(marked, "id"), "toxic-keys")
    counts = keys.groupBy("toxic").agg(F.count("*").alias("n"))
    chosen = None
    for kind in (0, 1):
        part = keys.where(F.col("toxic") == kind).orderBy(F.md5(F.col("id").cast("string")), "id").limit(PER_CLASS)
        chosen = part if chosen is None else chosen.unionByName(part)
    sampled = chosen.groupBy("toxic").agg(F.count("*").alias("m"))
    weights = counts.join(sampled, "toxic").select("toxic", (F.col("n") / F.col("m")).alias("weight"))
    # at most 2 * PER_CLASS rows
    wanted = F.broadcast(chosen.distinct().join(weights, "toxic"))
    texts_ = pick(docs, id=id_col, text=text_col).select("id", text_of().alias("text"))
    return texts_.join(wanted, "id").select("text", "toxic", "weight")


def choose_features(rows: DataFrame) -> list[str]:
    """The features that tell most, by a chi-square of the documents that have them."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, text in zip(batch.column(1).to_pylist(), texts(batch, 0)):
                words = set(_WORD.findall(text.lower()))
                names = pa.array(sorted({f for w in words for f in features_of(w)}), pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array([toxic] * len(names), pa.int32())], ["f", "toxic"])

    totals = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return []
    a, b = F.col("a"), F.col("b")
    counts = (
        rows.select("text", "toxic")
        .mapInArrow(frugal(emit), "f string, toxic int")
        .groupBy("f")
        .agg(F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b"))
        .where((a >= 2) & (a * clean > 3 * b * toxic))
    )
    n, missing = toxic + clean, (a + b) * (F.lit(float(toxic + clean)) - a - b)
    chi = F.pow(a * (clean - b) - b * (toxic - a), 2) * n / (float(toxic) * clean * missing)
    # a limited number of rows whatever the sample holds; without a word's copies in
    # all its beginnings the list would be short of kinds
    best = counts.withColumn("chi", F.round(chi, 6)).where("chi > 3").orderBy(F.desc("chi"), "f").limit(FEATURES)
    return [r.f for r in best.select("f").collect()]


def _sentences(text: str) -> list[re.Match]:
    return list(_SENTENCE.finditer(text))


def _active(words: list[str], known: dict) -> set[str]:
    return {f for w in words for f in features_of(w) if f in known}


def bags(rows: DataFrame, names: list[str]) -> DataFrame:
    """Per document: ``toxic``, ``weight``, ``n`` sentences and the feature numbers of each
    sentence that has any."""
    index = {f: i for i, f in enumerate(names)}
    lists = pa.list_(pa.list_(pa.int32()))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found = [], []
            for text in texts(batch, 0):
                sentences = _sentences(text.lower())
                hits = [_active(_WORD.findall(s[0]), index) for s in sentences]
                counts.append(len(sentences))
                found.append([sorted(index[f] for f in h) for h in hits if h])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(counts, pa.int64()), pa.array(found, lists)],
                ["toxic", "weight", "n", "hits"],
            )

    return rows.select("text", "toxic", "weight").mapInArrow(
        frugal(gather), "toxic int, weight double, n bigint, hits array<array<int>>"
    )


def train(rows: list, n_features: int) -> tuple[np.ndarray, float]:
    """Weights and bias that make the labels likeliest under the noisy-or, by Adam with
    weight decay. Sentences without a feature share one probability."""
    doc, cols, sentence = [], [], []
    for d, r in enumerate(rows):
        for hit in r.hits:
            cols += hit
            sentence += [len(doc)] * len(hit)
            doc.append(d)
    doc, cols, sentence = (np.array(x, np.int64) for x in (doc, cols, sentence))
    y = np.array([r.toxic for r in rows], float)
    weight = np.array([r.weight for r in rows], float)
    plain = np.array([r.n - len(r.hits) for r in rows], float)
    weight = weight / weight.sum()
    theta = np.zeros(n_features + 1)
    theta[-1] = -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        z = theta[-1] + np.bincount(sentence, theta[cols], len(doc)) if len(doc) else np.empty(0)
        keep = np.logaddexp(0, z)  # -log(1 - p) of a sentence
        base = np.logaddexp(0, theta[-1])
        s = np.bincount(doc, keep, len(rows)) + plain * base if len(doc) else plain * base
        p = -np.expm1(-s)
        # d loss / d s: clean documents want s = 0, toxic ones a large s
        g = weight * np.where(y > 0, -np.exp(-s) / np.maximum(p, 1e-12), 1.0)
        of_sentence = g[doc] / (1 + np.exp(-z)) if len(doc) else np.empty(0)
        grad = np.append(np.bincount(cols, of_sentence[sentence], n_features) if len(doc) else np.zeros(n_features), 0.0)
        grad[-1] = of_sentence.sum() + (g * plain).sum() / (1 + np.exp(-theta[-1]))
        grad[:-1] += DECAY * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return theta[:-1], float(theta[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """The model of the labelled rows; None without both labels. The sample is staged."""
    rows = stage(training_rows(docs, labels, id_col, text_col), "toxic-sample")
    names = choose_features(rows)
    if not names:
        return None
    # bounded by PER_CLASS
    found = bags(rows, names).orderBy("toxic", "weight", "n", F.to_json("hits")).collect()
    weights, bias = train(found, len(names))
    return Model({f: float(w) for f, w in zip(names, weights) if abs(w) > 1e-6}, bias)


def sentence_scores(text: str, model: Model) -> tuple[int, float, list[tuple[int, int, float]]]:
    """Number of sentences, the document's score, and the sentences likelier toxic than
    not with their places in code points."""
    lowered = text.lower()
    same = len(lowered) == len(text)  # else places are of another text: go sentence by sentence
    found = _sentences(lowered if same else text)
    if not found:
        return 0, 0.0, []
    weights, bias = model
    hot = {w for w in set(_WORD.findall(lowered)) if any(f in weights for f in features_of(w))}
    base = math.log1p(math.exp(bias))
    total, worst = 0.0, []
    if not hot:
        total = base * len(found)
    else:
        for s in found:
            words = [w for w in _WORD.findall(s[0] if same else s[0].lower()) if w in hot]
            if not words:
                total += base
                continue
            z = bias + sum(weights[f] for f in _active(words, weights))
            total += z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))
            if z >= 0:
                worst.append((s.start(), s.end(), 1 / (1 + math.exp(-z))))
    return len(found), -math.expm1(-total), worst


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_sentences``, ``score`` and the ``offending`` sentences. Only the two
    named columns and those to be returned are read."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    at = docs.columns.index(text_col)
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (few for whole in batches for few in slices(whole, at)):
            rows = [sentence_scores(t, model) if model else (len(_sentences(t)), 0.0, []) for t in texts(batch, at)]
            worst = [[{"start": a, "end": b, "score": p} for a, b, p in r[2]] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.float64()),
                    pa.array(worst, spans),
                ],
                [*batch.schema.names, "n_sentences", "score", "offending"],
            )

    return docs.mapInArrow(frugal(run), f"{kinds}, {SCORE}")


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, ``held_out``, ``score``, ``predicted`` and the offending
    sentences."""
    model = fit(docs, labels, id_col, text_col)
    scored = score(pick(docs, id=id_col, text=text_col), model, "id", "text")
    return scored.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_sentences",
        "offending",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    model = fit(docs, labels, id_col, text_col)
    mine, names = numbered(docs)
    return restored(score(mine, model, names[id_col], names[text_col]).where("score < 0.5"), names)
