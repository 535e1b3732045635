"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade >= k) = sigmoid(w.x - t_k) with one weight vector for all grades and
ordered thresholds t_1 < t_2 < ...; a text's expected severity is the sum of
these probabilities.  Features are words (lower-cased, marks stripped) and
their beginnings of ``PREFIXES`` letters; a feature's value is
min(1, sqrt(GAIN * count / words)), so that a text's length does not matter.

Fitting uses at most ``max_docs`` labelled texts (those with the smallest hash
of their id; of an id on several rows the text with the least hash), read from
the documents once: feature counts by grade are added up in Spark, the
``max_features`` features that separate toxic texts best are kept, and the
regression is solved on the sparse rows of that bounded sample.  Scoring is
one narrow pass over all whole texts; the model is at most ``max_features``
weights, and each worker's word table is bounded.

Defined results: a null or empty text has no features and gets the severity
of the thresholds alone; without a toxic label every severity is 0; null
labels are ignored and the highest of an id's grades counts; repeated rows
give repeated results, and every row of an id on several texts is scored by its
own text; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import saved

PREFIXES = (4, 5, 6, 7, 8)
GAIN = 25.0
WORD_TABLE = 300_000  # words a worker keeps before it starts its table anew
_MARKS = ".,;:!?\"'()[]{}<>*#$%&|~`^_-+=/\\@"


def word_features(word: str) -> list[str]:
    w = word.strip(_MARKS)
    return ["=" + w, *(w[:n] for n in PREFIXES if len(w) > n)] if w else []


def _tokens(text: str | None) -> list[str]:
    return text.lower().split() if text else []


class Features:
    """Sparse vectors over a fixed list of features."""

    def __init__(self, names: Iterable[str]):
        self.place = {f: i for i, f in enumerate(names)}
        self.table: dict[str, tuple[int, ...]] = {}

    def _of(self, word: str) -> tuple[int, ...]:
        if len(self.table) >= WORD_TABLE:
            self.table.clear()
        self.table[word] = found = tuple(self.place[f] for f in word_features(word) if f in self.place)
        return found

    def vector(self, text: str | None) -> dict[int, float]:
        words, get = _tokens(text), self.table.get
        n: Counter[int] = Counter()
        for word in words:
            found = get(word)
            if found is None:
                found = self._of(word)
            if found:
                n.update(found)
        return {i: min(1.0, (GAIN * c / len(words)) ** 0.5) for i, c in n.items()}


@dataclass
class OrdinalModel:
    features: list[str]
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one for each grade from 1

    def at_least(self, vector: dict[int, float]) -> np.ndarray:
        z = sum(self.weights[i] * v for i, v in vector.items())
        return 1 / (1 + np.exp(np.clip(self.thresholds - z, -40, 40)))


def solve(rows: list[dict[int, float]], grades: np.ndarray, n_features: int, *, decay: float = 0.3, steps: int = 400, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of least penalised negative log-likelihood (Adam, all rows in each step)."""
    top = int(grades.max(initial=0))
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    place = np.fromiter((i for r in rows for i in r), np.int64, len(owner))
    value = np.fromiter((v for r in rows for v in r.values()), float, len(owner))
    share = [np.clip((grades >= k).mean(), 1e-3, 1 - 1e-3) for k in range(1, top + 1)]
    first = np.array([np.log((1 - p) / p) for p in share])
    gaps = np.log(np.maximum(np.diff(first), 1e-2))
    x = np.concatenate([np.zeros(n_features), first[:1], gaps])
    m, s = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        w, widths = x[:n_features], np.exp(x[n_features + 1 :])
        t = x[n_features] + np.concatenate([[0.0], np.cumsum(widths)])
        z = np.bincount(owner, value * w[place], minlength=len(rows))
        p = 1 / (1 + np.exp(np.clip(t[None, :] - z[:, None], -40, 40)))  # P(grade >= k) by column
        edge = np.hstack([np.ones((len(rows), 1)), p, np.zeros((len(rows), 1))])
        r = np.arange(len(rows))
        mass = np.maximum(edge[r, grades] - edge[r, grades + 1], 1e-9)
        slope = edge * (1 - edge)
        up, down = slope[r, grades] / mass, slope[r, grades + 1] / mass  # of log mass by the lower and the upper threshold
        gz = -(up - down)
        gt = np.zeros((len(rows), top + 2))
        gt[r, grades] += up
        gt[r, grades + 1] -= down
        gt = gt[:, 1 : top + 1].sum(0)
        tail = np.cumsum(gt[::-1])[::-1]
        g = np.concatenate([np.bincount(place, value * gz[owner], minlength=n_features) + decay * w, tail[:1], tail[1:] * widths])
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        x = x - rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return x[:n_features], x[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(x[n_features + 1 :]))])


def grades_of(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 not toxic, 1 toxic, 2 toxic and of low quality."""
    low = F.coalesce((F.col("quality") == 0).cast("int"), F.lit(0))
    rows = labels.filter("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") * (1 + low)).cast("int").alias("grade"))
    return rows.groupBy("doc_id").agg(F.max("grade").alias("grade"))


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each feature, added up by task: (feature, toxic, n)."""
    n: Counter[tuple[str, int]] = Counter()
    for batch in batches:
        for text, grade in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen = {f for w in set(_tokens(text)) for f in word_features(w)}
            n.update((f, int(grade > 0)) for f in seen)
    keys = list(n)
    yield pa.RecordBatch.from_pydict({"feature": pa.array([k[0] for k in keys], pa.string()), "toxic": pa.array([k[1] for k in keys], pa.int32()), "n": pa.array([n[k] for k in keys], pa.int64())})


def _vectors(names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(names)
        for batch in batches:
            rows = [features.vector(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"grade": batch.column(1), "place": pa.array([list(r) for r in rows], pa.list_(pa.int32())), "value": pa.array([list(r.values()) for r in rows], pa.list_(pa.float64()))})

    return run


def choose_features(counts: DataFrame, toxic: int, clean: int, max_features: int) -> list[str]:
    """Features whose share of toxic texts exceeds that of clean ones by the most standard errors."""
    c = counts.groupBy("feature").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"))
    p, q = (F.col("a") + 0.5) / (toxic + 1), (F.col("b") + 0.5) / (clean + 1)
    z = F.round((p - q) / F.sqrt(p * (1 - p) / toxic + q * (1 - q) / clean), 9)
    best = c.filter("a >= 3").withColumn("z", z).filter("z > 2.5").orderBy(F.desc("z"), "feature").limit(max_features)
    return [r["feature"] for r in best.select("feature").collect()]


def fit(docs: DataFrame, labels: DataFrame, *, max_docs: int = 8_000, max_features: int = 3_000, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    sample = grades_of(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    # one text an id, so that at most max_docs rows are read again and collected, however many rows an id has
    texts = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.max("grade").alias("grade"), F.min_by("text", F.xxhash64("text")).alias("text"))
    texts = saved(texts.select("text", "grade"), "toxicity-sample")
    n = texts.groupBy((F.col("grade") > 0).alias("toxic")).count().collect()
    n = {r["toxic"]: r["count"] for r in n}
    if not n.get(True) or not n.get(False):
        return OrdinalModel([], np.zeros(0), np.array([40.0]))
    counts = texts.mapInArrow(_count_features, "feature string, toxic int, n long")
    names = choose_features(counts, n[True], n[False], max_features)
    rows = texts.mapInArrow(_vectors(names), "grade int, place array<int>, value array<double>").collect()
    rows.sort(key=lambda r: (r["grade"], r["place"], r["value"]))  # the same sums however tasks end
    vectors = [dict(zip(r["place"], r["value"])) for r in rows]
    return OrdinalModel(names, *solve(vectors, np.array([r["grade"] for r in rows]), len(names)))


def _score(model: OrdinalModel) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(model.features)
        for batch in batches:
            p = [model.at_least(features.vector(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "severity": pa.array([round(float(x.sum()), 6) for x in p], pa.float64()), "p_toxic": pa.array([round(float(x[0]), 6) for x in p], pa.float64()), "grade": pa.array([int((x >= 0.5).sum()) for x in p], pa.int32())})

    return run


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: expected ``severity``, ``p_toxic``, the median ``grade`` and ``toxic`` (grade >= 1)."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(_score(model), "doc_id long, severity double, p_toxic double, grade int").withColumn("toxic", F.col("grade") >= 1)
