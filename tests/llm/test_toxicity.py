import numpy as np
import pytest

from peerscope.llm import toxicity as X


def test_thresholds_are_ordered_and_share_weights():
    rnd = np.random.default_rng(1)
    grades = rnd.integers(0, 4, 600)
    rows = [{0: g / 3, 1: float(rnd.random())} for g in grades]
    w, t = X.solve(rows, grades, 2, decay=0.01, steps=800)
    assert len(t) == 3 and (np.diff(t) > 0).all() and w[0] > 5 * abs(w[1])
    model = X.OrdinalModel(["a", "b"], w, t)
    expected = [model.at_least({0: g / 3}).sum() for g in range(4)]
    assert expected == sorted(expected) and expected[0] < 0.7 and expected[3] > 2.3


def test_gradient_lowers_the_loss():
    rows, grades = [{0: 1.0}, {0: 1.0}, {}, {}], np.array([1, 1, 0, 0])
    w, t = X.solve(rows, grades, 1, decay=0.1)
    p = 1 / (1 + np.exp(t[0] - np.array([w[0], 0.0])))
    assert p[0] > 0.8 and p[1] < 0.2


def test_held_out_documents(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = X.fit(docs, labels.filter("doc_id % 2 = 0"))
    assert (np.diff(model.thresholds) > 0).all() and len(model.features) <= 3000
    held = labels.filter("doc_id % 2 = 1 and quality = 1").withColumnRenamed("toxic", "label")
    rows = X.score(docs, model).join(held, "doc_id").collect()
    hit = [r.toxic for r in rows if r.label == 1]
    wrong = [r.toxic for r in rows if r.label == 0]
    assert sum(hit) >= 0.9 * len(hit) and sum(wrong) <= 0.01 * len(wrong)


@pytest.fixture(scope="module")
def labelled(spark, docs_of):
    rows = [(i, f"plain words number {i} of the text " * 4 + ("idiot scum " if i % 3 == 0 else "")) for i in range(60)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)] + [(None, 1, 1), (1, None, None), (400, 1, 1)], "doc_id long, quality int, toxic int")
    return docs_of(rows), labels


def test_tables(labelled, edge, nothing):
    docs, labels = labelled
    model = X.fit(docs, labels)
    assert {r.doc_id for r in X.score(docs, model).collect() if r.toxic} == {i for i in range(60) if i % 3 == 0}
    scored = X.score(edge, model)
    assert scored.count() == edge.count() and not [r for r in scored.collect() if r.toxic]
    assert X.score(nothing, model).count() == 0
    assert model.weights.tolist() == X.fit(docs.repartition(7), labels).weights.tolist()


def test_without_toxic_labels(labelled, nothing):
    docs, labels = labelled
    for model in (X.fit(docs, labels.filter("toxic = 0")), X.fit(nothing, labels), X.fit(docs, labels.limit(0))):
        assert {r.severity for r in X.score(docs, model).collect()} == {0.0}


def test_sample_is_bounded(labelled):
    docs, labels = labelled
    assert X.fit(docs, labels, max_docs=40, max_features=5).weights.size <= 5


def test_against_a_plain_version(spark, labelled):
    """Features, vectors, solution and severities made in plain Python, row by row."""
    import math
    import random
    from collections import Counter

    rnd = random.Random(3)
    bad, good = ["idiot", "scumbag", "vile."], ["plain", "words,", "of", "the", "story", "Idiomatic", "scum"]
    rows = [(i, " ".join(rnd.choice(bad if i % 4 == 0 and rnd.random() < 0.3 else good) for _ in range(rnd.randint(5, 40)))) for i in range(160)]
    marks = [(i, int(i % 5 > 0), int(i % 4 == 0)) for i in range(0, 160, 2)]
    docs = spark.createDataFrame([*rows, (0, "plain words on a second row of an id")], "doc_id long, text string")
    model = X.fit(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))

    def features(word):
        w = word.strip(X._MARKS)
        return ["=" + w] + [w[:n] for n in (4, 5, 6, 7, 8) if len(w) > n] if w else []

    firsts = {r.doc_id: r.text for r in docs.selectExpr("doc_id", "text", "xxhash64(text) as h").orderBy("h", ascending=False).collect()}
    sample = [(firsts[i], t * (2 - q)) for i, q, t in marks]
    with_it = [Counter(f for t, g in sample if (g > 0) == toxic for f in {f for w in set(t.lower().split()) for f in features(w)}) for toxic in (False, True)]
    sizes = [sum((g > 0) == toxic for _, g in sample) for toxic in (False, True)]
    z = {}
    for f in with_it[1]:
        p, q = (with_it[1][f] + 0.5) / (sizes[1] + 1), (with_it[0][f] + 0.5) / (sizes[0] + 1)
        score = round((p - q) / math.sqrt(p * (1 - p) / sizes[1] + q * (1 - q) / sizes[0]), 9)
        if with_it[1][f] >= 3 and score > 2.5:
            z[f] = score
    names = sorted(z, key=lambda f: (-z[f], f))
    assert model.features == names and len(names) >= 5

    def vector(text):
        words = text.lower().split()
        n = Counter(f for w in words for f in features(w) if f in z)
        return {names.index(f): min(1.0, math.sqrt(25 * c / len(words))) for f, c in n.items()}

    w, t = X.solve([vector(x) for x, _ in sample], np.array([g for _, g in sample]), len(names))
    assert np.allclose(w, model.weights, atol=1e-9) and np.allclose(t, model.thresholds, atol=1e-9)
    got = {r.doc_id: r.severity for r in X.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for i, text in rows:
        dot = sum(w[k] * v for k, v in vector(text).items())
        assert abs(got[i] - sum(1 / (1 + math.exp(x - dot)) for x in t)) < 2e-6
