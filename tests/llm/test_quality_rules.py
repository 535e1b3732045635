import math
import re
from collections import Counter

import pytest
import xxhash

from peerscope.llm import quality_rules as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def spark_hash(*words):
    h = 42
    for w in words:
        h = xxhash.xxh64_intdigest(w.encode(), seed=h & (1 << 64) - 1)
    return h - (1 << 64) if h >> 63 else h


def brute(rows, labels, *, buckets, prior, threshold, **_):
    """(base statistics, score, kept) of each row, counted and summed in plain Python."""
    grams = []
    for _, t in rows:
        w = WORD.findall(t or "")
        grams.append([spark_hash(x) % buckets for x in w] + [spark_hash(a, b) % buckets for a, b in zip(w, w[1:])])
    good = {i for i, q in labels if q == 1 and i is not None}
    raw = Counter(g for gs in grams for g in gs)
    target = Counter(g for (i, _), gs in zip(rows, grams) if i in good for g in gs)
    scale = sum(target.values()) / sum(raw.values()) if target else 0.0
    out = []
    for (i, t), gs in zip(rows, grams):
        ratio = lambda g: round(math.log((target[g] + prior) / (raw[g] * scale + prior)) * Q.SCALE) if scale else 0
        score = sum(map(ratio, gs)) / len(gs) if gs else 0.0
        b = base(t)
        out.append((i, *b, score, not b[-1] and score >= threshold * Q.SCALE))
    return out


TEXTS = [
    "a b c a b c", "a a a a", "x " * 200, "one\n\none\n \none two", "##$ %% a|b <c> &", "é ü\xa0z\x85w\x1cq\x0bv", "\n\n\n", "A\tb\r\nA\tb",
    " ".join(f"w{i}" for i in range(49)), " ".join(f"w{i}" for i in range(50)), "p q r " * 9 + " ".join(f"v{i}" for i in range(27)), "😀 a 😀 a 😀 a 😀",
]


def test_base_statistics(docs_of, edge_rows):
    rows = [*enumerate(TEXTS), *edge_rows]
    got = Q.base_statistics(docs_of(rows)).drop("text_hash", "words").collect()
    assert Counter(map(tuple, got)) == Counter((i, *base(t)) for i, t in rows)


@pytest.mark.parametrize("labels", [[(100, 1), (100, 0), (101, 1), (102, 1), (103, 0), (None, 1), (104, None)], []], ids=["labelled", "no labels"])
def test_against_plain_counts(spark, docs_of, edge_rows, labels):
    clean = [(100 + i, " ".join(f"word{(i * 7 + k * k) % 90}" for k in range(80))) for i in range(8)]
    junk = [(200 + i, " ".join(f"zz{k}$$$" for k in range(i, i + 80))) for i in range(8)]
    rows = [*enumerate(TEXTS), *edge_rows, *clean, *junk]
    settings = {"buckets": 4096, "trusted_docs": 50, "prior": 5.0, "threshold": -0.05}
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    got = Q.judge(docs_of(rows), frame, **settings).collect()
    key = lambda r: tuple((x is None, x) if not isinstance(x, float) else (False, round(x, 3)) for x in r)
    expected = brute(rows, labels, **settings)
    a, b = sorted(map(key, map(tuple, got))), sorted(map(key, expected))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:7] == y[:7] and x[8] == y[8] and abs(x[7][1] - y[7][1]) <= 2  # a ratio may round differently
    if labels:
        kept = {r.doc_id: r.kept for r in got}
        assert all(kept[i] for i, _ in clean)


def test_empty_tables_and_bounded_sample(spark, nothing):
    labels = spark.createDataFrame([(i, 1) for i in range(30)], "doc_id long, quality int")
    assert Q.judge(nothing, labels).count() == 0
    ids = [r.doc_id for r in Q.trusted_ids(labels, 10).collect()]
    assert len(ids) == 10 and ids == [r.doc_id for r in Q.trusted_ids(labels.repartition(5), 10).collect()]


def test_clean_documents_stay(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = Q.judge(docs, labels).join(labels, "doc_id").collect()
    good, bad = ([r.kept for r in rows if r.quality == q and not r.base_failed] for q in (1, 0))
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_main_path_runs_no_python(spark, docs_of):
    plan = Q.judge(docs_of([(1, "a b c")]), spark.createDataFrame([(1, 1)], "doc_id long, quality int"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
