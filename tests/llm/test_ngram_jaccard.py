import random
from collections import Counter

import numpy as np
import pytest

from peerscope.llm import ngram_jaccard as J
from peerscope.llm.components import components
from peerscope.llm.shingles import shingle_set


def words(text):
    return (text or "").encode().lower().split()


def brute(rows, t):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i : i + t.width]) for i in range(max(1, len(w) - t.width + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and t.den * both >= t.num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        least[r] = doc if least.get(r) is None else least[r] if doc is None else min(doc, least[r])
    return Counter((doc, len(s), least[find(i)] if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets)))


def corpus(seed, n=160):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["The", "the", "a."]
    rows = []
    for i in range(n):
        if rows and rnd.random() < 0.6:
            w = rows[rnd.randrange(len(rows))][1].split(" ")
            for _ in range(rnd.randint(0, max(1, len(w) // 25))):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        else:
            w = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 9, 20, 60, 200, 700]))]
        rows.append((rnd.randrange(10**6), " ".join(w)))
    return rows


@pytest.mark.parametrize("t", [J.Threshold(90, 100, 3), J.Threshold(80, 100, 5)], ids=["0.9", "0.8"])
def test_components_against_all_pairs(docs_of, t):
    rows = corpus(11)
    got = J.link_components(docs_of(rows), t).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, t)


def test_edges(edge, edge_rows, nothing):
    t = J.Threshold()
    got = J.link_components(edge, t).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(edge_rows, t)
    assert J.link_components(nothing, t).count() == 0


def test_buckets_of_many_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 4)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(60)]  # near copies of one another
    t = J.Threshold()
    got = J.link_components(docs_of(rows), t).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, t)
    assert {r.component_id for r in got} == {0}


def test_sketch_bounds_the_symmetric_difference():
    rnd = random.Random(5)
    for _ in range(300):
        a = [f"t{rnd.randrange(400)}" for _ in range(rnd.randint(3, 200))]
        b = [x for x in a if rnd.random() < 0.95] + [f"u{rnd.randrange(99)}" for _ in range(rnd.randint(0, 6))]
        x, y = (shingle_set(" ".join(w).encode()) for w in (a, b))
        (wx, px), (wy, py) = J.sketch(x, 17, 6), J.sketch(y, 17, 6)
        apart = len(np.setxor1d(x, y))
        assert int(np.bitwise_count(px ^ py).sum()) <= apart and int((wx != wy).sum()) <= apart


def test_linked_sizes_share_a_band():
    for t in (J.Threshold(), J.Threshold(80, 100, 5)):
        for n in [*range(1, 400), 1000, 5003, 20000]:
            mine = {k for k, *_ in J.bands_of(t, n)}
            for m in range(n, t.partner(n) + 1):
                assert t.apart(n, m) == 0 or mine & {k for k, *_ in J.bands_of(t, m)}, (n, m)


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(200 + i, 200 + (i + 1) % 30) for i in range(30)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(80)}, **{200 + i: 200 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_positions_beyond_twenty_bits(spark):
    """Sets of very long texts have over a million positions; band and place keep apart."""
    last = 1_100_000
    words = f"transform(sequence(0, {last}), i -> if(i = {last}, 77L, 0L))"
    sets = spark.range(2).selectExpr(
        "id as rid", "9000000L as n", "id as d1", "id as d2",
        f"array(named_struct('band', 70, 'spare_zeros', true, 'words', {words}, 'parity', array(1L))) as bands",
    )
    met, folds = J.shared_positions(sets)
    assert {(r["at"] >> 32, r["at"] & 0xFFFFFFFF) for r in met.collect()} == {(70, last)}
    found = J._compared(met, folds, ["n", "parity"], J._stars(J.Threshold(80, 100, 5)), "test-stars")
    assert [tuple(r) for r in found.collect()] == [(0, 1)]
