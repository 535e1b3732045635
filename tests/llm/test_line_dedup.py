import random
from collections import Counter, defaultdict

import pytest

from peerscope.llm import line_dedup as L


def distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        c = [i]
        for j, y in enumerate(b, 1):
            c.append(min(p[j] + 1, c[-1] + 1, p[j - 1] + (x != y)))
        p = c
    return p[-1]


def changed(rnd, line, n, letters="abc"):
    out = list(line)
    for _ in range(n):
        k, kind = rnd.randrange(len(out) + 1), rnd.random()
        if kind < 0.34 or not out:
            out.insert(k, rnd.choice(letters))
        elif kind < 0.67:
            del out[min(k, len(out) - 1)]
        else:
            out[min(k, len(out) - 1)] = rnd.choice(letters)
    return "".join(out)


def brute(rows, edits, min_chars):
    at = defaultdict(list)
    for doc, text in rows:
        for number, _, line in L.lines_of(text, min_chars):
            at[line].append((doc is None, doc or 0, number))
    rank = {x: min(v) for x, v in at.items()}
    near = {x for x in rank for y in rank if rank[y] < rank[x] and abs(len(x) - len(y)) <= edits and distance(x, y) <= edits}
    out = Counter()
    for doc, text in rows:
        gone = []
        for number, _, line in L.lines_of(text, min_chars):
            if (doc is None, doc or 0, number) != rank[line]:
                gone.append((number, "exact"))
            elif line in near:
                gone.append((number, "near"))
        out[doc, tuple(gone)] += 1
    return out


def found(df):
    return Counter((r.doc_id, tuple((x.number, x.kind) for x in r.removed)) for r in df.collect())


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(edits):
    rnd = random.Random(edits)
    for _ in range(8000):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 12)))
        b = changed(rnd, a, rnd.randint(0, 5))
        assert L.within(a, b, edits) == (distance(a, b) <= edits), (a, b)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_near_lines_share_a_segment(edits):
    rnd = random.Random(edits)
    for _ in range(4000):
        a = "".join(rnd.choice("abcd") for _ in range(rnd.randint(6, 24)))
        b = changed(rnd, a, rnd.randint(0, edits), "abcd")
        if min(len(a), len(b)) <= edits or distance(a, b) > edits:
            continue
        keys = lambda x: [(s, x[p : p + n]) for s, p, n in L.places(len(x), edits)[0]]
        own = lambda x: set(keys(x)[: edits + 1])
        assert own(a) & set(keys(b)) or own(b) & set(keys(a)), (a, b)


def test_against_all_pairs(docs_of, edge_rows):
    rnd = random.Random(9)
    pool = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(20, 60))).strip() for _ in range(25)]
    rows = list(edge_rows)
    for i in range(60):
        lines = [changed(rnd, rnd.choice(pool), rnd.randint(0, 4), "abcdefgh") if rnd.random() < 0.7 else f"own line {i} {rnd.random()}" for _ in range(rnd.randint(0, 5))]
        rows.append((rnd.randrange(500), "\n".join(lines)))
    got = L.repeated_lines(docs_of(rows), edits=2, min_chars=16)
    assert found(got) == brute(rows, 2, 16)
    assert sum(r.n_near for r in got.collect()) > 5


def test_mutual_near_copies_over_many_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 5)
    rows = [(i, f"this is line number {chr(97 + i % 26)}{chr(97 + i // 26)} of a long list of lines") for i in range(60)]
    assert found(L.repeated_lines(docs_of(rows))) == brute(rows, 2, L.MIN_CHARS)


def brute_short(rows):
    at = defaultdict(list)
    for doc, text in rows:
        for number, _, line in L.lines_of(text, 1):
            at[line].append((doc is None, doc or 0, number))
    rank = {x: min(v) for x, v in at.items()}
    bound = lambda x, y: min(2, min(len(x), len(y)) // 16)
    near = {x for x in rank for y in rank if rank[y] < rank[x] and abs(len(x) - len(y)) <= bound(x, y) and distance(x, y) <= bound(x, y)}
    out = Counter()
    for doc, text in rows:
        lines = [(n, (doc is None, doc or 0, n) != rank[x], x in near) for n, _, x in L.lines_of(text, 1)]
        out[doc, tuple((n, "exact" if again else "near") for n, again, close in lines if again or close)] += 1
    return out


def test_short_lines(docs_of, edge_rows):
    rnd = random.Random(12)
    pool = ["".join(rnd.choice("abcdefgh ") for _ in range(n)).strip() for n in (1, 2, 3, 8, 14, 15, 16, 17, 18, 24, 30, 31, 32, 33, 34, 35, 40)]
    rows = list(edge_rows)
    for i in range(80):
        rows.append((rnd.randrange(500), "\n".join(changed(rnd, rnd.choice(pool), rnd.choice([0, 0, 1, 2, 3]), "abcdefgh") for _ in range(rnd.randint(0, 6)))))
    got = L.repeated_lines(docs_of(rows), short=True)
    assert found(got) == brute_short(rows)
    kinds = Counter((x.kind, x.stop - x.start < L.MIN_CHARS) for r in got.collect() for x in r.removed)
    assert kinds["exact", True] > 20 and kinds["near", True] > 5 and kinds["near", False] > 5


def test_short_lines_of_the_query_and_the_pipeline(spark, docs_of, tmp_dir):
    from corpus_pipeline import lines
    from peerscope.llm.queries import op7_lines

    docs = docs_of([(1, "And ornd.\nown line one"), (2, "own line two\nAnd ornd."), (3, "Les.\nAnd ornd."), (4, "Les.")])
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    assert {r.doc_id: r.n_exact for r in op7_lines(spark, tmp_dir).collect()} == {1: 0, 2: 1, 3: 1, 4: 1}
    assert {r.doc_id: r.text for r in lines(spark, docs, tmp_dir).collect()} == {1: "And ornd.\nown line one", 2: "own line two", 3: "Les."}


def test_cut_texts(docs_of, nothing):
    line, other = "a line that is long enough to be looked at", "another line that is long enough as well"
    rows = [(1, f"{line}\nshort"), (2, f"  {line}  \n{other}"), (3, line), (4, ""), (5, None), (6, f"{other}.\nshort"), (6, f"{other}.\nshort")]
    out = L.without_repeats(docs_of(rows))
    assert out.columns == docs_of(rows).columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(1, f"{line}\nshort"), (2, other), (4, ""), (5, None), (6, "short"), (6, "short")], key=str)
    assert L.without_repeats(nothing).count() == 0
    with pytest.raises(ValueError):
        L.repeated_lines(docs_of(rows), edits=2, min_chars=2)


def test_many_lines_with_a_common_segment(docs_of):
    """A bucket of two thousand different lines: each is compared by letter counts, few by distance."""
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(24))
    own = [word() for _ in range(2000)]
    rows = [(i, f"2024-01-01 12:00:00 error {w}") for i, w in enumerate(own)] + [(5000 + i, f"2024-01-01 12:00:00 error {own[i][:-1]}#") for i in range(0, 2000, 100)]
    got = {r.doc_id for r in L.repeated_lines(docs_of(rows)).collect() if r.n_near}
    assert got == {5000 + i for i in range(0, 2000, 100)}


def test_memory_of_a_task_is_bounded(docs_of, monkeypatch):
    """Lines that carry their keys twice change nothing."""
    monkeypatch.setattr(L, "SEEN", 1)
    rows = [(i, "one line that stands in many texts\nand another line that does so too\n" + f"own line of text number {chr(97 + i)}") for i in range(12)]
    assert found(L.repeated_lines(docs_of(rows))) == brute(rows, 2, L.MIN_CHARS)
