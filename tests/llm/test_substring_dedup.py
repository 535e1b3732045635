import random
from collections import defaultdict

from peerscope.llm import substring_dedup as S


def brute(rows, min_words):
    """Spans of each row, by comparing all units in rank order."""
    first, n = {}, defaultdict(int)
    for doc, text in rows:
        for h1, h2, *_ in S.units(text):
            n[h1, h2] += 1
            old = first.get((h1, h2), "none")
            first[h1, h2] = doc if old in ("none", None) else old if doc is None else min(old, doc)
    out = []
    for doc, text in rows:
        seen, run = set(), []
        for u in [*S.units(text), None]:
            again = False
            if u is not None and n[u[:2]] > 1:
                again = first[u[:2]] != doc or u[:2] in seen
                seen.add(u[:2])
            if again:
                run.append(u)
                continue
            if sum(x[4] for x in run) >= min_words and run:
                out.append((str(doc), run[0][2], run[-1][3]))
            run = []
    return sorted(out)


def spans(df):
    return sorted((str(r.doc_id), r.start, r.stop) for r in df.collect())


def test_against_rank_order(docs_of, edge_rows):
    rnd = random.Random(3)
    sentence = lambda: " ".join(rnd.choice("abcdefghij") * rnd.randint(1, 3) for _ in range(rnd.randint(3, 9))).capitalize() + rnd.choice(".!?")
    stock = [" ".join(sentence() for _ in range(5)) for _ in range(5)]
    rows = list(edge_rows)
    for i in range(60):
        parts = [rnd.choice(stock) if rnd.random() < 0.4 else sentence() for _ in range(rnd.randint(1, 6))]
        rows.append((1000 - i, rnd.choice([" ", "\n", "  \n"]).join(parts)))
    got = spans(S.repeated_spans(docs_of(rows), min_words=12))
    assert got == brute(rows, 12) and len(got) > 10


def test_passage_pasted_inside_lines(docs_of):
    passage = " ".join(f"Sentence {i} of the shared passage has a number of words in it." for i in range(6))
    rows = [(i, f"Own start {i} of the text goes on {passage} and then {i} ends it here. Own end {i}.") for i in range(5)]
    got = S.repeated_spans(docs_of(rows)).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 3, 4] and {r.first_doc_id for r in got} == {0}
    for r in got:
        text = rows[r.doc_id][1]
        assert text[r.start : r.stop] in passage and r.n_words >= 50
        left = S.without_spans(text, [(r.start, r.stop)])
        assert "Own start" in left and "Own end" in left and len(left) == len(text) - (r.stop - r.start)


def repeated_words(rows, passage=S.PASSAGE):
    """Words of each row in a repeating unit or in a window that an earlier text holds, or its own text a window before."""
    whole = brute(rows, 1)
    first = {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        w = text.lower().split()
        for p in range(len(w) - passage + 1):
            first.setdefault(tuple(w[p : p + passage]), (doc, p))
    out = set()
    for doc, text in rows:
        at, spots = 0, []
        for word in text.split():
            at = text.index(word, at)
            spots.append((at, at + len(word)))
            at += len(word)
        w = text.lower().split()
        for p in range(len(w) - passage + 1):
            d, q = first[tuple(w[p : p + passage])]
            if d != doc or p >= q + passage:
                out |= {(doc, x) for x in range(p, p + passage)}
        out |= {(doc, x) for x, (a, b) in enumerate(spots) for i, c, d in whole if i == str(doc) and c <= a and b <= d}
    return out


def removed_words(rows, got):
    text_of = dict(rows)
    out = set()
    for r in got:
        before = len(text_of[r.doc_id][: r.start].split())
        n = len(text_of[r.doc_id][r.start : r.stop].split())
        assert n == r.n_words
        out |= {(r.doc_id, before + x) for x in range(n)}
    return out


def test_short_passages_pasted_inside_lines(docs_of):
    one = "the one long sentence " + " ".join(f"a{i}" for i in range(51))
    two = " ".join(f"b{i}" for i in range(26)) + ". Then " + " ".join(f"c{i}" for i in range(27))
    short = "A licence line stands here."
    rows = [(i, f"Own{i} x{i} {one} z{i} end{i}.\nNext{i} y{i} {two} v{i} more{i}. {short}") for i in range(5)]
    got = S.repeated_passages(docs_of(rows)).collect()
    assert {r.doc_id for r in got} == {1, 2, 3, 4} and {r.first_doc_id for r in got} == {0}
    for i, text in rows[1:]:
        left = S.without_spans(text, sorted((r.start, r.stop) for r in got if r.doc_id == i))
        assert left.split() == f"Own{i} x{i} z{i} end{i}. Next{i} y{i} v{i} more{i}.".split()


def test_passages_against_all_windows(docs_of, edge, nothing):
    rnd = random.Random(8)
    word = lambda: rnd.choice("abcdefghijklmnopqrstuvwxyz") * rnd.randint(1, 4)
    stock = [[word() + rnd.choice(["", "", "", "", "."]) for _ in range(rnd.randint(45, 130))] for _ in range(6)]
    rows = [(900, "flood " * 300), (901, " ".join(stock[0]) + " own " + " ".join(stock[0]))]
    for i in range(50):
        words = [word() for _ in range(rnd.randint(0, 40))]
        for _ in range(rnd.randint(0, 3)):
            s = rnd.choice(stock)
            a = rnd.randint(0, 30)
            words += s[a : rnd.randint(a + 40, len(s) + 20)] + [word() for _ in range(rnd.randint(0, 9))]
        rows.append((500 - i, " ".join(words)))
    got = S.repeated_passages(docs_of(rows)).collect()
    assert removed_words(rows, got) == repeated_words(rows) and len(got) > 20
    twice = docs_of([(1, " ".join(stock[0])), (1, " ".join(stock[0])), (2, "own " + " ".join(stock[0]) + " words")])
    assert {r.doc_id for r in S.repeated_passages(twice).collect()} <= {2}
    assert S.repeated_passages(nothing).count() == 0 and S.repeated_passages(edge).columns == S.repeated_spans(edge).columns


def test_normalisation_and_offsets():
    a, b = S.units("  The  CAT sat.\tOn it"), S.units("the cat\xa0sat. on IT")
    assert [u[:2] for u in a] == [u[:2] for u in b] and [(u[2], u[3]) for u in a] == [(2, 15), (16, 21)]


def test_empty(nothing):
    assert S.repeated_spans(nothing).count() == 0
