"""The pipeline against a plain version of its five stages."""

import os
import random
from collections import defaultdict

import pytest
from test_line_dedup import distance
from test_quality_rules import brute as judged

import corpus_pipeline as P
from peerscope.llm import bpe, decontaminate, line_dedup

tokenizers = pytest.importorskip("tokenizers")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ITEMS = [(i, f"Question {'abcde'[i]} asks how many red and blue marbles remain when {'two three four five six'.split()[i]} friends share {i + 11} of them") for i in range(5)]


def corpus():
    rnd = random.Random(21)
    vocabulary = [f"word{i}" for i in range(400)]
    line = lambda: " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(8, 14)))
    stock = [line() for _ in range(6)]
    rows = []
    for i in range(40):
        lines = [rnd.choice(stock) if rnd.random() < 0.2 else line() for _ in range(rnd.randint(6, 12))]
        rows.append((i, "\n".join(lines)))
    for i in range(12):  # near copies: a word changed in one line or in every third, the lines kept or joined
        lines = rows[i][1].split("\n")
        out = [" ".join("wordx" if k == 3 and (n == 0 or i % 3 == 0 and n % 3 == 0) else w for k, w in enumerate(x.split(" "))) for n, x in enumerate(lines)]
        rows.append((100 + i, "\n".join(out) if i % 4 == 3 else " ".join(out)))
    for i in range(6):  # exact copies and lines with a typing error
        rows.append((200 + i, rows[i][1] if i % 2 else rows[i][1].replace("word1", "wrod1")))
    for i, (_, item) in enumerate(ITEMS):
        rows.append((300 + i, rows[20 + i][1] + " " + item + " " + line() + "\n" + "\n".join(line() for _ in range(4))))
    rows += [(400, None), (401, ""), (402, "too short"), (403, "same same same " * 40), (None, "\n".join(line() for _ in range(7))), (404, " ".join(f"q{k}$$$" for k in range(90)))]
    return rows


def cut_lines(rows):
    edits, least = line_dedup.EDITS, line_dedup.MIN_CHARS
    at = defaultdict(list)
    for doc, text in rows:
        for number, _, x in line_dedup.lines_of(text, least):
            at[x].append((doc is None, doc or 0, number))
    rank = {x: min(v) for x, v in at.items()}
    near = {x for x in rank for y in rank if rank[y] < rank[x] and abs(len(x) - len(y)) <= edits and distance(x, y) <= edits}
    out = []
    for doc, text in rows:
        gone = {n for n, _, x in line_dedup.lines_of(text, least) if (doc is None, doc or 0, n) != rank[x] or x in near}
        left = "\n".join(x for n, x in enumerate((text or "").split("\n")) if n not in gone)
        if not gone or left.strip():
            out.append((doc, left if gone else text))
    return out


def one_of_each_group(rows):
    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets, group = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {g: min((d for (d, _), x in zip(rows, group) if x == g and d is not None), default=None) for g in set(group)}
    return [r for r, g, s in zip(rows, group, sets) if not s or r[0] == least[g]]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", "s", len(t or "")) for i, t in corpus()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(os.path.join(d, "documents.parquet"))
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(os.path.join(d, "benchmark.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(15)] + [(404, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(os.path.join(d, "labels.parquet"))
    return d


def test_against_plain_stages(spark, folder):
    rows = corpus()
    verdicts = judged(rows, [(i, 1) for i in range(15)] + [(404, 0)], buckets=65_536, prior=20.0, threshold=-0.1)
    rows = [r for r, v in zip(rows, verdicts) if v[-1]]
    assert {400, 401, 402, 403} & {i for i, _ in rows} == set() and {i for i in range(40)} <= {i for i, _ in rows}
    rows = cut_lines(rows)
    before = len(rows)
    rows = one_of_each_group(rows)
    assert len(rows) < before
    items = decontaminate.Items(ITEMS)
    rows = [r for r in rows if not decontaminate.leaks(r[1], items)]
    assert not {300 + i for i in range(5)} & {i for i, _ in rows}
    tokenizer = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    expected = sorted((str(i), t, tuple(tokenizer.encode(t, add_special_tokens=False).ids)) for i, t in rows)
    got = P.run(spark, folder).collect()
    assert sorted((str(r.doc_id), r.text, tuple(bpe.unpack(r.ids))) for r in got) == expected
    assert all(r.decoded == r.text and r.n_tokens == len(r.ids) // 4 for r in got)


def test_near_duplicates_go_by_id_and_text(spark, docs_of):
    words = " ".join(f"w{i}" for i in range(60))
    docs = docs_of([(1, words), (5, words + " more"), (5, "a text of its own that no other row of the table holds"), (6, None)])
    left = P.near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id, (r.text or "")[:4]) for r in left) == [(1, "w0 w"), (5, "a te"), (6, "")]


def test_stages_keep_the_columns(spark, folder):
    docs = P.table(spark, folder, "documents")
    assert [name for name, _ in P.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "encoding"]
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == COLUMNS
        docs = P.saved(docs, "test")


def test_stages_of_edge_rows_and_empty_tables(spark, folder, edge, nothing):
    for docs in (edge, nothing):
        for _, stage in P.STAGES:
            out = stage(spark, docs, folder)
            assert set(docs.columns) <= set(out.columns)
            assert out.count() <= docs.count()
