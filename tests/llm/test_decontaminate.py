import pytest

from peerscope.llm import decontaminate as D

QUESTION = "Yesterday Bob Jones bought 7 kg of apples at the market and sold 3 kg, how much did Bob Jones keep?"


def kinds(text, *items):
    return [(x[0], x[4]) for x in D.leaks(text, D.Items(list(enumerate(items or (QUESTION,)))))]


def test_verbatim_inside_other_words():
    text = "some words before " + QUESTION + " and some words after it"
    (item, start, stop, coverage, kind), = D.leaks(text, D.Items([(4, QUESTION)]))
    assert (item, kind) == (4, "verbatim") and coverage >= 0.8
    assert text[start:stop] in text and start >= text.index("Yesterday") and stop <= text.index(" and some")


@pytest.mark.parametrize(
    "text,found",
    [
        ("Yesterday Anna Smith bought 12 kg of apples at the market and sold 5 kg, how much did Anna Smith keep?", [(0, "reparameterised")]),
        ("Yesterday Anna Smith bought 12 kg of apples at the market and sold 5 kg, how much did Carl Meyer keep?", []),
        ("Yesterday Anna Smith bought 12 lb of apples at the market and sold 5 lb, how much did Anna Smith keep?", [(0, "reparameterised")]),
        ("Yesterday Anna Smith bought 12 kg of apples at the market and sold 5 lb, how much did Anna Smith keep?", []),
        ("yesterday bob jones bought apples", []),
        ("", []),
        (None, []),
    ],
)
def test_slots_must_correspond(text, found):
    assert kinds(text) == found


def test_edits_and_short_items():
    words = QUESTION.split()
    words[12] = "then"
    assert kinds(" ".join(words)) == [(0, "verbatim")]
    assert kinds("we saw the red car there", "the red car") == [(0, "verbatim")]
    assert kinds("anything at all", "a b", "", "1 2 3 4 5 6") == []  # too few literal tokens


def test_leak_behind_many_variants():
    variant = "Yesterday Anna Smith bought {} kg of apples at the market and sold {} kg, how much did Carl Meyer keep? "
    bank = "".join(variant.format(20 + i, 5 + i) for i in range(12))
    (item, start, stop, coverage, kind), = D.leaks(bank + QUESTION + " Done.", D.Items([(0, QUESTION)]))
    assert (item, kind) == (0, "verbatim") and coverage >= 0.8 and start >= len(bank)
    assert kinds(bank) == []


NAMES = "Did Barack Obama meet Angela Merkel in Berlin in July 2015 or in Paris in May 2016?"


@pytest.mark.parametrize("item", [NAMES, "12 + 7 * 3", "1 2 3 4 5 6", "What is 12 + 7?", "Barack met Angela", "Add 3 kg, 4 lb, 5 kg, 6 lb and 7 kg"])
def test_verbatim_copies_of_items_poor_in_literals(item):
    for text in (item, f"some words before {item} and some after", f"A sentence ends. {item} Next."):
        assert kinds(text, item) == [(0, "verbatim")]


def test_items_poor_in_literals_fit_with_their_own_values_only():
    assert kinds("Did Emmanuel Macron meet Boris Johnson in Rome in June 2019 or in Madrid in March 2020?", NAMES) == []
    assert kinds("we count 1 2 3 4 5 7 here and 13 + 7 * 3", "1 2 3 4 5 6 7 8 9", "12 + 7 * 3") == []


def test_hashes_follow_the_template():
    for text in (QUESTION, "In May 3 km north. Then Al saw 4% of it , and £5 \n U.S. forces", "", "— … --"):
        tokens = D.template(text)[0]
        h, slot = D.template_hashes(text)
        assert len(h) == len(tokens) and [t[0] == "\x00" for t in tokens] == slot.tolist()
        assert len({t: x for t, x in zip(tokens, h.tolist())}) == len(set(h.tolist())) == len(set(tokens))


def test_tables(spark, edge, edge_rows, nothing, docs_of):
    items = spark.createDataFrame([(1, QUESTION), (1, QUESTION), (None, QUESTION), (2, None), (3, edge_rows[-1][1][:400])], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.find_leaks(edge, items).collect()} == {(9, 3)}
    assert D.find_leaks(nothing, items).count() == 0
    assert D.find_leaks(edge, items.limit(0)).columns == ["doc_id", "item_id", "start", "stop", "coverage", "kind"]
    twice = docs_of([(5, "x " + QUESTION), (5, "x " + QUESTION), (None, QUESTION)])
    assert sorted((str(r.doc_id), r.item_id) for r in D.find_leaks(twice, items).collect()) == [("5", 1), ("5", 1), ("None", 1)]


def test_blocks_of_items(spark, docs_of, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_WINDOWS", 30)
    items = spark.createDataFrame([(i, f"item number {'abcdefg'[i]} has these plain words to find again here") for i in range(6)], "item_id long, text string")
    docs = docs_of([(i, "so: " + r.text) for i, r in enumerate(items.collect())])
    assert len(list(D.item_blocks(items))) > 1
    assert {(r.doc_id, r.item_id) for r in D.find_leaks(docs, items).collect()} >= {(i, i) for i in range(6)}


def test_planted_passages(spark):
    d = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    texts = items.collect()
    expected = {(r.doc_id, i.item_id) for r in docs.collect() for i in texts if i.text in r.text}
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(docs, items).collect()}
    assert expected and expected <= got and len(got - expected) <= len(expected) // 10


APPLES = "Tom has 12 apples. Mary has 7 apples. Tom gives Mary 3 apples. How many apples does Tom have now?"


@pytest.mark.parametrize(
    "text,found",
    [
        (APPLES, [(0, "verbatim")]),
        ("Jack has 15 apples. Lucy has 9 apples. Jack gives Lucy 4 apples. How many apples does Jack have now?", [(0, "reparameterised")]),
        ("Jack has 15 apples. Lucy has 9 apples. Jack gives Lucy 4 apples. How many apples does Lucy have now?", []),
        ("We met Tom. " + APPLES + " Then tom went home and Mary too.", [(0, "verbatim")]),
    ],
)
def test_names_that_open_sentences(text, found):
    assert kinds(text, APPLES) == found


def test_one_item_with_two_texts(spark, docs_of):
    other = "Every second summer the old mill by the river is painted in another colour by its owners"
    items = spark.createDataFrame([(1, QUESTION), (1, other), (1, other)], "item_id long, text string")
    docs = docs_of([(5, "x " + QUESTION), (6, "so: " + other), (7, QUESTION + " " + other)])
    assert sorted((r.doc_id, r.item_id) for r in D.find_leaks(docs, items).collect()) == [(5, 1), (6, 1), (7, 1), (7, 1)]


def plain_leaks(text, items, coverage=0.8, window=5, drift=3):
    """Leaks by comparing every window of the text with every window of every item, tokens and not hashes."""
    ours, values, starts, stops = D.template(text)
    word = lambda tokens, slots: [v or t for t, v in zip(tokens, slots)]
    out = []
    for item, their_text in items:
        theirs, slots = D.template(their_text)[:2]
        if not theirs:
            continue
        width, mine, his = min(window, len(theirs)), word(ours, values), word(theirs, slots)
        opens, sentence = [], True
        for w in their_text.split():
            if D._plain(w)[0]:
                opens.append(sentence and D._plain(w)[2])
            sentence = D._plain(w)[3]
        shared = set()
        for p in range(len(theirs) - width + 1):
            literal = sum(s is None for s in slots[p : p + width])
            enough = literal >= min(3, width) and width >= 3
            for a in range(len(ours) - width + 1):
                rich = sum(v is None for v in values[a : a + width]) >= min(3, width)
                if enough and rich and theirs[p : p + width] == ours[a : a + width]:
                    shared.add((a, p))
                if (not enough or p == 0 or any(opens[p : p + width])) and his[p : p + width] == mine[a : a + width]:
                    shared.add((a, p))
        best = 0
        for diagonal in {a - p for a, p in shared}:
            line = [(slots[p], values[p + diagonal]) for p in range(len(theirs)) if 0 <= p + diagonal < len(ours) and slots[p] is not None and theirs[p] == ours[p + diagonal]]
            fits = len({x for x, _ in line}) == len(set(line)) == len({y for _, y in line})
            covered = set()
            for a, p in shared:
                if abs(a - p - diagonal) <= drift:
                    own = his[p : p + width] == mine[a : a + width]
                    if own or (fits and a - p == diagonal and theirs[p : p + width] == ours[a : a + width]):
                        covered |= set(range(p, p + width))
            best = max(best, len(covered) / len(theirs))
        if best >= coverage:
            out.append((item, round(best, 9)))
    return out


def test_against_every_window(spark):
    import random

    rnd = random.Random(8)
    items = [(0, QUESTION), (1, APPLES), (2, NAMES), (3, "12 + 7 * 3"), (4, "the red car"), (5, "It takes 5 days to paint the old red house by the sea with 3 people."), (6, "Anna and Bob walk. Anna walks 4 km and Bob walks 9 km each day.")]
    names, numbers = ["Tom", "Mary", "Bob Jones", "Anna", "Bob", "Zoe", "The"], [str(n) for n in range(1, 20)]
    texts = []
    for _ in range(250):
        words = rnd.choice(items)[1].split()
        for _ in range(rnd.choice([0, 0, 1, 2, 6])):
            i = rnd.randrange(len(words))
            words[i] = rnd.choice([*names, *numbers, "then", words[i].lower(), words[i].title()])
        swap = dict(zip(rnd.sample(names, 4), rnd.sample(names, 4)))
        words = [swap.get(w, w) for w in words] if rnd.random() < 0.5 else words
        pad = lambda: " ".join(rnd.choice(["some", "Words.", "of", "Tom", "3", "the", "Red"]) for _ in range(rnd.randrange(6)))
        texts.append(" ".join([pad(), *words, pad(), *(rnd.choice(items)[1].split() if rnd.random() < 0.2 else [])]))
    index = D.Items(items)
    got = [[(x[0], round(x[3], 9)) for x in D.leaks(t, index)] for t in texts]
    want = [plain_leaks(t, items) for t in texts]
    assert [[i for i, _ in g] for g in got] == [[i for i, _ in w] for w in want]
    assert sum(map(len, got)) > 60 and any(not g for g in got)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = D.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in table.collect()) == sorted((i, k) for i, w in enumerate(want) for k, _ in w)
