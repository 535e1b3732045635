import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """(id, text) rows as a documents table with columns whose names the operators use inside."""

    def make(rows):
        extra = "rid long, row long, words string, n int, key long, removed string, text_hash long, bands string, host string"
        full = [(i, t, "en", "s", len(t or ""), 1, 2, "w", 3, 4, "r", 5, "b", "h") for i, t in rows]
        return spark.createDataFrame(full, f"{DOCS}, {extra}")

    return make


#: null id and text, empty and blank texts, a repeated row, an id with two texts, a very long text
EDGE = [
    (None, None),
    (None, "a null id with a text of some words and no more than that"),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "two words"),
    (6, "the quick brown fox jumps over the lazy dog again and again"),
    (6, "the quick brown fox jumps over the lazy dog again and again"),
    (7, "the quick brown fox jumps over the lazy dog again and again"),
    (8, "first text of an id with two texts, not like the other one at all"),
    (8, "second text here; nothing of what was said before is said in it"),
    (9, " ".join(f"w{i * 7919 % 100003}" for i in range(60_000))),
]


@pytest.fixture(scope="session")
def edge_rows():
    return EDGE


@pytest.fixture(scope="session")
def edge(docs_of):
    return docs_of(EDGE)


@pytest.fixture(scope="session")
def nothing(docs_of):
    return docs_of([])
