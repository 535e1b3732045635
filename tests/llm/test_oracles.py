"""Queries with a DuckDB statement against it, on tables with odd rows besides those of the driver."""

import duckdb
import pytest

from peerscope.llm.oracle import SQL
from peerscope.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def compared(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet{'/*.parquet' if folder != SF else ''}')")
    df = QUERIES[name](spark, folder)
    got = sorted((tuple(r[c] for c in df.columns) for r in df.collect()), key=str)
    res = con.execute(SQL[name])
    at = [[d[0] for d in res.description].index(c) for c in df.columns]
    return got, sorted((tuple(r[i] for i in at) for r in res.fetchall()), key=str)


@pytest.mark.parametrize("name", ["op11_repair", "op12_merkle"])
def test_query_matches_oracle(spark, name):
    got, want = compared(spark, SF, name)
    assert got == want and got


def test_odd_rows(spark, tmp_dir):
    from test_conversation_repair import EDGES

    spark.createDataFrame(EDGES, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_dir}/conversations.parquet")
    docs = [(None, None, None, None, None), (1, "s", "en", None, ""), (2, "s", "en", 5, "äöü\U0001f600"), (2, "s", "en", 5, "äöü\U0001f600"), (-7, "s", "", 0, " "), (9, "s", "z", 1, "-")]
    spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_dir}/pages.parquet")
    for name in ("op11_repair", "op12_merkle"):
        got, want = compared(spark, tmp_dir, name)
        assert got == want and got
