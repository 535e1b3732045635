"""Every registered query against its DuckDB statement on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from peerscope.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if hasattr(v, "isoformat"):
        return str(v)[:10] if type(v).__name__ == "date" else v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["FIPS", "year", "sba_loan", "total_loan", "sba_loan_pp", "total_loan_pp"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)
    assert got == exp
