"""Balanced label propagation: the law, whole rows, links kept together, against plain recounts."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerscope.llm import sharding as S
from peerscope.llm.queries import op13_shards

SF = "/root/testdata/sf0.01"


def check_law(rows, shards):
    """Counts at most one apart, slots without gaps."""
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def facts(docs):
    return Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs)


def split_groups(rows, docs):
    """Texts on several rows that stand in several shards, and their number."""
    text = dict(docs)
    where, size = {}, Counter(t or "" for _, t in docs)
    for r in rows:
        where.setdefault(text[r.doc_id] or "", set()).add(r.shard)
    many = [t for t in where if size[t] > 1]
    return sum(len(where[t]) > 1 for t in many), len(many)


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = op13_shards(spark, SF).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == facts(docs)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    check_law(rows, 40)
    assert split_groups(rows, docs)[0] == 0


def test_hot_group_takes_few_shards(spark, docs_of):
    """A text on a third of the rows fills shards; the other groups stay whole."""
    docs = [(i, "hot") for i in range(400)] + [(1000 + i, f"pair {i // 2}") for i in range(400)] + [(2000 + i, f"alone {i}") for i in range(400)]
    found = S.shard_rows(docs_of(docs), 10)
    rows = found.rows.collect()
    check_law(rows, 10)
    text = dict(docs)
    hot = Counter(r.shard for r in rows if text[r.doc_id] == "hot")
    assert sum(n for _, n in hot.most_common(5)) >= 0.8 * 400, hot  # 400 rows in shards of 120: four at least
    split, many = split_groups(rows, docs)
    assert split <= 0.1 * many
    assert found.cut[-1] <= 0.1 * found.cut[0]


def test_only_linked_rows(spark, docs_of):
    """No free row makes room: groups come together by exchanges alone."""
    docs = [(i, f"group {i * 7919 % 1200 // 4}") for i in range(1200)]
    found = S.shard_rows(docs_of(docs), 8)
    rows = found.rows.collect()
    check_law(rows, 8)
    split, many = split_groups(rows, docs)
    assert split <= 0.1 * many


def test_odd_rows(spark, docs_of, edge, edge_rows, nothing):
    rows = S.shard_rows(edge, 4).rows.collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == facts(edge_rows)
    check_law(rows, 4)
    assert S.shard_rows(nothing, 4).rows.count() == 0
    few = S.shard_rows(docs_of([(1, "a"), (2, "a"), (3, None)]), 40).rows.collect()
    check_law(few, 40)
    assert len(few) == 3


def test_own_links(spark, docs_of):
    """A link column of the caller's; rows without one are free."""
    docs = docs_of([(i, f"t{i}") for i in range(300)]).withColumn("site", F.when(F.col("doc_id") % 3 == 0, F.col("doc_id") % 10))
    rows = S.shard_rows(docs, 5, link=F.col("site").cast("string")).rows.collect()
    check_law(rows, 5)
    where = {}
    for r in rows:
        if r.doc_id % 3 == 0:
            where.setdefault(r.doc_id % 10, set()).add(r.shard)
    assert sum(len(v) > 1 for v in where.values()) == 0


@pytest.mark.parametrize("seed", range(5))
def test_admitted_is_never_too_much(seed):
    rng = np.random.default_rng(seed)
    demand = rng.integers(0, 50, (9, 9))
    np.fill_diagonal(demand, 0)
    room = rng.integers(0, 3, 9) * rng.integers(0, 100, 9)
    go = S.admitted(demand, room)
    assert (go <= demand).all() and (go >= 0).all()
    assert (go.sum(0) - go.sum(1) <= room).all()
    assert (S.admitted(demand, np.full(9, 10_000)) == demand).all()
