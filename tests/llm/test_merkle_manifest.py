"""Merkle manifest against a plain tree built in lists."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from peerscope.llm import merkle_manifest as M
from peerscope.llm.queries import op12_merkle

SF = "/root/testdata/sf0.001"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row):
    word = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(map(word, row)))


def tree(nodes, fanout=2):
    """(top, for every node its siblings by level as (left, right) pairs)."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        new, new_under = [], []
        for a in range(0, len(nodes), fanout):
            run = nodes[a : a + fanout]
            for k, leaves in enumerate(under[a : a + fanout]):
                for i in leaves:
                    paths[i].append((run[:k], run[k + 1 :]))
            new.append(sha("".join(run)))
            new_under.append(sum(under[a : a + fanout], []))
        nodes, under = new, new_under
    return nodes[0], paths


def climb(node, path):
    for left, right in path:
        node = sha("".join(left) + node + "".join(right))
    return node


def plain(rows, fanout=2):
    """Rows of op12 from (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {g: (sorted(v, key=lambda x: x[:3]), *tree([x[2] for x in sorted(v, key=lambda x: x[:3])], fanout)) for g, v in groups.items()}
    if not names:
        return []
    root, root_paths = tree([built[g][1] for g in names], fanout)
    out = []
    for g, above in zip(names, root_paths):
        leaves, sub, paths = built[g]
        for (_, _, leaf, r), path in zip(leaves, paths):
            path = path + above
            proof = "".join("".join(a) + "".join(b) for a, b in path)
            bad = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = climb(leaf_of((*r[:3], r[3] + 1, r[4])) if bad else leaf, path)
            out.append((r[0], leaf, sub, root, sha(proof), folded, folded == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def run(spark, rows, tmp_path):
    extra = [(*r, 1, "n", 2, "p") for r in rows]
    schema = "doc_id long, source string, lang string, n_chars long, text string, place long, node string, n long, proof string"
    spark.createDataFrame(extra, schema).write.parquet(f"{tmp_path}/documents.parquet")
    return rows_of(op12_merkle(spark, str(tmp_path)))


def test_query_against_plain_tree(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    want = plain(rows)
    got = rows_of(op12_merkle(spark, SF))
    assert got == sorted(want, key=str)
    assert {r[-1] for r in got} == {True, False}


def test_odd_rows(spark, tmp_path):
    rows = [
        (None, None, None, None, None),
        (None, "s", "en", 3, "abc"),
        (1, "s", "en", None, ""),
        (2, "s", "en", 5, "äöü\U0001f600"),
        (2, "s", "en", 5, "äöü\U0001f600"),
        (2, "s", "en", 6, "other"),
        (-7, "s", "", 0, " \n"),
        (8, "s", "zß", 2**63 - 1, "x" * 500_000),
        (9, "s", "z", 1, "-"),
        (22, "s", "z", 1, "tampered by its id or not"),
    ]
    assert run(spark, rows, tmp_path) == sorted(plain(rows), key=str)


def test_tree_sizes(spark, tmp_path):
    """Lone leaves, runs cut short and heights on both sides of a pivot, in one table; many groups."""
    sizes = [1, 2, 3, 15, 16, 17, 31, 33, 257] + [1, 4] * 12
    rows = [(i * 3 + g, "s", f"g{g}", i, f"t{i}") for g, n in enumerate(sizes) for i in range(n)]
    assert run(spark, rows, tmp_path) == sorted(plain(rows), key=str)


@pytest.mark.parametrize("n", [0, 1, 17])
def test_one_group(spark, tmp_path, n):
    rows = [(i, "s", "en", i, f"t{i}") for i in range(n)]
    assert run(spark, rows, tmp_path) == sorted(plain(rows), key=str)


@pytest.mark.parametrize("fanout", [5])
def test_other_fanouts(spark, fanout):
    rows = [(i, f"g{i % 4 if i % 4 else 0}", f"t{i}") for i in range(130)]
    df = spark.createDataFrame(rows, "id long, part string, body string")
    out = M.manifest(df, ["id", "body"], group_col="part", order_col="id", fanout=fanout)
    got = out.withColumn("folded", M.folded_root(F.col("leaf"), F.col("proof"), fanout)).collect()
    groups = {}
    for i, g, t in rows:
        groups.setdefault(g, []).append(leaf_of((i, t)))
    tops = {g: tree(v, fanout) for g, v in groups.items()}
    root, above = tree([tops[g][0] for g in sorted(tops)], fanout)
    assert len(got) == len(rows)
    for r in got:
        path = tops[r.group][1][r.place] + above[sorted(tops).index(r.group)]
        assert r.proof == "".join("".join(a) + "".join(b) for a, b in path)
        assert r.root == root == r.folded and r.subroot == tops[r.group][0]
