"""Merkle manifest of a dataset: leaves, one tree per group, one tree over the groups, proofs and their check.

A leaf is the SHA-256 of a row's fields, each ``-`` if null, else its UTF-8
byte count, ``:`` and its text.  The leaves of a group ascend by the order
column; while a group has several nodes, every ``fanout`` consecutive ones (the
last run may be shorter, even one) become the hash of their hex digests.  What
remains is the group's subroot (a lone leaf itself); the subroots, by group
(null first, then bytewise), likewise give the root.

Method: slot pivot.  Conditional aggregates spread the children of a parent
into columns, one per slot; concatenating the columns hashes the parent and
leaving out the own slot's column yields the siblings.  One pivot holds a run
of up to ``COLUMNS`` nodes, so one shuffle builds several levels of the tree
(their nodes are columns as well), and what is shuffled shrinks by that factor
with every pivot.  Proofs come back down the same tables: a block's row is
joined to its parent's proof by (group, block), a key without repeats, and
hands each slot its siblings followed by that proof.  A hot group is spread
over blocks; nothing is gathered per group or on the driver (one number, the
height of the tallest tree, is read there).

Defined results: an empty table gives no rows; a null order column sorts first;
rows that agree in it are ordered by their leaf; repeated rows are leaves of
their own; a null group is a group.  Columns other than the fields, the group
and the order column are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import saved
from peerscope.llm.numbering import numbered

#: Most slot columns of one pivot.
COLUMNS = 16
DIGEST = 64  # hex characters


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of fields, each ``-`` if null, else byte count, ``:`` and text (integers decimal)."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _join_digests(*digests: Column) -> Column:
    return F.concat_ws("", *digests)


def height(n: Column, fanout: int) -> Column:
    """Levels above ``n`` leaves: the powers of ``fanout`` that are less than ``n``."""
    powers = [fanout**k for k in range(63) if fanout**k < 2**63]
    out = F.lit(0)
    for p in powers:
        out = out + F.when(n > F.lit(p), 1).otherwise(0)
    return out


def _levels_per_pivot(fanout: int) -> int:
    levels = 1
    while fanout ** (levels + 1) <= COLUMNS:
        levels += 1
    return levels


def _pivot(nodes: DataFrame, fanout: int, first_level: int, name: str) -> DataFrame:
    """Blocks (g, block, n, l0_*, l1_*, ...) of the nodes (g, place, n, node): their slots and every level inside them."""
    levels = _levels_per_pivot(fanout)
    width = fanout**levels
    slots = [F.max(F.when(F.col("place") % width == k, F.col("node"))).alias(f"l0_{k}") for k in range(width)]
    block = ((F.col("place") - F.col("place") % width) / width).cast("long")
    out = nodes.groupBy("g", block.alias("block")).agg(F.max("n").alias("n"), *slots)
    out = out.withColumn("height", height(F.col("n"), fanout))
    digest = lambda lv, k: F.col(f"l0_{k}.digest") if lv == 0 else F.col(f"l{lv}_{k}")
    for lv in range(1, levels + 1):
        made = {}
        for k in range(fanout ** (levels - lv)):
            run = [digest(lv - 1, k * fanout + j) for j in range(fanout)]
            hashed = F.when(run[0].isNotNull(), F.sha2(_join_digests(*run), 256))
            passed = run[0] if k == 0 else F.lit(None).cast("string")  # the tree ends below: its top is handed on
            made[f"l{lv}_{k}"] = F.when(F.col("height") >= first_level + lv, hashed).otherwise(passed)
        out = out.withColumns(made)
    return saved(out, name)


def build(nodes: DataFrame, fanout: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Pivot tables from the leaves up, and the tops (g, n, top), of the trees over nodes (g, place, n, node).

    ``node`` is a struct with the field ``digest``; other fields stay with the leaf.
    """
    tallest = nodes.agg(F.max("n").alias("n")).select(height(F.col("n"), fanout).alias("h"), "n").first()
    levels = _levels_per_pivot(fanout)
    pivots: list[DataFrame] = []
    while not pivots or tallest["n"] and len(pivots) * levels < tallest["h"]:
        pivots.append(_pivot(nodes, fanout, len(pivots) * levels, f"{name}-{len(pivots)}"))
        nodes = pivots[-1].select("g", F.col("block").alias("place"), "n", F.struct(F.col(f"l{levels}_0").alias("digest")).alias("node"))
    return pivots, nodes.select("g", "n", F.col("node.digest").alias("top"))


def proofs(pivots: list[DataFrame], parents: DataFrame, fanout: int) -> DataFrame:
    """Every leaf (g, place, n, node, proof, with) from the pivots and the proofs above their trees.

    ``parents`` has (g, proof, with): the siblings above the tree's top, and a
    struct that is handed down to its leaves.
    """
    levels = _levels_per_pivot(fanout)
    width = fanout**levels
    above = parents.select("g", F.lit(0).cast("long").alias("block"), "proof", "with")
    for pivot in reversed(pivots):
        slots = []
        for k in range(width):
            siblings = []
            for lv in range(levels):
                own = k // fanout**lv
                run = own - own % fanout
                siblings += [F.col(f"l0_{j}.digest") if lv == 0 else F.col(f"l{lv}_{j}") for j in range(run, run + fanout) if j != own]
            at = (F.col("block") * width + k).alias("place")
            slots.append(F.when(F.col(f"l0_{k}").isNotNull(), F.struct(at, F.col(f"l0_{k}").alias("node"), _join_digests(*siblings, F.col("proof")).alias("proof"))))
        rows = pivot.join(above, ["g", "block"]).select("g", "n", "with", F.explode(F.array_compact(F.array(*slots))).alias("s"))
        out = rows.select("g", "s.place", "n", "s.node", "s.proof", "with")
        above = out.select("g", F.col("place").alias("block"), "proof", "with")
    return out


def fold(digest: Column, proof: Column, place: Column, n: Column, fanout: int, start: Column | None = None) -> Column:
    """Struct (digest, at): the top that ``digest`` at ``place`` of ``n`` leaves gives with the siblings of ``proof`` from character ``start`` on."""
    long = lambda c: c.cast("long")

    def up(node: Column, _: Column) -> Column:
        slot = node["place"] % fanout
        run = node["place"] - slot
        others = F.least(F.lit(fanout), node["n"] - run) - 1
        left = F.substr(proof, long(node["at"] + 1).cast("int"), (slot * DIGEST).cast("int"))
        right = F.substr(proof, (node["at"] + 1 + slot * DIGEST).cast("int"), ((others - slot) * DIGEST).cast("int"))
        more = node["n"] + (fanout - 1)
        return F.struct(
            F.sha2(F.concat(left, node["digest"], right), 256).alias("digest"),
            long(node["at"] + others * DIGEST).alias("at"),
            long(run / fanout).alias("place"),
            long((more - more % fanout) / fanout).alias("n"),
        )

    h = height(n, fanout)
    steps = F.when(h > 0, F.sequence(F.lit(1), h)).otherwise(F.array().cast("array<int>"))
    first = F.struct(digest.alias("digest"), long(start if start is not None else F.lit(0)).alias("at"), long(place).alias("place"), long(n).alias("n"))
    return F.aggregate(steps, first, up)


def manifest(
    rows: DataFrame, fields: Sequence[str], *, group_col: str, order_col: str, carry: dict[str, Column] | None = None, fanout: int = 2
) -> DataFrame:
    """(group, <order_col>, leaf, subroot, root, proof, place, n, group_place, groups, carried ...) of every row.

    ``proof`` is the hex digests of the siblings, level by level up to the
    subroot and then to the root, left to right inside a run.  ``carry`` names
    further columns, built from the table's, that stay with the row.
    """
    if fanout < 2:
        raise ValueError("a tree needs a fanout of two or more")
    carried = {"order": rows[order_col], **(carry or {})}
    group = rows[group_col].cast("string")
    key = F.coalesce(F.concat(F.lit("="), group), F.lit(""))  # null first, then bytewise; never null
    leaves = rows.select(key.alias("g"), leaf_digest(*[rows[f] for f in fields]).alias("digest"), *[c.alias(f"_c_{k}") for k, c in carried.items()])
    leaves = numbered(leaves, ["g"], ["_c_order", "digest"], "merkle-leaves", total="n")
    node = F.struct("digest", *[F.col(f"_c_{k}").alias(k) for k in carried])
    pivots, tops = build(leaves.select("g", "place", "n", node.alias("node")), fanout, "merkle")

    subroots = numbered(tops.select(F.lit("").alias("all"), "g", "top"), ["all"], ["g"], "merkle-groups", total="n")
    nodes = subroots.select(F.col("all").alias("g"), "place", "n", F.struct(F.col("top").alias("digest"), F.col("g").alias("group")).alias("node"))
    root_pivots, root = build(nodes, fanout, "merkle-root")
    above = root.select("g", F.lit("").alias("proof"), F.struct(F.col("top").alias("root")).alias("with"))
    groups = proofs(root_pivots, above, fanout).select(
        F.col("node.group").alias("g"),
        "proof",
        F.struct(F.col("node.digest").alias("subroot"), F.col("with.root").alias("root"), F.col("place").alias("group_place"), F.col("n").alias("groups")).alias("with"),
    )
    out = proofs(pivots, saved(groups, "merkle-subroots"), fanout)
    return out.select(
        F.when(F.col("g") != "", F.substr("g", F.lit(2))).alias("group"),
        F.col("node.order").alias(order_col),
        F.col("node.digest").alias("leaf"),
        "with.subroot",
        "with.root",
        "proof",
        "place",
        "n",
        "with.group_place",
        "with.groups",
        *[F.col(f"node.{k}").alias(k) for k in carry or {}],
    )


def folded_root(leaf: Column, proof: Column, fanout: int = 2) -> Column:
    """The root that ``leaf`` gives with a row's ``proof`` and place in ``manifest``."""
    sub = fold(leaf, proof, F.col("place"), F.col("n"), fanout)
    return fold(sub["digest"], proof, F.col("group_place"), F.col("groups"), fanout, start=sub["at"])["digest"]
