"""Balanced label propagation: documents into shards of equal row counts, linked documents together.

Documents that share a link key (by default: equal texts) are linked.  The law
is ``rows``: shard s takes ``n div shards`` documents and one more if
``s < n mod shards``, whatever the links are.

Method, in Spark jobs over narrow rows (no texts):

1. documents are written once with their size, checksum and link key; keys that
   stand on one row only link nothing, their rows are free;
2. linked documents are dealt round robin in id order: equal counts, no regard
   to the links;
3. in every round each link key's documents are counted by shard (pre-aggregated,
   so a key on a third of all rows is at most ``shards`` rows) and joined back:
   a document wants to go to the shard that holds most of its neighbours, ties
   by a hash; a key with more documents than a shard takes wants as many shards
   as it needs.  Demands are added up by (from, to); what each shard can admit is
   its room (quota less linked documents) plus what leaves it, and demands are
   scaled down until all shards hold that (a table of shards x shards numbers).
   Where a pair is cut, its movers are numbered, those of large keys first, and
   the first ones go;
4. rounds end when no demand is left or admitted; a shard that could admit less
   than half of its demand is no target any more; a key that only such shards
   hold in parts goes to one with room.  Other documents only move to shards
   with at least as many neighbours, so rounds do not go in circles;
   ``max_rounds`` bounds them (quality only: the quotas hold after every round);
5. free documents fill what room is left, in id order; slots are numbers in the
   shard, linked documents first.

No shard, group or link key is gathered: counts are aggregates, numbers come
from range partitions (``numbering.numbered``).  The driver reads shards x
shards numbers a round.

Defined results: a null text counts as an empty one (size: the 16 bytes of
overhead, checksum of nothing), and all of them are linked; repeated rows are documents
of their own, linked like any equal texts; a null id sorts first; other columns
are not read.  An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerscope.llm.common import saved
from peerscope.llm.numbering import numbered

OVERHEAD = 16
LAW = "rows"


@dataclass(frozen=True)
class Sharding:
    """``rows``: the documents with shard and slot; ``cut``: documents that wanted to move, in every round."""

    rows: DataFrame
    cut: list[int]


def _quotas(n: int, shards: int) -> np.ndarray:
    return np.full(shards, n // shards, np.int64) + (np.arange(shards) < n % shards)


def _from_list(values, at: Column) -> Column:
    """The long at place ``at`` of a short list (one per shard, or per pair of shards)."""
    return F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]), at.cast("int"))


def admitted(demand: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The part of ``demand[from, to]`` after which no shard has more than its room: too much into a shard is scaled down, over and over."""
    go = demand.astype(np.int64).copy()
    while True:
        into, out = go.sum(0), go.sum(1)
        over = into - out - room
        if not (over > 0).any():
            return go
        for t in np.flatnonzero(over > 0):
            go[:, t] = go[:, t] * max(0, int(into[t] - over[t])) // int(into[t])


def _held(linked: DataFrame, shards: int) -> np.ndarray:
    out = np.zeros(shards, np.int64)
    for r in linked.groupBy("shard").count().collect():  # one row a shard
        out[r["shard"]] = r["count"]
    return out


def _wishes(linked: DataFrame, closed: set[int], spare: list[int], biggest: int) -> DataFrame:
    """``linked`` with ``target``: the shard a document wants to move to, null if it stays; ``spare``: open shards with room."""
    held = linked.groupBy("key", "shard").agg(F.count("*").alias("n"))
    by_key = Window.partitionBy("key")  # at most one row a shard
    is_open = ~F.col("shard").isin([int(s) for s in closed]) if closed else F.lit(True)
    order = by_key.orderBy(F.desc("n"), F.desc(is_open), F.xxhash64("key", "shard"))
    held = held.withColumns({"total": F.sum("n").over(by_key), "rank": F.row_number().over(order), "open": is_open})
    # the open shards that hold most of the key come first; what stands in better shards stays there
    key_rows = held.groupBy("key").agg(
        F.first("total").alias("copies"),
        F.array_sort(F.collect_list(F.when(F.col("open"), F.struct("rank", "shard")))).alias("holders"),
        F.map_from_entries(F.collect_list(F.struct("shard", "rank"))).alias("ranks"),
    )
    need = F.ceil(F.col("copies") / F.lit(biggest)).cast("int")
    targets = F.slice("holders", F.lit(1), need)
    if spare:  # a split key that only full shards hold moves to one with room, all of it
        other = F.get(F.array(*[F.lit(s) for s in spare]), F.pmod(F.xxhash64("key"), F.lit(len(spare))).cast("int"))
        targets = F.when((F.size("holders") > 0) | (need > 1), targets).otherwise(F.array(F.struct(F.lit(0).alias("rank"), other.alias("shard"))))
    # written before the join, so that it is a plain exchange and a hot key may be split
    key_rows = saved(key_rows.select("key", "copies", "ranks", targets.alias("targets")).filter(F.size("ranks") > 1), "shards-targets")
    rows = linked.join(key_rows, "key", "left")
    pick = F.get("targets", F.pmod(F.xxhash64("doc_id", "key"), F.greatest(F.size("targets"), F.lit(1))).cast("int"))
    stays = F.exists("targets", lambda t: t["shard"] == F.col("shard")) | (F.element_at("ranks", F.col("shard")) <= pick["rank"])
    return rows.select(*linked.columns, "copies", F.when(~stays, pick["shard"]).alias("target"))


def _round(linked: DataFrame, closed: set[int], quotas: np.ndarray, shards: int, number: int) -> tuple[DataFrame, int, int]:
    """One round: the new table, documents that wanted to move, documents that did; ``closed`` grows."""
    here = _held(linked, shards)
    spare = [s for s in range(shards) if s not in closed and quotas[s] > here[s]]
    wishes = saved(_wishes(linked, closed, spare, int(quotas.max())), f"shards-wishes-{number}")
    demand = np.zeros((shards, shards), np.int64)
    for r in wishes.filter("target is not null").groupBy("shard", "target").count().collect():  # at most shards x shards rows
        demand[r["shard"], r["target"]] = r["count"]
    go = admitted(demand, quotas - here)
    for t in np.flatnonzero(2 * go.sum(0) < demand.sum(0)):
        closed.add(int(t))
    pair = F.col("shard") * shards + F.col("target")
    whole, part = go == demand, (go > 0) & (go < demand)
    goes = _from_list((whole & (demand > 0)).ravel(), pair) == 1
    if part.any():
        is_part = F.coalesce(_from_list(part.ravel(), pair) == 1, F.lit(False))
        cut = numbered(wishes.filter(is_part).withColumn("ahead", -F.col("copies")), ["shard", "target"], ["ahead", "key", "doc_id"], f"shards-movers-{number}")
        cut = cut.withColumn("moved", F.col("place") < _from_list(go.ravel(), pair)).drop("place", "ahead")
        rest = wishes.filter(~is_part).withColumn("moved", F.coalesce(goes, F.lit(False)))
        wishes = rest.unionByName(cut)
    else:
        wishes = wishes.withColumn("moved", F.coalesce(goes, F.lit(False)))
    out = wishes.withColumn("shard", F.when(F.col("moved"), F.col("target")).otherwise(F.col("shard"))).select(*linked.columns)
    return saved(out, f"shards-{number}"), int(demand.sum()), int(go.sum())


def shard_rows(docs: DataFrame, shards: int = 40, *, id_col: str = "doc_id", text_col: str = "text", link: Column | None = None, max_rounds: int = 12) -> Sharding:
    """(doc_id, size, text_crc32, shard, slot) of every document, under the law ``rows``.

    ``link`` is the key that linked documents share (null: not linked); by default the SHA-256 of the text.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    key = link.cast("binary") if link is not None else F.unhex(F.sha2(text, 256))
    base = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        key.alias("key"),
    )
    base = saved(base, "shards-documents")
    n = base.count()
    quotas = _quotas(n, shards)
    repeated = base.filter(F.col("key").isNotNull()).groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key", F.lit(True).alias("linked"))
    repeated = saved(repeated, "shards-keys")  # written before the join, so that it is a plain exchange and a hot key may be split
    marked = saved(base.join(repeated, "key", "left"), "shards-marked")

    linked = numbered(marked.filter("linked").drop("linked"), [], ["doc_id", "text_crc32"], "shards-dealt")
    linked = saved(linked.withColumn("shard", (F.col("place") % shards).cast("int")).drop("place"), "shards-0")
    cut, closed = [], set()
    for number in range(1, max_rounds + 1):
        linked, wanted, moved = _round(linked, closed, quotas, shards, number)
        cut.append(wanted)
        if not wanted or not moved and len(closed) == shards:
            break

    cols = ["doc_id", "size", "text_crc32", "shard", "slot"]
    placed = numbered(linked, ["shard"], ["key", "doc_id"], "shards-slots", place="slot")
    here = _held(linked, shards)
    free = numbered(marked.filter("linked is null").drop("linked"), [], ["doc_id", "text_crc32"], "shards-free")
    ends = np.cumsum(quotas - here)  # free document i goes to the first shard whose end lies beyond i
    shard = sum((F.when(F.col("place") >= F.lit(int(e)), 1).otherwise(0) for e in ends[:-1]), F.lit(0))
    free = free.withColumn("shard", shard.cast("int"))
    starts = ends - (quotas - here)
    free = free.withColumn("slot", F.col("place") - _from_list(starts, F.col("shard")) + _from_list(here, F.col("shard")))
    return Sharding(placed.select(*cols).unionByName(free.select(*cols)), cut)
