"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import saved


def _toward_least(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Each node hands the least of itself and its neighbours to its larger (both_ways) or to its smaller neighbours."""
    down = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))  # a > b: every edge at its larger end
    if both_ways:
        down = down.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = down.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    moved = down.join(least, "u")
    if both_ways:
        return moved.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): component is the least node reachable.

    Large-star and small-star rounds until nothing changes; each round's edges
    are written to the shared folder.  Minima are combined map-side, so a hub
    is no hot task there, and its join may be split by AQE.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    e = saved(e, "component-edges")
    mark = lambda d: tuple(d.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    was = mark(e)
    while was[0]:
        e = saved(_toward_least(_toward_least(e, True).filter("a <> b").distinct(), False).filter("a <> b").distinct(), "component-edges")
        if (now := mark(e)) == was:
            break
        was = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
