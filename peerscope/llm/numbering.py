"""Gapless numbers inside groups of any size, without a window over a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerscope.llm.common import free_name, saved

#: Bits that ``monotonically_increasing_id`` keeps for the row's number in its partition.
ROW_BITS = 33


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str, place: str = "place", total: str | None = None) -> DataFrame:
    """``df`` with ``place``, 0, 1, 2 ... in its ``group`` by ``order`` (nulls first), and ``total``, the group's rows.

    Rows are range-partitioned by group and order, so a group that holds a
    third of all rows is cut over many partitions, and written once: a row's
    number is its place in its partition plus the group's rows in the
    partitions before.  What is added up is one row per partition and group.
    Rows that agree in group and order are numbered in any order.
    """
    at = free_name(df, "at")
    ranged = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    rows = saved(ranged.withColumn(at, F.monotonically_increasing_id()), name)
    part = F.shiftrightunsigned(F.col(at), ROW_BITS)
    keys = [F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]
    names = [f"_g{i}" for i in range(len(group))]
    pieces = rows.groupBy(*keys, part.alias("_part")).agg(F.min(at).alias("_low"), F.count("*").alias("_n"))
    one_group = Window.partitionBy(*(names or [F.lit(0)]))  # at most one row per partition of the range exchange
    pieces = pieces.withColumns({
        "_before": F.coalesce(F.sum("_n").over(one_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_total": F.sum("_n").over(one_group),
    })
    on = part == F.col("_part")
    for g, k in zip(group, names):
        on = on & F.col(g).eqNullSafe(F.col(k))
    out = rows.join(pieces, on).withColumn(place, F.col(at) - F.col("_low") + F.col("_before"))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.select(*df.columns, place, *([total] if total else []))
