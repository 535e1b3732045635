"""Skew-safe order statistics: rank within a group and exact median.

A window ``partitionBy(g).orderBy(v)`` sends every row of a group to one task,
so a group holding a third of the data becomes one huge task.  Here the
ordering work is split across tasks instead:

1. collapse the input to distinct ``(g, v, n)`` with a partially aggregated
   ``groupBy`` (ties and duplicate values shrink before any shuffle);
2. range-partition those rows on ``(g, v)``.  Range bounds come from a sample,
   so a hot group is cut into many partitions; the partition id is stored as
   a column and the result is checkpointed so the split is fixed;
3. per ``(g, partition)`` totals form a small table whose running sum gives
   each partition's offset inside its group;
4. a window over ``(g, partition)`` - bounded by one range partition -
   adds the offset of earlier values inside the partition.

The result is, for every distinct value, the number of rows of its group that
come strictly before it in the chosen order.  Ranks follow from that without
ever holding a whole group in one task; the exact median puts only the values
near the middle in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerscope.operators.joins import join_null_safe
from peerscope.operators.materialize import materialize
from peerscope.session import ensure_checkpoint_dir

_PID = "__pid"
_N = "__n"
_OFF = "__off"
_BEFORE = "__before"
_TOTAL = "__total"


def _order(c: str, descending: bool) -> Column:
    return F.col(c).desc() if descending else F.col(c).asc()


def prefix_counts(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    descending: bool = False,
    partitions: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Distinct ``(groups, value)`` with ``__n`` (rows with that value),
    ``__before`` (rows of the group strictly earlier in the order) and
    ``__total`` (non-null rows of the group).

    Null values are left out.  ``weight`` names a column holding how many
    rows each input row stands for (input already collapsed by value).
    """
    groups = list(groups)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    distinct = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*groups, value)
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).cast("long").alias(_N))
    )
    # without an explicit count AQE may merge adjacent (small) ranges; merged
    # partitions are still contiguous ranges, so partition order = value order
    order = [*[F.col(g) for g in groups], _order(value, descending)]
    ranged = (
        (distinct.repartitionByRange(partitions, *order) if partitions else distinct.repartitionByRange(*order))
        .withColumn(_PID, F.spark_partition_id())
        .checkpoint(eager=True)
    )
    # one row per (group, partition): small, at most partitions + groups rows
    totals = ranged.groupBy(*groups, _PID).agg(F.sum(_N).alias("__pn"))
    w_groups = Window.partitionBy(*groups).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumns(
        {
            _OFF: F.coalesce(F.sum("__pn").over(w_groups), F.lit(0)),
            _TOTAL: F.sum("__pn").over(Window.partitionBy(*groups)),
        }
    ).drop("__pn")
    w_part = (
        Window.partitionBy(*groups, _PID)
        .orderBy(_order(value, descending))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        join_null_safe(ranged, offsets, [*groups, _PID], "inner")
        .withColumn(_BEFORE, F.col(_OFF) + F.coalesce(F.sum(_N).over(w_part), F.lit(0)))
        .drop(_OFF, _PID)
    )


def rank_within(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    out: str = "rank",
    descending: bool = True,
    checkpoint_input: bool = True,
) -> DataFrame:
    """SQL ``RANK()`` of ``value`` inside each group (ties share the lowest
    rank, gaps follow).  Rows with a null value get a null rank.

    The input is read twice (value counts, then the join back); with
    ``checkpoint_input`` it is checkpointed, so the plan that produced it -
    typically a large aggregation - runs only once.
    """
    groups = list(groups)
    if checkpoint_input:
        df = materialize(df)
    ranks = prefix_counts(df, groups, value, descending).select(
        *groups, value, (F.col(_BEFORE) + 1).cast("int").alias(out)
    )
    return join_null_safe(df, ranks, [*groups, value], "left")


def rank_all(
    df: DataFrame, value: str, out: str = "rank", descending: bool = True, checkpoint_input: bool = True
) -> DataFrame:
    """Rank over the whole frame (no grouping) without a single-task window."""
    key = "__all"
    ranked = rank_within(df.withColumn(key, F.lit(0)), [key], value, out, descending, checkpoint_input)
    return ranked.drop(key)


#: Quantile brackets of the exact median; the rows of one or two of them are put in order.
BRACKETS = 64


def exact_median(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    out: str = "median",
    weight: str | None = None,
) -> DataFrame:
    """Exact median per group, nulls skipped: the middle value, or the mean of
    the two middle values for an even count.  Groups whose values are all
    null are absent from the result (join back with ``how='left'``).
    ``weight`` names a column holding how many rows each input row stands for;
    such an input is read more than once (write it first).

    No sort of all values: a quantile sketch (a mergeable aggregate) cuts each
    group's distinct values into ``BRACKETS`` brackets, counting rows by bracket
    tells which one or two hold the middle, and only the values of those are
    put in order (``prefix_counts``).  The sketch decides where the cuts are,
    not what the median is, so the result is exact whatever its error.
    """
    groups = list(groups)
    rows = df.filter(F.col(value).isNotNull()).withColumn(_N, F.col(weight).cast("long") if weight else F.lit(1).cast("long"))
    if weight:  # collapsed and written by the caller
        rows = rows.select(*groups, value, _N)
    else:
        rows = materialize(rows.groupBy(*groups, value).agg(F.sum(_N).alias(_N)))
    cuts = F.percentile_approx(value, [i / BRACKETS for i in range(1, BRACKETS)], F.lit(1000))
    bounds = rows.groupBy(*groups).agg(cuts.alias("__cuts"))
    bracket = F.size(F.filter("__cuts", lambda b: b <= F.col(value)))
    placed = join_null_safe(rows, bounds, groups, "inner").withColumn("__bracket", bracket).drop("__cuts")

    in_group = Window.partitionBy(*groups)  # at most BRACKETS rows
    counts = placed.groupBy(*groups, "__bracket").agg(F.sum(_N).alias("__in"))
    counts = counts.withColumns({
        "__low": F.coalesce(F.sum("__in").over(in_group.orderBy("__bracket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "__all": F.sum("__in").over(in_group),
    })
    first, second = F.floor((F.col("__all") + 1) / 2), F.floor(F.col("__all") / 2) + 1
    holds = lambda k: (F.col("__low") < k) & (k <= F.col("__low") + F.col("__in"))
    middle = counts.filter(holds(first) | holds(second)).drop("__in")

    # the facts of a bracket go along as parts of its key
    keys = [*groups, "__bracket", "__low", "__all"]
    inside = prefix_counts(join_null_safe(placed, middle, [*groups, "__bracket"], "inner"), keys, value, weight=_N)
    before = F.col("__low") + F.col(_BEFORE)
    hit = lambda k: (before < k) & (k <= before + F.col(_N))
    return inside.filter(hit(first) | hit(second)).groupBy(*groups).agg(((F.min(value) + F.max(value)) / 2).alias(out))
