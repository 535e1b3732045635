"""Panel operators: completion, group shares, rolling means, trends, ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerscope.functions.nulls import exact, ratio, strict_sum
from peerscope.operators.joins import join_null_safe
from peerscope.operators.order_stats import prefix_counts, rank_all
from peerscope.operators.materialize import materialize


def complete_panel(
    df: DataFrame,
    entity: str,
    time: str = "year",
    fill: Mapping[str, object] | None = None,
    checkpoint: bool = True,
) -> DataFrame:
    """One row for every (entity, time) seen anywhere in ``df``.

    A null time is a time (and a null entity an entity), so no row is lost.
    The set of times is one small array computed as a scalar subquery; each
    entity is expanded over it (no join of two large tables).  ``fill``
    replaces missing and null measure values.  The panel is read three times
    (entities, times, values), so it is checkpointed first: the plan that
    built it runs once.
    """
    if checkpoint:
        df = materialize(df)
    times = df.select(F.collect_set(F.struct(F.col(time).alias("t")))).scalar()  # a struct is kept when its field is null
    grid = df.select(entity).distinct().select(entity, F.explode(times).alias("__t")).select(entity, F.col("__t.t").alias(time))
    out = join_null_safe(grid, df, [entity, time], how="left")
    if fill:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})
    return out


def group_total(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    out: str,
    exact_scale: int | None = None,
    bounded_groups: bool = False,
) -> DataFrame:
    """Attach the (strict) group sum of ``measure`` to every row.

    By default the sums are aggregated first (map-side combine) and joined
    back, so a large group never sits in one window partition.  When every
    group is small by construction (``bounded_groups``, e.g. the brackets of
    one place-year) a window does it in one pass over ``df``.
    """
    keys = list(keys)
    if bounded_groups:
        w = Window.partitionBy(*keys)
        x = F.col(measure)
        total = F.sum(exact(x, exact_scale)).over(w)
        total = total.cast("double") if exact_scale is not None else total
        return df.withColumn(out, F.when(F.count(x).over(w) == F.count(F.lit(1)).over(w), total))
    totals = df.groupBy(*keys).agg(strict_sum(measure, exact_scale).alias(out))
    return join_null_safe(df, totals, keys, how="left")


def share_of_group(df: DataFrame, keys: Sequence[str], measure: str, out: str, exact_scale: int | None = None) -> DataFrame:
    tmp = f"__{out}_total"
    return group_total(df, keys, measure, tmp, exact_scale).withColumn(out, ratio(measure, tmp)).drop(tmp)


def rolling_mean(
    df: DataFrame, entity: str, measure: str, n: int = 3, time: str = "year", align: str = "right", out: str | None = None
) -> DataFrame:
    """Mean over ``n`` consecutive years per entity; null unless all ``n`` have a value.

    ``align`` is "right" (trailing, default), "center" or "left".  The window
    holds one entity's years, so its size is bounded by the calendar.
    """
    lo, hi = {"right": (-(n - 1), 0), "center": (-(n // 2), n - 1 - n // 2), "left": (0, n - 1)}[align]
    w = Window.partitionBy(entity).orderBy(F.col(time).cast("long")).rangeBetween(lo, hi)
    value = F.when(F.count(measure).over(w) == n, F.avg(measure).over(w))
    return df.withColumn(out or measure, value)


def cond_mean(cond: Column, x: Column, strict: bool = True, exact_scale: int | None = None) -> Column:
    """Mean of ``x`` over rows where ``cond`` holds; strict: null if any is null."""
    picked = F.when(cond, x)
    if exact_scale is None:
        mean = F.avg(picked)
    else:
        mean = F.try_divide(F.sum(exact(picked, exact_scale)).cast("double"), F.count(picked).cast("double"))
    if not strict:
        return mean
    return F.when(F.count(F.when(cond, F.lit(1))) == F.count(picked), mean)


def home_vs_peers(
    df: DataFrame,
    by: Sequence[str],
    entity: str,
    home: str,
    measure: str,
    home_out: str = "home",
    peers_out: str = "peers",
    exact_scale: int | None = None,
) -> DataFrame:
    """Per ``by`` group: the home entity's value and the mean of the others."""
    is_home = F.col(entity) == home
    return df.groupBy(*by).agg(
        F.max(F.when(is_home, F.col(measure))).alias(home_out),
        cond_mean(~is_home, F.col(measure), exact_scale=exact_scale).alias(peers_out),
    )


def trend(
    df: DataFrame,
    entity: str,
    measure: str,
    home: str,
    time: str = "year",
    rollmean: int | None = None,
    align: str = "right",
    exact_scale: int | None = None,
) -> DataFrame:
    """Home series and peer-average series over time (optionally smoothed)."""
    if rollmean:
        df = rolling_mean(df, entity, measure, rollmean, time, align)
    return home_vs_peers(df, [time], entity, home, measure, exact_scale=exact_scale)


def rank_table(
    df: DataFrame,
    entity: str,
    metric: str,
    time: str = "year",
    year: int | None = None,
    years: Sequence[int] | None = None,
    out: str = "rank",
    descending: bool = True,
) -> DataFrame:
    """Rank entities on a metric (1 = highest).

    * no ``time`` column: rank all rows;
    * ``years``: rank the strict mean over those years;
    * otherwise: rank one year, ``year`` or the latest present.
    """
    if time not in df.columns:
        return rank_all(df, metric, out, descending)
    if years is not None:
        from peerscope.functions.nulls import strict_mean

        avg = df.filter(F.col(time).isin(list(years))).groupBy(entity).agg(strict_mean(metric).alias(metric))
        return rank_all(avg, metric, out, descending)
    if year is not None:
        return rank_all(df.filter(F.col(time) == year), metric, out, descending)
    df = materialize(df)  # read for its latest year and for its rows: evaluated once
    latest = df.select(F.max(time)).scalar()
    return rank_all(df.filter(F.col(time) == latest), metric, out, descending, checkpoint_input=False)


def _metric_ranks(df: DataFrame, groups: Sequence[str], metrics: Sequence[str], descending: bool) -> tuple[DataFrame, DataFrame]:
    """``df`` written once, and (groups, __metric, __value, __rank): all metrics ranked by one range sort and one checkpoint."""
    df = materialize(df)
    kinds = {df.schema[m].dataType.simpleString() for m in metrics}
    value = lambda m: F.col(m) if len(kinds) == 1 else F.col(m).cast("double")
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("__metric"), value(m).alias("__value")) for m in metrics])).alias("__m")
    long = df.select(*groups, each).select(*groups, "__m.__metric", "__m.__value")
    counts = prefix_counts(long, [*groups, "__metric"], "__value", descending)
    return df, counts.select(*groups, "__metric", "__value", (F.col("__before") + 1).cast("int").alias("__rank"))


def rank_long(df: DataFrame, groups: Sequence[str], metrics: Sequence[str], ids: Sequence[str], variable: str = "variable", rank: str = "rank", descending: bool = True) -> DataFrame:
    """(ids, variable, rank): one row per row and metric, ranked within the groups; one join brings all ranks back."""
    df, ranks = _metric_ranks(df, groups, metrics, descending)
    kind = ranks.schema["__value"].dataType
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("__metric"), F.col(m).cast(kind).alias("__value")) for m in metrics])).alias("__m")
    cols = list(dict.fromkeys([*groups, *ids]))
    long = df.select(*cols, each).select(*cols, "__m.__metric", "__m.__value")
    out = join_null_safe(long, ranks, [*groups, "__metric", "__value"], "left")
    return out.select(*ids, F.col("__metric").alias(variable), F.col("__rank").alias(rank))


def rank_by(
    df: DataFrame, groups: Sequence[str], metrics: Sequence[str], suffix: str = "", descending: bool = True
) -> DataFrame:
    """Rank several metrics within each group; ``<metric><suffix>`` columns."""
    out, ranks = _metric_ranks(df, groups, metrics, descending)
    kind = ranks.schema["__value"].dataType
    for m in metrics:
        own = ranks.filter(F.col("__metric") == m).select(*groups, "__value", F.col("__rank").alias(f"{m}{suffix or '__rank'}"))
        out = join_null_safe(out.withColumn("__value", F.col(m).cast(kind)), own, [*groups, "__value"], "left").drop("__value")
    if not suffix:
        out = out.drop(*metrics).withColumnsRenamed({f"{m}__rank": m for m in metrics})
    return out
