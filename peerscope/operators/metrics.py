"""Domain metrics: inflation, per-capita, scaling, gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.functions.nulls import ratio
from peerscope.operators.joins import join_dim
from peerscope.operators.panel import cond_mean


def price_factors(cpi: DataFrame, base_year: int, time: str = "year") -> DataFrame:
    """``(year, factor)`` with factor = cpi[base_year] / cpi[year]."""
    base = cpi.filter(F.col(time) == base_year).select(F.max("cpi")).scalar()
    return cpi.select(time, F.try_divide(base, F.col("cpi")).alias("__factor"))


def deflate(df: DataFrame, cols: Sequence[str], cpi: DataFrame, base_year: int = 2018, time: str = "year") -> DataFrame:
    """Express money columns in ``base_year`` dollars (factor depends on year only)."""
    cols = list(cols)
    joined = join_dim(df, price_factors(cpi, base_year, time), time, how="left")
    return joined.withColumns({c: F.col(c) * F.col("__factor") for c in cols}).drop("__factor")


def per_capita(
    df: DataFrame,
    cols: Sequence[str],
    pop: DataFrame,
    entity: str,
    time: str | None = "year",
    suffix: str = "_pp",
    keep_pop: bool = False,
) -> DataFrame:
    """Add ``<col>_pp`` = value / population (null for a zero or missing population).

    ``pop`` has ``entity``, ``population`` and, unless ``time`` is None, ``time``.
    """
    keys = [entity] if time is None else [entity, time]
    joined = join_dim(df, pop.select(*keys, "population"), keys, how="left")
    out = joined.withColumns({f"{c}{suffix}": ratio(c, "population") for c in cols})
    return out if keep_pop else out.drop("population")


def per_n(col: str, pop: str, n: float = 100000.0):
    return ratio(col, pop) * n


def scale_to_home(
    df: DataFrame, col: str, entity: str, home: str, out: str, population: DataFrame, pop: str = "population"
) -> DataFrame:
    """``col * population of the home entity``, a scalar looked up in the ``population`` dimension."""
    home_pop = population.filter(F.col(entity) == home).select(F.max(pop)).scalar()
    return df.withColumn(out, F.col(col) * home_pop)


def peer_gap(
    df: DataFrame,
    entity: str,
    home: str,
    metric: str,
    income: str,
    count: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Gap between the peer mean and home on a percent metric, in points and money.

    ``percent_gap = mean(metric of peers) - metric(home)`` and
    ``dollar_gap = percent_gap / 100 * income(home) * count(home)``.
    """
    is_home = F.col(entity) == home
    g = df.groupBy(*by).agg(
        cond_mean(~is_home, F.col(metric)).alias("__peer"),
        F.max(F.when(is_home, F.col(metric))).alias("__home"),
        F.max(F.when(is_home, F.col(income))).alias("__income"),
        F.max(F.when(is_home, F.col(count))).alias("__count"),
    )
    gap = F.col("__peer") - F.col("__home")
    return g.select(
        *by,
        gap.alias("percent_gap"),
        (gap / 100 * F.col("__income") * F.col("__count")).alias("dollar_gap"),
    )
