"""Charitable giving by county, year and income bracket; ranks and gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.dims import Dimensions
from peerscope.functions.format import dollar_text, label, percent_text
from peerscope.functions.nulls import if_else, ratio, strict_sum
from peerscope.functions.text import recode_by_position
from peerscope.operators.geo import pull_peers, relabel_entity
from peerscope.operators.metrics import peer_gap
from peerscope.operators.panel import group_total, home_vs_peers, rank_long
from peerscope.plans.sba import HOME, MERGED_PAIR
from peerscope.sources.files import read_yearly

# fixed values: source columns kept when present, and the renamed variant
GIVING_COLUMNS = [
    "STATEFIPS", "COUNTYFIPS", "agi_stub", "N1", "A19700", "N19700", "A00100", "N04470",
    "N02650", "A02650", "mars1", "MARS2", "MARS4", "NUMDEP", "MARS1",
]
GIVING_RENAMES = {"mars1": "MARS1"}
GIVING_TYPES = {
    "agi_stub": "int", "N1": "double", "A19700": "double", "N19700": "double", "A00100": "double",
    "N04470": "double", "N02650": "double", "A02650": "double", "MARS1": "double", "MARS2": "double",
    "MARS4": "double", "NUMDEP": "double",
}

# fixed values: bracket labels, in bracket order
BRACKETS = [
    "Under $1",
    "$1 to $25,000",
    "$25,000 to $49,999",
    "$50,000 to $74,999",
    "$75,000 to $99,999",
    "$100,000 to $199,999",
    "$200,000 or more",
]

# fixed values: rank-chart labels, the highlighted home city and colours
METRIC_LABELS = {"donating_pct": "Percent of Residents Donating", "giving_pct_income": "Percent of Income Donated"}
HOME_CITY = "Louisville"
HOME_COLOR, OTHER_COLOR = "#00a9b7", "black"

MEASURES = ["total_returns", "dollars_donated", "num_giving", "agi_amt", "number_itemized", "income_num", "income_amt"]


def read_giving(spark: SparkSession, path: str, start_year: int = 2010, glob: str = "*.csv") -> DataFrame:
    """One file per year from ``start_year`` in name order; schema drift fixed."""
    return read_yearly(spark, path, GIVING_COLUMNS, start_year=start_year, renames=GIVING_RENAMES, types=GIVING_TYPES, glob=glob)


def giving_panel(
    giving: DataFrame,
    dims: Dimensions,
    members: Sequence[str] = MERGED_PAIR,
    merge_from: int = 2012,
    current_only: bool = True,
) -> DataFrame:
    """Ratios per (FIPS, year, bracket) for the current peers.

    From ``merge_from`` on the source has one more bracket; brackets 3 and up
    shift down so brackets 2 and 3 sum together.
    """
    df = giving.select(
        F.concat("STATEFIPS", "COUNTYFIPS").alias("FIPS"),
        "year",
        if_else((F.col("year") >= merge_from) & (F.col("agi_stub") >= 3), F.col("agi_stub") - 1, F.col("agi_stub")).alias("agi"),
        F.col("N1").alias("total_returns"),
        (F.col("A19700") * 1000).alias("dollars_donated"),
        F.col("N19700").alias("num_giving"),
        (F.col("A00100") * 1000).alias("agi_amt"),
        F.col("N04470").alias("number_itemized"),
        F.col("N02650").alias("income_num"),
        (F.col("A02650") * 1000).alias("income_amt"),
    )
    df = relabel_entity(df, "FIPS", members)
    df = pull_peers(df, dims, "FIPS", add_info=True)
    if current_only:
        df = df.filter(F.col("current") == 1)
    panel = df.groupBy("FIPS", "year", "agi").agg(*[strict_sum(m, 4).alias(m) for m in MEASURES])
    # a place-year holds one row per bracket: a bounded window, one pass
    panel = group_total(panel, ["FIPS", "year"], "total_returns", "total_returns_city", exact_scale=4, bounded_groups=True)
    filer = ratio("dollars_donated", "total_returns")
    avg_agi = ratio("agi_amt", "total_returns")
    avg_income = ratio("income_amt", "income_num")
    return panel.select(
        "FIPS",
        "year",
        "agi",
        (ratio("num_giving", "total_returns") * 100).alias("donating_pct"),
        filer.alias("avg_giving_per_filer"),
        ratio("dollars_donated", "num_giving").alias("avg_giving_per_donor"),
        avg_agi.alias("avg_agi"),
        avg_income.alias("avg_income"),
        (ratio("number_itemized", "total_returns") * 100).alias("pct_itemized"),
        (F.try_divide(filer, avg_agi) * 100).alias("giving_pct_agi"),
        (F.try_divide(filer, avg_income) * 100).alias("giving_pct_income"),
        "total_returns",
        ratio("total_returns", "total_returns_city").alias("agi_pct"),
    )


def ranks_long(
    panel: DataFrame, dims: Dimensions, agi: int = 7, home_city: str = HOME_CITY, label_parts: Sequence[str] = ("city", "rank")
) -> DataFrame:
    """Ranks on participation and on share of income given, one row per
    (city, year, metric), with the home city highlighted.  The label joins
    ``label_parts`` (the other chart puts the rank first)."""
    metrics = list(METRIC_LABELS)
    long = rank_long(panel.filter(F.col("agi") == agi), ["year"], metrics, ["FIPS", "year"])
    long = pull_peers(long, dims, "FIPS", add_info=True).select("city", "year", "variable", "rank")
    is_home = F.col("city") == home_city
    variable = F.coalesce(*[F.when(F.col("variable") == k, F.lit(v)) for k, v in METRIC_LABELS.items()])
    return long.select(
        "city",
        "year",
        variable.alias("variable"),
        "rank",
        if_else(is_home, HOME_COLOR, OTHER_COLOR).alias("color"),
        if_else(is_home, 1.0, 0.8).alias("alpha"),
        label(*label_parts).alias("label"),
    )


def itemizing_table(panel: DataFrame, year: int = 2017, home: str = HOME) -> DataFrame:
    """Share of returns itemized by bracket: home vs mean of peers, as text too."""
    t = home_vs_peers(panel.filter(F.col("year") == year), ["agi"], "FIPS", home, "pct_itemized", "home_pct", "peer_pct")
    return t.select(
        "agi",
        recode_by_position("agi", BRACKETS).alias("bracket"),
        "home_pct",
        "peer_pct",
        percent_text("home_pct").alias("home_text"),
        percent_text("peer_pct").alias("peer_text"),
    )


def giving_gap(panel: DataFrame, year: int = 2017, agi: int = 7, home: str = HOME) -> DataFrame:
    """How far home trails the peer mean in share of income given, and in dollars."""
    df = panel.filter((F.col("agi") == agi) & (F.col("year") == year))
    g = peer_gap(df, "FIPS", home, "giving_pct_income", "avg_income", "total_returns")
    return g.select(
        "percent_gap",
        "dollar_gap",
        percent_text("percent_gap").alias("percent_gap_text"),
        dollar_text("dollar_gap").alias("dollar_gap_text"),
    )
