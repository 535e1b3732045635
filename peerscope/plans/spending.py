"""Local government spending per resident: read and rank."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from peerscope.operators.panel import rank_table
from peerscope.sources.delimited import read_delimited

# fixed values: kept columns of the spending table (label, FIPS, spend, tax, net)
SPENDING_TYPES = "_cn__"
SPENDING_NAMES = ["FIPS", "local_spend"]


def read_spending(spark: SparkSession, path: str) -> DataFrame:
    """FIPS stays text exactly as written; the amount is parsed leniently."""
    return read_delimited(spark, path, SPENDING_TYPES, names=SPENDING_NAMES, header=True)


def spending_rank(spending: DataFrame) -> DataFrame:
    """Rank on spending per resident, highest first (1 = most)."""
    return rank_table(spending, "FIPS", "local_spend")
