"""Company headquarters and venture deals by metro area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.dims import Dimensions
from peerscope.functions.nulls import exact, ratio
from peerscope.operators.materialize import materialize
from peerscope.session import ensure_checkpoint_dir
from peerscope.sources.delimited import read_delimited
from peerscope.operators.geo import pull_peers
from peerscope.operators.joins import join_dim
from peerscope.operators.metrics import deflate, per_capita, per_n, scale_to_home
from peerscope.operators.order_stats import exact_median

# fixed value: the home metro area
HOME_MSA = "31140"


# fixed values: deal export column types (name, ids, post code, deal date, size, ...)
DEAL_TYPES = "ccccDdcc"


# fixed value: title lines above the header of an export
EXPORT_SKIP = 7


def read_export(spark: SparkSession, path: str, col_types: str = DEAL_TYPES, skip: int = EXPORT_SKIP, date_format: str | None = None) -> DataFrame:
    """A data-provider export with ``skip`` title lines above the header; every data line is a row."""
    return read_delimited(spark, path, col_types, skip=skip, date_format=date_format)


def headquarters_by_msa(companies: DataFrame, dims: Dimensions, home: str = HOME_MSA) -> DataFrame:
    """Company count per peer metro, per resident and scaled to the home population."""
    df = companies.select(
        F.col("Company Name").alias("name"), F.col("HQ Location").alias("location"), F.col("HQ Post Code").alias("zip")
    )
    df = join_dim(df, dims.msa_zips.select("zip", "MSA"), "zip", how="left")
    counts = df.groupBy("MSA").agg(F.count(F.lit(1)).alias("fortune_1000"))
    counts = per_capita(counts, ["fortune_1000"], dims.pop_latest("MSA"), "MSA", time=None, keep_pop=True)
    counts = pull_peers(counts, dims, "MSA")
    return scale_to_home(counts, "fortune_1000_pp", "MSA", home, "fortune_1000_per_lou", dims.pop_latest("MSA"))


def deals_by_msa(deals: DataFrame, dims: Dimensions, base_year: int = 2018, exact_scale: int = 4) -> DataFrame:
    """Deal count, dollars, average and exact median deal per metro-year.

    ``Deal Size`` is in millions and may be missing: counts include every
    deal, money statistics skip missing sizes (0 dollars when all are missing).
    Sizes become dollars before they are rounded to ``exact_scale`` decimals.
    """
    ensure_checkpoint_dir(deals.sparkSession)
    df = deals.select(
        F.col("Company Name").alias("name"),
        F.col("Company Post Code").alias("zip"),
        F.substring(F.col("Deal Date").cast("string"), 1, 4).try_cast("int").alias("year"),
        F.col("Deal Size").cast("double").alias("amount"),
    )
    df = join_dim(df, dims.msa_zips.select("zip", "MSA"), "zip", how="left").filter(F.col("MSA").isNotNull())
    # one pass over the deals: rows collapsed to (metro, year, size, n), written
    # once; counts, sums and the exact median all read that table
    sizes = df.groupBy("MSA", "year", "amount").agg(F.count(F.lit(1)).alias("n"))
    sizes = materialize(sizes)
    dollars = exact(F.col("amount") * 1000000, exact_scale)
    stats = sizes.groupBy("MSA", "year").agg(
        F.sum("n").alias("deals"),
        F.sum(F.when(F.col("amount").isNotNull(), F.col("n"))).alias("deals_amount"),
        F.coalesce(F.sum(dollars * F.col("n").cast("decimal(10,0)")).cast("double"), F.lit(0.0)).alias("total_dollars"),
    )
    stats = stats.withColumn("deals_amount", F.coalesce("deals_amount", F.lit(0)))
    stats = stats.withColumn("avg_deal", ratio("total_dollars", "deals_amount"))
    medians = exact_median(sizes, ["MSA", "year"], "amount", "median_deal", weight="n")
    stats = stats.join(medians, ["MSA", "year"], "left")
    stats = stats.withColumn("median_deal", F.col("median_deal") * 1000000)
    stats = deflate(stats, ["total_dollars", "avg_deal", "median_deal"], dims.cpi, base_year)
    stats = join_dim(stats, dims.pop_latest("MSA"), "MSA", how="left")
    return stats.select(
        "MSA",
        "year",
        F.lit("total").alias("sex"),
        F.lit("total").alias("race"),
        "deals",
        per_n("deals", "population", 100000).alias("deals_per_100000"),
        "total_dollars",
        ratio("total_dollars", "population").alias("total_dollars_pc"),
        "avg_deal",
        "median_deal",
    )


