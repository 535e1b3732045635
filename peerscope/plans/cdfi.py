"""Community development lender transactions by county, metro, tract and neighborhood."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.dims import Dimensions
from peerscope.functions.nulls import strict_sum
from peerscope.functions.text import null_if, pad_left, recode, split_into, two_digit_year
from peerscope.operators.geo import merge_entities, process_map, pull_peers
from peerscope.operators.joins import join_dim
from peerscope.operators.metrics import deflate, per_capita
from peerscope.operators.panel import complete_panel
from peerscope.plans.sba import HOME, MERGED_PAIR
from peerscope.sources.delimited import read_delimited

# fixed values: transaction purpose codes and their labels
PURPOSE_RECODE = {
    "BUSFIXED": "business",
    "BUSINESS": "business",
    "BUSWORKCAP": "business",
    "MICRO": "business",
    "CONSUMER": "consumer",
    "HOMEIMP": "consumer",
    "HOMEPURCH": "consumer",
    "RECOCOM": "commercial_re",
    "RERHCOM": "commercial_re",
    "RECOMULTI": "residential_re",
    "RECOSINGLE": "residential_re",
    "RERHMULTI": "residential_re",
    "RERHSINGLE": "residential_re",
    "OTHER": "other",
}

# fixed values: transaction file columns kept, in file order (types "nnnccccc")
TRANSACTION_TYPES = "nnnccccc"
TRANSACTION_COLUMNS = [
    "orgid",
    "transactionid",
    "originalamount",
    "projectfipscode_2000",
    "projectfipscode_2010",
    "investee",
    "dateclosed",
    "purpose",
]


# fixed values: institution file kept columns (org id, type, year, zip, then
# 28 origination counts and amounts), padded with skips to 203 columns
INSTITUTION_TYPES = "ncnn" + "_" * (21 + 5 + 19 + 11 + 18 + 21) + "n" * 28
INSTITUTION_WIDTH = 203


def read_institutions(spark: SparkSession, path: str) -> DataFrame:
    """Institution-level file: 32 of 203 columns parsed, the rest never converted."""
    return read_delimited(spark, path, INSTITUTION_TYPES.ljust(INSTITUTION_WIDTH, "_"))


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Transaction files (a folder read as one scan): 8 of 50 columns parsed."""
    return read_delimited(spark, path, TRANSACTION_TYPES)


def clean_transactions(raw: DataFrame, dims: Dimensions, min_year: int = 2000, pivot: int = 84) -> DataFrame:
    """Dates split into parts, two-digit years expanded, tract codes padded,
    county from the 2010 tract else the 2000 tract, purposes labelled, and
    only counties of peer metros kept."""
    day, month, yy = split_into("dateclosed", "-", 3)
    df = raw.withColumns({"day": day.try_cast("int"), "month": month, "year": two_digit_year(yy.try_cast("int"), pivot)})
    df = df.filter(F.col("year") >= min_year)
    t00 = pad_left(null_if("projectfipscode_2000", "NONE"), 11)
    t10 = pad_left(null_if("projectfipscode_2010", "NONE"), 11)
    county = F.substring(F.coalesce(t10, t00), 1, 5)
    df = df.withColumns({"FIPS": county, "tract_10": t10, "tract_00": t00, "purpose": recode("purpose", PURPOSE_RECODE)})
    return pull_peers(df, dims, geog="MSA", entity="FIPS")


def county_panel(tx: DataFrame, dims: Dimensions, base_year: int = 2018, members=MERGED_PAIR) -> DataFrame:
    panel = pull_peers(tx, dims, "FIPS").groupBy("FIPS", "year").agg(strict_sum("originalamount", 4).alias("cdfi"))
    panel = complete_panel(panel, "FIPS", "year", {"cdfi": 0.0})
    panel = merge_entities(panel, "FIPS", members, ["cdfi"], ["year"])
    panel = deflate(panel, ["cdfi"], dims.cpi, base_year)
    return per_capita(panel, ["cdfi"], dims.pop_for("FIPS"), "FIPS")


def msa_panel(tx: DataFrame, dims: Dimensions, base_year: int = 2018) -> DataFrame:
    df = join_dim(tx.select("FIPS", "year", "originalamount"), dims.msa_counties.select("FIPS", "MSA"), "FIPS", how="left")
    panel = df.groupBy("MSA", "year").agg(strict_sum("originalamount", 4).alias("cdfi"))
    panel = complete_panel(panel, "MSA", "year", {"cdfi": 0.0})
    panel = deflate(panel, ["cdfi"], dims.cpi, base_year)
    return per_capita(panel, ["cdfi"], dims.pop_for("MSA"), "MSA")


def map_layers(
    tx: DataFrame, dims: Dimensions, home: str = HOME, min_year: int = 2014, base_year: int = 2018
) -> dict[str, DataFrame]:
    """Home-county tracts and the neighborhood layers (sums, per resident).

    Sums are taken before deflating; the factor depends on the year only,
    so the result equals deflating each tract first.
    """
    df = tx.filter((F.col("year") >= min_year) & F.col("tract_10").startswith(home))
    tracts = df.groupBy(F.col("tract_10").alias("tract"), "year").agg(strict_sum("originalamount", 4).alias("cdfi"))
    layers = process_map(tracts, dims.crosswalk, ["cdfi"], "cdfi", method="sum", pop_adjust=True, exact_scale=4)
    return {k: deflate(v, ["cdfi", "cdfi_pp"], dims.cpi, base_year) for k, v in layers.items()}
