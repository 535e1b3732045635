"""Bank small-business loans from fixed-width disclosure files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.dims import Dimensions
from peerscope.functions.columns import col_range, cols_containing, map_columns
from peerscope.functions.nulls import strict_sum
from peerscope.functions.text import remove_first
from peerscope.operators.geo import process_map, pull_peers, relabel_entity, roll_up
from peerscope.operators.grains import grain_of, sum_by_grain
from peerscope.operators.joins import join_dim
from peerscope.operators.materialize import materialize
from peerscope.operators.metrics import deflate, per_capita
from peerscope.plans.sba import HOME, MERGED_PAIR
from peerscope.sources.fixed_width import Layout, parse_layouts, read_fixed_width
from peerscope.sources.files import list_entries

# fixed values: record layouts, (name, first byte, last byte, type), 1-based inclusive
OLD_LAYOUT = Layout.of(
    [
        ("table", 1, 5, "c"),
        ("year", 6, 9, "n"),
        ("FIPS", 12, 16, "c"),
        ("MSA", 17, 20, "c"),
        ("tract", 21, 27, "c"),
        ("income_group", 30, 32, "c"),
        ("geog_level", 33, 35, "n"),
        ("num_under_100k", 36, 41, "n"),
        ("amount_under_100k", 42, 49, "n"),
        ("num_100k_250k", 50, 55, "n"),
        ("amount_100k_250k", 56, 63, "n"),
        ("num_250k_1m", 64, 69, "n"),
        ("amount_250k_1m", 70, 77, "n"),
        ("num_business_1m", 78, 83, "n"),
        ("amount_business_1m", 84, 91, "n"),
    ]
)
NEW_LAYOUT = Layout.of(
    [
        ("table", 1, 5, "c"),
        ("year", 6, 9, "n"),
        ("FIPS", 12, 16, "c"),
        ("MSA", 17, 21, "c"),
        ("tract", 22, 28, "c"),
        ("income_group", 31, 33, "c"),
        ("geog_level", 34, 36, "n"),
        ("num_under_100k", 37, 46, "n"),
        ("amount_under_100k", 47, 56, "n"),
        ("num_100k_250k", 57, 66, "n"),
        ("amount_100k_250k", 67, 76, "n"),
        ("num_250k_1m", 77, 86, "n"),
        ("amount_250k_1m", 87, 96, "n"),
        ("num_business_1m", 97, 106, "n"),
        ("amount_business_1m", 107, 116, "n"),
    ]
)
N_OLD_FILES = 4


def read_by_file_order(spark: SparkSession, path: str, n_old: int = N_OLD_FILES) -> DataFrame:
    """The first ``n_old`` files (name order) use the old layout, the rest the new."""
    files = list_entries(spark, path)
    old, new = files[:n_old], files[n_old:]
    frames = [read_fixed_width(spark, p, lay) for p, lay in ((old, OLD_LAYOUT), (new, NEW_LAYOUT)) if p]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_by_selector(spark: SparkSession, paths: str | Sequence[str], choose: Column) -> DataFrame:
    """One scan over files of both layouts; ``choose`` gives "old"/"new" per line."""
    return parse_layouts(spark.read.text(paths), {"old": OLD_LAYOUT, "new": NEW_LAYOUT}, choose)


def normalize(cra: DataFrame, table: str = "A1-1") -> DataFrame:
    """Keep one table, counts then amounts, amounts in dollars, all-loan total."""
    df = cra.filter(F.col("table") == table)
    df = df.select("FIPS", "tract", "year", "income_group", "geog_level", *cols_containing(df, "num"), *cols_containing(df, "amount"))
    df = map_columns(df, cols_containing(df, "amount"), lambda c: c * 1000)
    return df.withColumn(
        "all_sb_loans", F.col("amount_under_100k") + F.col("amount_100k_250k") + F.col("amount_250k_1m")
    ).withColumn("year", F.col("year").cast("int"))


def _measures(df: DataFrame) -> list[str]:
    return col_range(df, "num_under_100k", "all_sb_loans")


def _money(df: DataFrame) -> list[str]:
    return col_range(df, "amount_under_100k", "all_sb_loans")


def county_panel(cra: DataFrame, dims: Dimensions, base_year: int = 2018, members=MERGED_PAIR) -> DataFrame:
    df = pull_peers(cra.filter(F.col("geog_level") == 200), dims, "FIPS")
    measures, money = _measures(df), _money(df)
    df = relabel_entity(df, "FIPS", members)
    panel = df.groupBy("FIPS", "year").agg(*[strict_sum(m, 4).alias(m) for m in measures])
    panel = deflate(panel, money, dims.cpi, base_year)
    return per_capita(panel, measures, dims.pop_for("FIPS"), "FIPS")


def msa_panel(cra: DataFrame, dims: Dimensions, base_year: int = 2018) -> DataFrame:
    df = pull_peers(cra.filter(F.col("geog_level") == 200), dims, "MSA", entity="FIPS")
    measures, money = _measures(df), _money(df)
    df = df.drop("MSA") if "MSA" in df.columns else df
    panel = roll_up(df, dims.msa_counties, "FIPS", "MSA", measures, ["year"], exact_scale=4)
    panel = deflate(panel, money, dims.cpi, base_year)
    return per_capita(panel, measures, dims.pop_for("MSA"), "MSA")


def map_layers(
    cra: DataFrame, dims: Dimensions, home: str = HOME, min_year: int = 2012, base_year: int = 2018
) -> dict[str, DataFrame]:
    """Home-county tract rows to tracts and neighborhoods (population-weighted means)."""
    df = cra.filter(F.col("geog_level").isNull() & (F.col("FIPS") == home))
    df = df.withColumn("tract", F.concat(F.lit(home), remove_first("tract", ".", literal=True)))
    df = df.drop("FIPS", "income_group", "geog_level").filter(F.col("year") >= min_year)
    cols = col_range(df, "amount_business_1m", "all_sb_loans")
    tracts = df.groupBy("tract", "year").agg(*[strict_sum(c, 4).alias(c) for c in cols])
    layers = process_map(tracts, dims.crosswalk, cols, "cra", method="mean", pop_adjust=True, exact_scale=4)
    money = cols + [f"{c}_pp" for c in cols]
    return {k: deflate(v, money, dims.cpi, base_year) for k, v in layers.items()}


def results(
    cra: DataFrame, dims: Dimensions, home: str = HOME, min_year: int = 2012, base_year: int = 2018, members=MERGED_PAIR
) -> dict[str, DataFrame]:
    """The five published results (county, metro, tract, two neighborhood layers) from one pass over the records.

    Every row is expanded to the county, metros and tract that it counts for
    and summed once (``sum_by_grain``); the sums, a row per place and year, are
    written once and all results are made from them.
    """
    peers = dims.peers_for("FIPS").select("FIPS").distinct().withColumn("__peer", F.lit(True))
    metro = pull_peers(dims.msa_counties.select("FIPS", "MSA"), dims, "MSA", entity="FIPS").groupBy("FIPS").agg(F.collect_set("MSA").alias("__metros"))
    df = cra.drop("MSA") if "MSA" in cra.columns else cra
    df = df.filter((F.col("geog_level") == 200) | (F.col("geog_level").isNull() & (F.col("FIPS") == home) & (F.col("year") >= min_year)))
    df = join_dim(join_dim(df, peers, "FIPS"), metro, "FIPS")
    level = F.col("geog_level") == 200
    measures, money, cols = _measures(df), _money(df), col_range(df, "amount_business_1m", "all_sb_loans")
    df = relabel_entity(df.withColumn("__county", F.col("FIPS")), "__county", members)
    tract = F.concat(F.lit(home), remove_first("tract", ".", literal=True))
    sums = sum_by_grain(
        df,
        {"county": F.when(level & F.col("__peer"), F.array("__county")), "metro": F.when(level, F.col("__metros")), "tract": F.when(~F.coalesce(level, F.lit(False)), F.array(tract))},
        measures,
        exact_scale=4,
    )
    sums = materialize(sums)
    panel = lambda grain, entity: per_capita(deflate(grain_of(sums, grain, entity), money, dims.cpi, base_year), measures, dims.pop_for(entity), entity)
    layers = process_map(grain_of(sums, "tract", "tract").select("tract", "year", *cols), dims.crosswalk, cols, "cra", method="mean", pop_adjust=True, exact_scale=4)
    layered = {k: deflate(v, cols + [f"{c}_pp" for c in cols], dims.cpi, base_year) for k, v in layers.items()}
    return {"cra_county": panel("county", "FIPS"), "cra_msa": panel("metro", "MSA"), **layered}
