"""Report tables: real-dollar series and binned map layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.functions.format import bin_values
from peerscope.operators.joins import join_dim, join_null_safe
from peerscope.operators.metrics import price_factors

# fixed values: map class edges for per-resident dollars
MAP_BINS = [0, 50, 100, 250, 500, 1000, 3500]


def real_series(series: DataFrame, cpi: DataFrame, base_year: int = 2018, value: str = "amount", time: str = "year") -> DataFrame:
    """A yearly dollar series in ``base_year`` dollars: value * cpi[base] / cpi[year]."""
    joined = join_dim(series, price_factors(cpi, base_year, time), time, how="left")
    return joined.withColumn(f"real_{value}", F.col(value) * F.col("__factor")).drop("__factor")


def map_layers(
    layers: Mapping[str, DataFrame],
    areas: Mapping[str, DataFrame],
    metric: str,
    year: int,
    edges: Sequence[float] = MAP_BINS,
) -> DataFrame:
    """Every area of every layer with its metric for ``year`` and its class.

    ``areas[layer]`` lists all areas (id column ``area``); areas without data
    keep a null value and class.
    """
    frames = []
    for layer, df in layers.items():
        vals = df.filter(F.col("year") == year).select("area", metric)
        out = join_null_safe(areas[layer].select("area"), vals, ["area"], how="left")
        frames.append(out.withColumn("layer", F.lit(layer)).withColumn("bin", bin_values(F.col(metric), edges)))
    res = frames[0]
    for f in frames[1:]:
        res = res.unionByName(f)
    return res
