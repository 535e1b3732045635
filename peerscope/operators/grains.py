"""One pass over rows that count for several kinds of place at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.functions.nulls import strict_sum


def sum_by_grain(
    rows: DataFrame, places: Mapping[str, Column], measures: Sequence[str], keys: Sequence[str] = ("year",), exact_scale: int | None = None
) -> DataFrame:
    """Strict sums of ``measures`` per (grain, place, keys).

    ``places`` gives, for each grain, the array of the places that a row counts
    for (null or empty: none; a null place is a place).  Every row is expanded
    to its (grain, place) pairs before the one aggregation, whose partial sums
    are made before its one shuffle: the rows are read and parsed once, however
    many grains are asked for, and a hot place is combined map-side.
    """
    pair = lambda grain: lambda p: F.struct(F.lit(grain).alias("grain"), p.cast("string").alias("place"))
    pairs = [F.transform(of, pair(grain)) for grain, of in places.items()]
    none = F.array().cast("array<struct<grain:string,place:string>>")
    to = F.explode(F.concat(*[F.coalesce(p, none) for p in pairs])).alias("to")
    expanded = rows.select(*keys, *measures, to)
    return expanded.groupBy(F.col("to.grain").alias("grain"), F.col("to.place").alias("place"), *keys).agg(*[strict_sum(m, exact_scale).alias(m) for m in measures])


def grain_of(sums: DataFrame, grain: str, place: str) -> DataFrame:
    """The rows of one grain of ``sum_by_grain``, with its own name for the place."""
    return sums.filter(F.col("grain") == grain).drop("grain").withColumnRenamed("place", place)
