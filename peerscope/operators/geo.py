"""Place operators: peer filter, entity merge, roll-up and crosswalks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerscope.dims import Dimensions
from peerscope.functions.nulls import exact, strict_mean, strict_sum
from peerscope.operators.joins import join_dim, semi_filter
from peerscope.operators.materialize import materialize


def pull_peers(
    df: DataFrame,
    dims: Dimensions,
    geog: str = "FIPS",
    add_info: bool = False,
    entity: str | None = None,
) -> DataFrame:
    """Keep rows that belong to the peer set of ``geog`` ("FIPS" or "MSA").

    ``entity`` names the id column of ``df`` (default: ``geog``).  County rows
    filtered by the MSA peer set keep the counties of peer MSAs.  With
    ``add_info`` the peer attributes (``city``, ``current``) are joined on.
    """
    peers = dims.peers_for(geog)
    entity = entity or geog
    if entity == geog:
        if add_info:
            info = [c for c in peers.columns if c != geog]
            return join_dim(df, peers.select(geog, *info), geog, how="inner")
        return semi_filter(df, peers, geog)
    if geog == "MSA" and entity == "FIPS":
        counties = join_dim(dims.msa_counties.select("FIPS", "MSA"), peers.select("MSA"), "MSA", "left_semi")
        return semi_filter(df, counties, "FIPS")
    raise ValueError(f"cannot filter {entity!r} rows by {geog!r} peers")


def relabel_entity(df: DataFrame, entity: str, members: Sequence[str], merged: str = "MERGED") -> DataFrame:
    """Give the member entities one shared id (apply before aggregating)."""
    c = F.col(entity)
    return df.withColumn(entity, F.when(c.isin(list(members)), F.lit(merged)).otherwise(c))


def merge_entities(
    panel: DataFrame,
    entity: str,
    members: Sequence[str],
    measures: Sequence[str],
    keys: Sequence[str] = ("year",),
    method: str = "sum",
    merged: str = "MERGED",
    exact_scale: int | None = None,
) -> DataFrame:
    """Combine the member entities of a panel into one entity.

    ``panel`` is unique per ``(entity, keys)`` (an aggregated panel, so its
    size is bounded by places x years); it is re-aggregated once with the
    members relabelled.  ``method`` is "sum" or "mean" (strict: a null member
    value gives null).  When the raw rows are at hand, prefer
    ``relabel_entity`` before the first aggregation: one shuffle instead of two.
    """
    keys, measures = list(keys), list(measures)
    agg = {"sum": strict_sum, "mean": strict_mean}[method]
    relabelled = relabel_entity(panel, entity, members, merged)
    return relabelled.groupBy(entity, *keys).agg(*[agg(m, exact_scale).alias(m) for m in measures])


def roll_up(
    df: DataFrame,
    mapping: DataFrame,
    source: str,
    target: str,
    measures: Sequence[str],
    keys: Sequence[str] = ("year",),
    exact_scale: int | None = None,
) -> DataFrame:
    """Sum a lower geography into a higher one through a mapping table."""
    joined = join_dim(df, mapping.select(source, target), source, how="inner")
    return joined.groupBy(target, *keys).agg(*[strict_sum(m, exact_scale).alias(m) for m in measures])


def process_map(
    df: DataFrame,
    crosswalk: DataFrame,
    measures: Sequence[str],
    name: str,
    unit: str = "tract",
    keys: Sequence[str] = ("year",),
    method: str = "sum",
    pop_adjust: bool = True,
    layers: Sequence[str] = ("nh", "muw"),
    exact_scale: int | None = None,
    weight_scale: int = 6,
) -> dict[str, DataFrame]:
    """Tract panel to the tract layer and each neighborhood layer.

    * ``sum``: area value = sum of its tracts (strict).
    * ``mean``: population-weighted mean of the tracts with a value; weights
      and weighted values are both summed at ``weight_scale`` decimals (as
      doubles if ``exact_scale`` is None).
    * tracts that a layer of the crosswalk lacks make up its area null, so
      every layer adds up to the tracts.
    * ``pop_adjust``: adds ``<measure>_pp`` = value / area population, where
      the area population is that of all its tracts in the crosswalk.

    All layers are aggregated by one shuffle; the result is a dict keyed
    ``<name>_tract``, ``<name>_<layer>``.
    """
    keys, measures = list(keys), list(measures)
    # the tract panel feeds the tract layer and every area layer: write it once
    df = materialize(df.select(unit, *keys, *measures))
    xw = crosswalk.select(unit, "layer", "neighborhood", "population")
    tract_pop = xw.groupBy(unit).agg(F.max("population").alias("__pop"))
    area_pop = xw.groupBy("layer", "neighborhood").agg(F.sum("population").alias("__pop"))

    by_layer = df.withColumn("layer", F.explode(F.array(*[F.lit(x) for x in layers])))
    joined = by_layer.join(xw, on=[unit, "layer"], how="left")
    if method == "sum":
        aggs = [strict_sum(m, exact_scale).alias(m) for m in measures]
    elif method == "mean":
        w = F.col("population")
        scale = None if exact_scale is None else weight_scale
        total = lambda x: F.sum(exact(x, scale)).cast("double")
        aggs = [F.try_divide(total(w * F.col(m)), total(F.when(F.col(m).isNotNull(), w))).alias(m) for m in measures]
    else:
        raise ValueError(f"unknown method {method!r}")
    areas = joined.groupBy("layer", "neighborhood", *keys).agg(*aggs)

    tracts = df.select(unit, *keys, *measures)
    if pop_adjust:
        pp = lambda t: t.withColumns({f"{m}_pp": F.try_divide(F.col(m), F.col("__pop")) for m in measures}).drop("__pop")
        tracts = pp(join_dim(tracts, tract_pop, unit, how="left"))
        areas = pp(join_dim(areas, area_pop, ["layer", "neighborhood"], how="left"))
    out = {f"{name}_{unit}": tracts}
    for layer in layers:
        out[f"{name}_{layer}"] = areas.filter(F.col("layer") == layer).drop("layer")
    return out


def check_shares(crosswalk: DataFrame, unit: str = "tract") -> DataFrame:
    """The crosswalk, whose read stops at a unit and layer with shares that don't sum to one or a repeated area."""
    one = Window.partitionBy(unit, "layer")
    total = F.sum(F.col("share").cast("decimal(18,6)")).over(one)
    wrong = F.raise_error(F.concat(F.lit("shares do not sum to one: "), F.coalesce(F.col(unit).cast("string"), F.lit("null")), F.lit(" "), F.col("layer")))
    repeat = F.raise_error(F.concat(F.lit("area stands twice: "), F.coalesce(F.col(unit).cast("string"), F.lit("null")), F.lit(" "), F.col("layer")))
    twice = F.count("*").over(Window.partitionBy(unit, "layer", "neighborhood"))
    share = F.when(total != 1, wrong.cast("decimal(18,6)")).when(twice > 1, repeat.cast("decimal(18,6)")).otherwise(F.col("share").cast("decimal(18,6)"))
    return crosswalk.withColumn("share", share)


def allocate(
    df: DataFrame,
    crosswalk: DataFrame,
    measures: Sequence[str],
    unit: str = "tract",
    keys: Sequence[str] = ("year",),
    layers: Sequence[str] = ("nh", "muw"),
    scale: int = 4,
) -> DataFrame:
    """Units that lie in several areas, divided by their shares: (layer, neighborhood, keys, measures).

    ``crosswalk`` has (unit, layer, neighborhood, share), the shares of a unit
    in a layer summing to one.  A value is a decimal of ``scale`` places and is
    cut where its cumulative shares, areas in name order, fall: the part of an
    area is the rounded value at its upper cut less that at its lower one, so
    the parts of a unit add up to it exactly and a layer's total is the units'
    total to the last place.  A null value makes the areas it touches null
    (strict); units that a layer lacks make up its area null, whole.

    A join on the unit (its areas are few) and one aggregation of decimals.
    """
    keys, measures = list(keys), list(measures)
    xw = check_shares(crosswalk.select(unit, "layer", "neighborhood", "share"), unit)
    in_unit = Window.partitionBy(unit, "layer").orderBy("neighborhood")  # the areas of one unit
    upper = F.sum("share").over(in_unit.rowsBetween(Window.unboundedPreceding, 0)).cast("decimal(9,6)")
    lower = F.coalesce(F.sum("share").over(in_unit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("decimal(9,6)")
    xw = xw.select(unit, "layer", "neighborhood", upper.alias("__upper"), lower.alias("__lower"))
    each = df.select(unit, *keys, *measures).withColumn("layer", F.explode(F.array(*[F.lit(x) for x in layers])))
    joined = each.join(xw, [unit, "layer"], "left")
    cut = lambda v, at: F.round(v.cast(f"decimal(20,{scale})") * at, scale).cast(f"decimal(22,{scale})")
    part = lambda m: F.when(F.col("__upper").isNull(), F.col(m).cast(f"decimal(22,{scale})")).otherwise(cut(F.col(m), F.col("__upper")) - cut(F.col(m), F.col("__lower")))
    parts = joined.select("layer", "neighborhood", *keys, *[part(m).alias(m) for m in measures])
    total = lambda m: F.when(F.count(m) == F.count(F.lit(1)), F.sum(m)).cast("double")
    return parts.groupBy("layer", "neighborhood", *keys).agg(*[total(m).alias(m) for m in measures])


def stack_layers(layers: dict[str, DataFrame], unit: str = "tract") -> DataFrame:
    """Union the layers of ``process_map`` with ``layer`` and ``area`` columns."""
    frames = []
    for key, df in layers.items():
        layer = key.rsplit("_", 1)[1]
        id_col = unit if unit in df.columns else "neighborhood"
        frames.append(df.withColumnRenamed(id_col, "area").withColumn("layer", F.lit(layer)))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
