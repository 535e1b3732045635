"""Dimension tables supplied by the caller.

Each table is an ordinary DataFrame; the expected columns are:

* ``counties``      FIPS, county, state_abbr
* ``zips``          zip, FIPS, population_total, population_in_FIPS
* ``msa_counties``  FIPS, MSA
* ``msa_zips``      zip, MSA
* ``peers``         FIPS or MSA (the entity), city, current
* ``population``    entity column (FIPS / MSA / zip / tract), year, population
* ``cpi``           year, cpi
* ``crosswalk``     tract, neighborhood, layer, population

Geography and calendar bound the size of all of them; whether one is broadcast
is left to the planner's and AQE's byte thresholds.  Keys are unique per table
(``check_unique`` tells).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Dimensions:
    counties: DataFrame | None = None
    zips: DataFrame | None = None
    msa_counties: DataFrame | None = None
    msa_zips: DataFrame | None = None
    peers: dict[str, DataFrame] = field(default_factory=dict)
    population: dict[str, DataFrame] = field(default_factory=dict)
    cpi: DataFrame | None = None
    crosswalk: DataFrame | None = None

    def check_unique(self) -> None:
        """Raise if a dimension has two rows for a key (a join would repeat rows); one job per table."""
        keys = [(self.counties, ["FIPS"]), (self.zips, ["zip", "FIPS"]), (self.msa_counties, ["FIPS"]), (self.msa_zips, ["zip"]), (self.cpi, ["year"]), (self.crosswalk, ["tract", "layer"])]
        keys += [(t, [g]) for g, t in self.peers.items()] + [(t, [g, "year"]) for g, t in self.population.items()]
        for t, k in keys:
            if t is not None and (row := t.groupBy(*k).count().filter("count > 1").limit(1).collect()):
                raise ValueError(f"key {k} is not unique: {row[0]}")

    def peers_for(self, geog: str) -> DataFrame:
        try:
            return self.peers[geog]
        except KeyError as e:
            raise KeyError(f"no peer table for geography {geog!r}") from e

    def pop_for(self, geog: str) -> DataFrame:
        try:
            return self.population[geog]
        except KeyError as e:
            raise KeyError(f"no population table for geography {geog!r}") from e

    def pop_latest(self, geog: str) -> DataFrame:
        """One population per entity: the value of the latest year on record.

        Used where a population is joined without a year.
        """
        pop = self.pop_for(geog)
        latest = pop.select(F.max("year")).scalar()
        return pop.filter(F.col("year") == latest).select(geog, "population")
