"""Replay of the published county panel for the home county.

The published values divided by the year's inflation factor are whole
dollars, so the raw yearly sums can be rebuilt exactly.  Feeding those sums
(with the zero years left out, as missing cells) through completion,
inflation and per-resident adjustment must give the published panel back.
"""

import math

from peerscope.operators.metrics import deflate, per_capita
from peerscope.operators.panel import complete_panel
from test_panel_geo import FACTORS_2018

# fixed values: published home-county panel, (year, value in 2018 dollars, value per resident)
HOME_PANEL = [
    (2000, 0.0, 0.0),
    (2001, 21153.336692768677, 0.030555618187487834),
    (2002, 0.0, 0.0),
    (2003, 0.0, 0.0),
    (2004, 195497.94326669181, 0.28401099107468536),
    (2005, 21570.82607564319, 0.03139711989491492),
    (2006, 2251469.4162689648, 3.2095073646029433),
    (2007, 242829.17356672304, 0.3423678257556045),
    (2008, 451772.3944888756, 0.6328434653152792),
    (2009, 256609.82439276468, 0.3556152412475224),
    (2010, 2892309.634318358, 3.897088052794174),
    (2011, 6066175.575196532, 8.121738980804187),
    (2012, 390709.39708557574, 0.5203713727852127),
    (2013, 4461341.768618157, 5.894758372555808),
    (2014, 3954378.7545946636, 5.202951944531718),
    (2015, 2540872.3458378376, 3.3273910631788692),
    (2016, 1145143.863725609, 1.4962316211698785),
    (2017, 267595.3762563465, 0.34700460379889275),
]


def test_published_panel_replays(spark):
    raw = []
    for year, value, _ in HOME_PANEL:
        dollars = value / FACTORS_2018[year]
        assert abs(dollars - round(dollars)) < 1e-6  # whole dollars
        if value:
            raw.append(("21111", year, float(round(dollars))))
    # a second county present every year fixes the set of years
    raw += [("99999", y, 1.0) for y in range(2000, 2018)]
    loans = spark.createDataFrame(raw, "FIPS string, year int, cdfi double")
    pop = spark.createDataFrame(
        [("21111", y, (v / pp) if pp else 750000.0) for y, v, pp in HOME_PANEL] + [("99999", y, 1.0) for y in range(2000, 2018)],
        "FIPS string, year int, population double",
    )
    cpi = spark.createDataFrame([(y, 1.0 / f) for y, f in FACTORS_2018.items()], "year int, cpi double")

    panel = complete_panel(loans, "FIPS", "year", {"cdfi": 0.0})
    panel = per_capita(deflate(panel, ["cdfi"], cpi, 2018), ["cdfi"], pop, "FIPS")
    got = {r.year: (r.cdfi, r.cdfi_pp) for r in panel.filter("FIPS = '21111'").collect()}
    assert sorted(got) == list(range(2000, 2018))
    for year, value, pp in HOME_PANEL:
        v, p = got[year]
        assert math.isclose(v, value, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(p, pp, rel_tol=1e-9, abs_tol=1e-12)
    # population implied for 2017 is a whole number of residents
    assert round(HOME_PANEL[-1][1] / HOME_PANEL[-1][2]) == 771158


# fixed values: published 2017 lender investment per resident, all 21 peer entities
PER_RESIDENT_2017 = [
    ("01073", 2.6836829954194625), ("12031", 7.494097338829599), ("18097", 12.53759941354913),
    ("21111", 0.34700460379889275), ("26081", 5.743644267557932), ("29095", 72.43507487530891),
    ("31055", 3.0818264296704836), ("37081", 18.382069510237248), ("37119", 19.223415732872535),
    ("37183", 12.450779340530822), ("39049", 6.218448862007792), ("39061", 32.73128599089861),
    ("39113", 3.9358763898775093), ("40109", 6.193082456475394), ("40143", 2.8756552155504984),
    ("45045", 12.386248595239861), ("47037", 49.46227661946138), ("47093", 17.581112548631307),
    ("47157", 116.85047472715601), ("51760", 63.4798182871832), ("MERGED", 22.566939681361994),
]


def test_home_ranks_last_in_2017(spark):
    from peerscope.operators.panel import rank_table

    df = spark.createDataFrame([(f, 2017, v) for f, v in PER_RESIDENT_2017] + [("21111", 2016, 99.0)], "FIPS string, year int, cdfi_pp double")
    ranks = {r.FIPS: r.rank for r in rank_table(df, "FIPS", "cdfi_pp").collect()}  # latest year by default
    assert len(ranks) == 21 and ranks["21111"] == 21 and ranks["47157"] == 1
    assert sorted(ranks.values()) == list(range(1, 22))


# fixed values: published metro panel of one peer, and one neighborhood, (year, value in 2018 dollars, value per resident)
METRO_PANEL = [
    (2000, 32675.77263747039, 0.033290820547077646),
    (2001, 545.5327039552537, 5.535421424466613e-4),
    (2002, 0.0, 0.0),
    (2003, 1120.4815783775423, 0.0011277650070113953),
    (2004, 78650.02998792908, 0.07884341034682116),
    (2005, 524979.1216499304, 0.5241651680247262),
    (2006, 959624.411368331, 0.9415296902680356),
    (2007, 800547.9546864461, 0.7712103420639899),
    (2008, 2241941.0601742035, 2.1366328375117614),
    (2009, 706828.9076256744, 0.6650911147213369),
    (2010, 4753796.866071725, 4.476310385287738),
]
AREA = "Algonquin-Park Hill-Park Duvalle"
AREA_PANEL = [(2014, 629716.65460444, 40.66098370274682), (2015, 1048.161477712904, 0.06827523955920427), (2016, 42328.196225558866, 2.6752746950801964)]


def test_published_metro_panel_replays(spark):
    raw = [("13820", y, float(round(v / FACTORS_2018[y]))) for y, v, _ in METRO_PANEL if v] + [("x", y, 1.0) for y, *_ in METRO_PANEL]
    tx = spark.createDataFrame([(f"c{m}", y, v) for m, y, v in raw], "FIPS string, year int, originalamount double")
    counties = spark.createDataFrame([("c13820", "13820"), ("cx", "x")], "FIPS string, MSA string")
    pop = spark.createDataFrame([("13820", y, v / p if p else 1e6) for y, v, p in METRO_PANEL] + [("x", y, 1.0) for y, *_ in METRO_PANEL], "MSA string, year int, population double")
    cpi = spark.createDataFrame([(y, 1.0 / f) for y, f in FACTORS_2018.items()], "year int, cpi double")
    from peerscope.dims import Dimensions
    from peerscope.plans import cdfi

    panel = cdfi.msa_panel(tx, Dimensions(msa_counties=counties, population={"MSA": pop}, cpi=cpi))
    got = {r.year: (r.cdfi, r.cdfi_pp) for r in panel.filter("MSA = '13820'").collect()}
    for year, value, pp in METRO_PANEL:
        assert math.isclose(got[year][0], value, rel_tol=1e-9, abs_tol=1e-9) and math.isclose(got[year][1], pp, rel_tol=1e-9, abs_tol=1e-9)


def test_published_neighborhood_replays_and_layers_agree(spark):
    from peerscope.dims import Dimensions
    from peerscope.plans import cdfi

    residents = AREA_PANEL[0][1] / AREA_PANEL[0][2]
    tracts = [("21111000700", 0.25), ("21111001200", 0.75)]
    tx = [(t, y, round(v / FACTORS_2018[y]) * part) for y, v, _ in AREA_PANEL for t, part in tracts]
    tx += [("21111999900", y, 7.0) for y, *_ in AREA_PANEL]  # a tract that the crosswalk lacks
    xw = [(t, layer, AREA, residents * part) for t, part in tracts for layer in ("nh", "muw")]
    dims = Dimensions(
        cpi=spark.createDataFrame([(y, 1.0 / f) for y, f in FACTORS_2018.items()], "year int, cpi double"),
        crosswalk=spark.createDataFrame(xw, "tract string, layer string, neighborhood string, population double"),
    )
    layers = cdfi.map_layers(spark.createDataFrame(tx, "tract_10 string, year int, originalamount double"), dims)
    got = {r.year: (r.cdfi, r.cdfi_pp) for r in layers["cdfi_nh"].filter("neighborhood is not null").collect()}
    for year, value, pp in AREA_PANEL:
        assert math.isclose(got[year][0], value, rel_tol=1e-9) and math.isclose(got[year][1], value / residents, rel_tol=1e-9)
    assert math.isclose(got[2014][1], AREA_PANEL[0][2], rel_tol=1e-9)
    totals = [{r.year: r.t for r in layers[f"cdfi_{k}"].groupBy("year").agg({"cdfi": "sum"}).toDF("year", "t").collect()} for k in ("tract", "nh", "muw")]
    for year in totals[0]:  # as the published layers do, each adds up to the county
        assert math.isclose(totals[0][year], totals[1][year], rel_tol=1e-9) and math.isclose(totals[0][year], totals[2][year], rel_tol=1e-9)
