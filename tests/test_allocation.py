"""Split crosswalks, several grains in one pass, byte positions, first matches, medians."""

import os
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from peerscope.functions.text import replace_first
from peerscope.operators.geo import allocate
from peerscope.operators.grains import grain_of, sum_by_grain
from peerscope.operators.order_stats import exact_median
from peerscope.operators.panel import rank_by, rank_long
from peerscope.sources.fixed_width import Layout, read_fixed_width

XW = "tract string, layer string, neighborhood string, share decimal(9,6)"


def shares(*rows):
    return [(*r[:3], Decimal(r[3])) for r in rows]


def test_parts_add_up_to_the_last_place(spark):
    rng = random.Random(1)
    xw, values = [], []
    for t in range(60):
        for layer in ("nh", "muw"):
            cuts = sorted({0, 1_000_000, *(rng.randrange(1_000_000) for _ in range(rng.randrange(4)))})
            xw += [(f"t{t}", layer, f"{layer}{i}", Decimal(b - a) / 1_000_000) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        values.append((f"t{t}", 2000 + t % 3, round(rng.uniform(-1e6, 1e6), 4)))
    out = allocate(spark.createDataFrame(values, "tract string, year int, v double"), spark.createDataFrame(xw, XW), ["v"])
    total = {}
    for r in out.collect():
        total[r.layer, r.year] = total.get((r.layer, r.year), Decimal(0)) + Decimal(repr(r.v)).quantize(Decimal("0.0001"))
    for layer in ("nh", "muw"):
        for year in (2000, 2001, 2002):
            assert total[layer, year] == sum(Decimal(repr(v)).quantize(Decimal("0.0001")) for _, y, v in values if y == year)


def test_thirds_nulls_and_tracts_outside(spark):
    xw = spark.createDataFrame(shares(("a", "nh", "x", "0.333333"), ("a", "nh", "y", "0.333333"), ("a", "nh", "z", "0.333334"), ("b", "nh", "x", "1")), XW)
    df = spark.createDataFrame([("a", 1, 0.0001), ("b", 1, None), ("c", 1, 5.0), (None, 1, 2.0)], "tract string, year int, v double")
    got = {r.neighborhood: r.v for r in allocate(df, xw, ["v"], layers=["nh"]).collect()}
    assert got == {"x": None, "y": 0.0001, "z": 0.0, None: 7.0}


@pytest.mark.parametrize("rows,message", [([("a", "nh", "x", "0.5"), ("a", "nh", "y", "0.4")], "do not sum to one: a nh"), ([("a", "nh", "x", "0.5"), ("a", "nh", "x", "0.5")], "stands twice")])
def test_bad_shares_stop_the_read(spark, rows, message):
    df = spark.createDataFrame([("a", 1, 1.0)], "tract string, year int, v double")
    with pytest.raises(Exception, match=message):
        allocate(df, spark.createDataFrame(shares(*rows), XW), ["v"]).collect()


def test_grains_match_their_own_sums(spark):
    rows = [(f"c{i % 5}", [f"m{i % 2}", "all"] if i % 3 else None, i % 4, None if i == 7 else float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "c string, m array<string>, year int, v double")
    out = sum_by_grain(df, {"county": F.when(F.col("year") < 3, F.array("c")), "metro": F.col("m"), "none": F.array().cast("array<string>")}, ["v"], exact_scale=4)
    got = {(r.grain, r.place, r.year): r.v for r in out.collect()}
    want = {}
    for c, m, y, v in rows:
        for key in ([("county", c, y)] if y < 3 else []) + [("metro", p, y) for p in m or []]:
            want.setdefault(key, []).append(v)
    assert got == {k: None if None in v else sum(v) for k, v in want.items()}
    assert grain_of(out, "county", "FIPS").columns == ["FIPS", "year", "v"]


def test_bytes_not_characters(spark, tmp_dir):
    for charset, name in (("UTF-8", "u.dat"), ("ISO-8859-1", "l.dat")):
        with open(os.path.join(tmp_dir, name), "wb") as f:
            for label, n in (("Saarbrücken", 12), ("Ségou", 345), ("plain", 6)):
                f.write(label.encode(charset).ljust(16) + str(n).rjust(6).encode() + b"\n")
        rows = read_fixed_width(spark, os.path.join(tmp_dir, name), Layout.of([("name", 1, 16, "c"), ("n", 17, 22, "i")], charset)).collect()
        assert sorted(map(tuple, rows)) == [("Saarbrücken", 12), ("Ségou", 345), ("plain", 6)]


@pytest.mark.parametrize(
    "text,pattern,new,want",
    [
        ("abXX cdd", r"(.)\1", "Q", "abQ cdd"),
        ("ST\nX", "ST.", "SAINT", "ST\nX"),
        ("ST\nX STY", "ST.", "SAINT", "ST\nX SAINT"),
        ("ST. LOUIS ST.", "ST.", "SAINT", "SAINT LOUIS ST."),
        ("a\U0001f600b1c2", "[0-9]", "$1\\", "a\U0001f600b$1\\c2"),
        ("xaay", "(?i)A+", "-", "x-y"),
        ("abc", "^", ">", ">abc"),
        ("foobar", "o(?=b)", "0", "fo0bar"),
        ("abc", "z", "y", "abc"),
        (None, "z", "y", None),
    ],
)
def test_first_match(spark, text, pattern, new, want):
    assert spark.createDataFrame([(text,)], "t string").select(replace_first("t", pattern, new)).first()[0] == want


@pytest.mark.parametrize("seed", range(3))
def test_median_of_skewed_and_weighted_values(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(2500):
        g = rng.choice(["hot", "hot", "hot", None, "b", "c"])
        v = rng.choice([rng.gauss(0, 1), float(rng.randrange(5)), 7.0, None])
        rows.append((g, v, rng.choice([0, 1, 1, 50]) if g == "b" else 1))
    rows += [("one", 3.5, 1), ("two", 1.0, 1), ("two", 2.0, 1), ("null", None, 4)]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    want = {}
    for g, v, n in rows:
        want.setdefault(g, []).extend([v] * n if v is not None else [])
    got = {r.g: r.m for r in exact_median(df, ["g"], "v", "m", weight="n").collect()}
    assert got == {g: statistics.median(v) for g, v in want.items() if v}


def test_ranks_of_two_metrics(spark):
    rng = random.Random(4)
    rows = [(i, 2000 + i % 2, rng.choice([None, 1.0, 2.0, 3.0]), rng.randrange(6)) for i in range(50)]
    df = spark.createDataFrame(rows, "k int, year int, a double, b int")
    rank = lambda y, v, c: None if v is None else 1 + sum(r[1] == y and r[c] is not None and r[c] > v for r in rows)
    want = {(k, y): (rank(y, a, 2), rank(y, b, 3)) for k, y, a, b in rows}
    assert {(r.k, r.year): (r.a, r.b) for r in rank_by(df, ["year"], ["a", "b"]).collect()} == want
    long = {(r.k, r.variable): r.rank for r in rank_long(df, ["year"], ["a", "b"], ["k"]).collect()}
    assert long == {(k, m): r for (k, _), both in want.items() for m, r in zip("ab", both)}
