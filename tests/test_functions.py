import math

from pyspark.sql import functions as F

from peerscope.functions.columns import col_range, cols_containing, keep_existing, rename_if_present
from peerscope.functions.format import bin_values, dollar_text, label, percent_text, signif
from peerscope.functions.nulls import if_else, ratio, strict_mean, strict_sum, sum0
from peerscope.functions.text import (
    pad_left,
    parse_number,
    recode,
    recode_by_position,
    remove_first,
    replace_first,
    split_into,
    two_digit_year,
)


def test_strict_and_skipping_aggregates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("b", 3.5), ("c", None)], "k string, x double")
    out = {
        r.k: r
        for r in df.groupBy("k")
        .agg(strict_sum("x").alias("s"), sum0("x").alias("s0"), strict_mean("x").alias("m"), strict_sum("x", 4).alias("e"))
        .collect()
    }
    assert out["a"].s is None and out["a"].s0 == 1.0 and out["a"].m is None
    assert out["b"].s == 5.5 and out["b"].m == 2.75 and out["b"].e == 5.5
    assert out["c"].s is None and out["c"].s0 == 0


def test_ratio_and_if_else(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (3.0, 2.0), (None, 1.0)], "a double, b double")
    rows = df.select(ratio("a", "b").alias("r"), if_else(F.col("a") > 1, "hi", "lo").alias("f")).collect()
    assert [r.r for r in rows] == [None, None, 1.5, None]
    assert [r.f for r in rows] == ["lo", "lo", "hi", None]  # null predicate stays null


def test_replace_first_wildcard_and_literal(spark):
    df = spark.createDataFrame([("ST. LOUIS",), ("EAST BATON ROUGE",), ("ST. ST. X",), (None,)], "c string")
    rows = df.select(replace_first("c", "ST.", "SAINT").alias("w"), replace_first("c", "ST.", "SAINT", literal=True).alias("l")).collect()
    assert [r.w for r in rows] == ["SAINT LOUIS", "EASAINTBATON ROUGE", "SAINT ST. X", None]
    assert [r.l for r in rows] == ["SAINT LOUIS", "EAST BATON ROUGE", "SAINT ST. X", None]


def test_remove_first_and_pad(spark):
    df = spark.createDataFrame([("0012.34",), ("1.2.3",), ("2111100100",), ("211110010012",)], "c string")
    rows = df.select(remove_first("c", ".", literal=True).alias("r"), pad_left("c", 11).alias("p")).collect()
    assert [r.r for r in rows][:2] == ["001234", "12.3"]
    assert rows[2].p == "02111100100"
    assert rows[3].p == "211110010012"  # never truncated


def test_split_and_pivot_year(spark):
    df = spark.createDataFrame([("01-JAN-83",), ("15-MAR-84",), ("31-DEC-00",), ("02-FEB",)], "d string")
    day, month, yy = split_into("d", "-", 3)
    rows = df.select(day.try_cast("int").alias("day"), month.alias("m"), two_digit_year(yy.try_cast("int")).alias("y")).collect()
    assert [r.y for r in rows] == [2083, 1984, 2000, None]
    assert rows[3].day == 2 and rows[3].m == "FEB"


def test_parse_number_and_recode(spark):
    df = spark.createDataFrame([("$1,234.50 est.",), ("-12",), ("n/a",), ("MICRO",), ("ODD",)], "s string")
    rows = df.select(parse_number("s").alias("n"), recode("s", {"MICRO": "business"}).alias("r")).collect()
    assert [r.n for r in rows] == [1234.5, -12.0, None, None, None]
    assert [r.r for r in rows][3:] == ["business", "ODD"]
    pos = spark.range(0, 4).select(recode_by_position("id", ["a", "b", "c"]).alias("v")).collect()
    assert [r.v for r in pos] == [None, "a", "b", "c"]


def test_text_formats(spark):
    df = spark.createDataFrame([(5.74,), (-80123456.4,), (0.05,), (None,)], "x double")
    rows = df.select(percent_text("x").alias("p"), dollar_text("x").alias("d"), dollar_text("x", 1).alias("d1")).collect()
    assert rows[0].p == "5.7%" and rows[0].d == "$6" and rows[0].d1 == "$5.7"
    assert rows[1].d == "-$80,123,456" and rows[1].p == "-80,123,456.4%"
    assert rows[2].p == "0.1%"  # half away from zero
    assert rows[3].p is None and rows[3].d is None


def test_signif_bins_label(spark):
    df = spark.createDataFrame([(12345.678, "A"), (0.0, "B"), (0.0012345, "C"), (None, "D")], "x double, c string")
    rows = df.select(signif("x", 4).alias("s"), label("c", F.lit(3)).alias("l")).collect()
    assert rows[0].s == 12350.0 and rows[1].s == 0.0 and math.isclose(rows[2].s, 0.001235) and rows[3].s is None
    assert rows[0].l == "A - 3"
    b = spark.createDataFrame([(-1.0,), (0.0,), (49.9,), (50.0,), (3500.0,), (3500.1,), (None,)], "x double")
    assert [r.b for r in b.select(bin_values("x", [0, 50, 100, 250, 500, 1000, 3500]).alias("b")).collect()] == [
        None, 0, 0, 1, 5, None, None,
    ]


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "a int, num_x int, amount_y int, num_z int, mars1 int")
    assert col_range(df, "num_x", "num_z") == ["num_x", "amount_y", "num_z"]
    assert cols_containing(df, "NUM") == ["num_x", "num_z"]
    assert keep_existing(df, ["zz", "num_z", "a"]).columns == ["num_z", "a"]
    assert rename_if_present(df, {"mars1": "MARS1", "nope": "x"}).columns[-1] == "MARS1"
