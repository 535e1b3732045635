"""Column types from the values."""

import os

import pytest

from peerscope.sources.infer import infer_types, read_inferred, type_of


@pytest.mark.parametrize(
    "values,kind",
    [
        ([None, ""], "boolean"),
        (["T", "FALSE", None], "boolean"),
        (["0", "-5", "+7", None], "bigint"),
        (["9223372036854775807"], "bigint"),
        (["9223372036854775808", "1"], "double"),
        (["1", "2.5"], "double"),
        ([".5", "5.", "1e-3", "-0.25"], "double"),
        (["00011", "1"], "string"),
        (["007.5"], "string"),
        (["0", "0.5"], "double"),
        (["2019-02-28", None], "date"),
        (["2019-02-30"], "string"),
        (["2019-02-28", "7"], "string"),
        (["T", "1"], "string"),
        (["$5"], "string"),
        ([".", "1"], "string"),
        (["-"], "string"),
        (["1e999"], "double"),
        (["x"], "string"),
    ],
)
def test_type_of_values(spark, values, kind):
    df = spark.createDataFrame([(None if not v else v,) for v in values], "c string")
    assert infer_types(df) == {"c": kind}


def test_merge_in_any_order():
    """Or-ing classes is associative and commutative, and the type of a set is one."""
    bits = [1, 2, 4, 8, 16]
    for a in range(32):
        for b in bits:
            assert type_of(a | b) == type_of(b | a)
    assert type_of(2 | 4) == "double" and type_of(1 | 2) == "string" and type_of(16 | 2) == "string"


def test_read_inferred(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.csv"), "w") as f:
        f.write('zip,n,share,when,ok,note,none\n00501,1,2,2020-01-31,T,"a\nb",NA\n40202,NA,0.5,NA,F, x ,\n')
    df = read_inferred(spark, tmp_dir)
    assert dict(df.dtypes) == {"zip": "string", "n": "bigint", "share": "double", "when": "date", "ok": "boolean", "note": "string", "none": "boolean"}
    rows = sorted(df.collect(), key=lambda r: r.zip)
    assert [(r.zip, r.n, r.share, str(r.when), r.ok, r.note, r.none) for r in rows] == [("00501", 1, 2.0, "2020-01-31", True, "a\nb", None), ("40202", None, 0.5, "None", False, "x", None)]
    assert dict(read_inferred(spark, tmp_dir, types={"n": "double"}).dtypes)["n"] == "double"


def test_one_pass(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.csv"), "w") as f:
        f.write("a,b\n" + "\n".join(f"{i},{i}.5" for i in range(100)) + "\n")
    df = spark.read.option("header", True).csv(tmp_dir)
    sc = spark.sparkContext
    sc.setJobGroup("infer", "types")
    infer_types(df)
    jobs = sc.statusTracker().getJobIdsForGroup("infer")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2  # one aggregate: its partial and final stage
