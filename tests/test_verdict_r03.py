"""Inputs that the stand-ins write, and how often files are read."""

import glob
import json

import pytest
from test_building import plans_of

from peerscope.plans import catalog, standins


@pytest.fixture()
def tables(spark, tmp_dir):
    """Three orders of a customer each with seven lines."""
    when = "timestamp '1995-02-01 00:00:00' + make_interval(int(id))"
    made = {
        "nation": spark.range(3).selectExpr("int(id) n_nationkey", "concat('N', id) n_name", "int(id) % 2 n_regionkey"),
        "customer": spark.range(3).selectExpr("id c_custkey", "int(id) c_nationkey", "concat('C', id) c_name", "double(id) c_acctbal"),
        "orders": spark.range(6).selectExpr("id o_orderkey", "id % 3 o_custkey", f"{when} o_orderdate", "10.5D o_totalprice", "'F' o_orderstatus", "'1-URGENT' o_orderpriority"),
        "lineitem": spark.range(42).selectExpr(
            "id % 6 l_orderkey", "id l_partkey", "id l_suppkey", "int(id div 6) + 1 l_linenumber", "double(id) l_quantity", "double(id) * 10 l_extendedprice",
            "0.0D l_discount", "0.0D l_tax", "'N' l_returnflag", "'O' l_linestatus", "timestamp '1996-03-04 00:00:00' l_shipdate",
        ),
    }
    for name, df in made.items():
        df.write.parquet(f"{tmp_dir}/{name}.parquet")
    return tmp_dir


def test_records_are_not_sorted_by_year_before_they_are_written(spark, tables):
    path = []
    ran = json.dumps(plans_of(spark, lambda: path.append(standins.write_cra_files(spark, tables))))
    assert "Sort [o_orderkey" in ran or "Sort [l_orderkey" in ran  # the plans are there
    assert "Sort [year" not in ran
    lines = spark.read.text(path[0])
    assert lines.count() == 42 and lines.select("year").distinct().count() == 6
    assert lines.filter("substring(value, 6, 4) <> cast(year as string)").isEmpty()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_exports_are_many_files_read_once_for_rows(spark, tables, monkeypatch):
    monkeypatch.setattr(standins, "SHEET_ROWS", 10, raising=False)
    df = catalog.q27_export_keeps_rows(spark, tables)
    assert sorted((r["order"], r["line"]) for r in df.collect()) == [(float(o), n) for o in range(6) for n in range(1, 8)]
    path = df.inputFiles()[0].removeprefix("file:").split("/k=")[0]
    assert len(glob.glob(f"/{path.lstrip('/')}/k=*/**/*.txt", recursive=True)) > 7  # a file of one line number is divided
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Union" not in plan  # no line is part of a record: one pass


def test_header_over_blocks_names_the_columns(spark, tmp_dir):
    """The first file's header record is put together from its own blocks, titles with quotes above it."""
    for name, rows in (("a.csv", 3), ("b.csv", 40)):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write('Title "x\n"one\n\nname",two\n' + "".join(f'{i},"t\n{i}"\n' for i in range(rows)))
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "8")
    try:
        df = catalog.read_delimited(spark, tmp_dir, "ic", skip=1)
        assert df.columns == ["one\n\nname", "two"]
        assert sorted(df.collect()) == sorted([(i, f"t\n{i}") for n in (3, 40) for i in range(n)])
    finally:
        spark.conf.set(key, old)
