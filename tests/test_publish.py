"""Published datasets: versions, rewriting from itself, killed writes; join constraints."""

import os

import pytest
from pyspark.sql import functions as F

from peerscope.operators.joins import JoinChecks, unique_keys
from peerscope.sources.sinks import drop_versions, publish, read_csv_na, read_table, versions, write_csv_na, write_table


def numbers(df):
    return sorted(r.v for r in df.collect())


def test_rewrite_from_itself(spark, tmp_dir):
    path = os.path.join(tmp_dir, "data")
    write_table(spark.range(10).select(F.col("id").alias("v")), path)
    old = read_table(spark, path)
    write_table(read_table(spark, path).filter("v < 5").withColumn("v", F.col("v") + 100), path)
    assert numbers(read_table(spark, path)) == [100, 101, 102, 103, 104]
    assert numbers(old) == list(range(10))  # a reader of the version before is not disturbed
    assert len(versions(spark, path)) == 2
    assert drop_versions(spark, path) == 1
    assert numbers(read_table(spark, path)) == [100, 101, 102, 103, 104]


def test_rewrite_by_name_with_another_schema(spark):
    write_table(spark.range(3).select(F.col("id").alias("v")), name="peerscope_t1")
    write_table(read_table(spark, name="peerscope_t1").select((F.col("v") * 2).cast("string").alias("v"), F.lit(1).alias("p")), name="peerscope_t1", partition_by=["p"])
    assert numbers(read_table(spark, name="peerscope_t1")) == ["0", "2", "4"]
    spark.sql("CREATE TABLE peerscope_t2 (v int) USING parquet")
    with pytest.raises(ValueError, match="not a published dataset"):
        write_table(spark.range(1), name="peerscope_t2")
    spark.sql("DROP TABLE peerscope_t2")
    spark.sql("DROP VIEW peerscope_t1")


def test_killed_write_leaves_the_version_before(spark, tmp_dir):
    path = os.path.join(tmp_dir, "data")
    write_table(spark.range(4).select(F.col("id").alias("v")), path)
    dies = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id")).alias("v"))
    with pytest.raises(Exception, match="killed"):
        write_table(dies, path)
    assert numbers(read_table(spark, path)) == [0, 1, 2, 3] and len(versions(spark, path)) == 1
    assert drop_versions(spark, path) == 1  # what the killed write left


def test_plain_files_are_read_until_the_first_version(spark, tmp_dir):
    path = os.path.join(tmp_dir, "data")
    spark.range(2).select(F.col("id").alias("v")).write.parquet(path)
    assert numbers(read_table(spark, path)) == [0, 1]
    write_table(read_table(spark, path).withColumn("v", F.col("v") + 5), path)
    assert numbers(read_table(spark, path)) == [5, 6]


def test_two_writers_of_one_version(spark, tmp_dir, monkeypatch):
    from peerscope.sources import sinks

    path = os.path.join(tmp_dir, "data")
    publish(spark.range(1).select(F.col("id").alias("v")), path)
    monkeypatch.setattr(sinks, "versions", lambda *a: [])  # a writer that has not seen the first
    with pytest.raises(Exception):
        publish(spark.range(7).select(F.col("id").alias("v")), path)
    monkeypatch.undo()
    assert numbers(read_table(spark, path)) == [0]


def test_csv_rewritten_from_itself(spark, tmp_dir):
    path = os.path.join(tmp_dir, "x")
    write_csv_na(spark.createDataFrame([("a", 1.0), ('b "q", c', None)], "k string, v double"), path)
    schema = spark.createDataFrame([], "k string, v double").schema
    write_csv_na(read_csv_na(spark, path, schema).filter("v is null"), path)
    assert [tuple(r) for r in read_csv_na(spark, path, schema).collect()] == [('b "q", c', None)]
    assert os.listdir(tmp_dir) == ["x"]
    dies = spark.range(1).select(F.raise_error(F.lit("killed")).cast("string").alias("k"))
    with pytest.raises(Exception, match="killed"):
        write_csv_na(dies, path)
    assert os.listdir(tmp_dir) == ["x"] and read_csv_na(spark, path, schema).count() == 1


FACT = [("a", 1), ("b", 2), (None, 3), ("c", 4)]


@pytest.mark.parametrize("dim,message", [([("a", 1), ("a", 2)], "not unique: a"), ([("a", 1), (None, 2)], "is null")])
def test_bad_dimension_keys_stop_the_plan(spark, dim, message):
    fact = spark.createDataFrame(FACT, "k string, n int")
    out = JoinChecks().join(fact, spark.createDataFrame(dim, "k string, x int"), "k")
    with pytest.raises(Exception, match=message):
        out.collect()


def test_counts_without_a_job_of_their_own(spark):
    checks = JoinChecks()
    fact, dim = spark.createDataFrame(FACT, "k string, n int"), spark.createDataFrame([("a", 1), ("b", None)], "k string, x int")
    sc = spark.sparkContext
    sc.setJobGroup("checks-build", "building")
    out = checks.join(fact, dim, "k")
    assert len(sc.statusTracker().getJobIdsForGroup("checks-build")) == 0
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert sorted((r.n, r.x) for r in out.collect()) == [(1, 1), (2, None), (3, None), (4, None)]
    sc.setJobGroup("checks-verify", "verifying")
    assert checks.verify() == [{"on": "['k']", "rows": 4, "null_keys": 1, "joined": 4}]
    assert len(sc.statusTracker().getJobIdsForGroup("checks-verify")) == 0
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_violated_constraint_is_not_published(spark, tmp_dir):
    path = os.path.join(tmp_dir, "data")
    write_table(spark.range(1).select(F.col("id").alias("v")), path)
    checks = JoinChecks()
    out = checks.join(spark.createDataFrame(FACT, "k string, v int"), spark.createDataFrame([("a", 1)], "k string, x int"), "k", nulls=False)
    with pytest.raises(ValueError, match="1 null keys"):
        write_table(out, path, checks=checks)
    assert numbers(read_table(spark, path)) == [0]


def test_unique_keys_keeps_rows_and_columns(spark):
    dim = spark.createDataFrame([(1, "x", None), (2, None, 3.0)], "a int, b string, c double")
    assert sorted(map(tuple, unique_keys(dim, ["a"]).collect())) == [(1, "x", None), (2, None, 3.0)]
