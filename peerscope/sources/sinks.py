"""Writers: CSV with ``NA`` for missing values, and published datasets.

A dataset is published in versions.  Each write goes to a new folder beside
the others (``<path>/_snapshots/<id>``); when all its files are there, a small
numbered manifest that names it is added (``<path>/_manifests/<number>``), and
readers take the manifest with the highest number.  So a reader never meets a
gap or half a dataset, a write that is killed leaves the version before, a
dataset may be rewritten from itself, and of two writers of one number the
second fails (manifests are created, never overwritten).  ``drop_versions``
deletes what no reader needs any more.

A named dataset is a view of the session catalog on the current version of a
folder in the warehouse; replacing the view is one step of the catalog.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from peerscope.operators.joins import JoinChecks

SNAPSHOTS, MANIFESTS = "_snapshots", "_manifests"


# ------------------------------------------------------------ file system


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join([parts[0].rstrip("/"), *parts[1:]]))


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder) -> list[str]:
    fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


# -------------------------------------------------------------------- CSV


def write_csv_na(df: DataFrame, path: str, order_by: Sequence[str] | None = None) -> None:
    """Header line, missing values written as ``NA``, quoting only when needed.

    ``order_by`` sorts the output (a range-partitioned sort, not one task).
    The files are written beside ``path`` and take its place when they are all
    there, so the folder may be one that ``df`` reads.
    """
    spark = df.sparkSession
    out = df.orderBy(*order_by) if order_by else df
    new = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    try:
        out.write.options(header=True, nullValue="NA", emptyValue="", escape='"').csv(new)
    except BaseException:
        _fs(spark, _path(spark, new)).delete(_path(spark, new), True)
        raise
    _take_place(spark, new, path)


def _take_place(spark: SparkSession, new: str, path: str) -> None:
    """The folder ``new`` becomes ``path``; what stood there is deleted last."""
    fs, old = _fs(spark, _path(spark, path)), f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    had = fs.exists(_path(spark, path))
    if had and not fs.rename(_path(spark, path), _path(spark, old)):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(_path(spark, new), _path(spark, path)):
        if had:
            fs.rename(_path(spark, old), _path(spark, path))
        raise OSError(f"cannot move {new} to {path}")
    if had:
        fs.delete(_path(spark, old), True)


def read_csv_na(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(header=True, nullValue="NA", escape='"').csv(path)


# --------------------------------------------------------------- datasets


def versions(spark: SparkSession, path: str) -> list[str]:
    """Manifests of a dataset, oldest first."""
    return [n for n in _names(spark, _path(spark, path, MANIFESTS)) if n.isdigit()]


def _snapshot(spark: SparkSession, path: str, number: str) -> str:
    where = _path(spark, path, MANIFESTS, number)
    stream = _fs(spark, where).open(where)
    try:
        text = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return f"{path.rstrip('/')}/{SNAPSHOTS}/{json.loads(text)['snapshot']}"


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), checks: JoinChecks | None = None) -> str:
    """Write ``df`` as the next version of the dataset at ``path``; returns the folder of the version.

    ``checks`` are verified when the files are there and before readers see
    them: a violated constraint raises and leaves the version before.
    """
    spark = df.sparkSession
    before, snapshot = versions(spark, path), uuid.uuid4().hex
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    folder = f"{path.rstrip('/')}/{SNAPSHOTS}/{snapshot}"
    writer.parquet(folder)
    if checks is not None:
        checks.verify()
    number = f"{int(before[-1]) + 1 if before else 0:010d}"
    where = _path(spark, path, MANIFESTS, number)
    stream = _fs(spark, where).create(where, False)  # fails if another writer was first
    try:
        stream.write(bytearray(json.dumps({"snapshot": snapshot, "schema": df.schema.simpleString()}).encode()))
    finally:
        stream.close()
    return folder


def drop_versions(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete all but the newest ``keep`` versions, and folders of writes that never ended; number of folders deleted.

    To be run when no reader is on an older version and no write is under way.
    """
    numbers = versions(spark, path)
    kept = {_snapshot(spark, path, n).rsplit("/", 1)[-1] for n in numbers[-keep:]}
    for n in numbers[:-keep]:
        where = _path(spark, path, MANIFESTS, n)
        _fs(spark, where).delete(where, False)
    gone = [s for s in _names(spark, _path(spark, path, SNAPSHOTS)) if s not in kept]
    for s in gone:
        where = _path(spark, path, SNAPSHOTS, s)
        _fs(spark, where).delete(where, True)
    return len(gone)


def _named_folder(spark: SparkSession, name: str) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name.replace('.', '/')}.dataset"


def write_table(df: DataFrame, path: str | None = None, name: str | None = None, partition_by: Sequence[str] = (), checks: JoinChecks | None = None) -> None:
    """Publish a dataset, at a path or under a catalog name; it may be one that ``df`` reads.

    Plain Parquet files that stand at ``path`` stay where they are and are no
    longer read.  A name that is a table, not a dataset of this module, is an error.
    """
    spark = df.sparkSession
    if not name:
        publish(df, path, partition_by, checks)
        return
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a table, not a published dataset")
    folder = publish(df, _named_folder(spark, name), partition_by, checks)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")


def read_table(spark: SparkSession, path: str | None = None, name: str | None = None) -> DataFrame:
    """The current version of a published dataset (a name: what the catalog has; a path without versions: its Parquet files)."""
    if name:
        return spark.table(name)
    numbers = versions(spark, path)
    return spark.read.parquet(_snapshot(spark, path, numbers[-1]) if numbers else path)


def drop_table(spark: SparkSession, name: str) -> None:
    """Delete a named dataset: the view, then all its versions."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    where = _path(spark, _named_folder(spark, name))
    _fs(spark, where).delete(where, True)


def write_many(results: Mapping[str, DataFrame], base: str, fmt: str = "csv") -> None:
    """Publish several named results of one computation."""
    for name, df in results.items():
        if fmt == "csv":
            write_csv_na(df, f"{base.rstrip('/')}/{name}")
        else:
            write_table(df, f"{base.rstrip('/')}/{name}")
