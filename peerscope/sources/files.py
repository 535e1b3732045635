"""File listings and multi-file reads where each file carries its own facts."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from fnmatch import fnmatch
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.functions.columns import keep_existing, rename_if_present
from peerscope.sources.delimited import names_in, null_texts, parse_records, read_lines
from peerscope.sources.records import read_records, spans_lines


def list_entries(spark: SparkSession, path: str, glob: str = "*") -> list[str]:
    """Sorted direct children of ``path`` that match ``glob`` or are folders with files that do.

    A child is a file, or a folder of part files (as Spark writes a dataset);
    the listing asks the file system for children only, not for part files.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    out = []
    for child in fs.listStatus(root):
        name = child.getPath().getName()
        if name[:1] in "._":
            continue
        where = child.getPath() if child.isFile() else jvm.org.apache.hadoop.fs.Path(child.getPath(), glob)
        if fnmatch(name, glob) if child.isFile() else len(fs.globStatus(where)) > 0:
            out.append(child.getPath().toString())
    return sorted(out)


def entry_files(spark: SparkSession, entries: Sequence[str], glob: str = "*") -> list[tuple[str, str, str]]:
    """(entry, file, its ``_metadata.file_path``) of every data file: the entry itself, or the files of its folder that match ``glob``."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for entry in entries:
        path = jvm.org.apache.hadoop.fs.Path(entry)
        fs = path.getFileSystem(conf)
        found = [path] if fs.getFileStatus(path).isFile() else sorted((s.getPath() for s in fs.listStatus(path) if s.isFile() and s.getLen() > 0), key=lambda p: p.toString())
        for f in found:
            if f.getName()[:1] not in "._" and (len(found) == 1 or fnmatch(f.getName(), glob)):
                out.append((entry, f.toString(), f.toUri().toString()))
    return out


def first_records(spark: SparkSession, files: Sequence[str]) -> list[str]:
    """The header record of each file: its first line, or lines until its quotes are closed.

    Opens each file for its first bytes only, through Spark's file systems, as
    a listing does; no data is read and no job runs.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for f in files:
        path = jvm.org.apache.hadoop.fs.Path(f)
        stream = path.getFileSystem(conf).open(path)
        try:
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
            header = reader.readLine() or ""
            while header.count('"') % 2 and (more := reader.readLine()) is not None:
                header += "\n" + more
        finally:
            stream.close()
        out.append(header.removeprefix("\ufeff"))
    return out


def by_header(spark: SparkSession, files: Sequence[str], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Files by their column names, in the order in which a header first appears."""
    out: dict[tuple[str, ...], list[str]] = {}
    for f, header in zip(files, first_records(spark, files)):
        out.setdefault(tuple(names_in(header, sep)) if header else (), []).append(f)
    out.pop((), None)  # empty files have no header and no rows
    return out


def read_yearly(
    spark: SparkSession,
    path: str,
    wanted: Sequence[str],
    start_year: int | None = None,
    years: Mapping[str, int] | None = None,
    renames: Mapping[str, str] | None = None,
    types: Mapping[str, str] | None = None,
    glob: str = "*.csv",
) -> DataFrame:
    """Read one delimited file (or folder of part files) per year and stack
    them by column name.

    * the year of an entry comes from ``years`` (name -> year) when given,
      else from its position in name order counted from ``start_year``;
    * ``renames`` fixes drifting names (e.g. lower-case variants) per file;
    * only the ``wanted`` columns that a file has are kept; columns a file
      lacks are null after the union;
    * ``types`` casts columns (everything else stays string, so codes keep
      their leading zeros).

    Files are grouped by their header and every group is one scan, so 200 files
    with three headers are three scans; the year is joined on the file's path
    (``_metadata.file_path``, a row per file).  Only listings and first lines
    are read on the driver.
    """
    entries = list_entries(spark, path, glob)
    if not entries:
        raise FileNotFoundError(f"no files matching {glob!r} under {path}")
    year_of = {e: years[e.rsplit("/", 1)[-1]] if years is not None else start_year + i for i, e in enumerate(entries)}
    files = entry_files(spark, entries, glob)
    facts = spark.createDataFrame([(_place(uri), year_of[e]) for e, _, uri in files], "_place string, year int")
    types = dict(types or {})
    frames = []
    for names, group in by_header(spark, [f for _, f, _ in files]).items():
        if spans_lines(spark, group):
            records = read_records(spark, group)
            df = parse_records(records, names, keep=("file",))
        else:
            df = read_lines(spark, group, names).withColumn("file", F.col("_metadata.file_path"))
        df = df.select("file", *[null_texts(F.col(f"`{c}`")).alias(c) for c in names])
        df = keep_existing(rename_if_present(df, renames or {}), ["file", *wanted])
        frames.append(df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns}))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    missing = [c for c in wanted if c not in out.columns and c not in (renames or {})]
    out = out.withColumns({c: F.lit(None).cast(types.get(c, "string")) for c in missing})
    # a row per file of the listing that the driver has just read
    return out.withColumn("_place", F.regexp_replace("file", "^[a-z0-9]+:/*", "/")).join(F.broadcast(facts), "_place").drop("_place", "file")


def _place(file: str) -> str:
    """A file's address without its scheme (listings and scans may write it with one slash or three)."""
    return re.sub("^[a-z0-9]+:/*", "/", file)
