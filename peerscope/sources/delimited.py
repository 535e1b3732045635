"""Delimited text scans with explicit, compact column types.

A type string assigns one letter per column, in file order:

``c`` string, ``n`` lenient number (text such as ``$1,234.50`` -> 1234.5),
``d`` double, ``i`` integer, ``D`` date, ``T`` timestamp, ``l`` boolean,
``_`` or ``-`` skip.

Every column is declared (no inference pass over the data).  Skipped columns
are never selected, so the CSV parser does not convert them.  The texts in
``null_values`` are missing values in every column, and a value that does not
parse is null; no row is dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerscope.functions.text import parse_number
from peerscope.sources.records import Records, spans_lines

#: Texts that stand for a missing value.
NULL_VALUES = ("", "NA")

_CASTS = {"d": "double", "i": "int", "D": "date", "T": "timestamp", "l": "boolean"}


def header_names(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> list[str]:
    """Column names from the header line (reads one line, no inference)."""
    return spark.read.options(header=True, sep=sep, escape='"', recursiveFileLookup=True).csv(path).columns


def null_texts(c: Column, null_values: Sequence[str] = NULL_VALUES) -> Column:
    return F.when(~F.trim(c).isin(list(null_values)), c)


def _typed(name: str, kind: str, null_values: Sequence[str], date_format: str | None) -> Column:
    text = null_texts(F.col(f"`{name}`"), null_values)
    if kind == "c":
        return F.trim(text, F.lit(" \t"))
    if kind == "n":
        return parse_number(text)
    if date_format and kind in "DT":
        return F.try_to_timestamp(F.trim(text), F.lit(date_format)).cast(_CASTS[kind])
    return F.trim(text).try_cast(_CASTS[kind])


def _all_names(col_types: str, names: Sequence[str]) -> tuple[str, list[str]]:
    """The type string and one name per column; names may be given for the kept columns only."""
    names = list(names)
    if len(col_types) < len(names):
        col_types += "_" * (len(names) - len(col_types))
    if len(col_types) != len(names):
        kept = [t for t in col_types if t not in "_-"]
        if len(names) != len(kept):
            raise ValueError(f"{len(col_types)} types for {len(names)} columns")
        it = iter(names)
        names = [next(it) if t not in "_-" else f"_skip{i}" for i, t in enumerate(col_types)]
    return col_types, names


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    col_types: str,
    names: Sequence[str] | None = None,
    header: bool = True,
    sep: str = ",",
    null_values: Sequence[str] = NULL_VALUES,
    skip: int = 0,
    date_format: str | None = None,
) -> DataFrame:
    """Read delimited files with a compact type string.

    ``names`` supplies the names of all columns, or of the kept ones (otherwise
    the header's).  A type string shorter than the number of columns is padded
    with skips.  ``skip`` lines at the top of each file (titles above the
    header) are passed over by their position; ``date_format`` is the pattern
    of date and time columns.  Names that come from the header are checked
    against the header of every file.

    Quoted fields may hold line breaks: one job looks for lines that end inside
    a quoted field, and if there are any, records are put together in parallel
    (``records.Records``); text fields lose blanks at their ends.
    """
    col_types = col_types.replace(" ", "")
    df = read_text_columns(spark, path, sep, skip, header, lambda found: _all_names(col_types, names if names is not None else found)[1], check=names is None)
    kept = [(n, t) for n, t in zip(df.columns, _all_names(col_types, df.columns)[0]) if t not in "_-"]
    return df.select(*[_typed(n, t, null_values, date_format).alias(n) for n, t in kept])


def read_text_columns(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    skip: int = 0,
    header: bool = True,
    name: Callable[[list[str]], list[str]] | None = None,
    check: bool = True,
) -> DataFrame:
    """All columns of delimited files as text.

    ``name`` makes the column names from those of the header (by default they
    are taken as they are); ``check``: every file must have this header.
    """
    name = name or list
    if skip or spans_lines(spark, path, sep):
        records = Records(spark, path, skip, sep)
        return parse_records(records.all(), name(names_in(records.first_text(), sep) if check else []), sep, header, check)
    return read_lines(spark, path, name(header_names(spark, path, sep) if check else []), sep, header, check)


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def read_lines(spark: SparkSession, path: str | Sequence[str], names: Sequence[str], sep: str = ",", header: bool = True, check: bool = True) -> DataFrame:
    """Files whose records are lines, as text columns; ``check``: every file must have these names in its header."""
    reader = spark.read.schema(_text_schema(names)).options(header=header, sep=sep, escape='"', mode="PERMISSIVE", recursiveFileLookup=True)
    return reader.option("enforceSchema", not check).csv(path if isinstance(path, str) else list(path))


def parse_records(records: DataFrame, names: Sequence[str], sep: str = ",", header: bool = True, check: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """The records of ``read_records`` as text columns, by the same rules as ``read_lines``; ``keep``: columns besides."""
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    fields = F.from_csv("value", schema, {"sep": sep, "escape": '"', "mode": "PERMISSIVE"})
    if header and check:
        same = F.lit(True)
        for n in names:
            same = same & F.coalesce(F.trim(fields[n]), F.lit("")).eqNullSafe(F.lit("" if n.startswith("_c") else n))
        other = F.raise_error(F.concat(F.lit(f"the header is not {list(names)} in "), F.col("file"))).cast("array<string>")
        # an array to explode, not a condition: the planner may take conditions apart and evaluate the error by itself
        kept = F.when(~F.col("head"), F.array("value")).when(same, F.array().cast("array<string>")).otherwise(other)
        records = records.select("file", F.explode(kept).alias("value"))
    elif header:
        records = records.filter(~F.col("head"))
    return records.select(*keep, fields.alias("r")).select(*keep, "r.*")


def names_in(header: str, sep: str = ",") -> list[str]:
    """Column names in the text of a header record; blank ones by their place."""
    import csv
    import io

    return [n.strip() or f"_c{i}" for i, n in enumerate(next(csv.reader(io.StringIO(header, newline=""), delimiter=sep)))]

