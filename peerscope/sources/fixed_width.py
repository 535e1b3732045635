"""Fixed-width text scans.

A layout lists ``(name, start, end, type)`` with 1-based inclusive byte
positions.  Files are read with ``spark.read.text`` (split across tasks like
any text file) and each field is a slice of the line's bytes, decoded by the
layout's charset, + ``trim`` + cast - a narrow projection inside whole-stage
codegen.  So a name of several bytes a letter leaves the fields after it in
place.  Blank fields become null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.functions.text import parse_number
from peerscope.sources.delimited import NULL_VALUES


@dataclass(frozen=True)
class Field:
    name: str
    start: int
    end: int
    type: str = "c"  # c string, n lenient number, i int, d double


@dataclass(frozen=True)
class Layout:
    fields: tuple[Field, ...]
    charset: str = "UTF-8"

    @classmethod
    def of(cls, spec: Sequence[tuple], charset: str = "UTF-8") -> "Layout":
        return cls(tuple(Field(*f) for f in spec), charset)

    @property
    def width(self) -> int:
        return max(f.end for f in self.fields)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)


def byte_slice(value: Column, start: int, length: int, charset: str = "UTF-8") -> Column:
    """Text of ``length`` bytes of a line from byte ``start`` on (the line's bytes are as they are in the file)."""
    part = F.substring(value.cast("binary"), start, length)
    return part.cast("string") if charset.upper() in ("UTF-8", "US-ASCII") else F.decode(part, charset)


def _typed(raw: Column, kind: str) -> Column:
    """A trimmed slice as its type; blank is null."""
    raw = F.when(~raw.isin(list(NULL_VALUES)), raw)
    if kind == "c":
        return raw
    if kind == "n":
        return F.coalesce(raw.try_cast("double"), parse_number(raw))  # digits alone need no pattern
    return raw.try_cast({"i": "int", "d": "double", "l": "bigint"}[kind])


def _fields(lines: DataFrame, slices: Mapping[str, Column], kinds: Mapping[str, str]) -> DataFrame:
    """The named slices in one projection and their values in the next: a slice is cut once, however often its value needs it."""
    raw = lines.select(*[F.trim(c).alias(n) for n, c in slices.items()])
    return raw.select(*[_typed(F.col(f"`{n}`"), kinds[n]).alias(n) for n in slices])


def _slice(value: Column, f: Field, charset: str) -> Column:
    return byte_slice(value, f.start, f.end - f.start + 1, charset)


def parse_fixed_width(lines: DataFrame, layout: Layout, value: str = "value") -> DataFrame:
    v = F.col(value)
    return _fields(lines, {f.name: _slice(v, f, layout.charset) for f in layout.fields}, {f.name: f.type for f in layout.fields})


def read_fixed_width(spark: SparkSession, paths: str | Sequence[str], layout: Layout) -> DataFrame:
    return parse_fixed_width(spark.read.text(paths), layout)


def parse_layouts(lines: DataFrame, layouts: Mapping[str, Layout], choose: Column, value: str = "value") -> DataFrame:
    """Parse lines written in several layouts in a single pass.

    ``choose`` is an expression over the line giving the layout key of each
    line (e.g. from a field that sits at the same bytes in every layout).
    Fields missing from a layout are null for its lines.  A line without a
    layout stops the read: it must not become a row of nulls.
    """
    names: list[str] = []
    for lay in layouts.values():
        names += [n for n in lay.names if n not in names]
    v = F.col(value)
    lost = F.raise_error(F.concat(F.lit("no layout for the line: "), v)).cast("string")
    key = F.when(choose.isin(list(layouts)), choose).otherwise(lost)
    slices, kinds = {}, {}
    for n in names:
        expr = F.lit(None).cast("string")
        for k, lay in layouts.items():
            if n not in lay.names:
                continue
            f = lay.field(n)
            if kinds.setdefault(n, f.type) != f.type:
                raise ValueError(f"field {n} has two types")
            expr = F.when(F.col("__layout") == k, _slice(v, f, lay.charset)).otherwise(expr)
        slices[n] = expr
    return _fields(lines.withColumn("__layout", key), slices, kinds)


def read_fixed_width_layouts(
    spark: SparkSession, paths: str | Sequence[str], layouts: Mapping[str, Layout], choose: Column
) -> DataFrame:
    return parse_layouts(spark.read.text(paths), layouts, choose)


def layout_by_year(start: int, length: int, switch_year: int, before: str = "old", after: str = "new", otherwise: str | None = None) -> Column:
    """Layout key from a year field found at the same bytes in every layout; ``otherwise`` for lines without a year."""
    year = byte_slice(F.col("value"), start, length).try_cast("int")
    return F.when(year < switch_year, F.lit(before)).when(year >= switch_year, F.lit(after)).otherwise(F.lit(otherwise).cast("string"))


def layout_by_length(lengths: Mapping[int, str]) -> Column:
    """Layout key from the record's bytes without trailing blanks: the narrowest layout that holds the line."""
    n = F.octet_length(F.rtrim(F.col("value")))
    expr = None
    for width, key in sorted(lengths.items()):
        expr = F.when(n <= width, F.lit(key)) if expr is None else expr.when(n <= width, F.lit(key))
    return expr
