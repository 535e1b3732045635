"""Column selection helpers that work on schemas, not data."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame


def col_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Columns from ``first`` to ``last`` inclusive, in the frame's current order."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    if j < i:
        raise ValueError(f"column range {first}:{last} is reversed")
    return cols[i : j + 1]


def cols_containing(df: DataFrame, text: str, ignore_case: bool = True) -> list[str]:
    t = text.lower() if ignore_case else text
    return [c for c in df.columns if t in (c.lower() if ignore_case else c)]


def map_columns(df: DataFrame, cols: Iterable[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply one column function to many columns (names kept)."""
    from pyspark.sql import functions as F

    cols = list(cols)
    return df.withColumns({c: fn(F.col(c)) for c in cols}) if cols else df


def keep_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Select the wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return df.select(*[c for c in wanted if c in present])


def rename_if_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    todo = {a: b for a, b in mapping.items() if a in df.columns and a != b}
    return df.withColumnsRenamed(todo) if todo else df
