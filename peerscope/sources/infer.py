"""Column types from the values: one aggregate over all rows.

Every value has a class, the classes of a column are or-ed together bit by bit
(an aggregate that merges in any order), and the set of classes gives the type:

* nothing but missing values: logical (all null);
* ``T F TRUE FALSE true false``: logical;
* whole numbers of 64 bits: integer; with other numbers among them: double;
* ``yyyy-mm-dd``: date;
* anything else, and any mixture of logical, numbers and dates: text.

A number with a leading zero (``00011``) is a code, so its column is text and
keeps the zero; ``0``, ``0.5`` and ``-0.5`` are numbers.  All rows count, not a
first thousand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.sources.delimited import NULL_VALUES, null_texts, read_text_columns

LOGICAL, INTEGER, DOUBLE, DATE, TEXT = 1, 2, 4, 8, 16
#: Texts of logical values (fixed values).
TRUE, FALSE = ("T", "TRUE", "true", "True"), ("F", "FALSE", "false", "False")


def value_class(text: Column) -> Column:
    """The class bit of a value; 0 if it is null."""
    whole = text.rlike("^[-+]?(0|[1-9][0-9]{0,18})$") & text.try_cast("bigint").isNotNull()
    number = text.rlike(r"^[-+]?(0|[1-9][0-9]*)?(\.[0-9]*)?([eE][-+]?[0-9]+)?$") & text.rlike("^[-+]?\\.?[0-9]") & text.try_cast("double").isNotNull()
    date = text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & text.try_cast("date").isNotNull()
    return F.when(text.isNull(), 0).when(whole, INTEGER).when(number, DOUBLE).when(text.isin(*TRUE, *FALSE), LOGICAL).when(date, DATE).otherwise(TEXT)


def type_of(classes: int) -> str:
    """The type that holds values of all these classes."""
    if classes in (0, LOGICAL):
        return "boolean"
    if classes == INTEGER:
        return "bigint"
    if classes in (DOUBLE, DOUBLE | INTEGER):
        return "double"
    return "date" if classes == DATE else "string"


def infer_types(texts: DataFrame) -> dict[str, str]:
    """The type of every column of a table of texts (one job; one row reaches the driver)."""
    if not texts.columns:
        return {}
    found = texts.select(*[F.coalesce(F.bit_or(value_class(F.col(f"`{c}`"))), F.lit(0)).alias(str(i)) for i, c in enumerate(texts.columns)]).first()
    return {c: type_of(found[i]) for i, c in enumerate(texts.columns)}


def _as(text: Column, kind: str) -> Column:
    if kind == "boolean":
        return F.when(text.isin(*TRUE), True).when(text.isin(*FALSE), False)
    return text if kind == "string" else text.try_cast(kind)


def read_inferred(
    spark: SparkSession, path: str | Sequence[str], sep: str = ",", null_values: Sequence[str] = NULL_VALUES, skip: int = 0, types: dict[str, str] | None = None
) -> DataFrame:
    """Delimited files with a header, each column of the type that its values give (or that ``types`` gives it)."""
    texts = read_text_columns(spark, path, sep, skip)
    texts = texts.select(*[null_texts(F.trim(F.col(f"`{c}`"), F.lit(" \t")), null_values).alias(c) for c in texts.columns])
    given = types or {}
    kinds = {**infer_types(texts.drop(*given)), **given}
    return texts.select(*[_as(F.col(f"`{c}`"), kinds[c]).alias(c) for c in texts.columns])
