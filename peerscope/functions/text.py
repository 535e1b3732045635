"""String and code-cleaning column functions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from peerscope.functions.nulls import _c, if_else


def _java_quote(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def replace_first(c, pattern: str, replacement: str, literal: bool = False) -> Column:
    """Replace the first match of a regex (``regexp_replace`` replaces all) by a plain text.

    ``literal=True`` treats ``pattern`` as plain text, e.g. a real ``ST.``
    instead of ``ST`` followed by any character.  The pattern is taken as the
    caller wrote it: its groups keep their numbers and ``.`` is no line break.
    """
    c = _c(c)
    pat = _java_quote(pattern) if literal else pattern
    match = F.coalesce(F.regexp_substr(c, F.lit(pat)), F.lit(""))  # null for an empty match as well
    upto = F.regexp_extract(c, rf"^[\s\S]*?(?:{pat})", 0)  # the text up to the end of the first match
    before = F.left(upto, F.length(upto) - F.length(match))
    return F.when(~c.rlike(pat), c).otherwise(F.concat(before, F.lit(replacement), F.substr(c, F.length(upto) + 1)))


def remove_first(c, pattern: str, literal: bool = False) -> Column:
    return replace_first(c, pattern, "", literal=literal)


def pad_left(c, width: int, fill: str = "0") -> Column:
    """Left pad to ``width``; longer strings are kept whole (never truncated)."""
    c = _c(c)
    return F.lpad(c, F.greatest(F.length(c), F.lit(width)), F.lit(fill))


def split_into(c, sep: str, n: int, cast: str | None = None) -> list[Column]:
    """Split into ``n`` parts; missing parts are null, extra parts dropped."""
    arr = F.split(_c(c), re.escape(sep))
    parts = [F.get(arr, i) for i in range(n)]
    if cast:
        parts = [p.try_cast(cast) for p in parts]
    return parts


def parse_number(c) -> Column:
    """Lenient number parse: the text as a number (with sign, leading point or
    exponent) or else the first number in it, grouping commas dropped."""
    text = F.trim(_c(c).cast("string"))
    plain = F.when(text.rlike(r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"), text.try_cast("double"))
    num = F.regexp_extract(text, r"[-+]?(?:[0-9][0-9,]*\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?", 0)
    return F.coalesce(plain, F.replace(num, F.lit(","), F.lit("")).try_cast("double"))


def null_if(c, sentinel: str) -> Column:
    return F.nullif(_c(c), F.lit(sentinel))


def recode(c, mapping: Mapping[str, str]) -> Column:
    """Map codes to labels; unmatched values are kept unchanged."""
    c = _c(c)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), c)


def recode_by_position(c, labels: Sequence[str]) -> Column:
    """1 -> labels[0], 2 -> labels[1], ...; out of range gives null."""
    i = _c(c).cast("int")
    return F.when(i >= 1, F.try_element_at(F.array(*[F.lit(x) for x in labels]), i))


def two_digit_year(c, pivot: int = 84) -> Column:
    """``yy >= pivot`` is 19yy, otherwise 20yy; null stays null."""
    y = _c(c)
    return if_else(y >= pivot, y + 1900, y + 2000)

