"""Report text and rounding helpers.

Numbers are rounded half away from zero on the binary value and then printed
from integers, so the text does not depend on a locale or on the formatting
library's own rounding rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from peerscope.functions.nulls import _c


def _fixed(x: Column, digits: int) -> Column:
    """Sign, grouped integer part and ``digits`` decimals of ``x``."""
    scaled = F.round(x * (10**digits), 0).cast("bigint")
    a = F.abs(scaled)
    whole = F.format_number(F.floor(a / (10**digits)) if digits else a, 0)
    text = whole
    if digits:
        frac = F.lpad((a % (10**digits)).cast("string"), digits, "0")
        text = F.concat(whole, F.lit("."), frac)
    sign = F.when(scaled < 0, F.lit("-")).otherwise(F.lit(""))
    return F.when(x.isNotNull(), F.concat(sign, text))


def number_text(c, digits: int = 0) -> Column:
    """``1234.5`` -> ``1,234.5`` style text (comma grouping)."""
    return _fixed(_c(c).cast("double"), digits)


def percent_text(c, digits: int = 1, scale: float = 1.0) -> Column:
    """``5.74`` -> ``5.7%`` (value already in percent when ``scale`` is 1)."""
    x = _c(c).cast("double") * scale
    return F.when(x.isNotNull(), F.concat(_fixed(x, digits), F.lit("%")))


def dollar_text(c, digits: int = 0) -> Column:
    """``-1234.4`` -> ``-$1,234``."""
    x = _c(c).cast("double")
    body = _fixed(F.abs(x), digits)
    return F.when(x.isNotNull(), F.concat(F.when(F.round(x * (10**digits), 0) < 0, F.lit("-")).otherwise(F.lit("")), F.lit("$"), body))


def signif(c, digits: int) -> Column:
    """Round to ``digits`` significant digits (0 and null pass through)."""
    x = _c(c).cast("double")
    s = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, x).otherwise(F.round(x * s, 0) / s)


def label(*parts, sep: str = " - ") -> Column:
    return F.concat_ws(sep, *[_c(p).cast("string") for p in parts])


def bin_values(c, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Class index (or label) of ``c`` in ``[e0, e1), [e1, e2), ... [e_{n-1}, e_n]``.

    Values outside the edges and nulls give null.
    """
    x = _c(c)
    out = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        last = i == len(edges) - 2
        cond = (x >= lo) & ((x <= hi) if last else (x < hi))
        val = F.lit(labels[i]) if labels else F.lit(i)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out
