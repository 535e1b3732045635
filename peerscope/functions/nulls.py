"""Null and division rules shared by every operator.

The reference's aggregates propagate missing values unless told otherwise;
Spark's skip them.  These helpers state the reference rules explicitly:

* ``strict_sum``  - null when any input in the group is null, else the sum.
* ``sum0``        - null-skipping sum, 0 when every input is null.
* ``strict_mean`` - null when any input is null, else the mean.
* ``ratio``       - division that yields null for a zero or null divisor.
* ``if_else``     - a null condition yields null (not the "else" branch).

Sums can be taken as exact decimals (``exact_scale``) so that the result does
not depend on partitioning or on the order rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact(c: ColumnOrName, scale: int | None) -> Column:
    """Cast to a decimal of the given scale (None keeps the type).

    The scale is the caller's: a value keeps ``scale`` decimals and up to
    ``28 - scale`` digits before the point, which leaves a sum ten more; a
    larger one raises.  Without a scale, doubles of any size are summed.
    """
    c = _c(c)
    if scale is None:
        return c
    if not 0 <= scale <= 18:
        raise ValueError("scale must be within 0 and 18")
    return c.cast(f"decimal(28,{scale})")


def _sum(c: Column, scale: int | None) -> Column:
    s = F.sum(exact(c, scale))
    return s.cast("double") if scale is not None else s


def strict_sum(c: ColumnOrName, exact_scale: int | None = None) -> Column:
    c = _c(c)
    return F.when(F.count(c) == F.count(F.lit(1)), _sum(c, exact_scale))


def sum0(c: ColumnOrName, exact_scale: int | None = None) -> Column:
    c = _c(c)
    return F.coalesce(_sum(c, exact_scale), F.lit(0).cast("double" if exact_scale is not None else "long"))


def strict_mean(c: ColumnOrName, exact_scale: int | None = None) -> Column:
    c = _c(c)
    if exact_scale is None:
        mean = F.avg(c)
    else:
        mean = F.try_divide(_sum(c, exact_scale), F.count(c).cast("double"))
    return F.when(F.count(c) == F.count(F.lit(1)), mean)


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` with null instead of an error or infinity when ``den`` is 0."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def if_else(cond: Column, yes, no) -> Column:
    """Three-valued ``if``: a null condition gives null."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond, yes).when(~cond, no)
