"""Joins against dimension tables, unions of panels, null-safe joins.

How a join runs is left to the planner and to AQE, which broadcast a side only
below their byte thresholds (estimated, then measured) and split skewed
partitions otherwise.  Nothing is remembered between calls, so a dimension
that was overwritten is read anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def join_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join a fact table to a dimension on equal keys (USING semantics)."""
    on = [on] if isinstance(on, str) else list(on)
    return fact.join(dim, on=on, how=how)


class JoinChecks:
    """Constraints of dimension joins, checked inside the jobs that run the plan anyway.

    ``join`` is ``join_dim`` with three watches: a repeated or null key of the
    dimension stops the job by the key (one small aggregation of the dimension,
    no job of its own), and ``DataFrame.observe`` counts the fact rows before
    and after the join and those whose key is null.  ``verify``, after an action,
    raises if a left join changed the number of rows or a key was null where
    ``nulls`` forbids it; it reads the counts and runs nothing.
    """

    def __init__(self) -> None:
        self._seen: list[tuple[str, str, bool, Observation, Observation]] = []

    def join(self, fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left", nulls: bool = True) -> DataFrame:
        on = [on] if isinstance(on, str) else list(on)
        label, before, after = f"{on}", Observation(), Observation()
        null_key = F.greatest(*[F.col(k).isNull().cast("int") for k in on], F.lit(0))
        watched = fact.observe(before, F.count(F.lit(1)).alias("rows"), F.sum(null_key).alias("nulls"))
        out = join_dim(watched, unique_keys(dim, on), on, how).observe(after, F.count(F.lit(1)).alias("rows"))
        self._seen.append((label, how, nulls, before, after))
        return out

    def verify(self) -> list[dict]:
        """The counts of every join, in order; to be called after an action on the joined plan."""
        out = []
        for label, how, nulls, before, after in self._seen:
            facts = {"on": label, "rows": before.get["rows"], "null_keys": before.get["nulls"] or 0, "joined": after.get["rows"]}
            if how == "left" and facts["rows"] != facts["joined"]:
                raise ValueError(f"join on {label}: {facts['rows']} rows became {facts['joined']}")
            if not nulls and facts["null_keys"]:
                raise ValueError(f"join on {label}: {facts['null_keys']} null keys")
            out.append(facts)
        return out


def unique_keys(dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """``dim``, whose read stops at a key that is null or stands on two rows."""
    on, others = list(on), [c for c in dim.columns if c not in on]
    rows = dim.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(*others, F.lit(1).alias("__one"))).alias("__row"))
    text = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in on])
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    why = F.when(null, "is null: ").when(F.col("__n") > 1, "is not unique: ")
    # part of the key itself: a join drops null keys of this side before any filter of ours could see them
    first = F.when(why.isNotNull(), F.raise_error(F.concat(F.lit(f"dimension key {on} "), why, text)).cast(dim.schema[on[0]].dataType)).otherwise(F.col(on[0]))
    return rows.select(first.alias(on[0]), *on[1:], *[F.col(f"__row.`{c}`").alias(c) for c in others])


def semi_filter(df: DataFrame, keys: DataFrame, on: str | Sequence[str], anti: bool = False) -> DataFrame:
    """Keep rows whose key is (or, with ``anti``, is not) in ``keys``."""
    on = [on] if isinstance(on, str) else list(on)
    return join_dim(df, keys.select(*on).distinct(), on, how="left_anti" if anti else "left_semi")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null keys match each other (a null group is
    a group, as in the source's grouping).  Output columns follow ``USING``:
    keys, then the other left columns, then the other right columns.  Both
    sides are aliased, so it also works when one side derives from the other.
    Planned as a hash or sort-merge join like any equi-join.
    """
    keys = list(keys)
    lft, rgt = left.alias("__l"), right.alias("__r")
    cond = None
    for k in keys:
        c = F.col(f"__l.`{k}`").eqNullSafe(F.col(f"__r.`{k}`"))
        cond = c if cond is None else cond & c
    joined = lft.join(rgt, on=cond, how=how)
    if how in ("left_semi", "semi", "left_anti", "anti"):
        return joined
    if how in ("inner", "left", "left_outer"):
        key_cols = [F.col(f"__l.`{k}`").alias(k) for k in keys]
    else:
        key_cols = [F.coalesce(F.col(f"__l.`{k}`"), F.col(f"__r.`{k}`")).alias(k) for k in keys]
    return joined.select(
        *key_cols,
        *[F.col(f"__l.`{c}`").alias(c) for c in left.columns if c not in keys],
        *[F.col(f"__r.`{c}`").alias(c) for c in right.columns if c not in keys],
    )


def bind_panels(a: DataFrame, b: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Full outer join of two metric panels.

    With ``keys=None`` the keys are the columns both frames share, so each
    measure column must live on one side only.
    """
    if keys is None:
        keys = [c for c in a.columns if c in set(b.columns)]
        if not keys:
            raise ValueError("panels share no columns to join on")
    return a.join(b, on=list(keys), how="full")

