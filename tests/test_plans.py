"""Plan shape checks: the properties the design relies on at scale."""

import contextlib
import io
import json
import re

import pytest
from test_building import plans_of

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_pairwise_joins(spark, name):
    """Neither in the plan of the result nor in those that ran before it (checkpoints and written tables)."""
    made = []
    ran = plans_of(spark, lambda: made.append(E.queries()[name](spark, SF)))
    text = _plan(made[0]) + json.dumps(ran)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_flagship_scan_is_pruned_and_filtered(spark):
    text = _plan(E.queries()["q01_county_panel"](spark, SF))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", text)
    li = [s for s in schemas if "l_orderkey" in s]
    assert li and all("l_shipdate" not in s and "l_comment" not in s and "l_tax" not in s for s in li)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", text)
    # a single aggregation shuffle for the panel; dimensions are broadcast
    assert "BroadcastHashJoin" in text


def test_windows_are_partitioned(spark):
    """No window over the whole input (a single-task window)."""
    for name in ("q17_rank_two_metrics_long", "q21_trend_roll3", "q16_bracket_panel", "q20_spending_rank"):
        text = _plan(E.queries()[name](spark, SF))
        for spec in re.findall(r"windowspecdefinition\(([^)]*)\)", text):
            assert not spec.lstrip().startswith("specifiedwindowframe"), (name, spec)
