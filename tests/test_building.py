"""Building a query runs no job, and each fact table is scanned once per query."""

import json
import os

import pytest

from peerscope.plans import standins
from peerscope.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
#: Queries without a panel completion, a median, a rank, map layers or files of their own.
LAZY = ["q01_county_panel", "q02_zip_panel", "q04_zip_504_panel", "q06_clean_codes", "q14_count_per_home_pop", "q21_trend", "q22_rebase_series", "q24_first_match_replace", "q25_strict_vs_skipping_sum"]
#: Others: one or two checkpoints and a range sample each; every stage that AQE plans by itself counts as a job.
BOUNDED = {"q03_sparse_panel_complete": 14, "q07_cdfi_county": 14, "q09_crosswalk_sum": 12, "q15_deal_stats": 16, "q21_rank_latest": 24, "q28_label_text": 24}


def jobs_while_building(spark, name):
    QUERIES[name](spark, SF)  # table handles and stand-in inputs are made once per session
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{name}", "building")
    try:
        QUERIES[name](spark, SF)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(f"build-{name}"))


@pytest.mark.parametrize("name", LAZY)
def test_no_job_before_an_action(spark, name):
    assert jobs_while_building(spark, name) == 0


@pytest.mark.parametrize("name", sorted(BOUNDED))
def test_few_jobs_for_checkpoints(spark, name):
    assert jobs_while_building(spark, name) <= BOUNDED[name]


def plans_of(spark, run):
    """The plans of the queries that ``run`` executes, as they ran, from the event log."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    folder = spark.conf.get("spark.eventLog.dir").removeprefix("file:")
    files = [os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs if not f.endswith(".crc")]
    at = {f: os.path.getsize(f) for f in files}
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    plans = {}
    for f in files:
        with open(f) as log:
            log.seek(at[f])
            for line in log:
                try:
                    e = json.loads(line)
                except ValueError:
                    continue
                if "sparkPlanInfo" in e:
                    plans[e["executionId"]] = e["sparkPlanInfo"]  # the last one is the one that ran

    return list(plans.values())


def nodes(plan):
    yield plan
    for child in plan["children"]:
        yield from nodes(child)


def scans_of(spark, run, kind=""):
    """File scans of a kind (text, csv, parquet) in the plans that ``run`` executes."""
    return sum(n["nodeName"].startswith(f"Scan {kind}") and "ExistingRDD" not in n["nodeName"] and "OneRow" not in n["nodeName"] for p in plans_of(spark, run) for n in nodes(p))


def scans(spark, table, run):
    """Scan nodes of ``table`` in the plans that ran."""
    return sum(n["nodeName"].startswith("Scan") and f"/{table}.parquet" in json.dumps(n.get("metadata", {})) for p in plans_of(spark, run) for n in nodes(p))


@pytest.mark.parametrize("name,table", [("q21_rank_latest", "lineitem"), ("q28_label_text", "lineitem"), ("q14_count_per_home_pop", "supplier"), ("q15_deal_stats", "orders"), ("q01_county_panel", "lineitem")])
def test_one_scan(spark, name, table):
    standins.dimensions(spark, SF)
    assert scans(spark, table, lambda: QUERIES[name](spark, SF).collect()) == 1


def test_bank_results_read_their_records_once(spark):
    standins.write_cra_files(spark, SF)
    standins.dimensions(spark, SF)
    assert scans_of(spark, lambda: QUERIES["q13_cra_results"](spark, SF).collect(), "text") == 1


def test_two_metrics_are_put_in_order_once(spark):
    standins.write_giving_files(spark, SF)
    plans = plans_of(spark, lambda: QUERIES["q17_rank_two_metrics_long"](spark, SF).collect())
    ranges = [n for p in plans for n in nodes(p) if "rangepartitioning" in n["simpleString"]]
    assert len(ranges) == 1


def test_median_sorts_no_whole_table(spark):
    """The one range exchange of the median takes the values near the middle only."""
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    from peerscope.operators.order_stats import exact_median

    plans = plans_of(spark, lambda: exact_median(orders, ["o_orderstatus"], "o_totalprice").collect())
    for p in plans:
        for n in nodes(p):
            if "rangepartitioning" in n["simpleString"]:
                assert any("__bracket" in m["simpleString"] and "Join" in m["nodeName"] for m in nodes(n))
