"""Every registered batch query against its reference SQL, and the shape of its plan."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_sql import connect, differences  # noqa: E402

from cabstream.plans.catalog import QUERIES, SQL  # noqa: E402

BATCH = [n for n in QUERIES if not n.startswith("stream_") and n in SQL]


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", BATCH)
def test_query_equals_sql_and_plan_is_distributed(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                 "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan, node
    _count, notes = differences(df, db, SQL[name])
    assert not notes


@pytest.mark.parametrize("name, columns", [
    ("trips_per_zone", {"l_partkey"}),
    ("trip_type_distribution", {"l_returnflag"}),
])
def test_scans_read_only_what_they_need(spark, sf_dir, name, columns):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert read and all({c.split(":")[0] for c in r.split(",")} <= columns for r in read)


def test_filters_reach_the_scan(spark, sf_dir):
    plan = QUERIES["requests_valid"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "In(event_type, [purchase,signup])" in plan


def test_matching_ranks_no_whole_cell_in_one_task(spark, sf_dir):
    from cabstream.operators import matching
    from cabstream.plans.catalog import matches

    asked, cars = matches.window_requests(spark, sf_dir), matches.window_vehicles(spark, sf_dir)
    seen = []
    stored = matching._stored_round
    try:
        matching._stored_round = lambda met: seen.append(met._jdf.queryExecution().executedPlan().toString()) or stored(met)
        matching.match_trips_rounds(asked, cars)
    finally:
        matching._stored_round = stored
    assert 1 < len(seen) <= 6
    ranks = re.findall(r"row_number\(\) windowspecdefinition\(([^)]*?) ASC", seen[0])
    assert ranks and all("since" in r for r in ranks)


def test_zone_lookup_needs_no_join(spark, sf_dir):
    plan = QUERIES["gps_anonymized"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
