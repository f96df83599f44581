"""Plan-shape checks: what a 100x larger input would punish."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as entry
from wiremap.operators.recent import recent
from wiremap.sources.tables import read_table

from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_in_gold(spark):
    for name in ("network_map_packet", "network_map_connection",
                 "network_map_connection_aligned", "edge_report"):
        p = plan(entry.queries()[name](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_latest_by_key_has_partial_group_limit(spark):
    p = plan(entry.queries()["latest_by_key"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_lookback_pushed_and_columns_pruned(spark):
    ev = read_table(spark, SF_SMALL, "events")
    df = recent(ev, 15, "ts", F.lit(dt.datetime(2024, 1, 30))).select("event_id")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_registered_lookbacks_reach_the_reader(spark):
    for name in ("recent_window", "recent_window_param"):
        assert "GreaterThanOrEqual(ts," in plan(entry.queries()[name](spark, SF_SMALL)), name


def test_asof_window_reuses_the_join_partitioning(spark):
    """Without broadcasts packets move for each interface join, never on the pid,
    and nothing is shuffled between the process-link join and the as-of window."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(entry.queries()["network_map_packet"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = p.splitlines()
    w = next(i for i, l in enumerate(lines) if "Window [row_number() windowspecdefinition(_id" in l)
    below = "\n".join(lines[w + 1:w + 4])
    assert "Exchange" not in below, below


def test_building_a_packet_plan_starts_no_job(spark):
    tracker, group = spark.sparkContext.statusTracker(), "building"
    spark.sparkContext.setJobGroup(group, "plans only")
    try:
        for name in ("ip_packet", "packet_with_host", "packet_with_process", "network_map_packet", "lookup_host",
                     "struct_field"):
            p = plan(entry.queries()[name](spark, SF_SMALL))
            assert "GlobalLimit" not in p, name
        footers = tracker.getJobIdsForGroup(group)
        names = [s for j in footers for s in tracker.getJobInfo(j).stageIds]
        # reading a table's footer for its schema is Spark's own one-task job
        assert all(tracker.getStageInfo(s) is None or tracker.getStageInfo(s).numTasks == 1 for s in names)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_connection_map_group_limits(spark):
    """Both side reductions keep partial+final group limits (hot endpoints are
    cut map-side); the final pick has none (its groups span join partitions)."""
    df = entry.queries()["network_map_connection"](spark, SF_SMALL)
    p = plan(df)
    assert p.count("WindowGroupLimit") == 4
    assert "CartesianProduct" not in p
