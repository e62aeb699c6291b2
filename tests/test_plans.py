"""Plan-shape invariants of every registered query (scale guards).

* the scan pushes the event-type filter and reads a pruned schema;
* no window runs over a whole key of raw rows: row-level windows partition
  by (key, chunk); windows partitioned by a bare key only order a chunk
  summary (ordered by chunk);
* no unpartitioned window and no single-partition exchange outside a scalar
  subquery (global max as a partial + final aggregate).
"""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as ep
from conftest import SMALL
from fleetlens.plans import BATCH_QUERIES

NAMES = sorted(BATCH_QUERIES)


def _plan(spark, name) -> str:
    df = ep.queries()[name](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_scan_pushes_filter_and_prunes(spark, name):
    plan = _plan(spark, name)
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln or "Scan parquet" in ln]
    assert scans, plan
    events_scans = [ln for ln in scans if "events.parquet" in ln]
    assert events_scans, plan
    for ln in events_scans:
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", ln)
        assert pushed and "event_type" in pushed.group(1), ln
        schema = re.search(r"ReadSchema: struct<([^>]*?)(?:>|\.\.\.)", ln)
        assert schema and "event_type" in schema.group(1), ln


@pytest.mark.parametrize("name", NAMES)
def test_no_window_over_a_whole_key(spark, name):
    plan = _plan(spark, name)
    for ln in plan.splitlines():
        m = re.search(r"Window \[.*\], \[(.*?)\], \[(.*?)\]\s*$", ln)
        if not m:
            continue
        partition, order = m.group(1), m.group(2)
        assert partition.strip(), f"unpartitioned window: {ln}"
        if "_chunk" not in partition:
            assert order.startswith("_chunk"), f"window over raw rows of a key: {ln}"


@pytest.mark.parametrize("name", NAMES)
def test_single_partition_only_in_scalar_subqueries(spark, name):
    lines = _plan(spark, name).splitlines()
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" in ln:
            context = "\n".join(lines[max(0, i - 3) : i])
            assert "Subquery" in context and "HashAggregate(keys=[]" in context, context


CHUNKED = ["passenger_deltas", "route_occupancy_changelog", "late_fares", "offgrid_gaps"]


@pytest.mark.parametrize("name", CHUNKED)
def test_carry_join_keeps_row_partitioning_without_broadcast(spark, name):
    """When the carry table is too large to broadcast, the sort-merge join
    must reuse the rows' (key, chunk) partitioning: no exchange directly above
    a row-level window."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        lines = _plan(spark, name).splitlines()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert any("SortMergeJoin" in ln for ln in lines)
    for i, ln in enumerate(lines[:-1]):
        if "Exchange hashpartitioning" in ln:
            child = lines[i + 1]
            m = re.search(r"Window \[.*\], \[(.*?)\], \[", child)
            assert not (m and "_chunk" in m.group(1) and "ORDER" not in child), f"re-shuffled rows: {ln}"


@pytest.mark.parametrize(
    "name, exchanges",
    [
        ("passenger_deltas", 3),
        ("late_fares", 3),
        ("sacco_revenue", 1),
        ("sacco_revenue_emitted", 5),
        ("route_occupancy", 5),
        ("route_occupancy_changelog", 6),
    ],
)
def test_source_is_read_and_shuffled_once(spark, name, exchanges):
    """Rows and chunk edges share one scan and one exchange of the rows."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = _plan(spark, name)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plan.count("FileScan parquet") == 1, plan
    own = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln and "ReusedExchange" not in ln]
    assert len(own) <= exchanges, plan


def test_building_a_query_runs_no_job(spark):
    sc = spark.sparkContext
    sc.setJobGroup("plan-building", "plan-building")
    try:
        for name in NAMES:
            ep.queries()[name](spark, SMALL)
        # reading a file's schema is the only job that building may start
        jobs = sc.statusTracker().getJobIdsForGroup("plan-building")
        stages = [s for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds]
        tasks = [sc.statusTracker().getStageInfo(s) for s in stages]
        assert all(t is None or t.numTasks == 1 for t in tasks)
        assert len(jobs) <= len(NAMES) * 3
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", ["vehicle_snapshots", "last_seen", "offgrid_as_of"])
def test_latest_rows_sort_no_raw_row(spark, name):
    """Raw rows are hash-aggregated: no sort aggregate, and no sort below the
    first exchange."""
    plan = ep.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Sort [" in line:  # every sort stands above an exchange, not on a scan
            below = []
            for x in lines[i + 1 :]:
                if depth(x) <= depth(line):
                    break
                below.append(x)
            assert any("Exchange" in x for x in below)


def test_offgrid_lines_are_formatted_once_a_gap(spark):
    """Time formatting stands below the expansion into ticks."""
    plan = ep.queries()["offgrid_messages"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate explode", 1)
    assert "date_format" not in above.lower() and "date_format" in below.lower()
