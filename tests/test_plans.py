"""Plan-shape checks that guard the scale design (no execution of the queries)."""

import pytest

SF = "/root/testdata/sf0.001"
VIEWS = ["delegation_events", "proposal_voting_history", "proposals", "approved_proposals", "registered_voters",
         "user_activities", "proposal_non_voters"]


def _plan(df) -> str:
    # a fresh projection gets its own (not yet executed) physical plan, even when the
    # DataFrame object itself already ran in an earlier test
    return df.select(*df.columns)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    import __spark_entry__ as E
    return {name: _plan(fn(spark, SF)) for name, fn in E.queries().items()}


def test_no_cartesian_or_nested_loop_join(plans):
    bad = [n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p]
    assert not bad, bad


def test_views_prune_silver_by_method(plans):
    for name in VIEWS:
        # silver is the only table scanned with both method_part and height_bucket partition columns
        scans = [seg for seg in plans[name].split("FileScan")[1:]
                 if "method_part#" in seg.split("\n")[0] and "height_bucket#" in seg.split("\n")[0]]
        assert scans, name
        for seg in scans:
            line = seg.split("\n")[0]
            assert "method_part" in line.split("PartitionFilters: [")[1].split("]")[0], (name, line[:300])


def test_latest_vote_uses_partial_top1(plans):
    assert plans["proposal_voting_history"].count("WindowGroupLimit") >= 2  # partial before, final after exchange


def test_flatten_has_no_shuffle(plans):
    for name in ["actions_flatten", "outcomes_flatten", "blocks_table", "contract_filter"]:
        assert "Exchange" not in plans[name], name


def test_user_activities_single_aggregate(plans):
    p = plans["user_activities"]
    assert p.count("Exchange hashpartitioning") <= 1 and "Union" in p


def test_method_and_height_filters_reach_the_scan(spark):
    import __spark_entry__ as e
    lake = e._lake(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")  # plans cut long filters short
    try:
        ua = lake.user_activities().where("method_name in ('unstake', 'unstake_all') and block_height > 1050")
        plan = ua._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [x.split("\n")[0] for x in plan.split("FileScan")[1:] if "method_part#" in x.split("\n")[0]]
    assert len(scans) == 2  # the branches of one row per call or log line, and the grouped branch
    for line in scans:
        folders = line.split("PartitionFilters: [")[1].split("PushedFilters")[0]
        assert "IN (unstake,unstake_all)" in folders, folders
        assert "GreaterThan(block_height,1050)" in line.split("PushedFilters: [")[1]
    assert any("= on_lockup_update)" in line for line in scans)  # a contradiction there: no folder is read


def test_registered_voters_are_planned_once(spark):
    import __spark_entry__ as e
    lake = e._lake(spark, "/root/testdata/sf0.001")
    plan = lake.registered_voters()._jdf.queryExecution().optimizedPlan().toString()
    silver = plan.count("Relation [")
    assert "events.parquet" not in plan and "scalar-subquery" not in plan
    assert silver <= 7, silver  # voter events, growth rates, votes, approvals, titles, delegations (flag join reads twice)


def test_non_voters_build_runs_no_job(spark):
    import __spark_entry__ as e
    lake = e._lake(spark, "/root/testdata/sf0.001")
    lake.silver  # written before
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "no job may run here")
    try:
        lake.proposal_non_voters()
        lake.register_views("planonly_")
        assert list(tracker.getJobIdsForGroup("plan-only")) == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_active_proposals_collect_no_voters(spark):
    import __spark_entry__ as e
    from govlake.plans.proposals import active_proposals
    lake = e._lake(spark, "/root/testdata/sf0.001")
    assert "collect_set" not in active_proposals(lake.proposals())._jdf.queryExecution().optimizedPlan().toString()
