"""Invariants across views and a property check of the strict JSON rule."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    from govlake.plans.catalog import GovLake
    return GovLake.from_events(spark, SF).materialize(str(tmp_path_factory.mktemp("lake")))


def test_at_most_one_latest_flag_per_delegator(lake):
    de = lake.delegation_events()
    per = de.groupBy("delegator_id").agg(F.sum(F.col("is_latest_delegator_event").cast("int")).alias("n"))
    assert per.where("n <> 1").count() == 0


def test_vote_totals_add_up_to_latest_votes(lake):
    from govlake.plans.proposals import proposal_votes
    from govlake.plans.voting_history import latest_votes, proposal_metadata
    pvh = lake.proposal_voting_history()
    pv = proposal_votes(latest_votes(lake.silver, lake.cfg), proposal_metadata(lake.silver, lake.cfg)).agg(F.sum(F.col("num_for_votes") + F.col("num_against_votes")
                                       + F.col("num_abstain_votes"))).first()[0]
    assert pv == pvh.where(F.col("vote_option").isin(0, 1, 2)).count()


def test_latest_vote_is_unique_per_proposal_and_voter(lake):
    pvh = lake.proposal_voting_history()
    assert pvh.count() == pvh.select("proposal_id", "voter_id").distinct().count()


def test_replaying_the_same_blocks_changes_nothing(lake):
    from govlake.operators.upsert import upsert_frames
    a = lake.facts.actions
    again = upsert_frames(a, lake.flat.actions, ["id"])
    assert again.exceptAll(a).count() == 0 and a.exceptAll(again).count() == 0


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-10**12, 10**12) | st.text(max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=5), inner, max_size=3),
    max_leaves=8)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(json_values, min_size=5, max_size=30))
def test_strict_parse_agrees_with_a_json_parser(spark, values):
    from govlake.functions.json import parse_json_strict
    texts = []
    for v in values:
        t = json.dumps(v)
        texts += [t, t + " x", t + "}", "'" + t]
    expected = []
    for t in texts:
        try:
            json.loads(t)
            expected.append(True)
        except ValueError:
            expected.append(False)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["ok"] for r in rows.select("i", parse_json_strict(F.col("t")).isNotNull().alias("ok")).collect()}
    # duplicate keys are the one documented deviation; json.dumps never produces them
    assert [got[i] for i in range(len(texts))] == expected
