"""Edge rows for the views (the cases the synthetic facts do not cover)."""

from pyspark.sql import functions as F

from factbuilder import FactBuilder, ev


def test_two_votes_in_one_receipt(spark):
    fb = FactBuilder()
    fb.call("c1", "create_proposal", {"metadata": {"title": "T"}}, receiver="vote.hos.test",
            logs=[ev("create_proposal", proposal_id=7)])
    for i in range(2):
        fb.call("rv", "vote", {"proposal_id": 7, "vote": i}, receiver="vote.hos.test", index=i, sec=5,
                logs=[ev("add_vote", account_balance="10")])
    lake = fb.lake(spark)
    from govlake.plans.voting_history import all_votes
    assert all_votes(lake.silver, lake.cfg).count() == 2
    pvh = lake.proposal_voting_history().collect()
    assert len(pvh) == 1 and pvh[0]["proposal_name"] == "T"


def test_approved_twice_fans_out_and_snapshot_required(spark):
    fb = FactBuilder()
    fb.call("c1", "create_proposal", {"metadata": {"title": "T"}}, receiver="vote.hos.test",
            logs=[ev("create_proposal", proposal_id=1)])
    fb.call("c2", "create_proposal", {"metadata": {"title": "U"}}, receiver="vote.hos.test",
            logs=[ev("create_proposal", proposal_id=2)])
    for n, rid in enumerate(["a1", "a2"]):
        fb.call(rid, "approve_proposal", {"proposal_id": 1}, receiver="vote.hos.test", sec=10 + n,
                status="SuccessReceiptId", results={"receipt_id": f"s{rid}", "status_type": "SuccessReceiptId"})
        fb.call(f"s{rid}", "on_get_snapshot", {}, receiver="vote.hos.test", sec=10 + n,
                results={"snapshot_and_state": {"total_venear": "5"}, "voting_start_time_ns": "1000",
                         "voting_duration_ns": "9", "creation_time_ns": "2000"})
    # proposal 2 is approved but its snapshot callback is missing: not approved
    fb.call("a3", "approve_proposal", {"proposal_id": 2}, receiver="vote.hos.test", sec=20,
            status="SuccessReceiptId", results={"receipt_id": "nosnap", "status_type": "SuccessReceiptId"})
    fb.call("v1", "vote", {"proposal_id": 2, "vote": 0}, receiver="vote.hos.test", sec=30,
            logs=[ev("add_vote", account_balance="10")])
    props = fb.lake(spark).proposals()
    p1 = props.where("proposal_id = 1").collect()
    assert len(p1) == 2 and all(r["is_approved"] for r in p1)
    p2 = props.where("proposal_id = 2").collect()
    assert len(p2) == 1 and not p2[0]["is_approved"] and p2[0]["num_for_votes"] == 0
    assert p2[0]["listagg_distinct_voters"] is None


def test_activity_logs_null_vs_empty(spark):
    fb = FactBuilder()
    fb.call("n1", "on_lockup_update", {}, logs=None)
    fb.call("n2", "on_lockup_update", {}, logs=[])
    fb.call("d1", "delegate_all", {"receiver_id": "x.near"}, logs=None)
    fb.call("d2", "undelegate", {}, logs=[])
    fb.call("d3", "delegate_all", {"receiver_id": "x.near"}, outcome=False)
    fb.call("l1", "lock_near", {"amount": "5"}, receiver="nodot")
    fb.call("l2", "lock_near", {"amount": "5"}, receiver="lk.v.hos.test")
    ua = fb.lake(spark).user_activities()
    rows = {r["receipt_id"]: r for r in ua.collect()}
    assert "n1" not in rows and "n2" not in rows           # inner unnest drops both
    assert {"d1", "d2", "d3"} <= set(rows)                  # outer unnest keeps both, missing outcome kept
    assert rows["d3"]["event_status"] is None and rows["d1"]["event_type"] == "delegate_all"
    assert "l1" not in rows and rows["l2"]["hos_contract_address"] == "v.hos.test"
    assert rows["l2"]["event_type"] == "lockup_lock_near" and rows["l2"]["near_amount"] == 5


def test_error_key_and_duplicate_delegator_timestamps(spark):
    fb = FactBuilder()
    bad = 'EVENT_JSON:{"error":"x","event":"ft_mint","data":[{"owner_id":"z.near","amount":"1"}]}'
    fb.call("e1", "delegate_all", {"receiver_id": "d.near"}, sec=1,
            logs=[bad, ev("ft_burn", owner_id="u1.near", amount="3")])
    fb.call("e2", "delegate_all", {"receiver_id": "d.near"}, sec=1,
            logs=[ev("ft_mint", owner_id="d.near", amount="4")])
    de = {r["receipt_id"]: r for r in fb.lake(spark).delegation_events().collect()}
    assert de["e1"]["owner_id"] is None and de["e1"]["delegate_event"] == "ft_burn"
    assert de["e1"]["near_amount"] == 3 and de["e2"]["near_amount"] == 4
    # equal timestamps: receipt id breaks the tie, exactly one latest
    assert [de["e1"]["is_latest_delegator_event"], de["e2"]["is_latest_delegator_event"]] == [False, True]


def _voter_setup(fb, voter, sec, lock=None):
    fb.call(f"reg-{voter}", "on_lockup_deployed", {"account_id": voter}, predecessor="v.hos.test", sec=sec,
            logs=[ev("lockup_deployed", account_id=voter, locked_near_balance=None)])
    fb.call(f"dep-{voter}", "storage_deposit", {"account_id": voter}, sec=sec,
            logs=[ev("ft_mint", owner_id=voter, amount="2000000000000000000000")])
    if lock:
        fb.call(f"lock-{voter}", "on_lockup_update", {}, predecessor="v.hos.test", sec=sec + 1,
                logs=[ev("lockup_update", account_id=voter, locked_near_balance=lock, timestamp="0")])


def test_registered_voters_rules(spark):
    fb = FactBuilder()
    fb.call("new1", "new", {"venear_growth_config": {"annual_growth_rate_ns": {
        "numerator": "1000000000", "denominator": "1000000000000000000000000000000"}}}, signer="v.hos.test")
    for n, v in enumerate(["a.near", "b.near", "c.near"]):
        _voter_setup(fb, v, 100 + n, lock="3000000000000000000000" if v == "b.near" else None)
    # a delegates to b; b delegates to c: b keeps its delegated balance but has power 0
    fb.call("dl-a", "delegate_all", {"receiver_id": "b.near"}, predecessor="a.near", sec=200,
            logs=[ev("ft_burn", owner_id="a.near", amount="1"), ev("ft_mint", owner_id="b.near", amount="1")])
    fb.call("dl-b", "delegate_all", {"receiver_id": "c.near"}, predecessor="b.near", sec=201,
            logs=[ev("ft_burn", owner_id="b.near", amount="1"), ev("ft_mint", owner_id="c.near", amount="1")])
    # c votes only on an old (not approved) proposal
    fb.call("vc", "vote", {"proposal_id": 99, "vote": 0}, receiver="vote.hos.test", predecessor="c.near", sec=300)
    rv = {r["registered_voter_id"]: r for r in fb.lake(spark).registered_voters().collect()}
    assert rv["a.near"]["proposal_participation_rate"] is None
    assert rv["c.near"]["proposal_participation_rate"] == 0.0
    assert rv["b.near"]["is_actively_delegating"] and rv["b.near"]["current_voting_power"] == 0
    assert rv["b.near"]["voting_power_from_delegations"] == 2000000000000000000000
    assert rv["b.near"]["principal_balance"] == 5000000000000000000000
    # reward: whole 1e21 units x whole seconds x numerator (denominator 1e30)
    secs_a = 86400 * 365 - 100
    assert rv["a.near"]["extra_venear_on_principal"] == 2 * secs_a * 1000000000
    secs_b = 1_735_603_200            # clock starts at the lock update timestamp (epoch 0) up to as_of
    assert rv["b.near"]["extra_venear_on_principal"] == 5 * secs_b * 1000000000
    assert rv["c.near"]["current_voting_power"] == (
        rv["c.near"]["principal_balance"] + rv["c.near"]["extra_venear_on_principal"]
        + rv["b.near"]["principal_balance"] + rv["b.near"]["extra_venear_on_principal"])


def test_non_voters_equal_the_plain_difference(spark):
    from govlake.plans.catalog import GovLake
    from govlake.plans.non_voters import proposal_non_voters
    from govlake.plans.proposals import proposal_ids
    from govlake.plans.voting_history import latest_votes
    lake = GovLake.from_events(spark, "/root/testdata/sf0.001")
    a = lake.proposal_non_voters()
    pids = [r[0] for r in lake.proposals().select("proposal_id").collect()]
    voters = [r[0] for r in lake.registered_voters().select("registered_voter_id").collect()]
    votes = {(r[0], r[1]) for r in lake.proposal_voting_history().select("proposal_id", "voter_id").collect()}
    want = sorted((str(p), v) for p in pids for v in voters if (p, v) not in votes)
    assert sorted((str(r["proposal_id"]), r["registered_voter_id"]) for r in a.collect()) == want
    ids, latest = proposal_ids(lake.silver, lake.cfg), latest_votes(lake.silver, lake.cfg)
    compact = proposal_non_voters(ids, lake.registered_voters(), latest, compact=True)
    assert sorted((str(p), r["registered_voter_id"]) for r in compact.collect() for p in r["proposal_ids"]) == sorted(set(want))
    some = proposal_non_voters(ids, lake.registered_voters(), latest, only=ids.limit(1))
    assert len({r["proposal_id"] for r in some.collect()}) == 1


def test_two_growth_configs_double_voters_and_amount_text(spark):
    fb = FactBuilder()
    for n in range(2):
        fb.call(f"new{n}", "new", {"venear_growth_config": {"annual_growth_rate_ns": {
            "numerator": "1", "denominator": "1000000000000000000000000000000"}}}, signer="v.hos.test", sec=n)
    _voter_setup(fb, "a.near", 10)
    assert fb.lake(spark).registered_voters().count() == 2      # not de-duplicated, as in the reference
    fb = FactBuilder()
    for rid, amount in [("x38", "9" * 38), ("x39", "9" * 39), ("half", "1.5"), ("bad", "abc")]:
        fb.call(rid, "begin_unlock_near", {"amount": amount}, receiver="lk.v.hos.test")
    got = {r["receipt_id"]: r["near_amount"] for r in fb.lake(spark).user_activities().collect()}
    assert got["x38"] == int("9" * 38) and got["x39"] is None and got["half"] == 2 and got["bad"] is None


def test_non_voters_keep_repeats_and_nulls(spark):
    from collections import Counter

    from govlake.plans.non_voters import proposal_non_voters
    pids = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (3,)], "proposal_id bigint")
    voters = spark.createDataFrame([("a",), ("b",), ("b",)], "registered_voter_id string")
    votes = spark.createDataFrame([(1, "a"), (3, "b"), (9, "a"), (None, "a")], "proposal_id bigint, voter_id string")
    got = Counter((r["proposal_id"], r["registered_voter_id"]) for r in proposal_non_voters(pids, voters, votes).collect())
    assert got == Counter({(2, "a"): 1, (3, "a"): 1, (None, "a"): 2, (1, "b"): 4, (2, "b"): 2, (None, "b"): 4})



def test_duplicate_recent_approval_counts_twice_unless_distinct(spark):
    from govlake.plans.registered_voters import registered_voters
    fb = FactBuilder()
    _voter_setup(fb, "a.near", 10)
    for n in range(2):
        fb.call(f"ap{n}", "approve_proposal", {"proposal_id": 1}, receiver="vote.hos.test", sec=20 + n,
                status="SuccessReceiptId", results={"receipt_id": f"s{n}", "status_type": "SuccessReceiptId"})
    fb.call("v1", "vote", {"proposal_id": 1, "vote": 0}, receiver="vote.hos.test", predecessor="a.near", sec=30)
    lake = fb.lake(spark)
    args = (lake.silver, lake.cfg, lake.proposal_voting_history(), lake.delegation_events(), lake.approved_proposals())
    assert registered_voters(*args).first()["proposal_participation_rate"] == 0.2
    assert registered_voters(*args, distinct_recent=True).first()["proposal_participation_rate"] == 0.1
