"""In-order chain validation: batch and stream against the rule taken block by block."""

import os
import random

import pytest

from govlake.plans.chain import accepted_blocks, chain_state, reached
from govlake.streaming.chain import Chain, chain_status, drop_orphans, start_chain_validation

HEADERS = "height bigint, hash string, prev_hash string"


def in_order(blocks):
    """The rule, one block after the other: (height, hash, prev_hash, expected, accepted)."""
    last, out = None, []
    for height, own, prev in sorted(blocks):
        good = last is None or prev == last
        out.append((height, own, prev, last, good))
        last = own if good else last
    return out


def random_feed(rng, n, repeat_hashes=False):
    """Forks, orphans, relinks, gaps, null parents, sometimes hashes that occur twice."""
    heights = sorted(rng.sample(range(1, 40 * n + 2), n))
    hashes = [f"h{i if not repeat_hashes else rng.randrange(max(1, n // 2))}" for i in range(n)]
    out = []
    for i, h in enumerate(heights):
        back = rng.choice([1, 1, 1, 1, 2, 3, 7])
        prev = hashes[i - back] if i >= back else None
        out.append((h, hashes[i], rng.choice([prev] * 12 + ["nowhere", None])))
    return out


@pytest.mark.parametrize("repeat_hashes", [False, True])
def test_batch_rule(spark, repeat_hashes):
    rng = random.Random(7 + repeat_hashes)
    for n in (0, 1, 2, 60, 300):
        feed = random_feed(rng, n, repeat_hashes)
        blocks = spark.createDataFrame([(*b, "x") for b in rng.sample(feed, len(feed))], HEADERS + ", author string")
        want = in_order(feed)
        assert sorted(map(tuple, chain_state(blocks).collect())) == want
    assert sorted(r["height"] for r in accepted_blocks(blocks).collect()) == [w[0] for w in want if w[4]]
    assert accepted_blocks(blocks).columns == blocks.columns


def test_no_disturbance_is_one_segment(spark, monkeypatch):
    """A sound chain needs one round of doubling whatever its length."""
    from govlake.plans import chain
    rounds = []
    monkeypatch.setattr(chain, "reached", lambda links, first: rounds.append(links.count()) or reached(links, first))
    blocks = spark.range(1, 3001).selectExpr("id AS height", "concat('h', id) AS hash", "concat('h', id - 1) AS prev_hash")
    assert chain.accepted_heights(blocks).count() == 3000 and rounds == [0]


def test_reached_follows_long_paths(spark):
    links = spark.range(0, 700).selectExpr("id AS node", "id + 1 AS to").where("node <> 650")
    got = reached(links, spark.createDataFrame([(3,)], "node bigint"))
    assert sorted(r["node"] for r in got.collect()) == list(range(3, 651))


def test_late_blocks_within_the_lag(spark):
    """With a lag, blocks that arrive late give the same accepted chain as in order; state holds no more than the lag."""
    rng = random.Random(5)
    for _ in range(200):
        feed = [(h, f"h{h}", f"h{h - 1}" if rng.random() < 0.9 else "nowhere") for h in range(1, 60)]
        arrival = sorted(feed, key=lambda b: b[0] + rng.random() * 6) if rng.random() < 0.7 else feed
        arrival = [feed[0], *[b for b in arrival if b[0] != 1]]
        state, out = (None, -1, {}), []
        at = 0
        while at < len(arrival):
            step = rng.randint(1, 9)
            chain = Chain(6, *state)
            out += chain.take(arrival[at:at + step])
            assert all(h + 6 > chain.top for h in chain.waiting)
            state, at = (chain.last, chain.top, chain.waiting), at + step
        accepted = [d[0] for d in out if d[4] == "accepted"]
        assert accepted == sorted(accepted)
        assert accepted == [w[0] for w in in_order(feed) if w[4]]


def _land(spark, path, rows):
    spark.createDataFrame(rows, HEADERS).coalesce(1).write.mode("append").parquet(path)


def test_stream_over_batches_and_a_restart(spark, tmp_path):
    d = str(tmp_path)
    feed = random_feed(random.Random(11), 120)

    def run():
        headers = spark.readStream.schema(HEADERS).option("maxFilesPerTrigger", 1).parquet(d + "/headers")
        start_chain_validation(spark, headers, d + "/lake", checkpoint=d + "/ck").awaitTermination()

    _land(spark, d + "/headers", feed[:40])
    _land(spark, d + "/headers", feed[40:41])
    run()
    _land(spark, d + "/headers", feed[41:])
    run()
    want = in_order(feed)
    got = sorted((r["height"], r["hash"], r["prev_hash"], r["expected_prev_hash"], r["status"] == "accepted")
                 for r in chain_status(spark, d + "/lake").collect())
    # an orphan leaves when its batch ends, so only its decision is compared
    assert [(g[0], g[4]) for g in got] == [(w[0], w[4]) for w in want]
    assert [g for g in got if g[4]] == [w for w in want if w[4]]
    # blocks delivered again are late up to the last accepted height, rejected again above it, and change nothing
    top = max(w[0] for w in want if w[4])
    _land(spark, d + "/headers", feed[:40])
    run()
    status = chain_status(spark, d + "/lake")
    assert status.where("status = 'late'").count() == sum(b[0] <= top for b in feed[:40])
    facts = spark.createDataFrame([(b[0], "a") for b in feed], "block_height bigint, id string")
    left = sorted(r["block_height"] for r in drop_orphans(facts, status, "block_height").collect())
    assert left == [w[0] for w in want if w[4]]
    assert os.path.isdir(d + "/ck/state")
