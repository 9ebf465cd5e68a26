"""Streaming gauges over restarts equal the batch reports; voters of a hot proposal come in ranges."""

from pyspark.sql import functions as F

from govlake.plans.proposals import proposal_votes
from govlake.plans.quality import block_rate
from govlake.streaming.gauges import block_gauges, start_gauges


def test_gauges_over_restarts_equal_the_batch_reports(spark, tmp_path):
    d = str(tmp_path)
    blocks = spark.range(2345).select(
        (F.col("id") * 3 + F.col("id") % 7).alias("height"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id + (id * id) % 5)").alias("timestamp"),
        F.lit("h").alias("hash"), F.lit("p").alias("prev_hash")).dropDuplicates(["height"]).persist()
    for low, high in ((0, 900), (900, 905), (905, 4000), (4000, 99999)):
        blocks.where(F.col("height").between(low, high - 1)).select("height", "timestamp").coalesce(1).write.mode("append").parquet(d + "/in")
        stream = spark.readStream.schema("height bigint, timestamp timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(d + "/in")
        start_gauges(spark, stream, d + "/lake", checkpoint=d + "/ck").awaitTermination()
    got = block_gauges(spark, d + "/lake", F.lit("2024-03-01").cast("timestamp_ntz"))
    rate = got.select("height", "window_blocks", "blocks_per_second")
    want = block_rate(blocks)
    assert rate.exceptAll(want).count() == 0 and want.exceptAll(rate).count() == 0
    rows = got.orderBy("height").collect()
    heights = [r["height"] for r in rows]
    assert [r["block_no"] for r in rows] == list(range(1, len(rows) + 1))
    assert [(r["range_first"], r["range_last"]) for r in rows if r["range_last"] is not None] == [
        (heights[0], heights[999]), (heights[1000], heights[1999])]
    assert [r["block_no"] for r in rows if r["block_age_seconds"] is not None] == list(range(10, len(rows) + 1, 10))


def test_voter_lists_are_in_order_and_come_in_ranges(spark):
    names = ["a", "ab", "abcd", "abcde", "abc", "b", "", "é.near", "zz", "abcd.near", "Ab", "ab€x", "ab€y", "😀"] + [f"user{i}.near" for i in range(300)]
    votes = spark.createDataFrame([(1, n, 0, 5) for n in names] + [(2, None, 1, 3), (3, "x", 2, None)],
                                  "proposal_id long, voter_id string, vote_option int, voting_power int")
    titles = spark.createDataFrame([(1,), (1,), (3,)], "proposal_id long")
    out = {r["proposal_id"]: r for r in proposal_votes(votes, titles).collect()}
    assert out[1]["listagg_distinct_voters"] == ", ".join(sorted(names, key=lambda n: n.encode()))
    assert (out[1]["num_distinct_voters"], out[1]["num_for_votes"], out[1]["for_voting_power"]) == (len(names), 2 * len(names), 10 * len(names))
    assert out[2]["listagg_distinct_voters"] is None and out[2]["num_distinct_voters"] == 0 and out[2]["num_against_votes"] == 1
    assert out[3]["listagg_distinct_voters"] == "x" and out[3]["abstain_voting_power"] is None or out[3]["abstain_voting_power"] == 0
    plan = proposal_votes(votes, titles)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan
    without = proposal_votes(votes, titles).select("num_for_votes")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in without
