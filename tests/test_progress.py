"""Interval sets against plain sets; ranges over batches, retries and a crash; observed metrics of a stream."""

import random

import pytest

from govlake.operators.intervals import gaps, merge_intervals
from govlake.sources.blockfeed import nested_blocks
from govlake.streaming.ingest import start_ingest
from govlake.streaming.progress import ProcessedRanges, batch_metrics


def islands(heights):
    out = []
    for h in sorted(heights):
        if out and out[-1][1] == h - 1:
            out[-1][1] = h
        else:
            out.append([h, h])
    return [tuple(x) for x in out]


def test_merge_and_gaps(spark, monkeypatch):
    from govlake.operators import intervals
    rng = random.Random(1)
    for width in (1, 20, 500):
        monkeypatch.setattr(intervals, "LEAST_WIDTH", width)
        spans = [(a, a + rng.choice([0, 0, 1, 3, 90])) for a in rng.sample(range(3000), 250)] + [(10, 10), (10, 12), (10, 10)]
        df = spark.createDataFrame(spans, "first bigint, last bigint")
        want = islands({h for a, b in spans for h in range(a, b + 1)})
        merged = merge_intervals(df)
        assert sorted(map(tuple, merged.collect())) == want
        assert sorted(map(tuple, gaps(merged).collect())) == [(a[1] + 1, b[0] - 1, b[0] - a[1] - 1) for a, b in zip(want, want[1:])]
    assert merge_intervals(df.where("false")).collect() == []


def test_ranges_over_batches(spark, tmp_path, monkeypatch):
    ranges, rng, done = ProcessedRanges(spark, str(tmp_path)), random.Random(2), set()
    for _ in range(4):
        heights = rng.sample(range(100), 30)
        done |= set(heights)
        for _ in range(rng.randint(1, 2)):  # a batch that is repeated changes nothing
            ranges.add("v1", spark.createDataFrame([(h,) for h in heights], "height bigint"))
        assert sorted(map(tuple, ranges.read("v1").collect())) == islands(done)
    from govlake.streaming import progress
    with monkeypatch.context() as m:  # a write that dies half-way leaves the last complete set
        m.setattr(progress, "merge_intervals", lambda df: df.selectExpr("first", "raise_error('lost') AS last"))
        with pytest.raises(Exception):
            ranges.add("v1", spark.createDataFrame([(5000,)], "height bigint"))
    assert sorted(map(tuple, ranges.read("v1").collect())) == islands(done)
    ranges.add("v2", spark.createDataFrame([(7,), (9,)], "height bigint"))
    assert ranges.versions() == ["v1", "v2"]
    assert [tuple(r) for r in ranges.silent_gaps().where("app_version = 'v2'").collect()] == [("v2", 8, 8, 1)]


def test_batch_metrics_outlive_the_stream(spark, tmp_path):
    import datetime as dt
    import time

    from govlake.config import ContractConfig
    d = str(tmp_path)
    records = nested_blocks(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    for low, high in ((1000, 1040), (1041, 1101)):
        records.where(f"block.header.height BETWEEN {low} AND {high}").coalesce(1).write.mode("append").parquet(d + "/landing")
    q = start_ingest(spark, d + "/landing", d + "/lake", ContractConfig(as_of=dt.datetime(2024, 3, 1)), max_files_per_trigger=1, checkpoint=d + "/ck")
    q.awaitTermination()
    for _ in range(100):  # progress events come on a thread of their own
        rows = batch_metrics(spark, d + "/lake").orderBy("batch_id").collect()
        if len(rows) == 2:
            break
        time.sleep(0.2)
    assert [(r["app_version"], r["blocks"], r["first_height"], r["last_height"], r["rejects"]) for r in rows] == [
        ("v1", 41, 1000, 1040, 0), ("v1", 59, 1041, 1100, 0)]
    newest = spark.read.parquet(d + "/lake/blocks").agg({"timestamp": "max"}).first()[0]
    assert rows[1]["age_seconds"] == pytest.approx((dt.datetime(2024, 3, 1) - newest).total_seconds())
    assert all(r["blocks_per_second"] > 0 for r in rows)
