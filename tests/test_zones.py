"""The zone log, the height-ordered source and the replay of a range."""

import os

import pytest
from pyspark.sql import functions as F

from govlake.plans.catalog import GovLake
from govlake.sources.blockfeed import nested_blocks
from govlake.sources.tables import read_facts
from govlake.sources.zones import files_by_height, index_landing
from govlake.streaming.ingest import replay, start_ordered_ingest, zone_log

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def records(spark):
    return nested_blocks(spark.read.parquet(f"{SF}/events.parquet")).persist()


def land(records, landing, low, high):
    part = records.where(F.col("block.header.height").between(low, high))
    before = set(os.listdir(landing)) if os.path.isdir(landing) else set()
    part.coalesce(1).write.mode("append").parquet(landing)
    new = [f for f in os.listdir(landing) if f.endswith(".parquet") and f not in before]
    assert len(new) == 1


def run(spark, d, lag, seen):
    def note(batch, batch_id):
        seen.append([(r["lowest"], r["highest"]) for r in batch.orderBy("lowest").collect()])

    q = files_by_height(spark, d + "/landing", d + "/zones", lag).writeStream.foreachBatch(note).option(
        "checkpointLocation", d + "/ck").trigger(availableNow=True).start()
    q.awaitTermination()


def test_files_come_in_order_of_height(spark, records, tmp_path):
    d, seen = str(tmp_path), []
    land(records, d + "/landing", 1040, 1059)
    land(records, d + "/landing", 1000, 1019)
    run(spark, d, 25, seen)
    assert sum(seen, []) == [(1000, 1019)]  # the other one ends within the lag
    land(records, d + "/landing", 1020, 1039)
    land(records, d + "/landing", 1060, 1069)
    run(spark, d, 25, seen)
    assert sum(seen, []) == [(1000, 1019), (1020, 1039)]
    land(records, d + "/landing", 1070, 1101)
    run(spark, d, 25, seen)  # a new reader after a restart: nothing lost, nothing twice
    assert sum(seen, []) == [(1000, 1019), (1020, 1039), (1040, 1059), (1060, 1069)]
    land(records, d + "/landing", 1010, 1012)  # later than the lag: in a later batch
    run(spark, d, 0, seen)
    assert seen[-1] == [(1010, 1012), (1070, 1100)]
    run(spark, d, 0, seen)
    assert sum(map(len, seen)) == 6


def test_ordered_ingest_equals_batch(spark, records, tmp_path):
    d = str(tmp_path)
    for low, high in [(1070, 1101), (1000, 1029), (1030, 1069)]:
        land(records, d + "/landing", low, high)
    start_ordered_ingest(spark, d + "/landing", d + "/lake", checkpoint=d + "/ck", files_at_once=2).awaitTermination()
    got, want = read_facts(spark, d + "/lake"), GovLake.from_events(spark, SF).facts
    for name in ["blocks", "actions", "outcomes"]:
        a, b = getattr(got, name), getattr(want, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    # taken in order of height, only the feed's own break is found, though the highest file landed first
    found = {r["height"] for r in spark.read.parquet(d + "/lake/chain_findings").collect()}
    assert found == {r["height"] for r in want.blocks.where("prev_hash = md5('x')").collect()}


def test_replay_reads_only_the_files_of_its_range(spark, records, tmp_path, monkeypatch):
    d, read = str(tmp_path), []
    for low, high in [(1000, 1029), (1030, 1069), (1070, 1101)]:
        land(records, d + "/landing", low, high)
    from govlake.streaming import ingest
    landed = ingest._landed
    monkeypatch.setattr(ingest, "_landed", lambda s, files, fmt: read.append(files) or landed(s, files, fmt))
    replay(spark, d + "/landing", d + "/lake", 1035, app_version="r", end_height=1040)
    assert len(read) == 1 and len(read[0]) == 1
    heights = sorted(r["height"] for r in read_facts(spark, d + "/lake").blocks.collect())
    assert heights == [h for h in range(1035, 1041)]
    replay(spark, d + "/landing", d + "/lake", 5000, app_version="r")
    assert len(read) == 1  # no file overlaps
    log = index_landing(spark, d + "/landing", zone_log(d + "/lake"))
    by_uri = index_landing(spark, "file:" + d + "/landing/", "file://" + d + "/other")
    assert by_uri.files_between(None, 1029) == ["file:" + f for f in log.files_between(None, 1029)]
    assert [len(log.files_between(*r)) for r in [(None, None), (None, 1029), (1029, 1030), (1102, None)]] == [3, 1, 2, 0]


def test_json_files_are_noted_by_spark(spark, tmp_path):
    import json
    d = str(tmp_path)
    os.makedirs(d + "/landing")
    for name, heights in (("a b.json", [5, 9]), ("c.json", [20])):
        lines = [json.dumps({"block": {"author": "n", "header": {"height": h, "hash": f"h{h}", "prev_hash": "p", "timestamp_nanosec": 1,
                                                                 "gas_price": "1", "total_supply": "1"}}, "shards": []}) for h in heights]
        with open(f"{d}/landing/{name}", "w") as f:
            f.write("\n".join(lines))
    log = index_landing(spark, d + "/landing", d + "/zones", "json")
    assert [os.path.basename(f) for f in log.files_between(6, 10)] == ["a b.json"]
    assert len(log.entries()) == 1 and index_landing(spark, d + "/landing", d + "/zones", "json").new_files() == {}
