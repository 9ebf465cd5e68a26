"""Streaming ingest over split landing files equals the batch flatten; replay is idempotent."""

from govlake.plans.catalog import GovLake
from govlake.sources.blockfeed import nested_blocks
from govlake.sources.tables import read_facts
from govlake.streaming import start_ingest


def test_stream_equals_batch_and_replay_is_idempotent(spark, tmp_path):
    d = str(tmp_path)
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    nested_blocks(ev).repartitionByRange(3, "block.header.height").write.parquet(d + "/landing")
    q = start_ingest(spark, d + "/landing", d + "/lake", max_files_per_trigger=1, checkpoint=d + "/ck1")
    q.awaitTermination()
    want = GovLake.from_events(spark, "/root/testdata/sf0.001").facts
    got = read_facts(spark, d + "/lake")
    for name in ["blocks", "actions", "outcomes"]:
        a, b = getattr(got, name), getattr(want, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    q = start_ingest(spark, d + "/landing", d + "/lake", app_version="v2", max_files_per_trigger=3,
                     checkpoint=d + "/ck2")
    q.awaitTermination()
    again = read_facts(spark, d + "/lake")
    assert again.actions.count() == want.actions.count()
    cur = {r["id"]: r["block_num"] for r in spark.read.parquet(d + "/lake/cursors").collect()}
    assert set(cur) == {"v1", "v2"}
    # the views over the stream-ingested tables equal the views over the batch facts
    import datetime as dt

    from govlake.config import ContractConfig
    cfg = ContractConfig(as_of=dt.datetime(2024, 3, 1))
    a = GovLake.from_tables(spark, d + "/lake", cfg)
    b = GovLake(spark, want, cfg)
    for view in ["proposals", "registered_voters", "user_activities"]:
        x, y = getattr(a, view)(), getattr(b, view)()
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, view


def test_replay_and_resume(spark, tmp_path):
    from govlake.streaming import replay, resume_start
    d = str(tmp_path)
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    nested_blocks(ev).write.parquet(d + "/landing")
    assert resume_start(spark, d + "/lake", "v1", None, 5) == 5
    replay(spark, d + "/landing", d + "/lake", 1050, app_version="v1")
    got = read_facts(spark, d + "/lake")
    want = GovLake.from_events(spark, "/root/testdata/sf0.001").facts
    assert got.blocks.count() == want.blocks.where("height >= 1050").count()
    assert resume_start(spark, d + "/lake", "v1") == want.blocks.agg({"height": "max"}).first()[0] + 1
    assert resume_start(spark, d + "/lake", "v1", 7) == 7


def _landing(spark, path, rows, mode="append"):
    rows.coalesce(1).write.mode(mode).parquet(path)


def _records(spark):
    return nested_blocks(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))


def _same(got, want):
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_lower_blocks_that_land_after_a_stop_are_stored(spark, tmp_path):
    d, height = str(tmp_path), "block.header.height"
    records = _records(spark)
    _landing(spark, d + "/landing", records.where(f"{height} >= 1050"))
    start_ingest(spark, d + "/landing", d + "/lake", checkpoint=d + "/ck").awaitTermination()
    _landing(spark, d + "/landing", records.where(f"{height} < 1050"))
    start_ingest(spark, d + "/landing", d + "/lake", checkpoint=d + "/ck").awaitTermination()
    got, want = read_facts(spark, d + "/lake"), GovLake.from_events(spark, "/root/testdata/sf0.001").facts
    for name in ["blocks", "actions", "outcomes"]:
        _same(getattr(got, name), getattr(want, name))
    # the cursor names the last processed block, which is not the highest
    from govlake.streaming.ingest import cursors
    assert cursors(spark, d + "/lake").first()["block_num"] == want.blocks.where("height < 1050").agg({"height": "max"}).first()[0]


def test_replay_reports_only_real_breaks(spark, tmp_path):
    from govlake.streaming import replay
    d = str(tmp_path)
    _landing(spark, d + "/landing", _records(spark))
    replay(spark, d + "/landing", d + "/lake", 0, app_version="v1")
    replay(spark, d + "/landing", d + "/lake", 1030, app_version="v1")
    runs = {}
    for r in spark.read.parquet(d + "/lake/chain_findings").collect():
        runs.setdefault(r["batch_id"], set()).add(r["height"])
    assert len(runs) == 2 and len({frozenset(x) for x in runs.values()}) == 1  # both runs find the same break


def test_unreadable_table_raises_and_changes_nothing(spark, tmp_path):
    import os

    import pytest

    from govlake.streaming.ingest import ingest_batch
    d = str(tmp_path)
    records = _records(spark)
    ingest_batch(spark, records, 0, d + "/lake")
    before = sorted(r["id"] for r in read_facts(spark, d + "/lake").actions.collect())
    part = next(os.path.join(p, f) for p, _, fs in os.walk(d + "/lake/receipt_actions") for f in fs if f.endswith(".parquet"))
    keep = open(part, "rb").read()
    open(part, "wb").write(b"not a table")
    with pytest.raises(Exception):
        ingest_batch(spark, records.where("block.header.height > 1080"), 1, d + "/lake")
    open(part, "wb").write(keep)
    crc = os.path.join(os.path.dirname(part), f".{os.path.basename(part)}.crc")
    assert os.path.exists(crc)
    assert sorted(r["id"] for r in read_facts(spark, d + "/lake").actions.collect()) == before


def test_a_receipt_at_a_later_height_leaves_one_row(spark, tmp_path):
    from pyspark.sql import functions as F

    from govlake.streaming.ingest import ingest_batch
    d = str(tmp_path)
    records = _records(spark).where("block.header.height < 1010")
    ingest_batch(spark, records, 0, d + "/lake")
    ids = {r["id"] for r in read_facts(spark, d + "/lake").actions.collect()}
    moved = records.withColumn("block", F.col("block").withField("header", F.col("block.header").withField(
        "height", F.col("block.header.height") + 250_000)))
    ingest_batch(spark, moved, 1, d + "/lake")
    rows = read_facts(spark, d + "/lake").actions.collect()
    assert {r["id"] for r in rows} == ids and len(rows) == len(ids)
    assert min(r["block_height"] for r in rows) > 250_000
    silver = spark.read.parquet(d + "/lake/silver").select("id", "block_height").collect()
    assert len(silver) == len(ids) and min(r["block_height"] for r in silver) > 250_000
    assert read_facts(spark, d + "/lake").blocks.count() == 2 * records.count()


def test_a_height_delivered_twice_in_a_batch_keeps_the_later_record(spark, tmp_path):
    import os

    from pyspark.sql import functions as F
    d = str(tmp_path)
    records = _records(spark).where("block.header.height < 1010")
    late = records.withColumn("block", F.col("block").withField("author", F.lit("late.test"))).withColumn(
        "shards", F.transform("shards", lambda s: s.withField("receipt_execution_outcomes", F.transform(
            s["receipt_execution_outcomes"], lambda p: p.withField("execution_outcome", F.lit(None).cast(
                records.schema["shards"].dataType.elementType["receipt_execution_outcomes"].dataType.elementType["execution_outcome"].dataType))))))
    _landing(spark, d + "/landing", records)
    first = {f for f in os.listdir(d + "/landing") if f.endswith(".parquet")}
    _landing(spark, d + "/landing", late)
    for f in os.listdir(d + "/landing"):
        if f.endswith(".parquet"):
            t = 1_600_000_000 if f in first else 1_600_000_100
            os.utime(f"{d}/landing/{f}", (t, t))
    start_ingest(spark, d + "/landing", d + "/lake", checkpoint=d + "/ck", max_files_per_trigger=10).awaitTermination()
    got = read_facts(spark, d + "/lake")
    assert {r["author"] for r in got.blocks.collect()} == {"late.test"} and got.blocks.count() == records.count()
    assert {r["author"] for r in got.actions.collect()} == {"late.test"}
    assert got.outcomes.count() == 0


def test_json_landing_keeps_every_action(spark, tmp_path):
    import base64
    import json

    import pytest

    from govlake.streaming import replay
    d = str(tmp_path)
    call = {"FunctionCall": {"method_name": "vote", "args": base64.b64encode(b'{"proposal_id":3,"vote":1}').decode(), "gas": 7, "deposit": "0"}}

    def record(height, ns, status, actions):
        receipt = {"receipt_id": f"r{height}", "receiver_id": "vote.hos.test", "predecessor_id": "a.near",
                   "receipt": {"Action": {"signer_id": "a.near", "signer_public_key": "k", "gas_price": "1", "actions": actions}}}
        outcome = {"outcome": {"logs": [], "receipt_ids": [], "gas_burnt": 5, "tokens_burnt": "9", "executor_id": "e", "status": status}}
        return {"block": {"author": "n", "header": {"height": height, "hash": f"h{height}", "prev_hash": f"h{(height or 0) - 1}",
                                                    "timestamp_nanosec": ns, "gas_price": "1", "total_supply": "1"}},
                "shards": [{"shard_id": 0, "chunk": None, "receipt_execution_outcomes": [{"receipt": receipt, "execution_outcome": outcome}]}]}

    rows = [record(10, "1640995200000000000", "Unknown", ["CreateAccount", call]),
            record(11, 1640995201000000000, {"SuccessValue": ""}, [{"Transfer": {"deposit": "3"}}, "CreateAccount", call, call]),
            record(12, 1640995202000000000, {"Failure": {"ActionError": {"index": 0}}}, ["CreateAccount"])]
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    replay(spark, d + "/landing", d + "/lake", 0, fmt="json")
    got = read_facts(spark, d + "/lake")
    assert sorted((r["id"], r["action_index"], r["method_name"], r["args_json"]) for r in got.actions.collect()) == [
        ("r10-1", 1, "vote", '{"proposal_id":3,"vote":1}'), ("r11-2", 2, "vote", '{"proposal_id":3,"vote":1}'),
        ("r11-3", 3, "vote", '{"proposal_id":3,"vote":1}')]
    assert {r["receipt_id"]: (r["status"], r["results_json"]) for r in got.outcomes.collect()} == {
        "r10": ("Unknown", '{"status_type":"Unknown"}'), "r11": ("SuccessValue", None),
        "r12": ("Failure", json.dumps({"error": '{"ActionError":{"index":0}}', "status_type": "Failure"}, separators=(",", ":")))}
    assert got.blocks.where("timestamp is null").count() == 0
    for bad in ['{"block": {"author": "n"', json.dumps(record(None, 5, "Unknown", []))]:
        (tmp_path / "bad").mkdir(exist_ok=True)
        (tmp_path / "bad" / "b.json").write_text(bad)
        with pytest.raises(Exception):
            replay(spark, d + "/bad", d + "/lake", 0, fmt="json")
    assert read_facts(spark, d + "/lake").blocks.count() == 3
