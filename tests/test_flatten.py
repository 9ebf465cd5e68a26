"""Block record -> facts: contract filter, action positions, non-action receipts, missing chunks."""

import json

from govlake.config import ContractConfig
from govlake.operators.flatten import flatten_blocks
from govlake.schemas import BLOCK_RECORD


def _fc(method, args=b"{}"):
    return {"FunctionCall": {"method_name": method, "args": bytearray(args), "gas": 5, "deposit": "0"},
            "Transfer": None, "Stake": None}


def _reo(rid, receiver, predecessor, actions=None, data=False, status=None, logs=None):
    receipt = {"Action": {"signer_id": "s.near", "signer_public_key": "pk", "gas_price": "1",
                          "actions": actions}, "Data": None} if not data else \
        {"Action": None, "Data": {"data_id": "d", "data": None}}
    st = status or {"SuccessValue": bytearray(b""), "SuccessReceiptId": None, "Failure": None, "Unknown": None}
    return {"receipt": {"receipt_id": rid, "receiver_id": receiver, "predecessor_id": predecessor,
                        "receipt": receipt},
            "execution_outcome": {"outcome": {"logs": logs or [], "receipt_ids": [], "gas_burnt": 7,
                                              "tokens_burnt": "2000000000000000000000000", "executor_id": receiver,
                                              "status": st}}}


def _block(height, shards):
    return {"block": {"author": "a", "header": {"height": height, "hash": f"h{height}", "prev_hash": "p",
                                                "timestamp_nanosec": 1_704_067_207_179_575_123,
                                                "gas_price": "1", "total_supply": "9"}},
            "shards": shards}


def test_flatten_edges(spark):
    transfer = {"FunctionCall": None, "Transfer": {"deposit": "1"}, "Stake": None}
    shards = [
        {"shard_id": 0, "chunk": {"header": {"chunk_hash": "ch0"}}, "receipt_execution_outcomes": [
            _reo("r1", "V.HOS.TEST", "u.near", [transfer, _fc("vote", json.dumps({"proposal_id": 1}, separators=(",", ":")).encode())]),
            _reo("r2", "hos.test", "u.near", [_fc("vote")]),          # bare contract: dropped
            _reo("r3", "nothos.test", "u.near", [_fc("vote")]),       # different suffix: dropped
            _reo("r4", "x.near", "v.hos.test", data=True),              # not an Action: outcome only
        ]},
        {"shard_id": 3, "chunk": None, "receipt_execution_outcomes": [
            _reo("r5", "vote.hos.test", "u.near", [_fc("vote"), _fc("vote")]),
        ]},
    ]
    df = spark.createDataFrame([_block(1001, shards)], BLOCK_RECORD)
    facts = flatten_blocks(df, ContractConfig())
    acts = {r["id"]: r for r in facts.actions.collect()}
    assert sorted(acts) == ["r1-1", "r5-0", "r5-1"]
    assert acts["r1-1"]["action_index"] == 1 and acts["r1-1"]["args_json"] == '{"proposal_id":1}'
    assert acts["r5-0"]["chunk_hash"] == "" and acts["r1-1"]["chunk_hash"] == "ch0"
    assert str(acts["r1-1"]["block_timestamp"]) == "2024-01-01 00:00:07.179575"
    outs = {r["receipt_id"]: r for r in facts.outcomes.collect()}
    assert sorted(outs) == ["r1", "r4", "r5"]
    assert outs["r4"]["tokens_burnt"] == 2.0 and outs["r4"]["shard_id"] == "0"
    assert outs["r1"]["results_json"] is None and outs["r1"]["status"] == "SuccessValue"
    assert facts.blocks.count() == 1


def test_flatten_matches_fixture_facts(spark):
    from govlake.plans.catalog import GovLake
    lake = GovLake.from_events(spark, "/root/testdata/sf0.001")
    for name in ["blocks", "actions", "outcomes"]:
        a, b = getattr(lake.flat, name), getattr(lake.facts, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_silver_from_records_equals_join_of_facts(spark):
    from pyspark.sql import functions as F

    from govlake.operators.decode import decode_actions
    from govlake.operators.flatten import flatten_silver
    from govlake.plans.catalog import GovLake
    lake = GovLake.from_events(spark, "/root/testdata/sf0.001")

    def comparable(df):
        return df.select(*[F.to_json(F.col(c)).alias(c) if c in ("args", "log0", "results") else
                           F.transform(c, lambda v: F.to_json(v)).alias(c) if c == "log_docs" else F.col(c)
                           for c in df.columns])
    a = comparable(flatten_silver(lake.nested, lake.cfg))
    b = comparable(decode_actions(lake.facts.actions, lake.facts.outcomes)).select(*a.columns)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
