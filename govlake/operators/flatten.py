"""Block record -> fact rows (blocks, receipt_actions, execution_outcomes).

Pure projections and explodes over each record: no shuffle. Shards and
receipt/outcome pairs are exploded; the receipt and its outcome travel in one
element, so status and logs come along without a join. The contract filter
keeps receipts whose receiver or predecessor account ends with
``.<contract>`` (lower-cased). Actions are exploded *with* their position
before non-FunctionCall actions are dropped, so ``action_index`` counts every
action of the receipt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from govlake.config import ContractConfig
from govlake.functions.json import b64_encode, json_text_or_fallback
from govlake.schemas import ACTION_COLUMNS, BLOCK_COLUMNS, OUTCOME_COLUMNS
from govlake.sources.fixtures import Facts


def ns_to_block_time(ns: Column) -> Column:
    """Header nanoseconds -> TIMESTAMP_NTZ (microseconds; out of range -> NULL)."""
    us = F.floor(ns.cast("decimal(20,0)") / F.lit(1000)).cast("bigint")  # exact, no double rounding
    return F.when(us.between(-62135596800000000, 253402300799999999),
                  F.timestamp_micros(us).cast("timestamp_ntz"))


def is_contract_account(col: Column, cfg: ContractConfig) -> Column:
    return F.lower(col).endswith(cfg.suffix)


def status_tag(st: Column) -> Column:
    return (F.when(st["SuccessValue"].isNotNull(), F.lit("SuccessValue"))
            .when(st["SuccessReceiptId"].isNotNull(), F.lit("SuccessReceiptId"))
            .when(st["Failure"].isNotNull(), F.lit("Failure"))
            .otherwise(F.lit("Unknown")))


def results_json(st: Column) -> Column:
    """The execution result as JSON text (NULL for an empty SuccessValue)."""
    sv = st["SuccessValue"]
    return (F.when(sv.isNotNull(),
                   F.when(F.length(sv) == 0, F.lit(None).cast("string"))
                   .otherwise(json_text_or_fallback(F.try_validate_utf8(sv.cast("string")))))
            .when(st["SuccessReceiptId"].isNotNull(),
                  F.to_json(F.struct(st["SuccessReceiptId"].alias("receipt_id"),
                                     F.lit("SuccessReceiptId").alias("status_type"))))
            .when(st["Failure"].isNotNull(),
                  F.to_json(F.struct(st["Failure"].alias("error"), F.lit("Failure").alias("status_type"))))
            .otherwise(F.to_json(F.struct(F.lit("Unknown").alias("status_type")))))


def flatten_blocks(blocks: DataFrame, cfg: ContractConfig = ContractConfig()) -> Facts:
    h = F.col("block.header")
    hdr = blocks.select(
        h["height"].alias("height"), h["hash"].alias("hash"), h["prev_hash"].alias("prev_hash"),
        F.col("block.author").alias("author"), ns_to_block_time(h["timestamp_nanosec"]).alias("timestamp"),
        h["gas_price"].alias("gas_price"), h["total_supply"].alias("total_supply"),
        F.col("shards"),
    )
    out_blocks = hdr.select(*BLOCK_COLUMNS)
    shards = hdr.select("height", "hash", "author", "timestamp", F.explode("shards").alias("s"))
    reos = shards.select(
        "height", "hash", "author", "timestamp",
        F.col("s.shard_id").cast("string").alias("shard_id"),
        F.coalesce(F.col("s.chunk.header.chunk_hash"), F.lit("")).alias("chunk_hash"),
        F.explode("s.receipt_execution_outcomes").alias("reo"),
    )
    reos = reos.where(is_contract_account(F.col("reo.receipt.receiver_id"), cfg)
                      | is_contract_account(F.col("reo.receipt.predecessor_id"), cfg))
    act = F.col("reo.receipt.receipt.Action")
    actions = reos.where(act.isNotNull()).select(
        "height", "hash", "author", "timestamp", "chunk_hash",
        F.col("reo.receipt.receipt_id").alias("receipt_id"),
        F.col("reo.receipt.receiver_id").alias("receiver_id"),
        F.col("reo.receipt.predecessor_id").alias("predecessor_id"),
        act["signer_id"].alias("signer_account_id"), act["signer_public_key"].alias("signer_public_key"),
        act["gas_price"].alias("gas_price"),
        F.posexplode(act["actions"]).alias("action_index", "action"),
    ).where(F.col("action.FunctionCall").isNotNull())
    fc = F.col("action.FunctionCall")
    actions = actions.select(
        F.concat_ws("-", F.col("receipt_id"), F.col("action_index").cast("string")).alias("id"),
        F.col("height").alias("block_height"), "receipt_id", "signer_account_id", "signer_public_key",
        "gas_price", F.lit("FunctionCall").alias("action_kind"), "predecessor_id", "receiver_id",
        F.col("hash").alias("block_hash"), "chunk_hash", "author", fc["method_name"].alias("method_name"),
        fc["gas"].alias("gas"), fc["deposit"].alias("deposit"),
        b64_encode(fc["args"]).alias("args_base64"),
        json_text_or_fallback(F.try_validate_utf8(fc["args"].cast("string"))).alias("args_json"),
        F.col("action_index").cast("int").alias("action_index"),
        F.col("timestamp").alias("block_timestamp"),
    ).select(*ACTION_COLUMNS)
    o = F.col("reo.execution_outcome.outcome")
    outcomes = reos.where(o.isNotNull()).select(
        F.col("reo.receipt.receipt_id").alias("receipt_id"), F.col("height").alias("block_height"),
        F.col("hash").alias("block_hash"), "chunk_hash", "shard_id",
        o["gas_burnt"].alias("gas_burnt"), o["gas_burnt"].cast("double").alias("gas_used"),
        (o["tokens_burnt"].cast("double") / F.lit(1e24)).alias("tokens_burnt"),
        o["executor_id"].alias("executor_account_id"), status_tag(o["status"]).alias("status"),
        F.coalesce(o["receipt_ids"], F.array().cast("array<string>")).alias("outcome_receipt_ids"),
        F.col("hash").alias("executed_in_block_hash"), o["logs"].alias("logs"),
        results_json(o["status"]).alias("results_json"), F.col("timestamp").alias("block_timestamp"),
    ).select(*OUTCOME_COLUMNS)
    return Facts(out_blocks, actions, outcomes)


def flatten_silver(blocks: DataFrame, cfg: ContractConfig = ContractConfig()) -> DataFrame:
    """Silver rows straight from block records: no actions-outcomes join.

    A receipt and its execution outcome travel in the same element of the
    record, so every FunctionCall row can carry the outcome's status, logs and
    result as it is exploded. Equals ``decode_actions(actions, outcomes)`` over
    the flattened facts (a left join on receipt_id), without the shuffle of
    both fact tables that the join would need.
    """
    from govlake.operators.decode import SILVER_ACTION_COLUMNS, add_decoded

    h = F.col("block.header")
    shards = blocks.select(h["height"].alias("height"), h["hash"].alias("hash"),
                           ns_to_block_time(h["timestamp_nanosec"]).alias("timestamp"),
                           F.explode("shards").alias("s"))
    reos = shards.select("height", "hash", "timestamp", F.explode("s.receipt_execution_outcomes").alias("reo"))
    reos = reos.where(is_contract_account(F.col("reo.receipt.receiver_id"), cfg)
                      | is_contract_account(F.col("reo.receipt.predecessor_id"), cfg))
    act = F.col("reo.receipt.receipt.Action")
    o = F.col("reo.execution_outcome.outcome")
    rows = reos.where(act.isNotNull()).select(
        "height", "hash", "timestamp",
        F.col("reo.receipt.receipt_id").alias("receipt_id"),
        F.col("reo.receipt.receiver_id").alias("receiver_id"),
        F.col("reo.receipt.predecessor_id").alias("predecessor_id"),
        act["signer_id"].alias("signer_account_id"),
        F.when(o.isNotNull(), status_tag(o["status"])).alias("status"),
        o["logs"].alias("logs"),
        F.when(o.isNotNull(), results_json(o["status"])).alias("results_json"),
        F.posexplode(act["actions"]).alias("action_index", "action"),
    ).where(F.col("action.FunctionCall").isNotNull())
    fc = F.col("action.FunctionCall")
    rows = rows.select(
        F.concat_ws("-", F.col("receipt_id"), F.col("action_index").cast("string")).alias("id"),
        "receipt_id", F.col("height").alias("block_height"), F.col("hash").alias("block_hash"),
        F.col("timestamp").alias("block_timestamp"), "signer_account_id", "predecessor_id", "receiver_id",
        fc["method_name"].alias("method_name"), F.lit("FunctionCall").alias("action_kind"),
        F.col("action_index").cast("int").alias("action_index"),
        b64_encode(fc["args"]).alias("args_base64"),
        "status", "logs", "results_json",
    )
    return add_decoded(rows.select(*SILVER_ACTION_COLUMNS, "status", "logs", "results_json"))
