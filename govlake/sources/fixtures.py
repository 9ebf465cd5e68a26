"""Synthetic governance facts derived from the driver's ``events`` table.

One event becomes one receipt with a FunctionCall action (in some receipts after
transfers, in some twice) and (usually) one execution outcome, and some events a Data receipt too;
ten consecutive events form a block. Some arguments are no JSON, no UTF-8, repeat a key or
hold numbers that are no DECIMAL(38,0), some logs are NULL, some receivers upper-case. The mapping rules are
fixed so that an independent SQL engine can derive the very same facts (see
``oracle/``). Everything is row-local except the block timestamp, which is the
first event time of the block. The events are shuffled by block before anything is derived from them: an event has
tens of bytes and a derived row hundreds, and the derivation runs in as many tasks as the session shuffles into,
however few row groups the events have. The block timestamp and the block records then need no other shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from govlake.config import ContractConfig
from govlake.functions.json import b64_encode, args_json_text
from govlake.schemas import ACTION_COLUMNS, BLOCK_COLUMNS, OUTCOME_COLUMNS

# ---- fixed values of the synthetic mapping ---------------------------------
PURCHASE_METHODS = [
    "lock_near", "begin_unlock_near", "lock_pending_near", "unstake", "unstake_all",
    "withdraw_from_staking_pool", "withdraw_all_from_staking_pool", "on_lockup_update",
]
LOCKUP_ACCOUNT_METHODS = [
    "lock_near", "begin_unlock_near", "lock_pending_near", "unstake", "unstake_all",
    "withdraw_from_staking_pool", "withdraw_all_from_staking_pool",
]
AMOUNT_ARG_METHODS = ["lock_near", "begin_unlock_near", "lock_pending_near", "unstake",
                      "withdraw_from_staking_pool"]
PROPOSAL_METHODS = ["vote", "create_proposal", "approve_proposal", "reject_proposal", "on_get_snapshot"]
CALLBACK_METHODS = ["on_lockup_deployed", "on_get_snapshot", "on_lockup_update"]
GROWTH_NUMERATOR = "1902587519026"
GROWTH_DENOMINATOR = "1000000000000000000000000000000"
AMOUNT_ZEROS = "0000000000000000000000"  # 22 zeros: value*100 becomes a yocto-sized amount
VOTING_DURATION_NS = "604800000000000"
HOUR_NS = 3_600_000_000_000
FAILURE_TEXT = "Smart contract panicked"
GAS_PRICE = "100000000"
TOTAL_SUPPLY = "1000000000000000000000000000000000"
FIRST_HEIGHT = 1000
TAIL = "] junk"                      # text after a document that closes its wrapping bracket
BAD_UTF8_HEX = "FFFEFD"
LONG_AMOUNT = "9" * 39
# -----------------------------------------------------------------------------


def _sql_list(xs):
    return ", ".join(f"'{x}'" for x in xs)


def event_rows(events: DataFrame, cfg: ContractConfig = ContractConfig()) -> DataFrame:
    """One row per event with every derived fact column (before the contract filter)."""
    v, vote = cfg.token_contract, cfg.voting_contract
    purchase = ", ".join(f"'{m}'" for m in PURCHASE_METHODS)
    e = events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.from_json("props", "k INT")["k"].alias("k"),
    )
    # the number keeps the tasks from being merged by the size of the events, which is a tenth of what they make of them
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    e = e.withColumn("b", F.expr("event_id div 10")).repartition(tasks, "b")
    e = e.withColumns({
        "q": F.expr("event_id div 100"),
        "r": F.expr("event_id % 100"),
        "acct": F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit(".near")),
        "amt": F.concat(F.expr("cast(cast(round(value * 100) as bigint) as string)"), F.lit(AMOUNT_ZEROS)),
        "ns": F.expr("unix_micros(cast(ts as timestamp)) * 1000"),
    })
    e = e.withColumns({
        "dlg": F.expr("concat('u', cast((user_id + k) % 15 as string), '.near')"),
        "height": F.expr(f"{FIRST_HEIGHT} + b + b div 50"),
        "prev_height": F.expr(f"CASE WHEN b = 0 THEN {FIRST_HEIGHT - 1} ELSE {FIRST_HEIGHT} + (b - 1) + (b - 1) div 50 END"),
        "shard": F.expr("user_id % 4"),
        "method_name": F.expr(f"""CASE
            WHEN r = 0 THEN 'create_proposal'
            WHEN r = 1 THEN CASE WHEN q % 4 <> 3 THEN 'approve_proposal' ELSE 'reject_proposal' END
            WHEN r = 2 THEN 'on_get_snapshot'
            WHEN r = 5 AND q % 10 = 3 THEN 'approve_proposal'
            WHEN r = 5 AND q % 10 = 7 THEN 'reject_proposal'
            WHEN event_id = 3 THEN 'new'
            WHEN event_type = 'click' THEN 'vote'
            WHEN event_type = 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'on_lockup_deployed' ELSE 'storage_deposit' END
            WHEN event_type = 'view' THEN CASE WHEN k % 3 = 0 THEN 'undelegate' ELSE 'delegate_all' END
            WHEN event_type = 'purchase' THEN element_at(array({purchase}), k % 8 + 1)
            ELSE 'other' END"""),
    })
    e = e.withColumns({
        "receiver_id": F.expr(f"""CASE
            WHEN method_name IN ({_sql_list(LOCKUP_ACCOUNT_METHODS)}) THEN concat('lk', cast(user_id as string), '.{v}')
            WHEN method_name = 'vote' AND event_id % 59 = 58 THEN upper('{vote}')
            WHEN method_name IN ({_sql_list(PROPOSAL_METHODS)}) THEN '{vote}'
            WHEN method_name = 'other' AND k % 4 = 1 THEN initcap('{v}')
            WHEN method_name = 'other' AND k % 2 = 0 THEN concat('x', cast(user_id as string), '.elsewhere.test')
            ELSE '{v}' END"""),
        "predecessor_id": F.expr(f"CASE WHEN method_name IN ({_sql_list(CALLBACK_METHODS)}) THEN '{v}' ELSE acct END"),
        "signer_account_id": F.expr(f"CASE WHEN method_name = 'new' THEN '{v}' ELSE acct END"),
        "status": F.expr("""CASE
            WHEN method_name = 'approve_proposal' THEN 'SuccessReceiptId'
            WHEN r = 2 AND q % 10 = 9 THEN 'Failure'
            WHEN r <= 3 THEN 'SuccessValue'
            WHEN k % 13 = 0 THEN 'Failure'
            WHEN k % 17 = 1 THEN 'Unknown'
            WHEN method_name = 'vote' THEN 'SuccessValue'
            WHEN event_id % 2 = 0 THEN 'SuccessReceiptId'
            ELSE 'SuccessValue' END"""),
        "has_outcome": F.expr("NOT (r > 3 AND event_id % 97 = 96)"),
        # amounts that are no whole number of 38 digits at most
        "arg_amt": F.expr(f"CASE WHEN event_id % 67 = 66 THEN '1.5' WHEN event_id % 61 = 60 THEN '{LONG_AMOUNT}' ELSE amt END"),
    })
    e = e.withColumns({
        "plain_args": F.expr(f"""CASE
            WHEN r > 3 AND event_id % 89 = 88 THEN 'not json'
            WHEN r > 3 AND event_id % 83 = 82 THEN '{{"error":"boom","proposal_id":1}}'
            WHEN method_name = 'create_proposal' THEN concat('{{"metadata":{{"title":"P', q, '","description":"d', q,
                 '","link":"http://x/', q, '"}}}}')
            WHEN method_name IN ('approve_proposal', 'reject_proposal') THEN concat('{{"proposal_id":', q, '}}')
            WHEN method_name = 'vote' THEN concat('{{"proposal_id":', greatest(q - k % 3, 0), ',"vote":', k % 3,
                 ',"v_account":{{"V0":{{"balance":{{"near_balance":"', amt, '","extra_venear_balance":"0"}},',
                 '"delegation":{{"account_id":"', dlg, '"}},',
                 '"delegated_balance":{{"near_balance":"0","extra_venear_balance":"0"}}}}}}}}')
            WHEN method_name = 'on_lockup_deployed' THEN concat('{{"account_id":"', acct, '","lockup_deposit":"', amt, '"}}')
            WHEN method_name = 'storage_deposit' THEN concat('{{"account_id":"', acct, '"}}')
            WHEN method_name = 'delegate_all' THEN concat('{{"receiver_id":"', dlg, '"}}')
            WHEN method_name IN ({_sql_list(AMOUNT_ARG_METHODS)}) THEN concat('{{"amount":"', arg_amt, '"}}')
            WHEN method_name = 'new' THEN '{{"venear_growth_config":{{"annual_growth_rate_ns":{{"numerator":"{GROWTH_NUMERATOR}","denominator":"{GROWTH_DENOMINATOR}"}}}}}}'
            ELSE '{{}}' END"""),
    })
    e = e.withColumn("args_text", F.expr(f"""CASE
            WHEN r > 3 AND event_id % 79 = 78 THEN concat(plain_args, '{TAIL}')
            WHEN r > 3 AND method_name = 'vote' AND event_id % 73 = 72 THEN concat('{{"proposal_id":999999,', substr(plain_args, 2))
            ELSE plain_args END"""))
    e = e.withColumns({
        "args_bytes": F.expr(f"CASE WHEN r > 3 AND event_id % 71 = 70 THEN unhex('{BAD_UTF8_HEX}') ELSE encode(args_text, 'UTF-8') END"),
        # actions of the receipt: transfers before the call, and how often the call comes
        "n_before": F.expr("cast(CASE WHEN r > 3 AND event_id % 5 = 4 THEN 1 + event_id % 2 ELSE 0 END as int)"),
        "n_calls": F.expr("CASE WHEN method_name = 'on_lockup_update' AND event_id % 3 = 0 THEN 2 ELSE 1 END"),
    })

    def ev(event, data):
        return f"""concat('EVENT_JSON:{{"standard":"venear","version":"1.0.0","event":"{event}","data":[{{', {data}, '}}]}}')"""

    def ft(event, owner):
        return ev(event, f"""'"owner_id":"', {owner}, '","amount":"', amt, '"'""")

    e = e.withColumn("logs", F.expr(f"""CASE
        WHEN r > 3 AND event_id % 53 = 52 THEN CAST(NULL AS array<string>)
        WHEN status IN ('Failure', 'Unknown') THEN CAST(array() AS array<string>)
        WHEN method_name = 'create_proposal' THEN array({ev('create_proposal', "'\"proposal_id\":', q")})
        WHEN method_name = 'vote' THEN array({ev('add_vote', "'\"account_balance\":\"', amt, '\"'")})
        WHEN method_name = 'on_lockup_deployed' THEN array({ev('lockup_deployed', "'\"account_id\":\"', acct, '\",\"locked_near_balance\":null'")})
        WHEN method_name = 'storage_deposit' THEN array({ft('ft_mint', 'acct')})
        WHEN method_name = 'lock_near' THEN array({ev('lock_near', "'\"account_id\":\"', acct, '\",\"locked_near_balance\":\"', amt, '\"'")})
        WHEN method_name = 'on_lockup_update' THEN array(
             {ev('lockup_update', "'\"account_id\":\"', acct, '\",\"locked_near_balance\":\"', amt, '\",\"timestamp\":\"', ns, '\"'")},
             CASE WHEN event_id % 2 = 0 THEN {ft('ft_mint', 'acct')} ELSE {ft('ft_burn', 'acct')} END)
        WHEN method_name = 'delegate_all' THEN array({ft('ft_burn', 'acct')}, {ft('ft_mint', 'dlg')})
        WHEN method_name = 'undelegate' AND event_id % 2 = 0 THEN array({ft('ft_burn', 'dlg')}, {ft('ft_mint', 'acct')}, 'Transfer done')
        WHEN method_name = 'undelegate' THEN array({ft('ft_burn', 'dlg')}, {ft('ft_mint', 'acct')})
        WHEN method_name IN ('unstake_all', 'withdraw_all_from_staking_pool') THEN array('Withdrawing all',
             {ev('withdraw', "'\"amount\":\"', amt, '\"'")})
        WHEN method_name IN ('unstake', 'withdraw_from_staking_pool') THEN array(concat('Unstaking ', amt))
        ELSE CAST(array() AS array<string>) END"""))
    e = e.withColumns({
        "results_json": F.expr(f"""CASE
            WHEN status = 'Failure' THEN '{{"error":"{FAILURE_TEXT}","status_type":"Failure"}}'
            WHEN status = 'Unknown' THEN '{{"status_type":"Unknown"}}'
            WHEN method_name = 'approve_proposal' THEN concat('{{"receipt_id":"r', event_id + 1, '","status_type":"SuccessReceiptId"}}')
            WHEN status = 'SuccessReceiptId' THEN concat('{{"receipt_id":"c', event_id, '","status_type":"SuccessReceiptId"}}')
            WHEN method_name = 'on_get_snapshot' THEN concat('{{"snapshot_and_state":{{"total_venear":"', amt,
                 '"}},"voting_duration_ns":"{VOTING_DURATION_NS}","voting_start_time_ns":"', ns,
                 '","creation_time_ns":"', ns - {HOUR_NS}, '"}}')
            END"""),
        "outcome_receipt_ids": F.expr("""CASE
            WHEN method_name = 'approve_proposal' THEN array(concat('r', event_id + 1))
            WHEN status = 'SuccessReceiptId' THEN array(concat('c', event_id))
            ELSE CAST(array() AS array<string>) END"""),
        "receipt_id": F.concat(F.lit("r"), F.col("event_id").cast("string")),
        "block_hash": F.md5(F.col("height").cast("string")),
        "chunk_hash": F.expr("CASE WHEN shard = 3 THEN '' ELSE md5(concat(height, '/', shard)) END"),
        "author": F.expr("concat('node', height % 5, '.test')"),
        "gas": F.expr("10000000000000 * (1 + k % 3)"),
        "deposit": F.expr("CASE WHEN method_name = 'storage_deposit' THEN amt ELSE '0' END"),
        "gas_burnt": F.expr("2400000000000 + cast(k as bigint) * 1000000000"),
        "block_timestamp": F.min("ts").over(Window.partitionBy("b")),
    })
    suffix = cfg.suffix
    return e.withColumn(
        "is_contract",
        F.lower("receiver_id").endswith(suffix) | F.lower("predecessor_id").endswith(suffix),
    )


@dataclass
class Facts:
    blocks: DataFrame
    actions: DataFrame
    outcomes: DataFrame


def facts_from_rows(rows: DataFrame) -> Facts:
    hot = rows.where("is_contract")
    calls = hot.withColumn("action_index", F.explode(F.sequence(F.col("n_before"), F.col("n_before") + F.col("n_calls") - 1)))
    actions = calls.select(
        F.concat_ws("-", "receipt_id", F.col("action_index").cast("string")).alias("id"),
        F.col("height").alias("block_height"), "receipt_id", "signer_account_id",
        F.concat(F.lit("ed25519:"), F.md5("signer_account_id")).alias("signer_public_key"),
        F.lit(GAS_PRICE).alias("gas_price"), F.lit("FunctionCall").alias("action_kind"),
        "predecessor_id", "receiver_id", "block_hash", "chunk_hash", "author", "method_name", "gas", "deposit",
        b64_encode("args_bytes").alias("args_base64"),
        F.col("action_index").cast("int").alias("action_index"), "block_timestamp",
    )
    actions = actions.withColumn("args_json", args_json_text(F.col("args_base64"))).select(*ACTION_COLUMNS)
    outcomes = hot.where("has_outcome").select(
        "receipt_id", F.col("height").alias("block_height"), "block_hash", "chunk_hash",
        F.col("shard").cast("string").alias("shard_id"), "gas_burnt",
        F.col("gas_burnt").cast("double").alias("gas_used"),
        (F.col("gas_burnt").cast("double") * F.lit(1e8) / F.lit(1e24)).alias("tokens_burnt"),
        F.col("receiver_id").alias("executor_account_id"), "status", "outcome_receipt_ids",
        F.col("block_hash").alias("executed_in_block_hash"), "logs", "results_json", "block_timestamp",
    ).select(*OUTCOME_COLUMNS)
    blocks = rows.groupBy("b", "height", "prev_height").agg(F.min("ts").alias("timestamp")).select(
        "height", F.md5(F.col("height").cast("string")).alias("hash"),
        F.expr("CASE WHEN b % 97 = 96 THEN md5('x') ELSE md5(cast(prev_height as string)) END").alias("prev_hash"),
        F.expr("concat('node', height % 5, '.test')").alias("author"), "timestamp",
        F.lit(GAS_PRICE).alias("gas_price"), F.lit(TOTAL_SUPPLY).alias("total_supply"),
    ).select(*BLOCK_COLUMNS)
    return Facts(blocks, actions, outcomes)


# Of every 41 blocks, how many blocks back a block's parent lies where it isn't the one before (0: nowhere).
BRANCHES = {7: 0, 8: 2, 19: 2, 20: 2, 30: 2, 32: 3}
LOST = (700, 650)  # of every 700 blocks the one at 650 has no parent, and nothing links around it


def branched_blocks(blocks: DataFrame) -> DataFrame:
    """The fixture's blocks with other parents: orphans, forks, chains that link around them again, and a lost end."""
    b = blocks.withColumn("b", F.expr(f"height - {FIRST_HEIGHT} - (height - {FIRST_HEIGHT}) div 51"))
    back = F.lit(1)
    for place, distance in BRANCHES.items():
        back = F.when(F.col("b") % 41 == place, distance).otherwise(back)
    b = b.withColumn("back", F.when(F.col("b") % LOST[0] == LOST[1], 0).otherwise(back))
    parent = F.expr(f"{FIRST_HEIGHT} + (b - back) + (b - back) div 50")
    prev = F.when(F.col("back") == 0, F.md5(F.lit("x"))).when(F.col("b") < F.col("back"), F.md5(F.lit("start"))).otherwise(
        F.md5(parent.cast("string")))
    return b.withColumn("prev_hash", prev).select(*blocks.columns)


def synthetic_facts(events: DataFrame, cfg: ContractConfig = ContractConfig()) -> Facts:
    return facts_from_rows(event_rows(events, cfg))
