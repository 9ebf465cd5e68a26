"""Silver layer: each action with its outcome, JSON decoded once.

Every view starts from silver. Built from block records it needs no join
(``operators.flatten.flatten_silver``); built from the two fact tables it is
``decode_actions``: the outcome table is keyed by receipt_id, so a left join
keeps every action and adds at most one outcome. Each view then applies its
own status set (an inner join with a status predicate equals
"status IN (...)" on this left join).

Decoded columns (VARIANT, NULL when unusable — see functions.json):
  args      call arguments (base64 -> UTF-8 -> strict JSON, error-guarded)
  log0      first log line (marker stripped)
  log_docs  every log line, same rule, array order kept
  results   the outcome's results_json
Only the columns a view touches are computed: Catalyst prunes the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake.functions.json import b64_text, log_event_docs, safe_json

SILVER_ACTION_COLUMNS = [
    "id", "receipt_id", "block_height", "block_hash", "block_timestamp", "signer_account_id",
    "predecessor_id", "receiver_id", "method_name", "action_kind", "action_index", "args_base64",
]


def decode_actions(actions: DataFrame, outcomes: DataFrame) -> DataFrame:
    eo = outcomes.select("receipt_id", "status", "logs", "results_json")
    joined = actions.select(*SILVER_ACTION_COLUMNS).join(eo, "receipt_id", "left")
    return add_decoded(joined)


def add_decoded(df: DataFrame) -> DataFrame:
    docs = df.withColumns({
        "args": safe_json(b64_text("args_base64")),
        "log_docs": log_event_docs("logs"),
        "results": safe_json("results_json"),
    })
    # the first log is the first parsed document: no second parse of logs[0]
    return docs.withColumn("log0", F.get(F.col("log_docs"), 0))


def successful(df: DataFrame, statuses=("SuccessReceiptId", "SuccessValue")) -> DataFrame:
    return df.where(F.col("status").isin(*statuses))


# The methods that the views read. Each has a storage folder of its own; every
# other method name (free text of foreign callers) is kept as a column under "other".
VIEW_METHODS = [
    "new", "storage_deposit", "on_lockup_update", "on_lockup_deployed", "create_proposal", "approve_proposal",
    "on_get_snapshot", "reject_proposal", "vote", "delegate_all", "undelegate", "lock_near", "begin_unlock_near",
    "lock_pending_near", "withdraw_from_staking_pool", "withdraw_all_from_staking_pool", "unstake", "unstake_all",
]
OTHER_METHODS = "other"
METHOD_PART = "method_part"


def method_part(col: str = "method_name") -> F.Column:
    """Storage folder of a method name."""
    return F.when(F.col(col).isin(*VIEW_METHODS), F.col(col)).otherwise(F.lit(OTHER_METHODS))


def calls(df: DataFrame, methods) -> DataFrame:
    """Function calls of the given methods; a stored table is pruned to their folders."""
    methods = [methods] if isinstance(methods, str) else list(methods)
    if METHOD_PART in df.columns:
        df = df.where(F.col(METHOD_PART).isin(*[m if m in VIEW_METHODS else OTHER_METHODS for m in methods]))
    return df.where((F.col("action_kind") == "FunctionCall") & F.col("method_name").isin(*methods))
