"""V6 user_activities: lockup, staking and delegation activity per account.

Seven of the eight branches are row-local (one row per action, or one row per
log line with empty/NULL logs kept as a single row), so they run as ONE pass
over the silver slice: each action explodes an array of its documents, or of one NULL —
no union of eight scans, no shuffle. The on_lockup_update
branch groups by receipt-level columns (two calls in one receipt collapse to
one row), so it is a separate, map-side-combined aggregate over its own slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake.config import ContractConfig
from govlake.functions.json import jnum, jstr
from govlake.functions.text import after_first_dot, md5_concat
from govlake.operators.decode import METHOD_PART, calls
from govlake.plans.common import on_contracts, on_contracts_after_dot

# The methods of the view, by the form of their rows.
METHODS = ["on_lockup_deployed", "lock_near", "on_lockup_update", "delegate_all", "undelegate",
           "begin_unlock_near", "lock_pending_near", "withdraw_from_staking_pool",
           "withdraw_all_from_staking_pool", "unstake", "unstake_all"]
DELEGATION = ["delegate_all", "undelegate"]
DOT_LOCK = ["lock_near", "begin_unlock_near", "lock_pending_near"]
PER_LOG_STAKING = ["withdraw_from_staking_pool", "withdraw_all_from_staking_pool", "unstake", "unstake_all"]

COLUMNS = ["id", "receipt_id", "hos_contract_address", "account_id", "event_date", "event_timestamp",
           "method_name", "event_type", "event_status", "near_amount", "locked_near_balance", "block_height",
           "block_hash"]


def with_event_status(silver: DataFrame) -> DataFrame:
    st = F.col("status")
    ra = calls(silver, METHODS)
    if METHOD_PART in ra.columns:
        # every method of this view has a storage folder of its own: a filter on method_name prunes them
        ra = ra.withColumn("method_name", F.col(METHOD_PART))
    return ra.withColumn(
        "event_status",
        F.when(st.isin("SuccessReceiptId", "SuccessValue"), F.lit("succeeded")).when(st == "Failure", F.lit("failed")))


def _row_local(ra: DataFrame, cfg: ContractConfig) -> DataFrame:
    """Seven branches in one pass. Row-level columns stay plain columns beside the exploded documents,

    so a filter on method_name, block_height or receipt_id reaches the scan.
    """
    dec = "decimal(38,0)"
    m, args, log0, doc = F.col("method_name"), F.col("args"), F.col("log0"), F.col("doc")
    signer, rid = F.col("signer_account_id"), F.col("receipt_id")
    one_per_call = m.isin(*DOT_LOCK, "on_lockup_deployed")
    delegation, staking, deployed, lock = m.isin(*DELEGATION), m.isin(*PER_LOG_STAKING), m == "on_lockup_deployed", m == "lock_near"
    keep = (F.when(deployed | delegation, on_contracts(cfg))
            .when(staking, (F.col("event_status") == "succeeded") & on_contracts_after_dot(cfg))
            .otherwise(on_contracts_after_dot(cfg)))
    # one row per call, or one per log line (NULL or empty logs give one row with a NULL document)
    nothing = F.array(F.lit(None).cast("variant"))
    docs = F.when(one_per_call | (F.coalesce(F.size("log_docs"), F.lit(0)) <= 0), nothing).otherwise(F.col("log_docs"))
    rows = ra.where((m != "on_lockup_update") & keep).select(
        "receipt_id", "block_timestamp", "method_name", "event_status", "block_height", "block_hash", "signer_account_id",
        "receiver_id", "predecessor_id", "args", "log0", F.explode(docs).alias("doc"))
    owner, amount_arg = jstr(doc, "$.data[0].owner_id"), jnum(args, "$.amount")
    doc_amount, locked = jnum(doc, "$.data[0].amount"), jnum(log0, "$.data[0].locked_near_balance")
    return rows.select(
        F.when(delegation, md5_concat(rid, F.lit("_"), owner)).otherwise(rid).alias("id"), "receipt_id",
        F.when(deployed, F.col("predecessor_id")).when(delegation, F.col("receiver_id"))
        .otherwise(after_first_dot(F.col("receiver_id"))).alias("hos_contract_address"),
        F.when(delegation, F.coalesce(owner, signer)).otherwise(signer).alias("account_id"),
        F.col("block_timestamp").alias("event_timestamp"), "method_name",
        F.when(deployed, F.coalesce(jstr(log0, "$.event"), F.lit("lockup_deployed")))
        .when(lock, F.coalesce(jstr(log0, "$.event"), F.lit("lockup_lock_near")))
        .when(delegation, F.coalesce(F.concat(m, F.lit("_"), jstr(doc, "$.event")), m)).otherwise(m).alias("event_type"),
        "event_status",
        F.when(deployed, jnum(args, "$.lockup_deposit")).when(delegation, doc_amount)
        .when(staking, F.coalesce(amount_arg, doc_amount, F.lit(0).cast(dec))).otherwise(amount_arg).cast(dec).alias("near_amount"),
        F.when(deployed | lock, locked).cast(dec).alias("locked_near_balance"), "block_height", "block_hash")


def _lockup_updates(ra: DataFrame, cfg: ContractConfig) -> DataFrame:
    docs = F.col("log_docs")
    ev = lambda d: jstr(d, "$.event")
    ft = F.filter(docs, lambda d: ev(d).isin("ft_mint", "ft_burn"))
    upd = F.filter(docs, lambda d: ev(d) == "lockup_update")
    per_action = ra.where((F.col("method_name") == "on_lockup_update") & on_contracts(cfg)
                          & (F.size("log_docs") > 0)).select(
        F.col("receipt_id").alias("id"), "receipt_id", F.col("block_timestamp").alias("event_timestamp"),
        "method_name", "event_status", F.col("signer_account_id").alias("account_id"),
        F.col("receiver_id").alias("hos_contract_address"), "block_hash", "block_height",
        F.array_max(F.transform(ft, ev)).alias("ft_event_type"),
        F.array_max(F.transform(upd, lambda d: jnum(d, "$.data[0].locked_near_balance"))).alias("locked"),
        F.array_max(F.transform(ft, lambda d: jnum(d, "$.data[0].amount"))).alias("near"),
    )
    keys = ["id", "receipt_id", "event_timestamp", "method_name", "event_status", "account_id",
            "hos_contract_address", "block_hash", "block_height"]
    g = per_action.groupBy(*keys).agg(F.max("ft_event_type").alias("ft_event_type"),
                                     F.max("locked").alias("locked_near_balance"),
                                     F.max("near").alias("near_amount"))
    return g.select(
        "id", "receipt_id", "hos_contract_address", "account_id", "event_timestamp", "method_name",
        F.coalesce(F.concat(F.col("method_name"), F.lit("_"), F.col("ft_event_type")), F.col("method_name"))
        .alias("event_type"),
        "event_status", F.col("near_amount").cast("decimal(38,0)"),
        F.col("locked_near_balance").cast("decimal(38,0)"), "block_height", "block_hash",
    )


def user_activities(silver: DataFrame, cfg: ContractConfig) -> DataFrame:
    ra = with_event_status(silver)
    allrows = _row_local(ra, cfg).unionByName(_lockup_updates(ra, cfg))
    return allrows.select(
        "id", "receipt_id", "hos_contract_address", "account_id",
        F.to_date("event_timestamp").alias("event_date"), "event_timestamp", "method_name", "event_type",
        "event_status", "near_amount", "locked_near_balance", "block_height", "block_hash",
    )


def branch(ua: DataFrame, methods) -> DataFrame:
    """One branch of the view (for per-branch checks)."""
    methods = [methods] if isinstance(methods, str) else list(methods)
    return ua.where(F.col("method_name").isin(*methods))
