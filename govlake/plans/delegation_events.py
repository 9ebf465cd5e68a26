"""V1 delegation_events: one row per successful delegate_all / undelegate action.

The per-log subqueries ("first ft_mint log", "mint before burn") are array
functions over the decoded log documents of the row itself: no explode, no
join. The latest-per-delegator flag is an aggregate joined back (skew-safe).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake.config import ContractConfig
from govlake.functions.json import jnum, jstr
from govlake.functions.text import md5_concat
from govlake.operators.decode import calls, successful
from govlake.operators.latest import flag_latest
from govlake.plans.common import on_contracts

METHODS = ["delegate_all", "undelegate"]

COLUMNS = ["id", "receipt_id", "event_date", "event_timestamp", "hos_contract_address", "delegator_id",
           "delegatee_id", "delegate_method", "delegate_event", "is_latest_delegator_event", "owner_id",
           "near_amount", "block_height", "block_hash", "block_timestamp"]


def _event(d):
    return jstr(d, "$.event")


def delegation_events(silver: DataFrame, cfg: ContractConfig) -> DataFrame:
    ra = successful(calls(silver, METHODS)).where(on_contracts(cfg))
    docs = F.col("log_docs")
    delegatee = jstr(F.col("args"), "$.receiver_id")
    mints = F.filter(docs, lambda d: _event(d) == "ft_mint")
    burns = F.filter(docs, lambda d: _event(d) == "ft_burn")
    mint_to_delegatee = F.filter(
        docs, lambda d: (_event(d) == "ft_mint") & (jstr(d, "$.data[0].owner_id") == delegatee))
    ra = ra.select(
        "receipt_id", "id", "block_timestamp", "receiver_id", "predecessor_id", "method_name", "block_height",
        "block_hash",
        delegatee.alias("delegatee_id"),
        jstr(F.get(mints, 0), "$.data[0].owner_id").alias("owner_id"),
        F.when(F.size(mints) > 0, F.lit("ft_mint")).when(F.size(burns) > 0, F.lit("ft_burn"))
        .alias("delegate_event"),
        F.coalesce(jnum(F.get(burns, 0), "$.data[0].amount"),
                   jnum(F.get(mint_to_delegatee, 0), "$.data[0].amount")).alias("near_amount"),
    )
    # reference orders by time only; receipt and action id make the flag deterministic
    ra = flag_latest(ra, "predecessor_id", ["block_timestamp", "receipt_id", "id"], "is_latest_delegator_event")
    return ra.select(
        md5_concat(F.col("receipt_id"), F.lit("_"), F.col("owner_id")).alias("id"),
        "receipt_id",
        F.to_date("block_timestamp").alias("event_date"),
        F.col("block_timestamp").alias("event_timestamp"),
        F.col("receiver_id").alias("hos_contract_address"),
        F.col("predecessor_id").alias("delegator_id"),
        "delegatee_id",
        F.col("method_name").alias("delegate_method"),
        "delegate_event", "is_latest_delegator_event", "owner_id", "near_amount",
        "block_height", "block_hash", "block_timestamp",
    )


def latest_delegation(de: DataFrame) -> DataFrame:
    """Latest active delegate_all per delegator (input: delegation_events, which flags one row per delegator)."""
    return de.where(F.col("is_latest_delegator_event") & (F.col("delegate_method") == "delegate_all")
                    & (F.col("delegate_event") == "ft_mint")).select("delegator_id", "delegatee_id")
