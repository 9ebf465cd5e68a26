"""V4 approved_proposals: one row per successful approve action."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govlake.config import ContractConfig
from govlake.functions.json import jnum
from govlake.operators.decode import calls, successful
from govlake.plans.common import on_contracts


def approved_proposals(silver: DataFrame, cfg: ContractConfig) -> DataFrame:
    ra = successful(calls(silver, "approve_proposal"), ["SuccessReceiptId"]).where(on_contracts(cfg))
    return ra.select(
        F.col("receipt_id").alias("id"), "receipt_id",
        F.to_date("block_timestamp").alias("proposal_approved_date"),
        F.col("block_timestamp").alias("proposal_approved_at"),
        F.col("receiver_id").alias("hos_contract_address"),
        jnum(F.col("args"), "$.proposal_id").alias("proposal_id"),
        F.col("signer_account_id").alias("proposal_approver_id"),
        "block_hash", "block_height",
    )


def recent_approved(silver: DataFrame, cfg: ContractConfig, n: int = 10) -> DataFrame:
    """L1: the n most recently approved proposals (receipt_id breaks ties)."""
    return (approved_proposals(silver, cfg)
            .orderBy(F.col("proposal_approved_at").desc(), F.col("receipt_id").desc())
            .limit(n).select("proposal_id", "receipt_id", "proposal_approved_at"))
