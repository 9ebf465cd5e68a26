"""Small shared pieces of the view plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from govlake.config import ContractConfig
from govlake.functions.text import after_first_dot


def on_contracts(cfg: ContractConfig, col: str = "receiver_id") -> Column:
    return F.col(col).isin(*cfg.view_contracts)


def on_contracts_after_dot(cfg: ContractConfig, col: str = "receiver_id") -> Column:
    return after_first_dot(F.col(col)).isin(*cfg.view_contracts)
