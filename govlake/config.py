"""Contract configuration shared by ingest and views."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ContractConfig:
    """Which contracts the pipeline follows.

    ``contract`` is the governance root account; the two contracts the views
    read are ``<token_prefix>.<contract>`` and ``<voting_prefix>.<contract>``.
    ``as_of`` replaces the wall clock in reward maths so results are
    reproducible; it may be a datetime, a Column (e.g. a scalar subquery) or
    None (use the current timestamp).
    """

    contract: str = "hos.test"
    token_prefix: str = "v"
    voting_prefix: str = "vote"
    as_of: object = field(default=None, compare=False)

    @property
    def token_contract(self) -> str:
        return f"{self.token_prefix}.{self.contract}"

    @property
    def voting_contract(self) -> str:
        return f"{self.voting_prefix}.{self.contract}"

    @property
    def view_contracts(self) -> list[str]:
        return [self.token_contract, self.voting_contract]

    @property
    def suffix(self) -> str:
        """Lower-cased account suffix the ingest filter matches."""
        return "." + self.contract.lower()

    def as_of_column(self) -> Column:
        if self.as_of is None:
            return F.current_timestamp().cast("timestamp_ntz")
        if isinstance(self.as_of, Column):
            return self.as_of.cast("timestamp_ntz")
        if isinstance(self.as_of, datetime):
            return F.lit(self.as_of).cast("timestamp_ntz")
        return F.lit(str(self.as_of)).cast("timestamp_ntz")

    def with_as_of(self, as_of) -> "ContractConfig":
        return ContractConfig(self.contract, self.token_prefix, self.voting_prefix, as_of)
