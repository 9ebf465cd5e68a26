"""The view catalogue: builds the seven views in dependency order over one silver layer.

    lake = GovLake.from_events(spark, sf_dir)      # or GovLake(spark, facts, cfg)
    lake.proposals().show()
    lake.register_views()                          # temp views for spark.sql

Views are DataFrames built lazily; derived views reuse the same DataFrame
objects (proposal_voting_history feeds proposals, registered_voters and
proposal_non_voters).
"""

from __future__ import annotations

import logging
import threading
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.config import ContractConfig
from govlake.operators.decode import decode_actions
from govlake.sources.fixtures import Facts, event_rows, facts_from_rows

log = logging.getLogger(__name__)

# The views in the order in which they build on each other.
VIEW_ORDER = ["delegation_events", "proposal_voting_history", "proposals", "approved_proposals",
              "registered_voters", "user_activities", "proposal_non_voters"]


class StoredTables:
    """Landing, facts and silver of a lake as Parquet tables, each written when first read."""

    def __init__(self, lake: "GovLake", root: str, cfg: ContractConfig):
        self._lake, self._root, self._cfg, self._lock = lake, root, cfg, threading.RLock()
        self._done: dict[str, DataFrame] = {}

    def _once(self, name: str, write, read) -> DataFrame:
        with self._lock:  # concurrent readers share one write
            if name not in self._done:
                write(f"{self._root}/{name}")
                self._done[name] = read()
            return self._done[name]

    def _fact(self, name: str, df: DataFrame, height: str) -> DataFrame:
        from govlake.sources.tables import read_fact, with_bucket, write_table
        return self._once(name, lambda path: write_table(with_bucket(df, height), path, "height_bucket"),
                          lambda: read_fact(self._lake.spark, self._root, name))

    @property
    def blocks(self) -> DataFrame:
        return self._fact("blocks", self._lake.facts.blocks, "height")

    @property
    def actions(self) -> DataFrame:
        return self._fact("receipt_actions", self._lake.facts.actions, "block_height")

    @property
    def outcomes(self) -> DataFrame:
        return self._fact("execution_outcomes", self._lake.facts.outcomes, "block_height")

    @property
    def landing(self) -> DataFrame:
        from govlake.sources.blockfeed import read_blocks
        from govlake.sources.tables import write_table
        return self._once("landing", lambda path: write_table(self._lake.nested, path, None),
                          lambda: read_blocks(self._lake.spark, f"{self._root}/landing"))

    @property
    def silver(self) -> DataFrame:
        from govlake.operators.flatten import flatten_silver
        from govlake.sources.tables import read_silver, write_silver

        def write(path: str) -> None:
            if self._lake.events is not None:  # from the landed records: receipt and outcome are together, no join
                write_silver(flatten_silver(self.landing, self._cfg), self._root)
            else:
                write_silver(decode_actions(self.actions, self.outcomes), self._root)

        return self._once("silver", write, lambda: read_silver(self._lake.spark, self._root))


class GovLake:
    def __init__(self, spark: SparkSession, facts: "Facts | StoredTables", cfg: ContractConfig = ContractConfig(),
                 silver: DataFrame | None = None, events: DataFrame | None = None,
                 rows: DataFrame | None = None, store: "StoredTables | None" = None):
        self.spark, self.facts, self.cfg = spark, facts, cfg
        self._silver = silver
        self.events = events
        self._rows = rows          # per-event fixture rows (fixture lakes only)
        self._store = store        # tables written on first use

    @classmethod
    def from_events(cls, spark: SparkSession, sf_dir: str, cfg: ContractConfig = ContractConfig(),
                    as_of_from_events: bool = True) -> "GovLake":
        events = spark.read.parquet(f"{sf_dir}/events.parquet")
        if as_of_from_events and cfg.as_of is None:
            cfg = cfg.with_as_of(events.agg(F.max("ts")).scalar())
        rows = event_rows(events, cfg)
        return cls(spark, facts_from_rows(rows), cfg, events=events, rows=rows)

    @classmethod
    def from_tables(cls, spark: SparkSession, root: str, cfg: ContractConfig = ContractConfig()) -> "GovLake":
        from govlake.sources.tables import has_table, read_facts, read_silver
        silver = read_silver(spark, root) if has_table(spark, f"{root}/silver") else None
        return cls(spark, read_facts(spark, root), cfg, silver=silver)

    def stored(self, root: str) -> "GovLake":
        """A lake over tables under ``root``, each written on first use.

        This is the deployed shape: views read the silver table (pruned by method) instead of
        re-joining and re-decoding the facts every time, and the lineage to the inputs is cut.
        ``as_of`` is evaluated once. The caller owns ``root`` and deletes it when done.
        """
        cfg = self.cfg
        if isinstance(cfg.as_of, Column):
            cfg = cfg.with_as_of(self.spark.range(1).select(cfg.as_of_column()).first()[0])
        tables = StoredTables(self, root, cfg)
        return GovLake(self.spark, tables, cfg, events=self.events, store=tables)

    def materialize(self, root: str) -> "GovLake":
        """``stored``, with every table written now."""
        lake = self.stored(root)
        lake.nested, lake.facts.blocks, lake.facts.actions, lake.facts.outcomes, lake.silver
        return lake

    # -- the block feed (fixture) and its flattening -------------------------
    @cached_property
    def nested(self) -> DataFrame:
        """The block feed: landed records if materialized, else rebuilt from the fixture rows."""
        if self._store is not None:
            return self._store.landing
        from govlake.sources.blockfeed import nested_from_rows
        rows = self._rows if self._rows is not None else event_rows(self.events, self.cfg)
        return nested_from_rows(rows)

    @cached_property
    def flat(self) -> Facts:
        from govlake.operators.flatten import flatten_blocks
        return flatten_blocks(self.nested, self.cfg)

    @cached_property
    def silver(self) -> DataFrame:
        if self._silver is not None:
            return self._silver
        if self._store is not None:
            return self._store.silver
        return decode_actions(self.facts.actions, self.facts.outcomes)

    # -- views ---------------------------------------------------------------
    @cached_property
    def _de(self):
        from govlake.plans.delegation_events import delegation_events
        return delegation_events(self.silver, self.cfg)

    @cached_property
    def _pvh(self):
        from govlake.plans.voting_history import proposal_voting_history
        return proposal_voting_history(self.silver, self.cfg)

    @cached_property
    def _ap(self):
        from govlake.plans.approved_proposals import approved_proposals
        return approved_proposals(self.silver, self.cfg)

    @cached_property
    def _props(self):
        from govlake.plans.proposals import proposals
        return proposals(self.silver, self.cfg)

    @cached_property
    def _rv(self):
        from govlake.plans.registered_voters import registered_voters
        return registered_voters(self.silver, self.cfg, self._pvh, self._de, self._ap)

    @cached_property
    def _ua(self):
        from govlake.plans.user_activities import user_activities
        return user_activities(self.silver, self.cfg)

    def delegation_events(self) -> DataFrame:
        return self._de

    def proposal_voting_history(self) -> DataFrame:
        return self._pvh

    def approved_proposals(self) -> DataFrame:
        return self._ap

    def proposals(self) -> DataFrame:
        return self._props

    def registered_voters(self) -> DataFrame:
        return self._rv

    def user_activities(self) -> DataFrame:
        return self._ua

    def proposal_non_voters(self) -> DataFrame:
        from govlake.plans.non_voters import proposal_non_voters
        from govlake.plans.proposals import proposal_ids
        from govlake.plans.voting_history import latest_votes
        return proposal_non_voters(proposal_ids(self.silver, self.cfg), self._rv, latest_votes(self.silver, self.cfg))

    def register_views(self, prefix: str = "") -> dict[str, str]:
        """Register every view as a temp view; a failing view does not stop the rest."""
        from govlake.functions.sql import register_sql_functions

        register_sql_functions(self.spark)
        status = {}
        for name in VIEW_ORDER:
            try:
                getattr(self, name)().createOrReplaceTempView(prefix + name)
                status[name] = "ok"
            except Exception as e:  # keep going, like the reference's per-view transactions
                log.warning("view %s failed: %s", name, e)
                status[name] = f"failed: {e}"
        for t, df in [("blocks", self.facts.blocks), ("receipt_actions", self.facts.actions),
                      ("execution_outcomes", self.facts.outcomes)]:
            df.createOrReplaceTempView(prefix + t)
        return status
