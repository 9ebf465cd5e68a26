"""

Every query derives the governance fact tables from the driver's ``events``
table (see govlake/sources/fixtures.py for the mapping) and runs the Spark
plan over the whole table. ``oracle_sql()`` gives the same result as an
independent DuckDB query over the same parquet files (oracle/).
"""

from __future__ import annotations

import hashlib
import os
import sys
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:  # importable when loaded by file path from another working directory
    sys.path.insert(0, _HERE)

from govlake.session import ensure_session_conf  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

_LAKES: dict = {}
_LOCK = threading.Lock()


def _lake(spark: SparkSession, sf_dir: str):
    """One GovLake per session and data folder.

    The facts derived from ``events`` and their decoded silver layer are
    written under the session's checkpoint folder (spark.checkpoint.dir), each table
    on first use, and every view reads those tables. The folder ``govlake/<application id>``
    there can be deleted when the application has ended.
    """
    from govlake.plans.catalog import GovLake
    from govlake.session import checkpoint_dir

    ensure_session_conf(spark)
    app = spark.sparkContext.applicationId  # jobs sharing the checkpoint folder never collide
    key = (app, sf_dir)
    with _LOCK:  # concurrent callers share one lake
        if key not in _LAKES:
            root = f"{checkpoint_dir(spark)}/govlake/{app}/{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}"
            _LAKES[key] = GovLake.from_events(spark, sf_dir).stored(root)
        return _LAKES[key]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the proposals view (joins, aggregates over the latest votes) at sf0.001."""
    return _lake(spark, SMOKE_DIR).proposals()


# ---- query bodies (lake -> DataFrame) ---------------------------------------

def _replay_cut(blocks: DataFrame):
    """Middle height of the stored chain: replays start there."""
    return blocks.agg(F.expr("(min(height) + max(height)) div 2")).scalar()


def _upsert(lake, table: str, key: list[str], marker_col: str):
    from govlake.operators.upsert import upsert_frames
    df = getattr(lake.facts, table)
    hcol = "height" if table == "blocks" else "block_height"
    replay = df.where(F.col(hcol) >= _replay_cut(lake.facts.blocks)).withColumn(
        marker_col, F.concat(F.lit("replay:"), F.col(marker_col)))
    return upsert_frames(df, replay, key)


_INGESTED: dict = {}


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """Root of a lake that ingest itself wrote: upper half of the chain, then the lower half, then a replay.

    Version v1 ends with the lower half, so its cursor is not the highest block; v2 replays from the cut.
    """
    from govlake.session import checkpoint_dir
    from govlake.streaming.ingest import ingest_batch

    lake = _lake(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        if key not in _INGESTED:
            root = f"{checkpoint_dir(spark)}/govlake/{key[0]}/{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}-ingested"
            records, cut = lake.nested, _replay_cut(lake.facts.blocks)
            height = F.col("block.header.height")
            ingest_batch(spark, records.where(height >= cut), 0, root, lake.cfg, "v1")
            ingest_batch(spark, records.where(height < cut), 1, root, lake.cfg, "v1")
            ingest_batch(spark, records.where(height >= cut), 2, root, lake.cfg, "v2")
            _INGESTED[key] = root
    return _INGESTED[key]


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actions of the middle half of the chain, replayed from the landed files that hold it into an empty lake."""
    from govlake.session import checkpoint_dir
    from govlake.sources.tables import read_fact
    from govlake.streaming.ingest import replay

    lake = _lake(spark, sf_dir)
    lake.nested.select("block.header.height").limit(1).collect()  # the landing is written
    low, high = lake.facts.blocks.agg(F.expr("(3 * min(height) + max(height)) div 4"), F.expr("(min(height) + 3 * max(height)) div 4")).first()
    key = (spark.sparkContext.applicationId, sf_dir, "replayed")
    base = f"{checkpoint_dir(spark)}/govlake/{key[0]}/{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}"
    with _LOCK:
        if key not in _INGESTED:
            replay(spark, f"{base}/landing", f"{base}-replayed", low, lake.cfg, end_height=high)
            _INGESTED[key] = f"{base}-replayed"
    return read_fact(spark, _INGESTED[key], "receipt_actions")


def _storage_queries() -> dict[str, Callable]:
    """Queries over tables that ingest wrote, (spark, sf_dir) -> DataFrame."""
    from govlake.operators.upsert import resume_height
    from govlake.sources.tables import read_fact
    from govlake.streaming.ingest import cursors
    from govlake.streaming.progress import ProcessedRanges

    def fact(name):
        return lambda spark, sf_dir: read_fact(spark, _ingested(spark, sf_dir), name)

    return {
        "chain_stream": _validated,
        "block_gauges": _gauged,
        "processed_ranges": lambda spark, sf_dir: ProcessedRanges(spark, _ingested(spark, sf_dir)).processed(),
        "silent_gaps": lambda spark, sf_dir: ProcessedRanges(spark, _ingested(spark, sf_dir)).silent_gaps(),
        "replayed_heights": _replayed,
        "ingest_storage_blocks": fact("blocks"),
        "ingest_storage_actions": fact("receipt_actions"),
        "ingest_storage_outcomes": fact("execution_outcomes"),
        "cursor_latest": lambda spark, sf_dir: cursors(spark, _ingested(spark, sf_dir)).select("id", "cursor", "block_num", "block_id"),
        "resume_height": lambda spark, sf_dir: resume_height(cursors(spark, _ingested(spark, sf_dir)), "v1", None, 0),
    }


_VALIDATED: dict = {}


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3 as a stream: the branched feed lands in five files in order of height; the stream stops after three and goes on."""
    from govlake.session import checkpoint_dir
    from govlake.sources.fixtures import branched_blocks
    from govlake.streaming.chain import HEADER, chain_status, start_chain_validation

    lake = _lake(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    root = f"{checkpoint_dir(spark)}/govlake/{key[0]}/{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}-validated"
    with _LOCK:
        if key not in _VALIDATED:
            feed = branched_blocks(lake.facts.blocks).select("height", "hash", "prev_hash")
            low, high = (feed.agg(f("height")).scalar() for f in (F.min, F.max))
            part = F.floor((F.col("height") - low) * 5 / (high - low + 1))

            def run(parts) -> None:
                for i in parts:
                    feed.where(part == i).select("height", "hash", "prev_hash").coalesce(1).write.mode("append").parquet(f"{root}/headers")
                headers = spark.readStream.schema(HEADER).option("maxFilesPerTrigger", 1).parquet(f"{root}/headers")
                start_chain_validation(spark, headers, root, checkpoint=f"{root}/checkpoint").awaitTermination()

            run(range(3))
            run(range(3, 5))
            _VALIDATED[key] = root
    return chain_status(spark, root).select("height", "hash", "prev_hash", (F.col("status") == "accepted").alias("accepted"))


def _gauged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5-ST7 as a stream: the blocks land in four files in order of height; the stream stops after two and goes on."""
    from govlake.session import checkpoint_dir
    from govlake.streaming.gauges import block_gauges, start_gauges

    lake = _lake(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, "gauges")
    root = f"{checkpoint_dir(spark)}/govlake/{key[0]}/{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}-gauged"
    with _LOCK:
        if key not in _VALIDATED:
            blocks = lake.facts.blocks.select("height", "timestamp")
            low, high = (blocks.agg(f("height")).scalar() for f in (F.min, F.max))
            part = F.floor((F.col("height") - low) * 4 / (high - low + 1))
            for parts in (range(2), range(2, 4)):
                for i in parts:
                    blocks.where(part == i).coalesce(1).write.mode("append").parquet(f"{root}/landed")
                stream = spark.readStream.schema(blocks.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landed")
                start_gauges(spark, stream, root, checkpoint=f"{root}/checkpoint").awaitTermination()
            _VALIDATED[key] = root
    return block_gauges(spark, root, lake.cfg.as_of_column())


def _branched(lake):
    from govlake.sources.fixtures import branched_blocks
    return branched_blocks(lake.facts.blocks)


def _decode_join(lake):
    """Actions with their outcomes from the two fact tables."""
    from govlake.functions.json import jstr
    from govlake.operators.decode import decode_actions
    d = decode_actions(lake.facts.actions, lake.facts.outcomes)
    return d.select("id", "receipt_id", "status", jstr("args", "$.proposal_id").alias("args_proposal_id"),
                    jstr("log0", "$.event").alias("first_event"), F.size("log_docs").alias("n_logs"),
                    jstr("results", "$.status_type").alias("result_type"))


def _safe_parse(lake):
    """UD1 over every call's argument text."""
    from govlake.functions.json import b64_text, jstr
    from govlake.functions.sql import register_sql_functions
    register_sql_functions(lake.spark)
    t = lake.facts.actions.select("id", b64_text("args_base64").alias("t"))
    p = t.select("id", "t", F.expr("safe_json_parse(t)").alias("v"))
    return p.select("id", F.col("v").isNull().alias("is_absent"), jstr("v", "$.error").alias("error"),
                    jstr("v", "$.original_text").alias("original_text"), jstr("v", "$.proposal_id").alias("proposal_id"))


def _contract_receipts(lake):
    from govlake.operators.flatten import is_contract_account
    r = lake.nested.select(F.explode("shards").alias("s")).select(
        F.explode("s.receipt_execution_outcomes").alias("reo")).select("reo.receipt.*")
    return r.where(is_contract_account(F.col("receiver_id"), lake.cfg)
                   | is_contract_account(F.col("predecessor_id"), lake.cfg)).select(
        "receipt_id", "receiver_id", "predecessor_id")


def _args_decode(lake):
    from govlake.functions.json import args_json_text, b64_text, parse_json_strict
    a = lake.facts.actions
    return a.select("id", "method_name", b64_text("args_base64").alias("args_text"),
                    parse_json_strict(b64_text("args_base64")).isNotNull().alias("args_valid"),
                    args_json_text(F.col("args_base64")).alias("args_json"))


def _stages(lake):
    from govlake.plans.registered_voters import voter_stages
    return voter_stages(lake.silver, lake.cfg, lake.proposal_voting_history(), lake.delegation_events(),
                        lake.approved_proposals())


def _proposal_votes(lake):
    from govlake.plans.proposals import proposal_votes
    from govlake.plans.voting_history import latest_votes, proposal_metadata
    return proposal_votes(latest_votes(lake.silver, lake.cfg), proposal_metadata(lake.silver, lake.cfg))


def _registry() -> dict[str, Callable]:
    from govlake.operators.upsert import upsert_frames
    from govlake.plans import chain as C
    from govlake.plans import quality as Q
    from govlake.plans import registered_voters as RV
    from govlake.plans.approved_proposals import recent_approved
    from govlake.plans.delegation_events import latest_delegation
    from govlake.plans.proposals import active_proposals
    from govlake.plans.user_activities import branch
    from govlake.plans.voting_history import top_voters

    r: dict[str, Callable] = {
        # the seven views
        "delegation_events": lambda L: L.delegation_events(),
        "proposal_voting_history": lambda L: L.proposal_voting_history(),
        "proposals": lambda L: L.proposals(),
        "approved_proposals": lambda L: L.approved_proposals(),
        "registered_voters": lambda L: L.registered_voters(),
        "user_activities": lambda L: L.user_activities(),
        "proposal_non_voters": lambda L: L.proposal_non_voters(),
        # ingest: flatten of the nested block feed, decoders, contract filter
        "blocks_table": lambda L: L.flat.blocks,
        "actions_flatten": lambda L: L.flat.actions,
        "outcomes_flatten": lambda L: L.flat.outcomes,
        "results_decode": lambda L: L.flat.outcomes.select("receipt_id", "status", "results_json"),
        "args_decode": _args_decode,
        "decode_quality": lambda L: Q.decode_quality(L.facts.actions),
        "contract_filter": _contract_receipts,
        # sinks: keyed upsert, cursor, replay
        "upsert_blocks": lambda L: _upsert(L, "blocks", ["height"], "author"),
        "upsert_actions": lambda L: _upsert(L, "actions", ["id"], "author"),
        "upsert_outcomes": lambda L: _upsert(L, "outcomes", ["receipt_id"], "executor_account_id"),
        "decode_join": _decode_join,
        "safe_json_parse": _safe_parse,
        "replay_range": lambda L: upsert_frames(
            L.facts.actions, L.flat.actions.where(F.col("block_height") >= _replay_cut(L.facts.blocks)), ["id"]),
        # monitoring and data quality
        "accepted_blocks": lambda L: C.accepted_blocks(_branched(L)),
        "chain_state": lambda L: C.chain_state(_branched(L)),
        "chain_breaks": lambda L: Q.chain_breaks(L.facts.blocks),
        "block_gaps": lambda L: Q.block_gaps(L.facts.blocks),
        "block_age": lambda L: Q.block_age(L.facts.blocks, L.cfg.as_of_column()),
        "block_rate": lambda L: Q.block_rate(L.facts.blocks),
        "range_summary": lambda L: Q.range_summary(L.facts.blocks),
        "coverage": lambda L: Q.coverage(L.facts.actions),
        "newest_blocks": lambda L: Q.newest_blocks(L.facts.blocks),
        # view pieces and documented consumer queries
        "latest_delegation": lambda L: latest_delegation(L.delegation_events()),
        "delegation_history": lambda L: L.delegation_events().select(
            "delegator_id", "delegatee_id", "event_timestamp"),
        "top_voters": lambda L: top_voters(L.proposal_voting_history()),
        "recent_approved": lambda L: recent_approved(L.silver, L.cfg),
        "proposal_votes": _proposal_votes,
        "active_proposals": lambda L: active_proposals(L.proposals()),
        "first_registration": lambda L: RV.first_registration(L.silver, L.cfg),
        "first_deposit": lambda L: RV.first_deposit(L.silver, L.cfg),
        "latest_lock": lambda L: RV.latest_lock(L.silver, L.cfg).withColumnRenamed(
            "lk_voter", "registered_voter_id"),
        "growth_config": lambda L: RV.growth_config(L.silver, L.cfg).withColumnRenamed(
            "gc_contract", "hos_contract_address"),
        "participation": lambda L: _stages(L).select("registered_voter_id", "proposal_participation_rate"),
        "delegated_power": lambda L: RV.delegated_power(_stages(L)),
    }
    for key, methods in [
        ("act_lockup_deployed", ["on_lockup_deployed"]), ("act_lock_near", ["lock_near"]),
        ("act_lockup_update", ["on_lockup_update"]), ("act_delegations", ["delegate_all", "undelegate"]),
        ("act_begin_unlock", ["begin_unlock_near"]), ("act_relock", ["lock_pending_near"]),
        ("act_withdraw", ["withdraw_from_staking_pool", "withdraw_all_from_staking_pool"]),
        ("act_unstake", ["unstake", "unstake_all"]),
    ]:
        r[key] = (lambda ms: lambda L: branch(L.user_activities(), ms))(methods)
    return r


def _llm():
    """The training-data queries; None when their subpackage is not installed."""
    try:
        from govlake.llm import queries as llm
    except ImportError:
        return None
    return llm


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = _llm()
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = dict(llm.QUERIES) if llm else {}
    for name, body in _registry().items():
        def run(spark: SparkSession, sf_dir: str, _body=body) -> DataFrame:
            return _body(_lake(spark, sf_dir))
        run.__name__ = name
        out[name] = run
    return out | _storage_queries()


def oracle_sql() -> dict[str, str]:
    from oracle import ORACLE_QUERIES
    names = set(_registry()) | set(_storage_queries())
    llm = _llm()
    return {k: v for k, v in ORACLE_QUERIES.items() if k in names} | (dict(llm.ORACLES) if llm else {})
