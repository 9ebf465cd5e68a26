"""Continuous ingest: landed block files -> fact tables, idempotent and replayable.

    q = start_ingest(spark, landing_dir, lake_root, cfg, app_version="v1")
    q.awaitTermination()

Each micro-batch (``foreachBatch``) flattens its block records and upserts
blocks, actions, outcomes and the decoded silver rows by key over the whole table
(last write wins), then records the cursor for the app version and
chain-continuity findings. A replayed or late block is absorbed by the keyed upsert, so
re-running a range (new ``app_version`` = new checkpoint folder) changes nothing but
the replayed rows.

Which files are unread is known to the stream's own checkpoint (under
spark.checkpoint.dir), and to nothing else: a restart with a checkpoint reads every file it has not
read, whatever heights it holds. Only a stream without a checkpoint starts at a height
(explicit, else the version's cursor + 1, else configured).

A height delivered twice in one batch: the record that arrived last (file
modification time, then file name, then place in the file) wins in all tables.

No watermark is needed: the feed is final and no state is kept between batches
except the cursor table.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.config import ContractConfig
from govlake.operators.flatten import flatten_blocks, flatten_silver, ns_to_block_time
from govlake.operators.latest import first_per_key
from govlake.operators.upsert import INGEST_COL, SLOTS, KeyIndex, cursor_latest, resume_height, upsert_table
from govlake.session import checkpoint_dir, ensure_session_conf, path_exists
from govlake.sources.blockfeed import landing_records, landing_schema
from govlake.streaming.progress import BatchMetrics, ProcessedRanges, observed
from govlake.sources.zones import files_by_height, index_landing
from govlake.sources.tables import SILVER_PARTITIONS, silver_for_storage, with_bucket

ARRIVAL = "__arrival"


def _ordered(df: DataFrame, height_col: str) -> DataFrame:
    """Rank within a batch: one record per height is left, so a key that comes twice goes to the higher block."""
    return df.withColumn(INGEST_COL, F.col(height_col).cast("bigint"))


def hash_index(spark: SparkSession, root: str) -> KeyIndex:
    """The hashes of the stored blocks, dealt to folders by hash."""
    return KeyIndex(spark, f"{root}/blocks", ["hash"], ["hash"], SLOTS)


def chain_findings(blocks: DataFrame, index: KeyIndex, root: str) -> DataFrame:
    """ST3: blocks of this batch whose parent is neither in the batch nor stored.

    Distributed anti-joins on the parent hash (no ordered scan); of the stored hashes only the folders are read that the
    batch's parents hash to. Rows are kept in the tables and only reported here; ``streaming.chain`` decides
    in order. The lowest block of the batch is unchecked when no stored block lies below it: there its parent is not
    known yet, as at the start of a run.
    """
    spark = blocks.sparkSession
    orphans = blocks.join(blocks.select(F.col("hash").alias("parent_hash")), F.col("prev_hash") == F.col("parent_hash"), "left_anti")
    if path_exists(spark, index.path):
        parents = index.find(index.entries(blocks.select(F.col("prev_hash").alias("hash"))))
        orphans = orphans.join(parents.select(F.col("hash").alias("stored_hash")), F.col("prev_hash") == F.col("stored_hash"), "left_anti")
    lowest = blocks.agg(F.min("height")).first()[0]
    if not _stored_below(spark, root, lowest):
        orphans = orphans.where(F.col("height") != lowest)
    return orphans.select("height", "hash", "prev_hash")


def _stored_below(spark: SparkSession, root: str, height: int) -> bool:
    """Whether a block below the height is stored; the filters leave the partitions and row groups that can hold one."""
    if not path_exists(spark, f"{root}/blocks"):
        return False
    stored = spark.read.schema("height bigint, height_bucket bigint").parquet(f"{root}/blocks")
    return not stored.where((F.col("height_bucket") <= height) & (F.col("height") < height)).limit(1).isEmpty()


CURSOR_SCHEMA = "cursor string, block_num bigint, block_id string, id string"


def cursors(spark: SparkSession, root: str) -> DataFrame:
    """The cursor table (partitioned by app version; the schema keeps the version a string)."""
    if path_exists(spark, f"{root}/cursors"):
        return spark.read.schema(CURSOR_SCHEMA).parquet(f"{root}/cursors")
    return spark.createDataFrame([], CURSOR_SCHEMA)


def _write_cursor(blocks: DataFrame, root: str, app_version: str) -> None:
    """ST4: the last block of the batch, one row per app version; only the version's partition is replaced."""
    log = blocks.select(F.lit(app_version).alias("app_version"), F.col("height").alias("block_num"),
                        F.col("hash").alias("block_hash"), F.col("height").alias("processed_order"))
    (cursor_latest(log).select("cursor", "block_num", "block_id", "id").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("id").parquet(f"{root}/cursors"))


def last_arrivals(records: DataFrame) -> DataFrame:
    """One record per height: the one that arrived last (``__arrival``, where the reader gave one)."""
    if ARRIVAL not in records.columns:
        records = records.withColumn(ARRIVAL, F.struct(F.lit(0).alias("at")))
    order = F.struct(ARRIVAL, F.monotonically_increasing_id().alias("place"))
    ranked = records.withColumn("__height", F.col("block.header.height")).withColumn(ARRIVAL, order)
    return first_per_key(ranked, ["__height"], [F.col(ARRIVAL).desc()]).drop("__height", ARRIVAL)


def ingest_batch(spark: SparkSession, records: DataFrame, batch_id: int, root: str,
                 cfg: ContractConfig = ContractConfig(), app_version: str = "v1",
                 start_height: int | None = None, end_height: int | None = None) -> None:
    """One micro-batch (also usable for a bounded replay)."""
    ensure_session_conf(spark)
    if end_height is not None:
        records = records.where(F.col("block.header.height") <= end_height)
    if start_height is not None:
        records = records.where(F.col("block.header.height") >= start_height)
    records = records.persist()  # read by several flattens; recomputed from the batch's files on loss
    try:
        n, distinct = records.agg(F.count(F.lit(1)), F.count_distinct("block.header.height")).first()
        if n == 0:
            return
        if n != distinct:
            checkpoint_dir(spark)
            once = last_arrivals(records).checkpoint()  # one winner for all tables
        else:
            once = records
        _store_batch(spark, once, batch_id, root, cfg, app_version)
    finally:
        records.unpersist()


def _store_batch(spark: SparkSession, records: DataFrame, batch_id: int, root: str, cfg: ContractConfig, app_version: str) -> None:
    facts = flatten_blocks(records, cfg)
    blocks = facts.blocks
    hashes = hash_index(spark, root)
    (chain_findings(blocks, hashes, root).withColumn("app_version", F.lit(app_version))
     .withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("app_version", "batch_id")
     .parquet(f"{root}/chain_findings"))  # a retried batch replaces its own findings
    hashes.add_new(hashes.entries(blocks))
    # silver for this batch: a receipt and its outcome arrive in the same block record,
    # so the decoded rows come straight from the records (no join)
    silver = silver_for_storage(flatten_silver(records, cfg))
    tables = [("receipt_actions", with_bucket(facts.actions, "block_height"), "block_height", ["id"], "height_bucket", False),
              ("execution_outcomes", with_bucket(facts.outcomes, "block_height"), "block_height", ["receipt_id"], "height_bucket", False),
              ("silver", silver, "block_height", ["id"], SILVER_PARTITIONS, False),
              ("blocks", with_bucket(blocks, "height"), "height", ["height"], "height_bucket", True)]
    # the tables don't depend on each other: their jobs share the cluster; all are done before the cursor moves
    with ThreadPoolExecutor(len(tables)) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(upsert_table), spark, _ordered(rows, height), f"{root}/{name}", keys, parts,
                            located=located) for name, rows, height, keys, parts, located in tables]
        for job in jobs:
            job.result()
    ProcessedRanges(spark, root).add(app_version, blocks.select("height"))
    _write_cursor(blocks, root, app_version)  # ST4: the cursor is written last


def resume_start(spark: SparkSession, root: str, app_version: str, explicit: int | None = None,
                 configured: int | None = None) -> int | None:
    """ST2: explicit start, else the version's cursor + 1, else the configured start."""
    return resume_height(cursors(spark, root), app_version, explicit, configured).first()["start_height"]


def _landed(spark: SparkSession, paths: str | list[str], fmt: str) -> DataFrame:
    return landing_records(spark.read.schema(landing_schema(fmt)).options(**READ_OPTIONS).format(fmt).load(paths), fmt)


def zone_log(root: str) -> str:
    return f"{root}/_zones"


def replay(spark: SparkSession, landing_dir: str, root: str, start_height: int | None = None,
           cfg: ContractConfig = ContractConfig(), app_version: str = "replay", fmt: str = "parquet",
           batch_id: int | None = None, end_height: int | None = None) -> None:
    """Bounded backfill of landed blocks of a range of heights (ends inclusive) into the same upsert sink.

    Only files that hold a height of the range are read; the zone log under ``root`` names them.
    The findings of each replay are kept under a ``batch_id`` of its own (default: milliseconds since 1970).
    """
    files = index_landing(spark, landing_dir, zone_log(root), fmt).files_between(start_height, end_height)
    if files:
        ingest_batch(spark, _landed(spark, files, fmt), time.time_ns() // 1_000_000 if batch_id is None else batch_id, root, cfg,
                     app_version, start_height, end_height)


READ_OPTIONS = {"mode": "FAILFAST"}  # a malformed record stops the ingest, it is not skipped


def start_ingest(spark: SparkSession, landing_dir: str, root: str, cfg: ContractConfig = ContractConfig(),
                 app_version: str = "v1", fmt: str = "parquet", max_files_per_trigger: int = 8,
                 start_height: int | None = None, available_now: bool = True, checkpoint: str | None = None,
                 configured_start: int | None = None):
    """Start the streaming ingest; returns the StreamingQuery.

    A restart with the same checkpoint reads every file it has not read yet, whatever its
    heights. Without a checkpoint the start height is resolved by ``resume_start``.
    """
    ensure_session_conf(spark)
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/streams/{app_version}"
    name = f"govlake-ingest-{app_version}"
    start = None if path_exists(spark, f"{ckpt}/offsets") else resume_start(spark, root, app_version, start_height, configured_start)
    src = landing_records(spark.readStream.schema(landing_schema(fmt)).options(**READ_OPTIONS).format(fmt)
                          .option("maxFilesPerTrigger", max_files_per_trigger).load(landing_dir), fmt)
    src = observe_records(src, name)
    w = (src.writeStream.foreachBatch(
        lambda df, bid: ingest_batch(spark, df, bid, root, cfg, app_version, start))
        .option("checkpointLocation", ckpt).queryName(name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    BatchMetrics.listen(spark, root, name, app_version, None if cfg.as_of is None else cfg.as_of_column())
    return w.start()


def observe_records(records: DataFrame, name: str) -> DataFrame:
    """M3: block records with the figures of their batch observed on the way (``streaming.progress``)."""
    h = F.col("block.header")
    named = records.withColumns({"height": h["height"], "hash": h["hash"], "timestamp": ns_to_block_time(h["timestamp_nanosec"])})
    return observed(named, name).drop("height", "hash", "timestamp")


def start_ordered_ingest(spark: SparkSession, landing_dir: str, root: str, cfg: ContractConfig = ContractConfig(),
                         app_version: str = "v1", fmt: str = "parquet", lag: int = 0, available_now: bool = True,
                         checkpoint: str | None = None, files_at_once: int = 64):
    """The ingest over files in order of height, whatever their order of arrival.

    The stream carries file names and their ranges; Spark reads the blocks of ``files_at_once`` files at a time, lowest first. Files
    that end within ``lag`` heights of the highest block seen wait for lower ones; a final run with lag 0 takes them.
    """
    ensure_session_conf(spark)
    index_landing(spark, landing_dir, zone_log(root), fmt)

    def store(batch: DataFrame, batch_id: int) -> None:
        files = [r["file"] for r in batch.orderBy("lowest", "highest", "file").collect()]  # file names only, no data
        for i in range(0, len(files), files_at_once):
            ingest_batch(spark, _landed(spark, files[i:i + files_at_once], fmt), batch_id * 1_000_000 + i, root, cfg, app_version)

    ckpt = checkpoint or f"{checkpoint_dir(spark)}/streams/ordered-{app_version}"
    w = files_by_height(spark, landing_dir, zone_log(root), lag, fmt).writeStream.foreachBatch(store).option(
        "checkpointLocation", ckpt).queryName(f"govlake-ordered-{app_version}")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
