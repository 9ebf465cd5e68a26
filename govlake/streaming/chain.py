"""In-order chain validation as a stream (ST3): the rule of ``plans.chain`` with state between batches.

State of a feed: the block that was accepted last, the highest height seen, and the blocks that wait for their parent.
A batch's blocks are taken in order of height. A block is accepted when it names the last accepted hash;
one that names another waits. When a block is accepted, waiting ones at or below its height can no longer be, and the
lowest waiting one that names it is accepted next. A block waits until a height more than ``lag`` above it
has been seen: ``lag`` 0 decides in the batch, as a feed in order needs it; a larger one allows blocks to arrive that many heights
late. So the state holds no more than the blocks of ``lag`` heights.

Each block leaves once, with its status: ``accepted``, ``orphan`` (its parent did not come) or ``late`` (at or below the last
accepted height, also a block that is delivered again). No stored block is read. The state store lies in the stream's
checkpoint folder, so a restart goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from govlake.session import checkpoint_dir, ensure_session_conf, path_exists

HEADER = "height bigint, hash string, prev_hash string"
STATUS = f"feed string, {HEADER}, expected_prev_hash string, status string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Chain:
    """The rule for one feed: blocks in, decisions out. ``waiting``: height -> (hash, prev_hash)."""

    def __init__(self, lag: int, last: tuple[int, str] | None, top: int, waiting: dict[int, tuple[str, str]]):
        self.lag, self.last, self.top, self.waiting = lag, last, top, dict(waiting)

    def decide(self, height: int, block: tuple[str, str], status: str) -> tuple:
        return height, *block, self.last[1] if self.last else None, status

    def accept(self, height: int, block: tuple[str, str]) -> Iterator[tuple]:
        while True:
            yield self.decide(height, block, "accepted")
            self.last = height, block[0]
            for h in sorted(h for h in self.waiting if h <= height):
                yield self.decide(h, self.waiting.pop(h), "orphan")
            height = min((h for h, (_, prev) in self.waiting.items() if prev == self.last[1]), default=None)
            if height is None:
                return
            block = self.waiting.pop(height)

    def take(self, blocks: list[tuple[int, str, str]]) -> Iterator[tuple]:
        for height, *block in sorted(blocks):
            self.top = max(self.top, height)
            if self.last and height <= self.last[0]:
                yield self.decide(height, block, "late")
            elif self.last is None or block[1] == self.last[1]:
                yield from self.accept(height, tuple(block))
            elif height in self.waiting:
                yield self.decide(height, block, "late")
            else:
                self.waiting[height] = tuple(block)
        for h in sorted(h for h in self.waiting if h + self.lag <= self.top):
            yield self.decide(h, self.waiting.pop(h), "orphan")


class ChainValidator(StatefulProcessor):
    def __init__(self, lag: int):
        self.lag = lag

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "height bigint, hash string, top bigint")
        self.waiting = handle.getMapState("waiting", "height bigint", "hash string, prev_hash string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = self.last.get() if self.last.exists() else None
        before = {k[0]: tuple(v) for k, v in self.waiting.iterator()}
        chain = Chain(self.lag, stored and (stored[0], stored[1]), stored[2] if stored else -1, before)
        for decision in chain.take([(r["height"], r["hash"], r["prev_hash"]) for r in rows]):
            yield Row(feed=key[0], **dict(zip(("height", "hash", "prev_hash", "expected_prev_hash", "status"), decision)))
        for h in before.keys() - chain.waiting.keys():
            self.waiting.removeKey((h,))
        for h in chain.waiting.keys() - before.keys():
            self.waiting.updateValue((h,), chain.waiting[h])
        if chain.last:
            self.last.update((*chain.last, chain.top))

    def close(self) -> None:
        pass


def chain_decisions(headers: DataFrame, lag: int = 0) -> DataFrame:
    """Streaming ``headers`` (feed, height, hash, prev_hash) -> one row per block with its status."""
    headers.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return headers.where("height is not null").select("feed", "height", "hash", "prev_hash").groupBy("feed").transformWithState(
        statefulProcessor=ChainValidator(lag), outputStructType=STATUS, outputMode="Append", timeMode="None")


def start_chain_validation(spark: SparkSession, headers: DataFrame, root: str, app_version: str = "v1", lag: int = 0,
                           available_now: bool = True, checkpoint: str | None = None):
    """Start the stream that writes ``<root>/chain_status/<app_version>``; returns the StreamingQuery.

    ``headers``: streaming height, hash, prev_hash (any source; blocks of a batch in any order).
    """
    ensure_session_conf(spark)
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/streams/chain-{app_version}"
    decided = chain_decisions(headers.select(F.lit(app_version).alias("feed"), "height", "hash", "prev_hash"), lag)
    w = decided.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt).option(
        "path", f"{root}/chain_status/{app_version}").queryName(f"govlake-chain-{app_version}")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def chain_status(spark: SparkSession, root: str, app_version: str = "v1") -> DataFrame:
    """What the stream decided so far."""
    path = f"{root}/chain_status/{app_version}"
    return spark.read.schema(STATUS).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], STATUS)


def drop_orphans(rows: DataFrame, status: DataFrame, height_col: str) -> DataFrame:
    """``rows`` of a fact table without those of heights that were only ever rejected (a block delivered again stays)."""
    accepted = F.max(F.col("status").isin("accepted"))
    bad = status.where("status <> 'late'").groupBy("height").agg(accepted.alias("ok")).where("not ok").select(F.col("height").alias("__bad"))
    return rows.join(bad, rows[height_col] == bad["__bad"], "left_anti")
