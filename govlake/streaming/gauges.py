"""Rate, age and range of blocks while they stream by (ST5-ST7, W8), equal to the batch reports of ``plans.quality``.

State of a feed: how many blocks it has had, where the open range began, and the times of the last ten blocks. Each block
gives a row with the rate over the last ten blocks; each tenth its age, each 1,000th the range it closes. Blocks of a
batch are taken in order of height, so a feed in order of height (``files_by_height``) gives the figures of the whole chain, also over
restarts: the state lies in the stream's checkpoint folder and holds ten numbers and two more, however long the chain.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from govlake.functions.time import epoch_micros
from govlake.plans.quality import RANGE_SIZE, RATE_WINDOW
from govlake.session import checkpoint_dir, ensure_session_conf, path_exists
from govlake.streaming.chain import ROCKSDB

AGE_EVERY = 10
GAUGES = ("feed string, height bigint, block_no bigint, window_blocks bigint, blocks_per_second double, newest_micros bigint, "
          "range_first bigint, range_last bigint")


class BlockGauges(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.times = handle.getListState("times", "micros bigint")
        self.count = handle.getValueState("count", "blocks bigint, range_first bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        times = [t[0] for t in self.times.get()] if self.times.exists() else []
        n, first = self.count.get() if self.count.exists() else (0, None)
        for height, micros in sorted((r["height"], r["micros"]) for r in rows):
            n, first = n + 1, height if n % RANGE_SIZE == 0 else first
            times = [*times, micros][-RATE_WINDOW:]
            span = (micros - min(times)) / 1e6
            closes = n % RANGE_SIZE == 0
            yield Row(feed=key[0], height=height, block_no=n, window_blocks=len(times),
                      blocks_per_second=(len(times) - 1) / span if len(times) > 1 and span > 0 else None,
                      newest_micros=micros if n % AGE_EVERY == 0 else None,
                      range_first=first if closes else None, range_last=height if closes else None)
        self.times.put([(t,) for t in times])
        self.count.update((n, first))

    def close(self) -> None:
        pass


def start_gauges(spark: SparkSession, blocks: DataFrame, root: str, app_version: str = "v1", available_now: bool = True,
                 checkpoint: str | None = None):
    """Start the stream that writes ``<root>/gauges/<app_version>`` from streaming blocks (height, timestamp); returns the query."""
    ensure_session_conf(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    ckpt = checkpoint or f"{checkpoint_dir(spark)}/streams/gauges-{app_version}"
    rows = blocks.where("height is not null and timestamp is not null").select(
        F.lit(app_version).alias("feed"), "height", epoch_micros("timestamp").alias("micros"))
    out = rows.groupBy("feed").transformWithState(statefulProcessor=BlockGauges(), outputStructType=GAUGES, outputMode="Append", timeMode="None")
    w = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt).option(
        "path", f"{root}/gauges/{app_version}").queryName(f"govlake-gauges-{app_version}")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def block_gauges(spark: SparkSession, root: str, as_of, app_version: str = "v1") -> DataFrame:
    """The gauges so far; ages are counted up to ``as_of``."""
    path = f"{root}/gauges/{app_version}"
    rows = spark.read.schema(GAUGES).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], GAUGES)
    return rows.select("height", "block_no", "window_blocks", "blocks_per_second",
                       ((epoch_micros(as_of) - F.col("newest_micros")) / F.lit(1e6)).alias("block_age_seconds"), "range_first", "range_last")
