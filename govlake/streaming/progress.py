"""What each app version has processed (ST4, M2), and the figures of its batches (ST5-ST7, M3).

``ProcessedRanges`` keeps a set of height intervals a version. Each batch's heights are merged into it, so what
was processed, and what was silently left out, is known without a look at the stored blocks. A set is written as a new
numbered folder and the older ones are deleted after it is complete: a crash leaves the last complete set.

``BatchMetrics`` is a listener that appends a row per batch of a stream to a table, from metrics that the batch's own plan
observes (``observed``): no extra pass over the data.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from govlake.functions.time import epoch_micros
from govlake.operators.intervals import INTERVAL, gaps, merge_intervals
from govlake.session import delete_path, list_folder, path_exists


class ProcessedRanges:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root}/ranges"

    def versions(self) -> list[str]:
        return sorted(list_folder(self.spark, self.root))

    def _sets(self, version: str) -> list[int]:
        """Numbers of the complete sets of a version."""
        folder = f"{self.root}/{version}"
        return sorted(int(n) for n in list_folder(self.spark, folder) if path_exists(self.spark, f"{folder}/{n}/_SUCCESS"))

    def read(self, version: str) -> DataFrame:
        """(first, last) of what the version has processed."""
        sets = self._sets(version)
        if not sets:
            return self.spark.createDataFrame([], INTERVAL)
        return self.spark.read.schema(INTERVAL).parquet(f"{self.root}/{version}/{sets[-1]}")

    def add(self, version: str, heights: DataFrame) -> None:
        """Merge the heights of a batch (one column, height). A repeated batch changes nothing."""
        sets = self._sets(version)
        batch = heights.select(F.col("height").alias("first"), F.col("height").alias("last"))
        known = {int(n) for n in list_folder(self.spark, f"{self.root}/{version}")}
        merge_intervals(self.read(version).unionByName(batch)).write.parquet(f"{self.root}/{version}/{max(known, default=-1) + 1}")
        for n in sets[:-1]:  # the one that was read stays until the next batch: a reader may still hold it
            delete_path(self.spark, f"{self.root}/{version}/{n}")

    def _each(self, rows) -> DataFrame:
        out = None
        for v in self.versions():
            one = rows(self.read(v)).select(F.lit(v).alias("app_version"), "*")
            out = one if out is None else out.unionByName(one)
        return out

    def processed(self) -> DataFrame:
        """(app_version, first_height, last_height, n_heights)."""
        return self._each(lambda r: r.select(F.col("first").alias("first_height"), F.col("last").alias("last_height"),
                                             (F.col("last") - F.col("first") + 1).alias("n_heights")))

    def silent_gaps(self) -> DataFrame:
        """(app_version, gap_start, gap_end, missing_blocks): heights that the version went past without processing them."""
        return self._each(gaps)


def observed(blocks: DataFrame, name: str) -> DataFrame:
    """``blocks`` (height, hash, timestamp as in the fact table) with the batch's figures observed on the way."""
    missing = F.col("hash").isNull() | F.col("timestamp").isNull()
    return blocks.observe(name, F.count(F.lit(1)).alias("blocks"), F.min("height").alias("first_height"), F.max("height").alias("last_height"),
                          F.count_if(missing).alias("rejects"), epoch_micros(F.max("timestamp")).alias("newest_micros"))


METRICS = ("app_version string, batch_id bigint, blocks bigint, first_height bigint, last_height bigint, rejects bigint, "
           "age_seconds double, blocks_per_second double, trigger_ms bigint")


class BatchMetrics(StreamingQueryListener):
    """Appends a row per batch to ``<root>/batch_metrics`` as the stream goes on.

    A batch is a row of figures that reaches the driver with the query's progress; the rows are written as JSON lines by
    the session, one file a batch, so they outlive the query and its bounded progress list.
    """

    _listening: dict[tuple, BatchMetrics] = {}

    @classmethod
    def listen(cls, spark: SparkSession, root: str, name: str, app_version: str, as_of: Column | None = None) -> None:
        """Listen to a query by name; one that is started again in the same application keeps its listener.

        A block's age is counted up to ``as_of``, by default the time of its batch.
        """
        key = (spark.sparkContext.applicationId, root, name)
        if key not in cls._listening:
            now = None if as_of is None else spark.range(1).select(epoch_micros(as_of)).first()[0]
            cls._listening[key] = cls(spark, root, name, app_version, now)
            spark.streams.addListener(cls._listening[key])

    def __init__(self, spark: SparkSession, root: str, name: str, app_version: str, now: int | None):
        self.spark, self.path, self.name, self.app_version, self.now = spark, f"{root}/batch_metrics", name, app_version, now

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(self.name)
        if p.name != self.name or seen is None or not seen["blocks"]:
            return
        ms = int(p.durationMs.get("triggerExecution", 0))
        figures = seen.asDict()
        newest, now = figures.pop("newest_micros"), self.now or int(datetime.fromisoformat(p.timestamp).timestamp() * 1e6)
        row = {"app_version": self.app_version, "batch_id": p.batchId, **figures, "trigger_ms": ms,
               "age_seconds": None if newest is None else (now - newest) / 1e6,
               "blocks_per_second": seen["blocks"] * 1000 / ms if ms else None}
        self.spark.createDataFrame([(json.dumps(row),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{self.path}/app_version={self.app_version}/batch={p.batchId}")


def batch_metrics(spark: SparkSession, root: str) -> DataFrame:
    """The figures of all batches so far."""
    path = f"{root}/batch_metrics"
    if not path_exists(spark, path):
        return spark.createDataFrame([], METRICS)
    return spark.read.schema(METRICS).option("recursiveFileLookup", "true").json(path)
