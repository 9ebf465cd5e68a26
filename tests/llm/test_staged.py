"""Staged tables."""

import time

from pyspark.sql import functions as F

from govlake.llm import common


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(files.apply(i).getName()) for i in range(files.size())}


def test_shuffle_files_go_with_the_write_and_the_setting_stays(spark):
    before, setting = _shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    counts = spark.range(5000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    out = common.staged(counts, "counts")
    for _ in range(100):  # executors delete them in the background
        left = {f for f in _shuffle_files(spark) - before if f.startswith("shuffle_")}
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, counts.collect()))
