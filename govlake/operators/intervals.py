"""Sets of heights as intervals: sort, sweep, merge, without a task that sees them all.

An interval set is a table (first, last), both ends inclusive. The sweep goes over buckets of ``first``: each looks at its own
intervals in order, and what reaches into it from the buckets before comes from one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from govlake.operators.ordered import BUCKET, bucketed, even_width, last_marked, with_halo, CONTEXT

GROUPS, LEAST_WIDTH = 1024, 500
INTERVAL = "first bigint, last bigint"


def merge_intervals(intervals: DataFrame) -> DataFrame:
    """The same heights as the fewest intervals: those that overlap or touch become one."""
    spans = intervals.groupBy("first").agg(F.max("last").alias("last"))
    width = even_width(spans, "first", GROUPS, LEAST_WIDTH)
    rows = bucketed(spans, "first", width)
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    reach = rows.groupBy(BUCKET).agg(F.max("last").alias("reach")).select(BUCKET, F.max("reach").over(before).alias("into"))
    here = Window.partitionBy(BUCKET).orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.max("last").over(here), F.col("into"))
    rows = rows.join(reach, BUCKET).select("first", "last", covered.alias("covered"))
    begins = F.col("covered").isNull() | (F.col("first") > F.col("covered") + 1)
    return last_marked(rows, "first", width, begins, F.col("first"), "begin", inclusive=True).groupBy("begin").agg(
        F.max("last").alias("last")).select(F.col("begin").alias("first"), "last")


def gaps(intervals: DataFrame) -> DataFrame:
    """(gap_start, gap_end, missing_blocks) between consecutive intervals of a merged set."""
    width = even_width(intervals, "first", GROUPS, LEAST_WIDTH)
    w = Window.partitionBy(BUCKET).orderBy("first")
    rows = with_halo(intervals, "first", 1, width).select("*", F.lag("last").over(w).alias("until"))
    return rows.where(~F.col(CONTEXT) & F.col("until").isNotNull()).select(
        (F.col("until") + 1).alias("gap_start"), (F.col("first") - 1).alias("gap_end"), (F.col("first") - F.col("until") - 1).alias("missing_blocks"))
