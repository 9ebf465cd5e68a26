"""Data-quality and monitoring reports over the fact tables (M1-M4, W7, W8, ST5-ST7, L4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from govlake.functions.json import parse_json_strict, jstr
from govlake.functions.time import epoch_micros
from govlake.operators.ordered import BUCKET, CONTEXT, even_width, global_row_number, with_halo

GROUPS, LEAST_WIDTH = 1024, 500  # buckets of an ordered report over the stored heights; heights in one at least
RATE_WINDOW = 10        # blocks in the rolling throughput window
RANGE_SIZE = 1000       # blocks per processed-range summary row


# Argument members that the views read as numbers.
NUMERIC_ARGS = ["$.proposal_id", "$.vote", "$.amount", "$.lockup_deposit", "$.v_account.V0.balance.near_balance"]
NUMBER, FRACTION, DIGITS = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$", r"\.\d*[1-9]", 38


def decode_quality(actions: DataFrame) -> DataFrame:
    """M1: per method, how many args fail each decode step, carry an error key, repeat a key, or hold a bad number.

    Bad numbers: text that is no number; numbers with a fraction (rounded by the views); numbers of more
    than 38 digits (NULL in the views).
    """
    # one step per decode, so that each text is decoded and parsed once
    d = actions.select("method_name", F.try_to_binary(F.col("args_base64"), F.lit("base64")).alias("raw"))
    d = d.withColumn("text", F.try_validate_utf8(F.col("raw").cast("string")))
    d = d.withColumn("doc", parse_json_strict("text"))
    d = d.withColumn("found", F.filter(F.array(*[jstr(F.col("doc"), p) for p in NUMERIC_ARGS]), lambda x: x.isNotNull()))
    raw, text, doc, found, keys = (*map(F.col, ("raw", "text", "doc", "found")), F.json_object_keys("text"))

    def some(test):
        return F.exists(found, test)

    a = d.select("method_name", raw.isNull().alias("bad_b64"),
                       (raw.isNotNull() & text.isNull()).alias("bad_utf8"),
                       (text.isNotNull() & doc.isNull()).alias("bad_json"),
                       jstr(doc, "$.error").isNotNull().alias("err"),
                       (doc.isNotNull() & (F.size(keys) > F.size(F.array_distinct(keys)))).alias("repeated"),
                       some(lambda x: ~x.rlike(NUMBER)).alias("no_number"),
                       some(lambda x: x.rlike(NUMBER) & x.rlike(FRACTION)).alias("fraction"),
                       some(lambda x: x.rlike(NUMBER) & ~x.rlike(FRACTION) & x.try_cast("decimal(38,0)").isNull()).alias("too_long"))
    return a.groupBy("method_name").agg(
        F.count(F.lit(1)).alias("n_actions"), F.count_if("bad_b64").alias("invalid_base64"),
        F.count_if("bad_utf8").alias("invalid_utf8"), F.count_if("bad_json").alias("invalid_json"),
        F.count_if("err").alias("error_key"), F.count_if("repeated").alias("repeated_key"),
        F.count_if("no_number").alias("not_a_number"), F.count_if("fraction").alias("fractional_number"),
        F.count_if("too_long").alias("over_38_digits"))


def _width(blocks: DataFrame) -> Column:
    return even_width(blocks, "height", GROUPS, LEAST_WIDTH)


def _with_prev(blocks: DataFrame, halo: int) -> DataFrame:
    return with_halo(blocks.select("height", "hash", "prev_hash", "timestamp"), "height", halo, _width(blocks))


def chain_breaks(blocks: DataFrame) -> DataFrame:
    """Blocks whose prev_hash is not the hash of the block before them."""
    w = Window.partitionBy(BUCKET).orderBy("height")
    d = _with_prev(blocks, 1).select(
        "*", F.lag("hash").over(w).alias("expected_prev_hash"), F.lag("height").over(w).alias("prev_height"))
    return d.where(~F.col(CONTEXT) & F.col("prev_height").isNotNull()
                   & (F.col("prev_hash") != F.col("expected_prev_hash"))).select(
        "height", "hash", "prev_hash", "expected_prev_hash", "prev_height")


def block_gaps(blocks: DataFrame) -> DataFrame:
    """M2/ST4: missing heights between consecutive stored blocks."""
    w = Window.partitionBy(BUCKET).orderBy("height")
    d = _with_prev(blocks, 1).select("*", F.lag("height").over(w).alias("prev_height"))
    return d.where(~F.col(CONTEXT) & (F.col("height") - F.col("prev_height") > 1)).select(
        (F.col("prev_height") + 1).alias("gap_start"), (F.col("height") - 1).alias("gap_end"),
        (F.col("height") - F.col("prev_height") - 1).alias("missing_blocks"))


def block_age(blocks: DataFrame, as_of: Column) -> DataFrame:
    """ST6: freshness of every block, seconds between as_of and the block time."""
    return blocks.select("height", ((epoch_micros(as_of) - epoch_micros(F.col("timestamp"))) / F.lit(1e6))
                         .alias("block_age_seconds"))


def block_rate(blocks: DataFrame) -> DataFrame:
    """W8/ST7: blocks per second over the last ten blocks (by height)."""
    w = Window.partitionBy(BUCKET).orderBy("height").rowsBetween(-(RATE_WINDOW - 1), 0)
    d = _with_prev(blocks, RATE_WINDOW - 1).select(
        "height", CONTEXT, F.count(F.lit(1)).over(w).alias("n"),
        F.min(epoch_micros(F.col("timestamp"))).over(w).alias("t0"), epoch_micros(F.col("timestamp")).alias("t1"))
    span = (F.col("t1") - F.col("t0")) / F.lit(1e6)
    return d.where(~F.col(CONTEXT)).select(
        "height", F.col("n").alias("window_blocks"),
        F.when((F.col("n") > 1) & (span > 0), (F.col("n") - 1) / span).alias("blocks_per_second"))


def range_summary(blocks: DataFrame) -> DataFrame:
    """ST5: processed ranges of 1,000 consecutive stored blocks."""
    d = global_row_number(blocks.select("height"), "height", _width(blocks))
    return d.groupBy(F.floor((F.col("row_num") - 1) / RANGE_SIZE).alias("range_no")).agg(
        F.min("height").alias("first_height"), F.max("height").alias("last_height"),
        F.count(F.lit(1)).alias("n_blocks"))


def coverage(actions: DataFrame) -> DataFrame:
    """M4: facts per contract and method with their height span."""
    return actions.groupBy("receiver_id", "method_name").agg(
        F.count(F.lit(1)).alias("n_actions"), F.min("block_height").alias("first_height"),
        F.max("block_height").alias("last_height"))


def newest_blocks(blocks: DataFrame, n: int = 10) -> DataFrame:
    """L4: the n newest blocks (documented launch check)."""
    return blocks.orderBy(F.col("height").desc()).limit(n).select("height", "hash", "timestamp")
