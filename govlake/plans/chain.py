"""In-order chain validation over stored blocks (ST3).

The rule: blocks are taken in order of height; the first is accepted, and each later one only if its
``prev_hash`` is the hash of the block that was accepted last. So after an accepted block comes the lowest later
block that names its hash, and the accepted blocks are those that the first one reaches along these links.

Nothing walks the chain block by block:

1. ``next_links``: each block's link, the lowest later block that names its hash (one join on the hash).
2. Blocks that link to the block stored right after them form segments; only a segment's last block links elsewhere.
   An undisturbed chain is one segment, so what is left grows with the disturbances.
3. Pointer doubling over the segments: a round joins the links with themselves and so doubles how far they reach;
   after log2(segments) rounds all segments that the first one reaches are known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from govlake.operators.ordered import even_width, last_marked
from govlake.session import checkpoint_dir

GROUPS, LEAST_WIDTH = 1024, 500  # buckets of the ordered steps; heights in one at least


def _width(blocks: DataFrame):
    return even_width(blocks, "height", GROUPS, LEAST_WIDTH)


def next_links(headers: DataFrame) -> DataFrame:
    """(height, next_height): the lowest later block whose prev_hash is the block's hash.

    A hash that is stored once (all, in a sound feed) is met by an equi-join and a partial minimum, however many
    blocks name it. Hashes that are stored at several heights are looked at in order of height, hash by hash.
    """
    parents = headers.where("hash is not null").select(F.col("hash").alias("key"), F.col("height").alias("parent"))
    children = headers.where("prev_hash is not null").select(F.col("prev_hash").alias("key"), F.col("height").alias("child"))
    known = parents.groupBy("key").agg(F.count(F.lit(1)).alias("times"), F.min("parent").alias("parent"))
    once = children.join(known.where("times = 1"), "key").where("child > parent").groupBy("parent").agg(F.min("child").alias("child"))
    repeated = known.where("times > 1").select("key")
    rows = parents.join(repeated, "key").select("key", F.col("parent").alias("height"), F.lit(None).cast("bigint").alias("child")).unionAll(
        children.join(repeated, "key").select("key", F.col("child").alias("height"), "child"))
    # from above: the child seen last is the lowest later one; a block isn't its own child
    above = Window.partitionBy("key").orderBy(F.col("height").desc(), F.col("child").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    several = rows.select("height", "child", F.min("child").over(above).alias("next")).where("child is null and next is not null")
    return once.select(F.col("parent").alias("height"), F.col("child").alias("next_height")).unionAll(
        several.select("height", F.col("next").alias("next_height")))


def reached(links: DataFrame, first: DataFrame) -> DataFrame:
    """(node) that ``first`` (node) reaches along ``links`` (node, to; one for a node at most), itself included, by pointer doubling."""
    checkpoint_dir(links.sparkSession)
    seen, jumps, steps = first.select("node").checkpoint(), links.select("node", "to").checkpoint(), 1
    while True:
        more = seen.join(jumps, "node").select(F.col("to").alias("node"))
        seen = seen.unionAll(more).distinct().checkpoint()
        steps *= 2
        if seen.count() < steps:  # the path ends within what was reached
            return seen
        onward = jumps.select(F.col("node").alias("to"), F.col("to").alias("far"))
        jumps = jumps.join(onward, "to").select("node", F.col("far").alias("to")).checkpoint()


def accepted_heights(blocks: DataFrame) -> DataFrame:
    """(height) of the blocks that the in-order rule accepts. Heights are unique."""
    checkpoint_dir(blocks.sparkSession)
    headers = blocks.select("height", "hash", "prev_hash").checkpoint()
    width = _width(headers)
    links = next_links(headers).checkpoint()
    before = last_marked(headers, "height", width, F.lit(True), F.col("height"), "stored_before").select("height", "stored_before")
    follows = links.groupBy(F.col("next_height").alias("height")).agg(F.count(F.lit(1)).alias("n"), F.max("height").alias("linked_from"))
    marked = before.join(follows, "height", "left").select(
        "height", F.coalesce((F.col("n") == 1) & (F.col("linked_from") == F.col("stored_before")), F.lit(False)).alias("goes_on"))
    segments = last_marked(marked, "height", width, ~F.col("goes_on"), F.col("height"), "segment", inclusive=True).select(
        "height", "segment").checkpoint()
    # the link that leaves a segment is that of its last block
    ends = segments.groupBy("segment").agg(F.max("height").alias("height"))
    out = ends.join(links, "height").select(F.col("segment").alias("node"), F.col("next_height").alias("to"))
    first = headers.agg(F.min("height").alias("node")).where("node is not null")
    good = reached(out, first).withColumnRenamed("node", "segment")
    return segments.join(good, "segment", "left_semi").select("height")


def chain_state(blocks: DataFrame) -> DataFrame:
    """Every block with the hash that the rule expected (that of the last accepted block below) and whether it is accepted."""
    headers = blocks.select("height", "hash", "prev_hash")
    good = accepted_heights(headers).withColumn("good", F.lit(True))
    marked = headers.join(good, "height", "left").withColumn("accepted", F.coalesce("good", F.lit(False))).drop("good")
    return last_marked(marked, "height", _width(headers), F.col("accepted"), F.col("hash"), "expected_prev_hash").select(
        "height", "hash", "prev_hash", "expected_prev_hash", "accepted")


def accepted_blocks(blocks: DataFrame) -> DataFrame:
    """The rows of ``blocks`` that the in-order rule accepts."""
    return blocks.join(accepted_heights(blocks), "height", "left_semi").select(*blocks.columns)
