"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix (DataFrame functions only).

1. Rows are dealt to cells by a hash of all their columns; the rows of each cell are counted.
2. The matrix "rows that cell c sends to shard s" is drawn with exactly the right margins:
   row sums are the cell counts, column sums the shard sizes (counts at most one apart).
   Cell by cell each entry is a hypergeometric draw from the room that the shards have left,
   which is the law of the matrix under a uniform permutation of all rows.
3. Each cell is permuted by a seeded hash; its first m[c, 0] rows go to shard 0, the next
   m[c, 1] to shard 1, and so on (exchange).
4. Inside each shard the rows are permuted again: dealt to sub-cells by a second seeded hash,
   ordered in each, and numbered on from the rows of the sub-cells before. So a slot needs
   no task that holds a whole shard.

Only the cell counts (at most ``MAX_CELLS`` numbers) reach the driver. Same rows and seed: same shards and slots.

Edge cases: rows may repeat and hold nulls anywhere; rows that are equal in all columns are
interchangeable and share a cell. Fewer rows than shards leave shards empty; an empty table
gives an empty result. All input columns pass through; where one is named as an output column, that one's name
gets an underscore (``shard_``).
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free_names, staged

ROWS_PER_CELL = 100_000
MIN_CELLS, MAX_CELLS = 64, 65_536


def hypergeometric(good: int, bad: int, draws: int, u: float) -> int:
    """Number of good ones among ``draws`` taken without return: the u-quantile, summed outward from the mode."""
    total = good + bad
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    p = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(total, draws))
    up_k = down_k = mode
    up_p = down_p = p
    u -= p
    while u > 0 and (up_p > 0 or down_p > 0):
        up_p = up_p * (good - up_k) * (draws - up_k) / ((up_k + 1) * (bad - draws + up_k + 1)) if up_k < high else 0.0
        up_k += up_p > 0
        u -= up_p
        if u <= 0:
            return up_k
        down_p = down_p * down_k * (bad - draws + down_k) / ((good - down_k + 1) * (draws - down_k + 1)) if down_k > low else 0.0
        down_k -= down_p > 0
        u -= down_p
        if u <= 0:
            return down_k
    return mode


def communication_matrix(counts: dict[int, int], shards: int, seed: int) -> list[tuple[int, int, int, int]]:
    """(cell, shard, from, to): which places of each permuted cell go to which shard."""
    total = sum(counts.values())
    rng = random.Random(seed)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    out = []
    left = total
    for cell in sorted(counts):
        n, others, at = counts[cell], left, 0
        for s in range(shards):
            others -= room[s]
            k = hypergeometric(room[s], others, n, rng.random())
            if k:
                out.append((cell, s, at, at + k))
            room[s] -= k
            n -= k
            at += k
        left -= counts[cell]
    return out


def shard_rows(rows: DataFrame, shards: int, seed: int = 17, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """``rows`` with two more columns: ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in each shard)."""
    spark = rows.sparkSession
    cols = [F.col(f"`{c}`") for c in rows.columns]
    own, slot, cell, first, second, place, sub, to = free_names(
        rows, "shard", "slot", "__cell", "__first", "__second", "__place", "__sub", "__to")
    mixed = [F.xxhash64(F.lit(seed + i), *cols) for i in range(3)]
    n = rows.count()
    cells = min(max(n // rows_per_cell, MIN_CELLS), MAX_CELLS)
    keyed = rows.select("*", F.pmod(mixed[0], F.lit(cells)).cast("int").alias(cell), mixed[1].alias(first), mixed[2].alias(second))
    counts = {r[cell]: r["n"] for r in keyed.groupBy(cell).agg(F.count("*").alias("n")).collect()}
    matrix = spark.createDataFrame(communication_matrix(counts, shards, seed), "cell int, shard int, begin long, to long")
    # one row per cell: the upper bounds of its shards, so that each row finds its shard without a range join
    bounds = matrix.groupBy(F.col("cell").alias(cell)).agg(F.sort_array(F.collect_list(F.struct("to", "shard"))).alias(to))

    at = F.row_number().over(Window.partitionBy(cell).orderBy(first, second)).cast("long")
    dealt = keyed.withColumn(place, at).join(F.broadcast(bounds), cell)
    shard = F.filter(F.col(to), lambda b: b["to"] >= F.col(place))[0]["shard"]
    # permute again inside each shard
    again = F.pmod(F.xxhash64(F.lit(seed), second), F.lit(max(1, cells // shards))).cast("int")
    dealt = staged(dealt.select(*cols, second, shard.alias(own), again.alias(sub)), "dealt")
    sizes = dealt.groupBy(own, sub).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(own).orderBy(sub)) - F.col("n")
    offsets = sizes.select(own, sub, before.alias(to))
    order = F.row_number().over(Window.partitionBy(own, sub).orderBy(F.xxhash64(F.lit(seed + 9), second), second))
    out = dealt.withColumn(place, order).join(F.broadcast(offsets), [own, sub])
    return out.select(*cols, own, (F.col(to) + F.col(place) - 1).alias(slot))
