"""First/last row per key (DISTINCT ON) and the "latest" flag.

``first_per_key`` keeps one row per key with ``row_number() = 1``; Catalyst
turns that filter into a partial WindowGroupLimit before the shuffle, so each
map task forwards at most one row per key and a hot key cannot pile up in one
reduce task. ``flag_latest`` must keep every row, so it aggregates the winner
per key (map-side combined) and joins it back instead of sorting whole groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def flag_latest(df: DataFrame, key: str, order_cols: list[str], flag: str, descending: bool = True) -> DataFrame:
    """Add boolean ``flag``: the row is the max (or min) of ``order_cols`` within ``key``.

    ``order_cols`` must identify a row within the key (the last one should be unique).
    """
    rank = F.struct(*[F.col(c) for c in order_cols])
    agg = F.max(rank) if descending else F.min(rank)
    win = df.groupBy(key).agg(agg.alias("__win"))
    out = df.join(win, key, "left")
    return out.withColumn(flag, F.coalesce(rank == F.col("__win"), F.lit(False))).drop("__win")
