"""Order-dependent operators without a single-task global window.

A window ordered over a whole table (``lag(hash) OVER (ORDER BY height)``)
makes Spark move every row into one task. Instead, rows are range-bucketed on
the ordering column; each bucket is windowed on its own task, and each bucket
receives the last ``halo`` rows of the previous non-empty bucket as read-only
context. Only per-bucket summaries (one row per bucket) are ever ordered
globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "__bucket"
CONTEXT = "__context"


def even_width(df: DataFrame, order_col: str, groups: int, least: int) -> Column:
    """Bucket width that gives about ``groups`` buckets over the column's range, as a scalar subquery."""
    span = F.max(order_col) - F.min(order_col) + 1
    return df.agg(F.coalesce(F.greatest(F.ceil(span / F.lit(groups)), F.lit(least)), F.lit(least)).cast("bigint")).scalar()


def bucketed(df: DataFrame, order_col: str, width: int | Column) -> DataFrame:
    c = F.col(order_col)
    return df.withColumn(BUCKET, c - F.pmod(c, width if isinstance(width, Column) else F.lit(width)))


def with_halo(df: DataFrame, order_col: str, halo: int, width: int | Column) -> DataFrame:
    """Rows + the ``halo`` rows preceding each bucket (flag ``__context``), exactly.

    Window per ``__bucket`` ordered by ``order_col``, then drop context rows.
    ``order_col`` must be unique. Each bucket's last ``halo`` rows are offered
    to the next ``halo`` non-empty buckets (each non-empty bucket holds at least
    one row, so that always covers ``halo`` predecessors); a target keeps the
    last ``halo`` offered rows. Only bucket tails are replicated.
    """
    d = bucketed(df, order_col, width)
    seq = d.select(BUCKET).distinct().withColumn(
        "__seq", F.row_number().over(Window.orderBy(BUCKET)))  # one row per bucket
    tail = d.withColumn("__rd", F.row_number().over(
        Window.partitionBy(BUCKET).orderBy(F.col(order_col).desc()))).where(F.col("__rd") <= halo).drop("__rd")
    targets = seq.select(F.col(BUCKET).alias("__target"), F.col("__seq").alias("__tseq"))
    ctx = (tail.join(seq, BUCKET)
           .withColumn("__tseq", F.explode(F.sequence(F.col("__seq") + 1, F.col("__seq") + halo)))
           .join(targets, "__tseq")
           .withColumn(BUCKET, F.col("__target")).drop("__seq", "__tseq", "__target"))
    ctx = ctx.withColumn("__rd", F.row_number().over(
        Window.partitionBy(BUCKET).orderBy(F.col(order_col).desc()))).where(F.col("__rd") <= halo) \
        .drop("__rd").withColumn(CONTEXT, F.lit(True))
    return d.withColumn(CONTEXT, F.lit(False)).unionByName(ctx)


def global_row_number(df: DataFrame, order_col: str, width: int | Column, name: str = "row_num") -> DataFrame:
    """Exact 1-based row number over ``order_col`` from per-bucket counts + offsets."""
    d = bucketed(df, order_col, width)
    counts = d.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    offs = counts.withColumn("__off", F.sum("__n").over(
        Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["__off"])
    w = Window.partitionBy(BUCKET).orderBy(order_col)
    return d.join(offs.select(BUCKET, "__off"), BUCKET) \
        .withColumn(name, F.row_number().over(w) + F.col("__off")).drop(BUCKET, "__off")


def last_marked(df: DataFrame, order_col: str, width: int | Column, mark: Column, value: Column, name: str, inclusive: bool = False) -> DataFrame:
    """``value`` (never null) of the last marked row before each row (``inclusive``: or of the row itself), exactly.

    Each bucket looks at its own rows; what it inherits is the last marked value of the buckets before it,
    from one row per bucket.
    """
    d = bucketed(df, order_col, width).withColumn("__value", F.when(mark, value))
    last = d.groupBy(BUCKET).agg(F.max_by("__value", F.when(F.col("__value").isNotNull(), F.col(order_col))).alias("__last"))
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    carried = last.select(BUCKET, F.last("__last", ignorenulls=True).over(before).alias("__carried"))
    here = Window.partitionBy(BUCKET).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return d.withColumn("__here", F.last("__value", ignorenulls=True).over(here)).join(carried, BUCKET).withColumn(
        name, F.coalesce("__here", "__carried")).drop(BUCKET, "__value", "__here", "__carried")
