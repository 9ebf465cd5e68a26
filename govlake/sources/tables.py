"""Fact and silver tables on storage (Parquet).

Layout under one root folder:
  blocks/              partitioned by height_bucket
  receipt_actions/     partitioned by height_bucket
  execution_outcomes/  partitioned by height_bucket
  cursors/             one row per app version
  silver/              decoded actions, partitioned by method_part and height
                       bucket (views prune to their methods at the scan; the
                       streaming ingest rewrites only the buckets it touches).
                       method_part is one of the view methods or "other": names
                       are free text, so they stay a column

Height buckets let a replay/upsert rewrite only the partitions it touches
(dynamic partition overwrite).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlake.operators.decode import METHOD_PART, decode_actions, method_part
from govlake.schemas import BLOCKS, EXECUTION_OUTCOMES, RECEIPT_ACTIONS
from govlake.session import path_exists
from govlake.sources.fixtures import Facts

HEIGHT_BUCKET = 100_000  # blocks per storage partition


def height_bucket(col: str) -> F.Column:
    return (F.col(col) - F.pmod(F.col(col), F.lit(HEIGHT_BUCKET))).alias("height_bucket")


def with_bucket(df: DataFrame, height_col: str) -> DataFrame:
    return df.withColumn("height_bucket", height_bucket(height_col))


def write_table(df: DataFrame, path: str, partition_by: str | list[str] | None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        # cluster rows of one partition value inside each task: few files per task, no shuffle
        df = df.sortWithinPartitions(*cols)
        w = df.write.mode(mode).partitionBy(*cols)
    w.parquet(path)


FACT_SCHEMAS = {"blocks": BLOCKS, "receipt_actions": RECEIPT_ACTIONS, "execution_outcomes": EXECUTION_OUTCOMES}


def read_fact(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored fact table by its known schema (an empty one has no file to take it from)."""
    schema = FACT_SCHEMAS[name]
    stored = T.StructType([*schema.fields, T.StructField("height_bucket", T.LongType())])
    return spark.read.schema(stored).parquet(f"{root}/{name}").select(*schema.names)


def read_facts(spark: SparkSession, root: str) -> Facts:
    return Facts(*[read_fact(spark, root, name) for name in FACT_SCHEMAS])


SILVER_PARTITIONS = [METHOD_PART, "height_bucket"]
# raw texts stay in the fact tables; silver stores only their decoded documents
SILVER_RAW = ["args_base64", "logs", "results_json"]


def silver_for_storage(silver: DataFrame) -> DataFrame:
    return with_bucket(silver.drop(*SILVER_RAW), "block_height").withColumn(METHOD_PART, method_part())


def write_silver(silver: DataFrame, root: str) -> None:
    # one shuffle brings the rows of a folder together (AQE splits a large folder into files
    # of the advisory size), instead of one file per task and folder
    write_table(silver_for_storage(silver).hint("rebalance", *SILVER_PARTITIONS), f"{root}/silver", SILVER_PARTITIONS)


def silver_schema(spark: SparkSession) -> T.StructType:
    """Schema of the stored silver table; folder names are not guessed into numbers or dates."""
    actions = spark.createDataFrame([], RECEIPT_ACTIONS)
    outcomes = spark.createDataFrame([], EXECUTION_OUTCOMES)
    return silver_for_storage(decode_actions(actions, outcomes)).schema


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(silver_schema(spark)).parquet(f"{root}/silver").drop("height_bucket")


def has_table(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)
