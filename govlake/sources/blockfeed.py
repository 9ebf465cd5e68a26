"""The nested block feed: building it from events (fixture) and reading it.

A block record nests shards -> receipt/outcome pairs -> actions (see
schemas.BLOCK_RECORD). In deployment the feed lands as JSON or Parquet files
in a folder; ``read_blocks`` is the batch reader and streaming.ingest the
streaming one. ``nested_blocks`` rebuilds records from the events fixture by
grouping receipts per (block, shard) and shards per block, so that
``operators.flatten`` must give back exactly the flat facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from govlake.config import ContractConfig
from govlake.schemas import BLOCK_RECORD, JSON_RECORD, RECEIPT_EXECUTION_OUTCOME
from govlake.sources.fixtures import FAILURE_TEXT, GAS_PRICE, TOTAL_SUPPLY, event_rows


def nested_blocks(events: DataFrame, cfg: ContractConfig = ContractConfig()) -> DataFrame:
    return nested_from_rows(event_rows(events, cfg))


def nested_from_rows(e: DataFrame) -> DataFrame:
    """Block records from the per-event fixture rows (see fixtures.event_rows)."""
    st = F.col("status")
    status = F.struct(
        F.when(st == "SuccessValue",
               F.when(F.col("method_name") == "on_get_snapshot", F.encode("results_json", "UTF-8"))
               .otherwise(F.lit(b"").cast("binary"))).alias("SuccessValue"),
        F.when(st == "SuccessReceiptId", F.get("outcome_receipt_ids", 0)).alias("SuccessReceiptId"),
        F.when(st == "Failure", F.lit(FAILURE_TEXT)).alias("Failure"),
        F.when(st == "Unknown", F.lit(True)).alias("Unknown"),
    )
    action = F.struct(
        F.struct(F.col("method_name").alias("method_name"), F.col("args_bytes").alias("args"),
                 F.col("gas").alias("gas"), F.col("deposit").alias("deposit")).alias("FunctionCall"),
        F.lit(None).cast("struct<deposit:string>").alias("Transfer"),
        F.lit(None).cast("struct<stake:string,public_key:string>").alias("Stake"),
    )
    transfer = F.struct(
        F.lit(None).cast("struct<method_name:string,args:binary,gas:bigint,deposit:string>").alias("FunctionCall"),
        F.struct(F.lit("1").alias("deposit")).alias("Transfer"),
        F.lit(None).cast("struct<stake:string,public_key:string>").alias("Stake"),
    )
    actions = F.concat(F.array_repeat(transfer, F.col("n_before")), F.array_repeat(action, F.col("n_calls")))
    reo = F.struct(
        F.struct(
            F.col("receipt_id").alias("receipt_id"), F.col("receiver_id").alias("receiver_id"),
            F.col("predecessor_id").alias("predecessor_id"),
            F.struct(
                F.struct(F.col("signer_account_id").alias("signer_id"),
                         F.concat(F.lit("ed25519:"), F.md5("signer_account_id")).alias("signer_public_key"),
                         F.lit(GAS_PRICE).alias("gas_price"), actions.alias("actions")).alias("Action"),
                F.lit(None).cast("struct<data_id:string,data:binary>").alias("Data"),
            ).alias("receipt"),
        ).alias("receipt"),
        F.when(F.col("has_outcome"), F.struct(F.struct(
            F.col("logs").alias("logs"), F.col("outcome_receipt_ids").alias("receipt_ids"),
            F.col("gas_burnt").alias("gas_burnt"),
            (F.col("gas_burnt").cast("decimal(38,0)") * F.lit(100000000)).cast("decimal(38,0)").cast("string")
            .alias("tokens_burnt"),
            F.col("receiver_id").alias("executor_id"), status.alias("status"),
        ).alias("outcome"))).alias("execution_outcome"),
    )
    action_type = "struct<signer_id:string,signer_public_key:string,gas_price:string,actions:array<" \
        "struct<FunctionCall:struct<method_name:string,args:binary,gas:bigint,deposit:string>," \
        "Transfer:struct<deposit:string>,Stake:struct<stake:string,public_key:string>>>>"
    data = reo.withField("receipt", reo["receipt"].withField("receipt_id", F.concat(F.lit("d"), F.col("event_id").cast("string")))
                         .withField("receipt", F.struct(
                             F.lit(None).cast(action_type).alias("Action"),
                             F.struct(F.col("receipt_id").alias("data_id"), F.lit(b"x").cast("binary").alias("data")).alias("Data")))) \
        .withField("execution_outcome", F.lit(None).cast(RECEIPT_EXECUTION_OUTCOME["execution_outcome"].dataType))
    e = e.withColumn("reos", F.when(F.col("event_id") % 10 == 7, F.array(reo, data)).otherwise(F.array(reo)))
    # one shuffle: receipts are grouped per block, shards are carved out of the block's
    # (small, bounded) receipt list with array functions
    blocks = e.groupBy("b", "height", "prev_height").agg(
        F.min("ts").alias("ts"),
        F.array_sort(F.collect_list(F.struct(F.col("shard"), F.col("event_id"), F.col("reos")))).alias("items"),
    )
    shard_ids = F.array_distinct(F.transform("items", lambda i: i["shard"]))

    def shard(sid):
        return F.struct(
            sid.cast("bigint").alias("shard_id"),
            F.when(sid != 3, F.struct(F.struct(
                F.md5(F.concat_ws("/", F.col("height").cast("string"), sid.cast("string")))
                .alias("chunk_hash")).alias("header"))).alias("chunk"),
            F.flatten(F.transform(F.filter("items", lambda i: i["shard"] == sid), lambda i: i["reos"]))
            .alias("receipt_execution_outcomes"),
        )

    blocks = blocks.withColumn("shards", F.transform(shard_ids, shard))
    return blocks.select(
        F.struct(
            F.expr("concat('node', height % 5, '.test')").alias("author"),
            F.struct(
                F.col("height").alias("height"), F.md5(F.col("height").cast("string")).alias("hash"),
                F.expr("CASE WHEN b % 97 = 96 THEN md5('x') ELSE md5(cast(prev_height as string)) END")
                .alias("prev_hash"),
                F.expr("unix_micros(cast(ts as timestamp)) * 1000").alias("timestamp_nanosec"),
                F.lit(GAS_PRICE).alias("gas_price"), F.lit(TOTAL_SUPPLY).alias("total_supply"),
            ).alias("header"),
        ).alias("block"),
        F.col("shards"),
    )


def landing_schema(fmt: str) -> T.StructType:
    """Schema of landed files. JSON writes a variant without fields as a bare string, so the sum types are read as VARIANT."""
    return BLOCK_RECORD if fmt != "json" else JSON_RECORD


def _from_json(shards: Column) -> Column:
    """Shards of a JSON record as in BLOCK_RECORD; every action keeps its place in the receipt."""
    def text(v, path):
        return F.try_variant_get(v, path, "string")

    def action(a):
        call = F.struct(text(a, "$.FunctionCall.method_name").alias("method_name"),
                        F.unbase64(text(a, "$.FunctionCall.args")).alias("args"),
                        F.try_variant_get(a, "$.FunctionCall.gas", "bigint").alias("gas"),
                        text(a, "$.FunctionCall.deposit").alias("deposit"))
        return F.struct(
            F.when(text(a, "$.FunctionCall").isNotNull(), call).alias("FunctionCall"),
            F.when(text(a, "$.Transfer").isNotNull(), F.struct(text(a, "$.Transfer.deposit").alias("deposit"))).alias("Transfer"),
            F.when(text(a, "$.Stake").isNotNull(), F.struct(
                text(a, "$.Stake.stake").alias("stake"), text(a, "$.Stake.public_key").alias("public_key"))).alias("Stake"))

    def status(st):
        return F.struct(F.unbase64(text(st, "$.SuccessValue")).alias("SuccessValue"),
                        text(st, "$.SuccessReceiptId").alias("SuccessReceiptId"), text(st, "$.Failure").alias("Failure"),
                        F.when(text(st, "$") == "Unknown", F.lit(True)).alias("Unknown"))

    def pair(p):
        call, o = p["receipt"]["receipt"]["Action"], p["execution_outcome"]["outcome"]
        named = F.when(call.isNotNull(), call.withField("actions", F.transform(call["actions"], action)))
        receipt = p["receipt"].withField("receipt", p["receipt"]["receipt"].withField("Action", named))
        outcome = F.when(o.isNotNull(), F.struct(o.withField("status", status(o["status"])).alias("outcome")))
        return F.struct(receipt.alias("receipt"), outcome.alias("execution_outcome"))

    return F.transform(shards, lambda s: s.withField(
        "receipt_execution_outcomes", F.transform(s["receipt_execution_outcomes"], pair)))


def landing_records(landed: DataFrame, fmt: str) -> DataFrame:
    """Block records of landed files with their order of arrival; a record without height, hash or time is an error."""
    at = F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file"),
                  F.col("_metadata.file_block_start").alias("start"))
    out = landed.select("block", "shards", at.alias("__arrival"))
    if fmt == "json":
        header = F.col("block.header")
        ns = header["timestamp_nanosec"].cast("bigint")
        out = out.select(F.col("block").withField("header", header.withField("timestamp_nanosec", ns)).alias("block"),
                         _from_json(F.col("shards")).alias("shards"), "__arrival")
    h = F.col("block.header")
    missing = h["height"].isNull() | h["hash"].isNull() | h["timestamp_nanosec"].isNull()
    checked = F.when(missing, F.raise_error(F.concat(
        F.lit("block record without height, hash or time in "), F.col("__arrival.file")))).otherwise(F.col("block"))
    return out.withColumn("block", checked)


def read_blocks(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Batch read of landed block files."""
    return landing_records(spark.read.schema(landing_schema(fmt)).option("mode", "FAILFAST").format(fmt).load(path), fmt).drop("__arrival")
