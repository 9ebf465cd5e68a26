"""Table schemas: the four fact tables and the nested block record."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
TS = T.TimestampNTZType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


CURSORS = T.StructType([_f("id", S, False), _f("cursor", S), _f("block_num", L), _f("block_id", S)])

BLOCKS = T.StructType([
    _f("height", L, False), _f("hash", S, False), _f("prev_hash", S, False), _f("author", S, False),
    _f("timestamp", TS, False), _f("gas_price", S, False), _f("total_supply", S, False),
])

RECEIPT_ACTIONS = T.StructType([
    _f("id", S, False), _f("block_height", L, False), _f("receipt_id", S, False),
    _f("signer_account_id", S, False), _f("signer_public_key", S, False), _f("gas_price", S, False),
    _f("action_kind", S, False), _f("predecessor_id", S, False), _f("receiver_id", S, False),
    _f("block_hash", S, False), _f("chunk_hash", S, False), _f("author", S, False),
    _f("method_name", S, False), _f("gas", L, False), _f("deposit", S, False),
    _f("args_base64", S, False), _f("args_json", S), _f("action_index", I, False),
    _f("block_timestamp", TS, False),
])

EXECUTION_OUTCOMES = T.StructType([
    _f("receipt_id", S, False), _f("block_height", L, False), _f("block_hash", S, False),
    _f("chunk_hash", S, False), _f("shard_id", S, False), _f("gas_burnt", L, False),
    _f("gas_used", D, False), _f("tokens_burnt", D, False), _f("executor_account_id", S, False),
    _f("status", S, False), _f("outcome_receipt_ids", T.ArrayType(S), False),
    _f("executed_in_block_hash", S, False), _f("logs", T.ArrayType(S)), _f("results_json", S),
    _f("block_timestamp", TS),
])

ACTION_COLUMNS = [f.name for f in RECEIPT_ACTIONS.fields]
OUTCOME_COLUMNS = [f.name for f in EXECUTION_OUTCOMES.fields]
BLOCK_COLUMNS = [f.name for f in BLOCKS.fields]

# Nested block record as delivered by the feed. Sum types (receipt kind,
# action kind, execution status) are structs with one non-null member.
FUNCTION_CALL = T.StructType([_f("method_name", S), _f("args", T.BinaryType()), _f("gas", L), _f("deposit", S)])
ACTION_VIEW = T.StructType([
    _f("FunctionCall", FUNCTION_CALL),
    _f("Transfer", T.StructType([_f("deposit", S)])),
    _f("Stake", T.StructType([_f("stake", S), _f("public_key", S)])),
])
RECEIPT_ENUM = T.StructType([
    _f("Action", T.StructType([
        _f("signer_id", S), _f("signer_public_key", S), _f("gas_price", S),
        _f("actions", T.ArrayType(ACTION_VIEW)),
    ])),
    _f("Data", T.StructType([_f("data_id", S), _f("data", T.BinaryType())])),
])
EXECUTION_STATUS = T.StructType([
    _f("SuccessValue", T.BinaryType()), _f("SuccessReceiptId", S), _f("Failure", S), _f("Unknown", T.BooleanType()),
])
RECEIPT_EXECUTION_OUTCOME = T.StructType([
    _f("receipt", T.StructType([
        _f("receipt_id", S), _f("receiver_id", S), _f("predecessor_id", S), _f("receipt", RECEIPT_ENUM),
    ])),
    _f("execution_outcome", T.StructType([
        _f("outcome", T.StructType([
            _f("logs", T.ArrayType(S)), _f("receipt_ids", T.ArrayType(S)), _f("gas_burnt", L),
            _f("tokens_burnt", S), _f("executor_id", S), _f("status", EXECUTION_STATUS),
        ])),
    ])),
])
SHARD = T.StructType([
    _f("shard_id", L),
    _f("chunk", T.StructType([_f("header", T.StructType([_f("chunk_hash", S)]))])),
    _f("receipt_execution_outcomes", T.ArrayType(RECEIPT_EXECUTION_OUTCOME)),
])
BLOCK_RECORD = T.StructType([
    _f("block", T.StructType([
        _f("author", S),
        _f("header", T.StructType([
            _f("height", L), _f("hash", S), _f("prev_hash", S), _f("timestamp_nanosec", L),
            _f("gas_price", S), _f("total_supply", S),
        ])),
    ])),
    _f("shards", T.ArrayType(SHARD)),
])


def _json_form(t: T.DataType, name: str = "") -> T.DataType:
    """The landed JSON form of a type: sum types as VARIANT, nanoseconds as text (a number or a string)."""
    if t in (ACTION_VIEW, EXECUTION_STATUS):
        return T.VariantType()
    if isinstance(t, T.StructType):
        return T.StructType([_f(f.name, _json_form(f.dataType, f.name)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_json_form(t.elementType))
    return S if name == "timestamp_nanosec" else t


JSON_RECORD = _json_form(BLOCK_RECORD)
