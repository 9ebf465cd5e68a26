"""SQL-callable helpers (UD1): ``safe_json_parse`` as a session SQL function.

Same rules as the reference's helper: NULL or empty text -> NULL; strict JSON
-> the parsed value; anything else -> an object
``{"error":"invalid_json","original_text":..,"message":..}``. It is a SQL
function (inlined into the plan, JVM-side), not a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from govlake.functions.json import strict_json_sql

# Fixed values of the helper's error object.
ERROR_VALUE = "invalid_json"
ERROR_MESSAGE = "Failed to parse as JSON"


def register_sql_functions(spark: SparkSession) -> None:
    parsed = strict_json_sql("input_text")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION safe_json_parse(input_text STRING)
        RETURNS VARIANT
        RETURN CASE
          WHEN input_text IS NULL OR input_text = '' THEN NULL
          ELSE coalesce({parsed}, to_variant_object(named_struct(
            'error', '{ERROR_VALUE}', 'original_text', input_text, 'message', '{ERROR_MESSAGE}')))
        END""")
