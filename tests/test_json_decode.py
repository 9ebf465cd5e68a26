"""Decode rules: base64 -> UTF-8 -> strict JSON, the error guard, result JSON shapes."""

import base64

from pyspark.sql import functions as F

from govlake.functions.json import args_json_text, b64_text, jnum, jstr, parse_json_strict, safe_json

FALLBACK = '{"value":"invalid json"}'


def _one(spark, col, value, typ="string"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(col(F.col("x")).alias("y")).first()[0]


def test_args_fallback_cases(spark):
    good = base64.b64encode(b'{"a":{"b":[1,{"c":"d"}]}}').decode()
    assert _one(spark, args_json_text, good) == '{"a":{"b":[1,{"c":"d"}]}}'
    assert _one(spark, args_json_text, "invalid_base64_string!@#") == FALLBACK
    assert _one(spark, args_json_text, base64.b64encode(b"plain text").decode()) == FALLBACK
    assert _one(spark, args_json_text, base64.b64encode(b"{ invalid json }").decode()) == FALLBACK
    assert _one(spark, args_json_text, "") == FALLBACK
    assert _one(spark, args_json_text, base64.b64encode(bytes([0xFF, 0xFE, 0xFD])).decode()) == FALLBACK


def test_large_payload_and_unicode(spark):
    zeros = base64.b64encode(bytes(10_000)).decode()
    assert len(_one(spark, b64_text, zeros)) == 10_000
    uni = base64.b64encode('{"t":"héllo \\u0041 ✓"}'.encode()).decode()
    assert _one(spark, lambda c: jstr(safe_json(b64_text(c)), "$.t"), uni) == "héllo A ✓"


def test_strict_parse(spark):
    assert _one(spark, lambda c: parse_json_strict(c).isNull(), '{"a":1} x') is True
    assert _one(spark, lambda c: parse_json_strict(c).isNull(), "{'a':1}") is True
    assert _one(spark, lambda c: parse_json_strict(c).isNull(), '{"a":1}, {"b":2}') is True
    assert _one(spark, lambda c: parse_json_strict(c).isNull(), "") is True
    assert _one(spark, lambda c: parse_json_strict(c).isNull(), '[1, null]') is False
    # text that closes the bracket it is wrapped in
    for bad in ['1],[2', '{"proposal_id":7}] junk', '1},{"v":2', '{"a":1}]', '1}']:
        assert _one(spark, lambda c: parse_json_strict(c).isNull(), bad) is True, bad
    # the last value of a repeated key counts
    assert _one(spark, lambda c: jstr(parse_json_strict(c), "$.a"), '{"a":1,"b":0,"a":2}') == "2"
    assert _one(spark, lambda c: jstr(parse_json_strict(c), "$"), " 5 ") == "5"


def test_repeated_keys_need_the_session_setting(spark):
    import pytest
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        with pytest.raises(RuntimeError):
            parse_json_strict("x")
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def test_error_guard(spark):
    assert _one(spark, lambda c: jstr(safe_json(c), "$.proposal_id"), '{"error":"boom","proposal_id":1}') is None
    assert _one(spark, lambda c: jstr(safe_json(c), "$.proposal_id"), '{"error":null,"proposal_id":1}') == "1"
    assert _one(spark, lambda c: jnum(safe_json(c), "$.a"), '{"a":"12345678901234567890123456789012345678"}') \
        == int("12345678901234567890123456789012345678")
    assert _one(spark, lambda c: jnum(safe_json(c), "$.a"), '{"a":"123456789012345678901234567890123456789"}') \
        is None
    assert _one(spark, lambda c: jnum(safe_json(c), "$.a"), '{"a":"abc"}') is None
    assert _one(spark, lambda c: jstr(safe_json(c), "$.data[0].x"), '{"data":{"x":1}}') is None
    assert _one(spark, lambda c: jstr(safe_json(c), "$.data[0].x"), '{"data":[]}') is None


def test_result_json_shapes(spark):
    from govlake.operators.flatten import results_json, status_tag
    rows = [((None, "rid", None, None),), ((None, None, "bad", None),), ((None, None, None, True),),
            ((b"", None, None, None),), ((b'{"x":1}', None, None, None),), ((b"nope", None, None, None),)]
    df = spark.createDataFrame(rows, "st struct<SuccessValue:binary,SuccessReceiptId:string,Failure:string,"
                                     "Unknown:boolean>")
    got = [tuple(r) for r in df.select(status_tag(F.col("st")), results_json(F.col("st"))).collect()]
    assert got == [
        ("SuccessReceiptId", '{"receipt_id":"rid","status_type":"SuccessReceiptId"}'),
        ("Failure", '{"error":"bad","status_type":"Failure"}'),
        ("Unknown", '{"status_type":"Unknown"}'),
        ("SuccessValue", None),
        ("SuccessValue", '{"x":1}'),
        ("SuccessValue", FALLBACK),
    ]


def test_a_document_is_parsed_once_or_twice(spark):
    df = spark.createDataFrame([("e30=", ["{}"])], "b string, logs array<string>")
    from govlake.functions.json import log_event_docs
    for col in (safe_json(b64_text("b")), log_event_docs("logs"), args_json_text("b")):
        plan = df.select(col.alias("c"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == 2, plan  # in brackets, and as a member where the text holds a bracket
        assert plan.count("unbase64") <= 1, plan


def test_strict_parse_of_texts_with_and_without_brackets(spark):
    good = ['{"a":1}', '{"a":"]"}', '{"a":[1,[2]]}', '[]', '"]"', ' 1 ', 'null', '{"a":"\\u005d"}']
    bad = ['1]', ']', '{"a":1}] {}', '1],[2', '"a" "b"', '1 2', '1,2', '{"a":1}}', '{"a":1', '{"a":[1}', ' ', '"', '1}', '1] ', '{"a":1}\x00']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "i int, t string")
    got = [r[0] for r in rows.select(parse_json_strict("t").isNotNull(), "i").orderBy("i").collect()]
    assert got == [True] * len(good) + [False] * len(bad)
