"""UD1: safe_json_parse callable from SQL."""

from govlake.functions.sql import register_sql_functions


def test_safe_json_parse_sql(spark):
    register_sql_functions(spark)
    r = spark.sql("""SELECT
        safe_json_parse(NULL) IS NULL AS a,
        safe_json_parse('') IS NULL AS b,
        variant_get(safe_json_parse('{"x":1}'), '$.x', 'int') AS c,
        variant_get(safe_json_parse('{"x":1} trailing'), '$.error', 'string') AS d,
        variant_get(safe_json_parse('{''x'':1}'), '$.original_text', 'string') AS e
    """).first()
    assert r["a"] and r["b"] and r["c"] == 1 and r["d"] == "invalid_json" and r["e"] == "{'x':1}"


def test_register_views_and_query_with_sql(spark):
    from govlake.plans.catalog import VIEW_ORDER, GovLake
    lake = GovLake.from_events(spark, "/root/testdata/sf0.001")
    status = lake.register_views(prefix="t_")
    assert all(v == "ok" for v in status.values()) and set(status) == set(VIEW_ORDER)
    r = spark.sql("""SELECT voter_id, count(*) AS votes_cast FROM t_proposal_voting_history
                     GROUP BY voter_id ORDER BY votes_cast DESC LIMIT 3""").collect()
    assert len(r) == 3 and r[0]["votes_cast"] >= r[-1]["votes_cast"]
    n = spark.sql("SELECT count(*) FROM t_receipt_actions WHERE method_name = 'vote'").first()[0]
    assert n > 0
