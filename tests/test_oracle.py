"""Every registered query against its DuckDB oracle on the smallest data set."""

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    from tools.oracle_check import duck_connect
    return duck_connect(SF)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "proposal_id" in df.columns


def own_queries():
    import __spark_entry__ as E
    return set(E._registry()) | set(E._storage_queries())


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    assert own_queries() <= set(E.queries()) and own_queries() <= set(E.oracle_sql()) <= set(E.queries())


def test_queries_match_oracle(spark, con):
    import __spark_entry__ as E
    from tools.oracle_check import compare
    qs, oq = E.queries(), E.oracle_sql()
    bad = {}
    for name in sorted(own_queries()):
        r = compare(qs[name](spark, SF), con, oq[name])
        if not r["hash_match"]:
            bad[name] = r
    assert not bad, bad
