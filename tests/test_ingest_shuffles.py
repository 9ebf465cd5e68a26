"""Shuffles of the block feed and of a batch's upsert."""

from govlake.operators import upsert
from govlake.sources.blockfeed import nested_blocks
from govlake.sources.fixtures import event_rows


def _events(spark):
    return spark.range(60).coalesce(1).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) AS ts", "id % 7 AS user_id",
        "element_at(array('click', 'view', 'signup', 'purchase'), cast(id % 4 AS int) + 1) AS event_type",
        "cast(id AS double) AS value", "concat('{\"k\": ', id % 11, '}') AS props")


def _shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]


def test_events_are_shuffled_once_before_anything_is_derived(spark):
    for df in (nested_blocks(_events(spark)), event_rows(_events(spark))):
        (shuffle,) = _shuffles(df)
        assert "REPARTITION_BY_NUM" in shuffle  # the block grouping and its window use the shuffle of the raw events
    assert nested_blocks(_events(spark)).count() == 6


def test_whole_rows_are_ranked_only_where_a_key_repeats(spark, tmp_path, monkeypatch):
    path, ranked, first = str(tmp_path / "t"), [], upsert.first_per_key
    monkeypatch.setattr(upsert, "first_per_key", lambda *a: ranked.append(a[1]) or first(*a))

    def put(*rows):
        upsert.upsert_table(spark, spark.createDataFrame(rows, f"k int, v string, p int, {upsert.INGEST_COL} bigint"), path, ["k"], "p")
        return sorted((r["k"] or 0, r["v"], r["p"]) for r in spark.read.parquet(path).collect())

    assert put((1, "a", 0, 5), (2, "a", 1, 5)) == [(1, "a", 0), (2, "a", 1)] and not ranked
    assert put((3, "low", 0, 5), (3, "high", 1, 6), (None, "low", 1, 1), (None, "high", 1, 2)) == [
        (0, "high", 1), (1, "a", 0), (2, "a", 1), (3, "high", 1)] and len(ranked) == 1
    assert put((1, "b", 1, 0), (4, "b", 0, 9)) == [
        (0, "high", 1), (1, "b", 1), (2, "a", 1), (3, "high", 1), (4, "b", 0)] and len(ranked) == 2  # the merge ranks, the batch isn't ranked before
