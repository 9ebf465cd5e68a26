"""Distributed ordered operators vs a plain global window; keyed upsert on storage."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from govlake.operators.ordered import BUCKET, CONTEXT, global_row_number, with_halo
from govlake.operators.upsert import cursor_latest, upsert_table


def test_halo_lag_and_rolling_equal_global(spark):
    random.seed(7)
    hs = sorted(random.sample(range(0, 5000), 600))
    df = spark.createDataFrame([(h, h * 3) for h in hs], "h bigint, v bigint")
    w = Window.partitionBy(BUCKET).orderBy("h")
    got = with_halo(df, "h", 4, 97).select(
        "h", CONTEXT, F.lag("v").over(w).alias("lag"),
        F.sum("v").over(w.rowsBetween(-4, 0)).alias("roll")).where(~F.col(CONTEXT)).drop(CONTEXT)
    g = Window.orderBy("h")
    want = df.select("h", F.lag("v").over(g).alias("lag"), F.sum("v").over(g.rowsBetween(-4, 0)).alias("roll"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    rn = global_row_number(df, "h", 97)
    want_rn = df.select("h", "v", F.row_number().over(g).alias("row_num"))
    assert rn.exceptAll(want_rn).count() == 0


def test_upsert_table_last_write_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, f"a{i}", i // 10) for i in range(40)]
    upsert_table(spark, spark.createDataFrame(rows, "k int, v string, p int"), path, ["k"], "p")
    new = [(5, "b5", 0), (35, "b35", 3), (50, "b50", 5)]
    upsert_table(spark, spark.createDataFrame(new, "k int, v string, p int"), path, ["k"], "p")
    got = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert len(got) == 41 and got[5] == "b5" and got[35] == "b35" and got[50] == "b50" and got[12] == "a12"
    # replaying the same batch changes nothing
    upsert_table(spark, spark.createDataFrame(new, "k int, v string, p int"), path, ["k"], "p")
    assert spark.read.parquet(path).count() == 41


def test_upsert_moves_a_key_between_partitions_and_deletes_emptied_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, v string, p string"
    upsert_table(spark, spark.createDataFrame([(1, "a", "007"), (2, "a", ""), (3, "a", "x/y z"), (4, "a", None)], schema), path, ["k"], "p")
    upsert_table(spark, spark.createDataFrame([(1, "b", "9"), (3, "b", "x/y z"), (4, "b", "n"), (5, "b", "007")], schema), path, ["k"], "p")
    rows = spark.read.schema(schema).parquet(path).collect()
    assert {(r["k"], r["v"], r["p"] or None) for r in rows} == {(1, "b", "9"), (2, "a", None), (3, "b", "x/y z"), (4, "b", "n"), (5, "b", "007")}
    assert len(rows) == 5


def test_cursor_is_last_processed_not_max(spark):
    prog = spark.createDataFrame([("v1", 10, "h10", 1), ("v1", 20, "h20", 2), ("v1", 12, "h12", 3)],
                                 "app_version string, block_num bigint, block_hash string, processed_order bigint")
    r = cursor_latest(prog).first()
    assert r["block_num"] == 12 and r["cursor"] == "h12"


def _files_read(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_a_batch_reads_only_the_index_slots_of_its_keys(spark, tmp_path, monkeypatch):
    from govlake.operators import upsert
    path, schema = str(tmp_path / "t"), "k int, v string, p int"
    upsert_table(spark, spark.createDataFrame([(i, "a", i // 100) for i in range(1000)], schema), path, ["k"], "p")
    seen = []
    find = upsert.KeyIndex.find
    monkeypatch.setattr(upsert.KeyIndex, "find", lambda self, e: seen.append((self, e.collect(), find(self, e))) or seen[-1][2])
    upsert_table(spark, spark.createDataFrame([(205, "b", 2), (731, "b", 7)], schema), path, ["k"], "p")
    index, entries, found = seen[0]
    slots = {e["slot"] for e in entries}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and {r["slot"] for r in found.collect()} <= slots and len(slots) <= 2
    folders = {f.split("slot=")[1].split("/")[0] for f in _files_read(spark.read.parquet(index.path).where(F.col("slot").isin(list(slots))))}
    assert folders == {str(s) for s in slots}
    got = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert len(got) == 1000 and {k for k, v in got.items() if v == "b"} == {205, 731}


def test_untouched_partitions_keep_their_files_and_nothing_is_checkpointed(spark, tmp_path):
    import os

    from govlake.session import checkpoint_dir
    path, schema = str(tmp_path / "t"), "k int, v string, p int"

    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}

    def checkpoints():
        return sum(len(fs) for _, _, fs in os.walk(checkpoint_dir(spark).removeprefix("file:")))

    upsert_table(spark, spark.createDataFrame([(i, "a", i // 100) for i in range(1000)], schema), path, ["k"], "p")
    before, kept = files(), checkpoints()
    upsert_table(spark, spark.createDataFrame([(205, "b", 2), (2000, "n", 20)], schema), path, ["k"], "p")
    assert {f for f in before - files()} == {f for f in before if "/p=2/" in f}
    assert checkpoints() == kept


def test_an_index_is_made_for_a_table_without_one(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, v string, p int"
    spark.createDataFrame([(i, "a", 0) for i in range(10)], schema).write.partitionBy("p").parquet(path)
    upsert_table(spark, spark.createDataFrame([(3, "b", 1)], schema), path, ["k"], "p")
    got = sorted((r["k"], r["v"], r["p"]) for r in spark.read.parquet(path).collect())
    assert got == sorted([(i, "a", 0) for i in range(10) if i != 3] + [(3, "b", 1)])


def test_a_crash_after_the_index_was_written_loses_nothing(spark, tmp_path, monkeypatch):
    import pytest

    from govlake.operators import upsert
    path, schema = str(tmp_path / "t"), "k int, v string, p int"
    rows = spark.createDataFrame([(i, "a", i // 5) for i in range(10)], schema)
    with monkeypatch.context() as m:
        m.setattr(upsert, "_write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            upsert_table(spark, rows, path, ["k"], "p")
    upsert_table(spark, rows, path, ["k"], "p")
    upsert_table(spark, rows, path, ["k"], "p")
    assert spark.read.parquet(path).count() == 10
