"""Storage and session fail closed; the silver layout keeps free-text method names and few files."""

import os

import pytest

from govlake.session import checkpoint_dir, ensure_session_conf, is_local, path_exists


class _Context:
    def __init__(self, master, folder=None):
        self.master, self._folder = master, folder

    def getConf(self):
        return {"spark.checkpoint.dir": self._folder} if self._folder else {}

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, folder):
        self.set = folder


class _Session:
    def __init__(self, *args):
        self.sparkContext = _Context(*args)


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,1024]"):
        assert not is_local(master)
        with pytest.raises(RuntimeError):
            checkpoint_dir(_Session(master))
        assert checkpoint_dir(_Session(master, "hdfs:///shared/")) == "hdfs:///shared"
    assert is_local("local") and is_local("local[8]") and is_local("local[*]")


def test_settings_that_results_need_are_set_or_raise(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    ensure_session_conf(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    ensure_session_conf(spark)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before

    class Deaf:
        class conf:
            @staticmethod
            def get(k, default=None):
                return "other"

            @staticmethod
            def set(k, v):
                pass

    with pytest.raises(RuntimeError):
        ensure_session_conf(Deaf())


def test_silver_keeps_odd_method_names_in_few_files(spark, tmp_path):
    from pyspark.sql import functions as F

    from govlake.operators.decode import decode_actions
    from govlake.plans.catalog import GovLake
    from govlake.sources.tables import read_silver, write_silver
    facts = GovLake.from_events(spark, "/root/testdata/sf0.001").facts
    names = ["", "007", "12", "2024-01-01", "a/b=c", "vote"]
    pick = F.element_at(F.array(*[F.lit(n) for n in names]), (F.pmod(F.xxhash64("id"), F.lit(len(names))) + 1).cast("int"))
    actions = facts.actions.withColumn("method_name", pick)
    silver = decode_actions(actions.repartition(7), facts.outcomes)
    write_silver(silver, str(tmp_path))
    got = read_silver(spark, str(tmp_path))
    key = ["id", "method_name", "block_height", "status"]
    assert got.select(key).exceptAll(silver.select(key)).count() == 0 and got.count() == actions.count()
    assert {r[0] for r in got.select("method_name").distinct().collect()} == set(names)
    folders = [(p, [f for f in fs if f.endswith(".parquet")]) for p, _, fs in os.walk(str(tmp_path))]
    folders = [(p, fs) for p, fs in folders if fs]
    assert {p.split("method_part=")[1].split("/")[0] for p, _ in folders} == {"other", "vote"}
    assert all(len(fs) == 1 for _, fs in folders)  # one file per folder, not one per task


def test_path_exists(spark, tmp_path):
    assert path_exists(spark, str(tmp_path)) and not path_exists(spark, str(tmp_path / "no"))
    with pytest.raises(Exception):
        path_exists(spark, "nosuchstore://a/b")
