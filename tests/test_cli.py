"""The command-line driver end to end on a tiny landing folder."""

from govlake.sources.blockfeed import nested_blocks


def test_cli_ingest_sql_report(spark, tmp_path, capsys):
    from govlake import cli
    d = str(tmp_path)
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("event_id < 300")
    nested_blocks(ev).write.parquet(d + "/landing")
    assert cli.main(["ingest", "--landing", d + "/landing", "--root", d + "/lake"]) == 0
    assert cli.main(["--as-of", "2024-02-01 00:00:00", "sql", "--root", d + "/lake", "--out", d + "/out",
                     "SELECT proposal_id, num_for_votes FROM proposals"]) == 0
    assert spark.read.parquet(d + "/out").count() == 3
    assert cli.main(["--size-partitions", "report", "--root", d + "/lake", "block_gaps", "--out", d + "/gaps"]) == 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == "200"   # tiny input: the floor
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.read.parquet(d + "/gaps").count() == 0


def test_cli_ordered_ingest_replay_and_progress_reports(spark, tmp_path):
    from govlake import cli
    d = str(tmp_path)
    records = nested_blocks(spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("event_id < 300"))
    for low, high in ((1015, 1029), (1000, 1014)):
        records.where(f"block.header.height BETWEEN {low} AND {high}").coalesce(1).write.mode("append").parquet(d + "/landing")
    assert cli.main(["ingest", "--landing", d + "/landing", "--root", d + "/lake", "--ordered", "--app-version", "cli"]) == 0
    assert cli.main(["replay", "--landing", d + "/landing", "--root", d + "/lake", "--start-height", "1003", "--end-height", "1005"]) == 0
    for name in ("processed_ranges", "silent_gaps", "chain_state"):
        assert cli.main(["report", "--root", d + "/lake", name, "--out", f"{d}/{name}"]) == 0
    ranges = {r["app_version"]: (r["first_height"], r["last_height"]) for r in spark.read.parquet(d + "/processed_ranges").collect()}
    assert ranges == {"cli": (1000, 1029), "replay": (1003, 1005)}
    assert spark.read.parquet(d + "/silent_gaps").count() == 0
    assert spark.read.parquet(d + "/chain_state").where("accepted").count() == 30
