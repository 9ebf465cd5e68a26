"""Command-line driver (replaces the reference's start/init commands).

    python -m govlake.cli ingest  --landing DIR --root DIR [--app-version v1] [--start-height N] [--ordered [--lag N]] [--continuous]
    python -m govlake.cli replay  --landing DIR --root DIR --start-height N [--end-height N] [--app-version replay]
    python -m govlake.cli sql     --root DIR "SELECT ... FROM proposals" [--out DIR] [--as-of TS]
    python -m govlake.cli report  --root DIR chain_breaks|chain_state|block_gaps|block_rate|range_summary|coverage|decode_quality|
                                             newest_blocks|processed_ranges|silent_gaps|batch_metrics

``sql`` registers the seven views (plus blocks, receipt_actions,
execution_outcomes and the ``safe_json_parse`` SQL function) over the tables
under ``--root`` and runs the statement; results go to ``--out`` as Parquet or
a bounded preview to stdout.
"""

from __future__ import annotations

import argparse
import sys

from govlake.config import ContractConfig


def _cfg(a) -> ContractConfig:
    return ContractConfig(contract=a.contract, token_prefix=a.token_prefix, voting_prefix=a.voting_prefix,
                          as_of=a.as_of)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="govlake")
    p.add_argument("--contract", default="hos.test")
    p.add_argument("--token-prefix", default="v")
    p.add_argument("--voting-prefix", default="vote")
    p.add_argument("--as-of", default=None, help="timestamp used instead of the wall clock")
    p.add_argument("--size-partitions", action="store_true",
                   help="set spark.sql.shuffle.partitions from the input size (about 256 MB each)")
    sub = p.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest")
    ing.add_argument("--landing", required=True)
    ing.add_argument("--root", required=True)
    ing.add_argument("--app-version", default="v1")
    ing.add_argument("--start-height", type=int, default=None)
    ing.add_argument("--configured-start", type=int, default=None)
    ing.add_argument("--format", default="parquet")
    ing.add_argument("--max-files-per-trigger", type=int, default=8)
    ing.add_argument("--ordered", action="store_true", help="files in order of height, not of arrival")
    ing.add_argument("--lag", type=int, default=0, help="with --ordered: heights below the highest that may still land")
    ing.add_argument("--continuous", action="store_true", help="keep running (default: process what is there)")
    rep = sub.add_parser("replay")
    rep.add_argument("--landing", required=True)
    rep.add_argument("--root", required=True)
    rep.add_argument("--start-height", type=int, required=True)
    rep.add_argument("--end-height", type=int, default=None)
    rep.add_argument("--app-version", default="replay")
    rep.add_argument("--format", default="parquet")
    q = sub.add_parser("sql")
    q.add_argument("--root", required=True)
    q.add_argument("statement")
    q.add_argument("--out", default=None)
    q.add_argument("--show", type=int, default=20)
    r = sub.add_parser("report")
    r.add_argument("--root", required=True)
    r.add_argument("name", choices=["chain_breaks", "chain_state", "block_gaps", "block_rate", "range_summary", "coverage",
                                    "decode_quality", "newest_blocks", "processed_ranges", "silent_gaps", "batch_metrics"])
    r.add_argument("--out", default=None)
    a = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from govlake.session import ensure_session_conf
    spark = SparkSession.builder.appName(f"govlake-{a.cmd}").getOrCreate()
    ensure_session_conf(spark)
    if a.size_partitions:
        from govlake.session import size_shuffle_partitions
        size_shuffle_partitions(spark, [getattr(a, "landing", None) or a.root])
    cfg = _cfg(a)
    if a.cmd == "ingest":
        from govlake.streaming import start_ingest, start_ordered_ingest
        if a.ordered:
            start_ordered_ingest(spark, a.landing, a.root, cfg, a.app_version, a.format, a.lag, not a.continuous).awaitTermination()
            return 0
        qy = start_ingest(spark, a.landing, a.root, cfg, a.app_version, a.format, a.max_files_per_trigger,
                          a.start_height, available_now=not a.continuous, configured_start=a.configured_start)
        qy.awaitTermination()
        return 0
    if a.cmd == "replay":
        from govlake.streaming import replay
        replay(spark, a.landing, a.root, a.start_height, cfg, a.app_version, a.format, end_height=a.end_height)
        return 0
    from govlake.plans.catalog import GovLake
    lake = GovLake.from_tables(spark, a.root, cfg)
    if a.cmd == "sql":
        status = lake.register_views()
        failed = {k: v for k, v in status.items() if v != "ok"}
        if failed:
            print(f"views not registered: {failed}", file=sys.stderr)
        df = spark.sql(a.statement)
    else:
        from govlake.plans import quality as Q
        from govlake.plans.chain import chain_state
        from govlake.streaming.progress import ProcessedRanges, batch_metrics
        f = lake.facts
        df = {"chain_breaks": lambda: Q.chain_breaks(f.blocks), "block_gaps": lambda: Q.block_gaps(f.blocks),
              "block_rate": lambda: Q.block_rate(f.blocks), "range_summary": lambda: Q.range_summary(f.blocks),
              "coverage": lambda: Q.coverage(f.actions), "decode_quality": lambda: Q.decode_quality(f.actions),
              "newest_blocks": lambda: Q.newest_blocks(f.blocks), "chain_state": lambda: chain_state(f.blocks),
              "processed_ranges": lambda: ProcessedRanges(spark, a.root).processed(),
              "silent_gaps": lambda: ProcessedRanges(spark, a.root).silent_gaps(),
              "batch_metrics": lambda: batch_metrics(spark, a.root)}[a.name]()
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        df.show(getattr(a, "show", 20), truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
