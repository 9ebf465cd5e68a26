"""govlake: governance analytics over on-chain block logs, built on Spark.

Layers:
  sources/    fact tables, the block feed (batch + landing files), test fixtures
  functions/  column expressions (guarded JSON, base64, time, text)
  operators/  reusable DataFrame operators (flatten, decode, latest-per-key, upsert)
  plans/      the governance views and the data-quality reports
  streaming/  Structured Streaming ingest (foreachBatch upsert, chain checks)
"""

from govlake.config import ContractConfig

__all__ = ["ContractConfig"]
