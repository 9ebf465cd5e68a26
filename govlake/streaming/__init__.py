"""Structured Streaming ingest of the block feed."""

from govlake.streaming.ingest import (  # noqa: F401
    ingest_batch, replay, resume_start, start_ingest, start_ordered_ingest,
)
