"""Time and integer helpers (UTC, microsecond timestamps without zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_micros(ts) -> Column:
    return F.unix_micros(_c(ts).cast("timestamp"))


def epoch_ns(ts) -> Column:
    """TIMESTAMP_NTZ -> epoch nanoseconds (BIGINT)."""
    return epoch_micros(ts) * F.lit(1000)


def ns_to_timestamp(ns) -> Column:
    """Epoch nanoseconds (any integral/decimal) -> TIMESTAMP_NTZ, microsecond floor."""
    us = floor_div(_c(ns).cast("decimal(38,0)"), 1000).cast("bigint")
    return F.timestamp_micros(us).cast("timestamp_ntz")


def floor_div(x, unit: int) -> Column:
    """Exact FLOOR(x / unit) for DECIMAL(38,0) x, as DECIMAL(38,0)."""
    c = _c(x).cast("decimal(38,0)")
    u = F.lit(str(unit)).cast("decimal(38,0)")
    return ((c - F.pmod(c, u)) / u).cast("decimal(38,0)")
