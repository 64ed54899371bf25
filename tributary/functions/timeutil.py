"""Date/time coercion and unit conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BYTES_PER_MIB = 1024 ** 2
BYTES_PER_GIB = 1024 ** 3
BYTES_PER_GB = 10 ** 9


def coerce_ts(c, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text -> timestamp (UTC wall clock), NULL when unparseable."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def hours_between(later: Column, earlier: Column) -> Column:
    """Exact elapsed hours between two timestamps (microsecond precision)."""
    return F.timestamp_diff("MICROSECOND", earlier, later).cast("double") / 3.6e9


def bytes_to_gib(c: Column) -> Column:
    return c / F.lit(float(BYTES_PER_GIB))


def gib_to_gb(c: Column) -> Column:
    """Binary GiB -> decimal GB (providers bill decimal GB)."""
    return c * F.lit(float(BYTES_PER_GIB)) / F.lit(float(BYTES_PER_GB))


def bytes_to_gb(c: Column) -> Column:
    return c / F.lit(float(BYTES_PER_GB))
