"""Join helpers: a size-checked broadcast and anti/semi-join audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (file sizes for scans, propagated
    through filters/projections/aggregates). No job is run. A checkpointed
    table has no statistics and counts as very large."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast only a side whose estimated size is within ``max_bytes``;
    otherwise leave the choice to the planner (sort-merge / AQE at run time)."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def missing_from(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` without a partner in ``right`` (NOT EXISTS)."""
    return left.join(right, on, "left_anti")


def attach_one_row(df: DataFrame, *one_row: DataFrame) -> DataFrame:
    """Append the columns of single-row results (a global ``agg`` without
    grouping always yields exactly one row) to every row of ``df`` as scalar
    subqueries: each is evaluated once (Spark merges subqueries over the same
    aggregate) and its value is substituted into the projection. No join,
    no shuffle, no pairing of data rows."""
    for r in one_row:
        df = df.select("*", *[r.select(c).scalar().alias(c) for c in r.columns])
    return df
