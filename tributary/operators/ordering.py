"""Consecutive numbering over a total order without a single-partition window.

``Window.orderBy`` with no partitioning pulls every row into one task. Here
the data is range-partitioned by the sort (Spark samples the sort keys, so a
hot key is split across partitions), checkpointed so partition contents are
fixed, and each partition's offset comes from a per-partition count table
(one row per partition, the only thing ordered in a single window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def global_row_number(df: DataFrame, order: list[Column], name: str = "seq") -> DataFrame:
    sorted_df = (df.orderBy(*order)
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_mid", F.monotonically_increasing_id()))
    # cut lineage: the sort must not be re-planned between the two uses below
    fixed = sorted_df.checkpoint(eager=True)
    counts = fixed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    offsets = counts.withColumn(
        "_off", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
    numbered = fixed.join(F.broadcast(offsets), "_pid").withColumn(
        name, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_mid") - F.col("_first") + 1).cast("bigint"))
    return numbered.drop("_pid", "_mid", "_n", "_first", "_off")


def rank_within(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank",
                count_name: str | None = None) -> DataFrame:
    """row_number() over (partition by keys order by ...) that stays balanced
    when one key holds a large share of the rows: global numbering of the
    (keys, order) sort, minus the first number of each key (a partial
    aggregate)."""
    g = global_row_number(df, [F.col(k) for k in keys] + order, "_g")
    firsts = g.groupBy(*keys).agg(F.min("_g").alias("_g0"), F.count(F.lit(1)).alias("_cnt"))
    out = g.join(firsts, keys).withColumn(name, (F.col("_g") - F.col("_g0") + 1).cast("bigint"))
    if count_name:
        out = out.withColumn(count_name, F.col("_cnt"))
    return out.drop("_g", "_g0", "_cnt")
