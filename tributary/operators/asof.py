"""As-of join: for every row of one table the latest row of another at or before its instant.

Both sides are sorted as one table by (key, instant). The sort is a range partitioning, so a key
with a third of all rows is cut into as many partitions as its rows fill, and every partition
fills its own rows forward. What a partition cannot know, the last row before it, is one row per
partition: those rows are carried forward in order and handed to the partition they precede.
Linear in both sides, with no group per key and no pairing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.session import written


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str,
              order: tuple[str, ...] = (), prefix: str = "asof_") -> DataFrame:
    """``left`` with the columns of its match in ``right`` (all but ``by``), named with ``prefix``
    and null where there is none.

    Of rows of ``right`` at one instant the last in ``order`` counts. Null keys match nothing,
    rows of ``right`` without an instant are left out, rows of ``left`` without one stay
    unmatched. Both sides' instants (and ``by`` columns) must have the same types."""
    keep = [c for c in right.columns if c not in by]
    key = lambda d: F.struct(*[d[c] for c in by])
    ties = [right[c] for c in order]
    none = F.lit(None)
    r_row = F.struct(*[right[c] for c in keep])
    l_row = F.struct(*[left[c] for c in left.columns])
    events = right.where(right[right_on].isNotNull()).select(
        key(right).alias("_k"), right[right_on].alias("_t"), F.lit(0).alias("_side"),
        F.struct(*ties).alias("_o") if ties else F.lit(0).alias("_o"), r_row.alias("_r"),
        none.cast(left.select(l_row.alias("x")).schema["x"].dataType).alias("_l"))
    asked = left.select(
        key(left).alias("_k"), left[left_on].alias("_t"), F.lit(1).alias("_side"),
        none.cast(events.schema["_o"].dataType).alias("_o"),
        none.cast(events.schema["_r"].dataType).alias("_r"), l_row.alias("_l"))
    # written once: partition numbers and positions must not change between the uses below
    line = written(events.unionByName(asked).orderBy("_k", "_t", "_side", "_o")
                   .withColumn("_part", F.spark_partition_id())
                   .withColumn("_place", F.monotonically_increasing_id()), "asof")
    entry = F.when(F.col("_side") == 0, F.struct("_k", "_r"))
    last = line.groupBy("_part").agg(F.max_by(entry, F.when(F.col("_side") == 0, F.col("_place"))).alias("_last"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    carried = last.select("_part", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    here = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    filled = (line.withColumn("_found", F.last(entry, ignorenulls=True).over(here))
              .where(F.col("_side") == 1)
              .join(F.broadcast(carried), "_part", "left")
              .withColumn("_found", F.coalesce("_found", "_carried")))
    mine = F.lit(True)
    for c in by:
        mine = mine & (F.col(f"_found._k.{c}") == F.col(f"_k.{c}"))
    hit = F.when(mine & F.col("_t").isNotNull(), F.col("_found._r"))
    return filled.select("_l.*", hit.alias("_hit")).select(
        *left.columns, *[F.col(f"_hit.{c}").alias(f"{prefix}{c}") for c in keep])
