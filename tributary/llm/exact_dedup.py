"""Exact de-duplication with a heavy-hitter split (operator 8).

Texts are equal when their UTF-8 bytes are; the identity used throughout is
their SHA-256. A group of copies may hold a third of all rows, so the groups
are split by frequency:

1. a mergeable Misra-Gries summary (Spark's ``approx_top_k``, a
   frequent-items sketch of the Misra-Gries family) names the digests that may
   be frequent; its size is a parameter, whatever the input;
2. those candidates are verified: an ordinary aggregate over only their rows
   gives exact counts and winners, combined on the map side, so a frequent
   digest costs one partial row per task;
3. the verified winners (at most ``tracked`` rows) are broadcast and decide
   their rows on the map side, without a shuffle;
4. the remaining digests, none of which is frequent, are shuffled by digest.

DataFrame and SQL functions only. The row of a group that stays is the one
with the largest id; null ids rank lowest; among repeated rows with equal id
and text exactly one stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.store import free_name, stage

#: Digests reported by the summary, and counters it keeps: any digest with more
#: than about rows / (0.75 * COUNTERS) copies is among the candidates.
TRACKED, COUNTERS = 1024, 8192
#: A digest is treated as frequent when it has at least this many rows.
FREQUENT = 16


def text_digest(text: str) -> Column:
    """SHA-256 of the text's UTF-8 bytes (null counts as empty), 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def frequent_digests(keyed: DataFrame, tracked: int = TRACKED,
                     counters: int = COUNTERS) -> DataFrame:
    """Candidates (digest) of the Misra-Gries summary over a ``digest`` column."""
    found = keyed.agg(F.expr(f"approx_top_k(hex(digest), {tracked}, {counters})").alias("top"))
    return (found.select(F.explode("top").alias("entry"))
            .where(F.col("entry.count") >= FREQUENT)
            .select(F.unhex("entry.item").alias("digest")))


def verified_winners(keyed: DataFrame, candidates: DataFrame) -> DataFrame:
    """Exact (digest, keep_id, keep_row, group_size) of the candidates, from all their rows."""
    mine = keyed.join(F.broadcast(candidates), "digest", "left_semi")
    counts = mine.groupBy("digest").agg(F.max("id").alias("keep_id"),
                                        F.count(F.lit(1)).alias("group_size"))
    rows = (mine.join(F.broadcast(counts), "digest")
            .where(F.col("id").eqNullSafe(F.col("keep_id")))
            .groupBy("digest").agg(F.max("row").alias("keep_row")))
    return counts.join(rows, "digest").where(F.col("group_size") >= FREQUENT)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, digest, keep_id, group_size, kept.

    Reads only the two named columns. An empty table gives no rows; null and
    empty texts form one group."""
    keyed = stage(docs.select(F.col(id_col).alias("id"), text_digest(text_col).alias("digest"),
                              F.monotonically_increasing_id().alias("row")), "digests")
    candidates = stage(frequent_digests(keyed), "frequent")
    winners = stage(verified_winners(keyed, candidates), "winners")
    split = keyed.join(F.broadcast(winners), "digest", "left")
    heavy = split.where(F.col("group_size").isNotNull())
    group = Window.partitionBy("digest")
    light = (keyed.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
             .withColumn("best", F.max(F.struct("id", "row")).over(group))
             .select("digest", "id", "row", F.col("best.id").alias("keep_id"),
                     F.count(F.lit(1)).over(group).alias("group_size"),
                     F.col("best.row").alias("keep_row")))
    return heavy.select(light.columns).unionByName(light).select(
        F.col("id").alias(id_col), "digest", "keep_id", "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Frequent digests lose their copies on the map side; what is left is
    shuffled once, and Spark cuts each task's own copies before the shuffle
    (a row-number limit). Working columns get names that the input lacks."""
    digest, order, keep, hot = (free_name(docs.columns, c)
                                for c in ("digest", "order", "keep", "hot"))
    keyed = docs.select(F.col(id_col).alias("id"), text_digest(text_col).alias("digest"))
    candidates = stage(frequent_digests(keyed), "frequent")
    counts = (keyed.join(F.broadcast(candidates), "digest", "left_semi")
              .groupBy("digest").agg(F.max("id").alias(keep),
                                     F.count(F.lit(1)).alias("size")))
    winners = stage(counts.where(F.col("size") >= FREQUENT)
                    .select(F.col("digest").alias(digest), F.col(keep), F.lit(True).alias(hot)),
                    "winners")
    left = (docs.withColumn(digest, text_digest(text_col))
            .join(F.broadcast(winners), digest, "left")
            .where(F.col(hot).isNull() | F.col(id_col).eqNullSafe(F.col(keep))))
    first = Window.partitionBy(digest).orderBy(F.col(id_col).desc_nulls_last())
    return (left.withColumn(order, F.row_number().over(first))
            .where(F.col(order) == 1).select(*[F.col(f"`{c}`") for c in docs.columns]))
