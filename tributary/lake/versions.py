"""Object-store version log.

The log has one row per event: (layer, object_key, version_id, instant,
kind = write | delete, bytes). State is derived, never stored: the latest
event per key decides whether the key is live. Per-key "latest" and
"previous" are ``max(struct(instant, version_id, ...))`` aggregates, which
Spark reduces map-side, so a key with a third of all events does not land
in one task the way a window partitioned by key would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.lake.layout import is_data
from tributary.operators.asof import asof_join
from tributary.operators.ordering import global_row_number, rank_within

KEY = ["layer", "object_key"]


def with_current(log: DataFrame) -> DataFrame:
    """The log with ``is_current``: whether an event is its key's latest. The latest events are met
    on their version id, so the join has no hot key."""
    latest = (log.groupBy(*KEY).agg(F.max(F.struct("instant", "version_id")).alias("_l"))
              .select(*KEY, F.col("_l.instant").alias("instant"), F.col("_l.version_id").alias("version_id"),
                      F.lit(True).alias("_current")))
    return (log.join(latest, [*KEY, "instant", "version_id"], "left")
            .select(*log.columns, F.coalesce("_current", F.lit(False)).alias("is_current")))


def union_events(writes: DataFrame, deletes: DataFrame) -> DataFrame:
    """Writes and delete markers into one log (markers carry no bytes and no sha256), each event
    with whether it is its key's latest."""
    log = (writes.withColumn("kind", F.lit("write"))
           .unionByName(deletes.withColumn("kind", F.lit("delete")), allowMissingColumns=True))
    sha = F.col("sha256") if "sha256" in log.columns else F.lit(None)
    return with_current(log.select("layer", "object_key", "version_id", "instant", "kind",
                                   F.col("bytes").cast("bigint").alias("bytes"),
                                   sha.cast("string").alias("sha256")))


def _latest(log: DataFrame, name: str = "_l") -> F.Column:
    return F.max(F.struct("instant", "version_id", "kind", "bytes")).alias(name)


def current_versions(log: DataFrame) -> DataFrame:
    """Latest event per key; live unless it is a delete marker."""
    g = log.groupBy(*KEY).agg(_latest(log), F.count(F.lit(1)).alias("events"))
    return g.select(*KEY, F.col("_l.version_id").alias("version_id"), F.col("_l.instant").alias("instant"),
                    F.col("_l.bytes").alias("bytes"),
                    F.when(F.col("_l.kind") == "delete", F.lit("deleted")).otherwise(F.lit("live"))
                    .alias("state"), "events")


def restored_versions(log: DataFrame) -> DataFrame:
    """Removing the delete marker of a deleted key brings back its latest
    write."""
    g = log.groupBy(*KEY).agg(
        _latest(log),
        F.max(F.when(F.col("kind") == "write", F.struct("instant", "version_id", "bytes"))).alias("_w"))
    return (g.where((F.col("_l.kind") == "delete") & F.col("_w").isNotNull())
            .select(*KEY, F.col("_l.version_id").alias("marker_version_id"),
                    F.col("_w.version_id").alias("restored_version_id"),
                    F.col("_w.instant").alias("restored_instant"), F.col("_w.bytes").alias("restored_bytes")))


def previous_version(log: DataFrame) -> DataFrame:
    """The second newest write of every key with more than one write.

    The filter on the row number lets Spark keep two rows per key and task before
    the shuffle (a window group limit), so a key with very many writes is no hot
    group; only the per-key counts are joined, one row a side."""
    writes = log.where(F.col("kind") == "write")
    newest = Window.partitionBy(*KEY).orderBy(F.col("instant").desc(), F.col("version_id").desc())
    second = (writes.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") <= 2)
              .where(F.col("_place") == 2))
    counts = writes.groupBy(*KEY).agg(F.count(F.lit(1)).alias("versions"))
    return (second.join(counts, KEY)
            .select(*KEY, "versions", F.col("version_id").alias("previous_version_id"),
                    F.col("instant").alias("previous_instant"), F.col("bytes").alias("previous_bytes")))


def read_versions(log: DataFrame, wanted: DataFrame) -> DataFrame:
    """The events of ``wanted`` (layer, object_key, version_id) with ``state``: ``current`` for
    the key's latest event, ``previous`` otherwise; wanted versions that the log does not have
    come back with state ``unknown``. Both joins are on the version id too, so a key with very
    many versions is spread like any other rows."""
    ids = [*KEY, "version_id"]
    marked = with_current(log)
    found = wanted.select(*ids).distinct().join(marked, ids, "left")
    state = (F.when(F.col("kind").isNull(), F.lit("unknown"))
             .when(F.col("is_current"), F.lit("current")).otherwise(F.lit("previous")))
    return found.select(*ids, "instant", "kind", "bytes", state.alias("state"))


def versions_at(log: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked`` (layer, object_key, at, and any others) with the version of the key that was the
    latest at the instant ``at``, its state then (live, deleted, or absent before the first
    write) and bytes. An as-of join: no window per key (see ``operators.asof``)."""
    events = log.select(*KEY, "instant", "version_id", "kind", "bytes")
    found = asof_join(asked, events, KEY, "at", "instant", ("version_id",), prefix="_")
    state = (F.when(F.col("_kind").isNull(), F.lit("absent"))
             .when(F.col("_kind") == "delete", F.lit("deleted")).otherwise(F.lit("live")))
    return found.select(*asked.columns, F.col("_version_id").alias("version_id"),
                        F.col("_instant").alias("instant"), F.col("_bytes").alias("bytes"),
                        state.alias("state"))


def immutability_audit(log: DataFrame, layer: str = "raw") -> DataFrame:
    """A data key of the raw layer written more than once broke the immutability rule.
    Other layers may be rewritten, and metadata and manifests are not data."""
    g = (log.where((F.col("kind") == "write") & (F.col("layer") == layer) & is_data(F.col("object_key")))
         .groupBy(*KEY)
         .agg(F.count(F.lit(1)).alias("versions")))
    return g.select(*KEY, "versions",
                    F.when(F.col("versions") > 1, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"))


def timeline(log: DataFrame) -> DataFrame:
    """Every event numbered by (instant, key, version) across all layers,
    plus its rank in its key's history (newest first) and the key's version
    count. Both numberings avoid single-task windows (see ordering)."""
    numbered = global_row_number(log, [F.col("instant"), F.col("object_key"), F.col("version_id")])
    ranked = rank_within(numbered, KEY, [F.col("instant").desc(), F.col("version_id").desc()],
                         "key_rank", "key_events")
    return ranked.select("seq", *KEY, "version_id", "instant", "kind", "bytes", "key_rank", "key_events")


def layer_summary(log: DataFrame) -> DataFrame:
    """Per layer, distinct keys, events and bytes of current versions
    (a delete marker as latest event counts 0)."""
    per_key = log.groupBy(*KEY).agg(_latest(log), F.count(F.lit(1)).alias("events"))
    cur = F.when(F.col("_l.kind") == "write", F.coalesce(F.col("_l.bytes"), F.lit(0))).otherwise(F.lit(0))
    return per_key.groupBy("layer").agg(
        F.count(F.lit(1)).alias("keys"), F.sum("events").cast("bigint").alias("events"),
        F.sum(cur).cast("bigint").alias("current_bytes"))
