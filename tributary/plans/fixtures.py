"""Deterministic fixtures derived from the driver tables.

Every rule is a pure function of ids (``id % n``), never ``rand()``, so the
same rows can be rebuilt by an independent SQL engine. See FIXTURES.md §3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.contract import LAKE_MANIFEST_SUFFIX
from tributary.functions.text import render_local_number
from tributary.sources.tables import load


def noisy_key(key: Column, row_id: Column) -> Column:
    """Raw keys with noise: blank every 50th, padded lower case on odd ids,
    widened inner spaces on every 3rd."""
    return (F.when(row_id % 50 == 0, F.lit("   "))
            .when(row_id % 2 == 1, F.concat(F.lit("  "), F.lower(key), F.lit(" ")))
            .when(row_id % 3 == 0, F.replace(key, F.lit("-"), F.lit(" - ")))
            .otherwise(key))


def dirty_local_number(value: Column, row_id: Column) -> Column:
    """Local-format text: every 97th 'n/d', every 101st '', every 89th missing
    (short row), every 13th with a currency prefix."""
    local = render_local_number(value, 2)
    return (F.when(row_id % 97 == 0, F.lit("n/d"))
            .when(row_id % 101 == 0, F.lit(""))
            .when(row_id % 89 == 0, F.lit(None).cast("string"))
            .when(row_id % 13 == 0, F.concat(F.lit("$ "), local))
            .otherwise(local))


def orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as a delimited-text source: noisy priority key, local price."""
    o = load(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_totalprice")
    return o.select("o_orderkey",
                    noisy_key(F.col("o_orderpriority"), F.col("o_orderkey")).alias("raw_key"),
                    dirty_local_number(F.col("o_totalprice"), F.col("o_orderkey")).alias("raw_value"))


def lineitem_row_id(l: DataFrame) -> Column:
    return l["l_orderkey"] * 8 + l["l_linenumber"]


def lineitem_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = load(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag",
             "l_extendedprice")
    rid = lineitem_row_id(l)
    return l.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("raw_key"),
                    dirty_local_number(F.col("l_extendedprice"), rid).alias("raw_value"))


# --- lake objects derived from documents ------------------------------------

def document_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as raw-lake objects: key from source and ingestion day
    (2024-01-01 + doc_id days, so every key is unique), content = text."""
    d = load(spark, sf_dir, "documents", "doc_id", "source", "text")
    ingest = F.date_add(F.lit("2024-01-01").cast("date"), F.col("doc_id").cast("int"))
    return d.select("doc_id", F.col("source").alias("source"), ingest.alias("ingest_date"),
                    F.col("text").alias("content"))


def declared_hashes(objects: DataFrame) -> Column:
    """Declared sha256 of an object: altered for doc_id % 17 = 0, absent for
    doc_id % 19 = 0."""
    real = F.sha2(F.col("content"), 256)
    return (F.when(F.col("doc_id") % 19 == 0, F.lit(None).cast("string"))
            .when(F.col("doc_id") % 17 == 0, F.sha2(F.concat(F.col("content"), F.lit("#")), 256))
            .otherwise(real))


def manifest_keys(spark: SparkSession, sf_dir: str, objects_with_keys: DataFrame) -> DataFrame:
    """Manifests exist for the objects whose doc_id is in labels."""
    labels = load(spark, sf_dir, "labels", "doc_id")
    return (objects_with_keys.join(labels, "doc_id", "left_semi")
            .select(F.concat(F.col("object_key"), F.lit(LAKE_MANIFEST_SUFFIX)).alias("object_key")))


# --- version log derived from events ----------------------------------------

LAYERS = ("raw", "refined", "curated")


def version_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as an object-store version log: layer by user_id % 3, key
    obj-<user_id>, version = event_id, instant = ts, 'error' = delete marker."""
    e = load(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    layer = F.element_at(F.array(*[F.lit(x) for x in LAYERS]), (F.col("user_id") % 3 + 1).cast("int"))
    is_delete = F.col("event_type") == "error"
    return e.select(
        layer.alias("layer"),
        F.concat(F.lit("obj-"), F.col("user_id").cast("string")).alias("object_key"),
        F.col("event_id").alias("version_id"),
        F.col("ts").alias("instant"),
        F.when(is_delete, F.lit("delete")).otherwise(F.lit("write")).alias("kind"),
        F.when(is_delete, F.lit(None).cast("bigint")).otherwise(F.col("value").cast("bigint")).alias("bytes"))


# --- lake fixtures -------------------------------------------------------------

from tributary.lake.layout import raw_key  # noqa: E402

CONFIGURED_SOURCES = [f"src{i}" for i in range(18)]  # src18, src19 are not configured


def lake_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as raw objects with their convention key (lot 1, .txt)."""
    o = document_objects(spark, sf_dir)
    return o.withColumn("object_key", raw_key(F.col("source"), F.col("ingest_date"), "txt"))


def damaged_objects(objects: DataFrame) -> DataFrame:
    """What is stored of ``objects``: altered where doc_id % 97 = 0, lost where doc_id % 101 = 0,
    and a second time under a source '<source>_bis' where doc_id % 103 = 0."""
    i = F.col("doc_id")
    kept = objects.where(i % 101 != 0).withColumn(
        "content", F.when(i % 97 == 0, F.concat("content", F.lit("~"))).otherwise(F.col("content")))
    copies = objects.where(i % 103 == 0).withColumn(
        "object_key", raw_key(F.concat(F.col("source"), F.lit("_bis")), F.col("ingest_date"), "txt"))
    return kept.select("object_key", "content").unionByName(copies.select("object_key", "content"))


def broken_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with deterministic faults: three-digit month (doc_id % 23), 30
    February (% 29), name date != partition date (% 31), upper case (% 37),
    bad extension (% 41)."""
    o = lake_objects(spark, sf_dir)
    i, s, k = F.col("doc_id"), F.col("source"), F.col("object_key")
    dd = F.date_format("ingest_date", "dd")
    key = (F.when(i % 23 == 0, F.replace(k, F.lit("/mes="), F.lit("/mes=0")))
           .when(i % 29 == 0, F.concat(s, F.lit("/anio=2024/mes=02/dia=30/"), s, F.lit("_20240230.txt")))
           .when(i % 31 == 0, F.concat(s, F.lit("/anio=2024/mes=01/dia="), dd, F.lit("/"), s,
                                       F.lit("_20231231.txt")))
           .when(i % 37 == 0, F.upper(k))
           .when(i % 41 == 0, F.replace(k, F.lit(".txt"), F.lit(".TXT")))
           .otherwise(k))
    return o.select("doc_id", key.alias("object_key"))


def mixed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data keys, manifests, probes, lake metadata and the bucket readme."""
    o = lake_objects(spark, sf_dir)
    i, k = F.col("doc_id"), F.col("object_key")
    key = (F.when(i % 6 == 1, F.concat(k, F.lit(LAKE_MANIFEST_SUFFIX)))
           .when(i % 6 == 2, F.concat(F.lit("_evidencia/probe-"), i.cast("string"), F.lit(".txt")))
           .when(i % 6 == 3, F.concat(F.lit("_meta/"), i.cast("string"), F.lit(".json")))
           .when(i % 6 == 4, F.lit("_LEEME.txt"))
           .otherwise(k))
    return o.select("doc_id", key.alias("object_key"))


def declared_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared buckets: nations that have customers; versioned in regions 0 and 2."""
    n = load(spark, sf_dir, "nation")
    c = load(spark, sf_dir, "customer", "c_nationkey")
    return n.join(c, n["n_nationkey"] == c["c_nationkey"], "left_semi").select(
        F.concat(F.lit("lake-"), F.lower(F.replace("n_name", F.lit(" "), F.lit("_")))).alias("bucket"),
        F.col("n_regionkey").isin(0, 2).alias("versioned"))


def actual_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual buckets: nations that have suppliers; versioning on
    when the supplier count is odd; readme present when a supplier balance
    exceeds 5000."""
    n = load(spark, sf_dir, "nation")
    s = load(spark, sf_dir, "supplier", "s_nationkey", "s_acctbal")
    j = s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return j.groupBy(F.concat(F.lit("lake-"), F.lower(F.replace("n_name", F.lit(" "), F.lit("_")))).alias("bucket")
                     ).agg((F.count(F.lit(1)) % 2 == 1).alias("versioned"),
                           (F.max("s_acctbal") > 5000).alias("has_readme"))


def largest_object_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as downloaded files: folder per source, period = lang,
    extension by doc_id % 4 (json is not eligible), every 50th a readme."""
    d = load(spark, sf_dir, "documents", "doc_id", "source", "lang", "text")
    ext = F.element_at(F.array(*[F.lit(x) for x in ("csv", "txt", "dta", "json")]),
                       (F.col("doc_id") % 4 + 1).cast("int"))
    name = F.when(F.col("doc_id") % 50 == 0, F.lit("readme.txt")).otherwise(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit("."), ext))
    return d.select("source", F.col("lang").alias("period"),
                    F.concat_ws("/", "source", "lang", name).alias("path"), name.alias("file_name"),
                    F.octet_length("text").cast("bigint").alias("bytes"))
