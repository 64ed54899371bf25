"""Raw-layer loading.

The raw layer is an append-only Parquet table partitioned by UTC ingestion
date and lot: ``<root>/<source>/anio=YYYY/mes=MM/dia=DD/lote=NN/``. Partition
values are zero-padded text. A batch is identified per (source, day) by a
content fingerprint (row count + exact sums of two 64-bit row hashes that
see where NULLs stand); lots are
resolved against the lot register ``<root>/_lots`` (underscore paths are
never read as data), so re-running a load writes nothing and a different
batch on the same day gets the next free lot.

Loads may run at the same time. Before anything is written, a load claims its lots: a small
file per (source, day, lot) under ``<root>/_claims``, created only if absent (atomic where the
file system's create without overwrite is, as on HDFS) and holding the batch's fingerprint. A
load that finds its lot taken reads the claims, which count as stored lots, and decides again.
A claim without a registered lot is of a load under way or one that crashed: the same batch
takes it up again, another batch goes to the next lot.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.contract import LAKE_MAX_LOTS, LakeLayout
from tributary.functions.hashing import table_fingerprint_aggs
from tributary.lake.layout import manifest_key, partition_values
from tributary.operators.joins import broadcast_if_small
from tributary.session import written

PARTS = ["anio", "mes", "dia"]
LOT_REGISTER = "_lots"
LOT_CLAIMS = "_claims"
REGISTER_SCHEMA = ("source string, anio string, mes string, dia string, lot int, rows bigint, "
                   "fingerprint string, written_at timestamp")


# --- W1 ----------------------------------------------------------------------------

def resolve_lots(stored: DataFrame, incoming: DataFrame, keys: list[str], new_lot: bool = True,
                 max_lots: int = LAKE_MAX_LOTS) -> DataFrame:
    """Decide load / skip / conflict / fail per incoming batch.

    ``stored``: keys + (lot, sha), lots unique per key; ``incoming``: keys +
    (sha). Only the contiguous prefix of lots 1..n-1 counts (n = first
    missing lot); a hash stored after a gap is not seen. Without ``new_lot``
    only lot 1 matters: missing -> load 1, same hash -> skip 1, else conflict
    1. With it: the smallest prefix lot with the same hash -> skip; none ->
    load n; n > max -> fail.

    No window: the first gap is the smallest ``lot + 1`` that is not itself
    stored (anti join on keys + lot) and hash matches come from a join on
    keys + sha, so every shuffle is keyed by near-unique values and a day
    with very many stored lots is still spread over many tasks.
    """
    present = stored.select(*keys, "lot")
    successors = present.select(*keys, (F.col("lot") + 1).alias("lot"))
    first_gap = (successors.join(present, [*keys, "lot"], "left_anti")
                 .groupBy(*keys).agg(F.min("lot").alias("_gap")))
    lot1 = stored.where(F.col("lot") == 1).select(*keys, F.col("sha").alias("_sha1"),
                                                  F.lit(True).alias("_has1"))
    inc = (incoming.select(*keys, "sha").join(lot1, keys, "left").join(first_gap, keys, "left")
           .withColumn("_n", F.when(F.col("_has1").isNull(), F.lit(1)).otherwise(F.col("_gap"))))
    same = (inc.select(*keys, "sha", "_n")
            .join(stored.select(*keys, "sha", F.col("lot").alias("_slot")), [*keys, "sha"])
            .where(F.col("_slot") < F.col("_n"))
            .groupBy(*keys, "sha").agg(F.min("_slot").alias("_same")))
    g = inc.join(same, [*keys, "sha"], "left")
    if new_lot:
        action = (F.when(F.col("_same").isNotNull(), F.lit("skip"))
                  .when(F.col("_n") > max_lots, F.lit("fail")).otherwise(F.lit("load")))
        lot = F.when(F.col("_same").isNotNull(), F.col("_same")).otherwise(F.col("_n"))
    else:
        action = (F.when(F.col("_has1").isNull(), F.lit("load"))
                  .when(F.col("_sha1") == F.col("sha"), F.lit("skip")).otherwise(F.lit("conflict")))
        lot = F.lit(1)
    return g.select(*keys, "sha", action.alias("action"), lot.cast("int").alias("lot"))


# --- fingerprints (S6) ---------------------------------------------------------------

def fingerprint(df: DataFrame, cols: list[str], keys: list[str] | None = None) -> DataFrame:
    """Order-insensitive content fingerprint per group (``table_fingerprint_aggs``)."""
    g = df.groupBy(*(keys or [])).agg(*table_fingerprint_aggs(cols))
    return g.select(*(keys or []), "rows",
                    F.concat_ws(":", F.col("rows").cast("string"), "hash_sum").alias("fingerprint"))


class ReadBackMismatch(RuntimeError):
    pass


# --- S5 -------------------------------------------------------------------------------

def raw_schema(data_schema: T.StructType) -> T.StructType:
    fields = list(data_schema.fields) + [T.StructField(p, T.StringType()) for p in PARTS] + \
        [T.StructField("lote", T.StringType())]
    return T.StructType(fields)


def lot_register(spark: SparkSession, root: str) -> DataFrame:
    """The committed lots: one folder of the register per load, so that loads never share one."""
    try:
        return (spark.read.schema(REGISTER_SCHEMA).option("recursiveFileLookup", "true")
                .parquet(f"{root}/{LOT_REGISTER}"))
    except Exception:  # noqa: BLE001 - no register yet: empty lake
        return spark.createDataFrame([], REGISTER_SCHEMA)


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Whether the file was created; an existing one is left as it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = files.create(target, False)
    except Py4JJavaError as taken:
        if "AlreadyExists" not in taken.java_exception.getClass().getName():
            raise
        return False
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def _claim_folder(root: str, source: str, day) -> str:
    return f"{root}/{LOT_CLAIMS}/{source}/" + "".join(day[p] for p in PARTS)


def lot_claims(spark: SparkSession, root: str, source: str, days: list) -> DataFrame:
    """Claimed lots (source, anio, mes, dia, lot, sha) of the given days (rows with PARTS): at
    most LAKE_MAX_LOTS small files a day. A claim that is just being written has an empty sha."""
    Path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    found = {}
    for day in days:
        folder = Path(_claim_folder(root, source, day))
        files = folder.getFileSystem(conf)
        for entry in files.listStatus(folder) if files.exists(folder) else ():
            found[entry.getPath().toString()] = (*(day[p] for p in PARTS), int(entry.getPath().getName()))
    texts = {}
    if found:
        rows = spark.read.text(list(found), wholetext=True).select("_metadata.file_path", "value")
        texts = {spark._jvm.org.apache.hadoop.fs.Path(r.file_path).toUri().getPath(): r.value
                 for r in rows.collect()}
    return spark.createDataFrame(
        [(source, *day_lot, texts.get(Path(path).toUri().getPath(), ""))
         for path, day_lot in found.items()],
        "source string, anio string, mes string, dia string, lot int, sha string")


def decide_and_claim(incoming: DataFrame, root: str, source: str, new_lot: bool = True) -> DataFrame:
    """W1 under concurrent loads: decisions (keys, action, lot, rows, fingerprint) whose lots to
    load are all claimed for their batch. ``incoming`` has one row per day."""
    spark = incoming.sparkSession
    keys = ["source", *PARTS]
    days = incoming.select(*PARTS).collect()
    for _ in range(LAKE_MAX_LOTS + 1):
        register = lot_register(spark, root).where(F.col("source") == source)
        registered = register.select(*keys, "lot", F.lit(True).alias("_registered")).distinct()
        stored = (register.select(*keys, "lot", F.col("fingerprint").alias("sha"))
                  .unionByName(lot_claims(spark, root, source, days))
                  .groupBy(*keys, "lot").agg(F.max("sha").alias("sha")))
        decided = resolve_lots(stored, incoming.withColumnRenamed("fingerprint", "sha"), keys,
                               new_lot=new_lot)
        unfinished = (F.col("action") == "skip") & F.col("_registered").isNull()
        decided = (decided.join(registered, [*keys, "lot"], "left")
                   .withColumn("action", F.when(unfinished, F.lit("load")).otherwise(F.col("action")))
                   .join(incoming.select(*PARTS, "rows"), PARTS))
        # written before the register changes: the decisions must not be derived again from it
        decided = written(decided.select(*keys, "action", "lot", "rows",
                                         F.col("sha").alias("fingerprint")), "lake", "decisions")
        refused = decided.where(F.col("action").isin("fail", "conflict")).limit(1).collect()
        if refused:
            raise RuntimeError(f"raw load refused for {source}: {refused[0].asDict()}")
        mine = {(*(r[p] for p in PARTS), r.lot): r.sha
                for r in lot_claims(spark, root, source, days).collect()}
        lost = False
        for r in decided.where(F.col("action") == "load").collect():  # one row a day of the batch
            held = mine.get((*(r[p] for p in PARTS), r.lot))
            if held is None:
                lost |= not create_if_absent(spark, f"{_claim_folder(root, source, r)}/{r.lot:02d}",
                                             r.fingerprint)
            else:
                lost |= held != r.fingerprint
        if not lost:
            return decided
    raise RuntimeError(f"no lot of {source} could be claimed")


def load_raw(batch: DataFrame, root: str, source: str, ingest_day: Column,
             new_lot: bool = True, verify: bool = True) -> DataFrame:
    """S5 + S6 + W1: add a batch to the raw layer of ``source``.

    ``ingest_day`` is the UTC ingestion date of each row (a literal for a
    one-shot load). Returns the per-day decision table (source, anio, mes,
    dia, action, lot, rows, fingerprint). Rows of days decided 'load' go to
    a new lote=NN partition; registered lots are never rewritten. Another load of
    the same days may run at the same time (see the module's text).
    """
    spark = batch.sparkSession
    cols = batch.columns
    days = batch.select("*", *partition_values(ingest_day))
    # one pass over the batch; one row per day from here on
    incoming = written(fingerprint(days, cols, PARTS).withColumn("source", F.lit(source)),
                       "lake", "incoming")
    decisions = decide_and_claim(incoming, root, source, new_lot)
    # a written table: its size is known, and the batch meets it without a shuffle
    to_load = decisions.where(F.col("action") == "load").select(*PARTS, "lot")
    rows = (days.join(broadcast_if_small(to_load), PARTS)
            .withColumn("lote", F.lpad(F.col("lot").cast("string"), 2, "0")).drop("lot"))
    # Only lots absent from the register are written, so registered data is
    # never touched. Dynamic partition overwrite (instead of append) makes a
    # rerun after a failure between this write and the register update replace
    # the orphaned, unregistered lot rather than duplicate it.
    # rebalance: about one file per day and lot, a large day split by AQE.
    (rows.hint("rebalance", *PARTS, "lote").sortWithinPartitions(*PARTS, "lote").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTS, "lote").parquet(f"{root}/{source}"))
    if verify:
        verify_read_back(spark, root, source, batch.schema, decisions.where(F.col("action") == "load"))
    register = decisions.where(F.col("action") == "load").select(
        F.lit(source).alias("source"), *PARTS, F.col("lot").cast("int").alias("lot"), "rows", "fingerprint",
        F.current_timestamp().alias("written_at"))
    register.write.parquet(f"{root}/{LOT_REGISTER}/{uuid.uuid4().hex}")
    return decisions.select("source", *PARTS, "action", "lot", "rows", "fingerprint")


def read_raw(spark: SparkSession, root: str, source: str, data_schema: T.StructType) -> DataFrame:
    """The registered lots of the raw layer, partition columns typed as text. A lot that a
    crashed load wrote but did not register is not seen."""
    lots = (lot_register(spark, root).where(F.col("source") == source)
            .select(*PARTS, F.lpad(F.col("lot").cast("string"), 2, "0").alias("lote")).distinct())
    rows = spark.read.schema(raw_schema(data_schema)).parquet(f"{root}/{source}")
    return rows.join(broadcast_if_small(lots), [*PARTS, "lote"], "left_semi")


def verify_read_back(spark: SparkSession, root: str, source: str, data_schema: T.StructType,
                     loaded: DataFrame) -> None:
    """The written partitions must hold exactly the fingerprinted rows. Only their own
    folders (one per day of the batch) are read, however much the lake holds."""
    cols = [f.name for f in data_schema.fields]
    lots = loaded.select(*PARTS, F.lpad(F.col("lot").cast("string"), 2, "0").alias("lote"), "fingerprint")
    base = f"{root}/{source}"
    folders = [f"{base}/" + "/".join(f"{p}={r[p]}" for p in [*PARTS, "lote"])
               for r in lots.select(*PARTS, "lote").collect()]
    if not folders:
        return
    back = (spark.read.schema(raw_schema(data_schema)).option("basePath", base).parquet(*folders))
    got = fingerprint(back, cols, PARTS + ["lote"]).withColumnRenamed("fingerprint", "_got")
    bad = (lots.join(got, PARTS + ["lote"], "left")
           .where(F.col("_got").isNull() | (F.col("_got") != F.col("fingerprint"))).limit(1).collect())
    if bad:
        raise ReadBackMismatch(f"read-back of {source} differs: {bad[0].asDict()}")


# --- S9 -----------------------------------------------------------------------------

def object_manifests(objects: DataFrame, layout: LakeLayout = LakeLayout(), layer: str = "raw",
                     fmt: str = "csv", keep: list[Column] | None = None) -> DataFrame:
    """One manifest row per object (key, layer, immutability, source,
    partition, format, bytes, sha256, data lines, header columns), and the columns ``keep``.

    ``objects``: object_key, source, ingest_date, content. Data lines count
    physical lines after the header (a quoted newline counts extra, as
    declared in the manifest), plus a last line without a newline."""
    c = F.col("content")
    has_nl = F.instr(c, "\n") > 0
    header = F.regexp_replace(F.substring_index(c, "\n", 1), "\r$", "")
    rest = F.when(has_nl, F.expr("substr(content, instr(content, '\n') + 1)")).otherwise(F.lit(""))
    nl = F.char_length(rest) - F.char_length(F.replace(rest, F.lit("\n"), F.lit("")))
    lines = nl + F.when((F.char_length(rest) > 0) & ~rest.endswith("\n"), 1).otherwise(0)
    d = F.col("ingest_date")
    part = F.concat(F.lit("anio="), F.date_format(d, "yyyy"), F.lit("/mes="), F.date_format(d, "MM"),
                    F.lit("/dia="), F.date_format(d, "dd"))
    return objects.select(
        "object_key", manifest_key("object_key").alias("manifest_key"), F.lit(layer).alias("layer"),
        F.lit(layer == "raw").alias("immutable"), "source", part.alias("partition"), F.lit(fmt).alias("format"),
        F.octet_length(c).cast("bigint").alias("bytes"), F.sha2(c, 256).alias("sha256"),
        lines.cast("bigint").alias("data_lines"), F.size(F.split(header, ",")).cast("bigint").alias("columns_n"),
        header.alias("header"), *(keep or []))


# --- S10 ----------------------------------------------------------------------------

def ingested_since(raw: DataFrame, day: str) -> DataFrame:
    """Everything ingested on or after ``day`` (YYYY-MM-DD). The filter
    touches only partition columns, so it is answered by partition pruning
    (PartitionFilters) without opening files of older days."""
    return raw.where(F.concat("anio", "mes", "dia") >= day.replace("-", ""))
