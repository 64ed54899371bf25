"""From ingestion days to business months (S7, S10): what a reprocess has to rebuild.

The raw layer is cut by ingestion day, the refined layer by business month, and one day's lots
hold rows of many months. A dependency index under ``<root>/_lineage/<source>`` keeps, for
every registered lot, the months it feeds and its rows in each. "Everything since day X" then
answers by looking up lots, not by reading the lake: the months those lots feed are rebuilt
from exactly the lots that feed them, and no other month's files are touched.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.lake.layers import write_partitioned
from tributary.lake.load import PARTS, lot_register, raw_schema
from tributary.session import written

LINEAGE = "_lineage"
LOT = [*PARTS, "lote"]
MONTH = ["anio", "mes"]
#: ``month`` (YYYY-MM) is null for rows without a business date; ``indexed`` orders an index's runs.
LINEAGE_SCHEMA = ("anio string, mes string, dia string, lote string, month string, rows bigint, "
                  "indexed bigint")


def registered_lots(spark: SparkSession, root: str, source: str, since: str | None = None) -> DataFrame:
    """(anio, mes, dia, lote) of the raw layer, ingested on ``since`` (YYYY-MM-DD) or later."""
    lots = lot_register(spark, root).where(F.col("source") == source)
    if since:
        lots = lots.where(F.concat(*PARTS) >= since.replace("-", ""))
    return lots.select(*PARTS, F.lpad(F.col("lot").cast("string"), 2, "0").alias("lote")).distinct()


def read_lots(spark: SparkSession, root: str, source: str, data_schema: T.StructType,
              lots: DataFrame) -> DataFrame:
    """The raw rows of the given lots: only their folders are listed and read (a path per lot)."""
    base = f"{root}/{source}"
    folders = [f"{base}/" + "/".join(f"{p}={r[p]}" for p in LOT) for r in lots.select(*LOT).collect()]
    schema = raw_schema(data_schema)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*folders)


def lineage(spark: SparkSession, root: str, source: str) -> DataFrame:
    """The index: each lot's latest entries (anio, mes, dia, lote, month, rows)."""
    path = f"{root}/{LINEAGE}/{source}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], LINEAGE_SCHEMA).drop("indexed")
    runs = spark.read.schema(LINEAGE_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    latest = runs.groupBy(*LOT).agg(F.max("indexed").alias("indexed"))
    return runs.join(latest, [*LOT, "indexed"]).select(*LOT, "month", "rows")


def index_lots(spark: SparkSession, root: str, source: str, data_schema: T.StructType,
               business_date: Column, since: str | None = None) -> DataFrame:
    """Indexes the lots that are not in the index yet, and those ingested since ``since`` again
    (their dates may be read by another rule now). Returns the new entries."""
    known = lineage(spark, root, source).select(*LOT).distinct()
    lots = registered_lots(spark, root, source).join(known, LOT, "left_anti")
    if since:
        lots = lots.unionByName(registered_lots(spark, root, source, since)).distinct()
    lots = written(lots, "lake", "lots")
    entries = (read_lots(spark, root, source, data_schema, lots)
               .groupBy(*LOT, F.date_format(business_date, "yyyy-MM").alias("month"))
               .agg(F.count(F.lit(1)).alias("rows")))
    entries = written(entries.withColumn("indexed", F.unix_micros(F.current_timestamp())), "lake", "lineage")
    entries.write.parquet(f"{root}/{LINEAGE}/{source}/{uuid.uuid4().hex}")
    return entries


def affected_months(index: DataFrame, since: str) -> DataFrame:
    """(month) fed by lots ingested on ``since`` or later."""
    day = F.concat(*PARTS)
    return (index.where((day >= since.replace("-", "")) & F.col("month").isNotNull())
            .select("month").distinct())


def contributing_lots(index: DataFrame, months: DataFrame) -> DataFrame:
    """(anio, mes, dia, lote) that feed any of the months."""
    return index.join(months, "month", "left_semi").select(*LOT).distinct()


def remove_months(spark: SparkSession, path: str, months: list[str]) -> None:
    for month in months:
        year, number = month.split("-")
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/anio={year}/mes={number}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def rebuild_since(spark: SparkSession, root: str, source: str, data_schema: T.StructType,
                  refined_path: str, rule: Callable[[DataFrame], DataFrame], business_date: Column,
                  since: str) -> list[str]:
    """Rebuilds the refined months that depend on anything ingested since ``since``.

    ``rule`` turns raw rows (with their ingestion columns) into refined rows with the business
    month as ``anio`` and ``mes``; ``business_date`` is the date it files a raw row under. Months
    a lot fed before and feeds now are both affected. Every affected month is computed from all
    the lots that feed it, so the result is that of a full rebuild, as long as the rule treats
    rows of different months apart. A month that is left without rows is removed. Only raw data
    is read: a rebuild that was stopped is run again. Returns the rebuilt months."""
    before = affected_months(lineage(spark, root, source), since)
    before = written(before, "lake", "months_before")
    index_lots(spark, root, source, data_schema, business_date, since)
    index = written(lineage(spark, root, source), "lake", "index")
    months = [r.month for r in affected_months(index, since).unionByName(before).distinct().collect()]
    if not months:  # one entry a calendar month: a list that Catalyst turns into partition filters
        return []
    wanted = spark.createDataFrame([(m,) for m in months], "month string")
    raw = read_lots(spark, root, source, data_schema, contributing_lots(index, wanted))
    refined = rule(raw)
    rebuilt = refined.where(F.concat_ws("-", *MONTH).isin(months))
    rebuilt = written(rebuilt, "lake", "rebuilt")
    write_partitioned(rebuilt, refined_path)
    held = {r.month for r in rebuilt.select(F.concat_ws("-", *MONTH).alias("month")).distinct().collect()}
    remove_months(spark, refined_path, [m for m in months if m not in held])
    return sorted(months)
