"""Curated products kept up month by month.

A product answers one business question at ``<root>/<domain>/<product>/anio=YYYY/mes=MM``. Each
month holds mergeable partials of its refined rows (sums, counts, least and greatest values), so
totals over any span of months are merged from partials and never from rows.

``update_product`` recomputes the months whose refined files changed since the product was last
written. What changed is read from a listing (a month's signature is made of its files' names
and lengths; every write gives files new names), so its cost does not depend on the rows of
the months that stayed. The signatures a product was computed from are appended beside it
after its months are in place: an update that was stopped is done again by the next one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.lake.layers import write_partitioned
from tributary.lake.lineage import MONTH, remove_months
from tributary.lake.store import key_below
from tributary.session import written

STATE = "_months"
STATE_SCHEMA = "anio string, mes string, signature string, updated bigint"

#: Measure kinds: how rows become a partial and how partials merge.
KINDS = {"sum": (F.sum, F.sum), "count": (F.count, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def month_signatures(spark: SparkSession, refined_path: str) -> DataFrame:
    """(anio, mes, signature) of a refined layer, from the listing of its files alone."""
    if not _exists(spark, refined_path):
        return spark.createDataFrame([], "anio string, mes string, signature string")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(refined_path)
             .select(key_below(refined_path).alias("key"), "length"))
    part = lambda name: F.regexp_extract("key", f"(?:^|/){name}=([^/]+)/", 1).alias(name)
    return (files.select(*map(part, MONTH), F.concat_ws(":", "key", F.col("length").cast("string")).alias("file"))
            .groupBy(*MONTH)
            .agg(F.sha2(F.array_join(F.array_sort(F.collect_list("file")), "\n"), 256).alias("signature")))


def product_state(spark: SparkSession, path: str) -> DataFrame:
    """(anio, mes, signature) the product was last computed from; a null signature: removed."""
    if not _exists(spark, f"{path}/{STATE}"):
        return spark.createDataFrame([], "anio string, mes string, signature string")
    runs = spark.read.schema(STATE_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{path}/{STATE}")
    return (runs.groupBy(*MONTH).agg(F.max(F.struct("updated", "signature")).alias("s"))
            .select(*MONTH, F.col("s.signature").alias("signature")))


def touched_months(spark: SparkSession, refined_path: str, path: str) -> DataFrame:
    """(anio, mes, signature) of months to recompute; a null signature: the month is gone."""
    now = month_signatures(spark, refined_path)
    then = product_state(spark, path).select(*MONTH, F.col("signature").alias("_then"))
    return (now.join(then, MONTH, "full_outer")
            .where(~F.col("signature").eqNullSafe(F.col("_then"))).drop("_then"))


def product_path(root: str, domain: str, product: str) -> str:
    return f"{root}/{domain}/{product}"


def update_product(spark: SparkSession, refined_path: str, refined_schema: T.StructType, root: str,
                   domain: str, product: str, dims: list[str],
                   measures: dict[str, tuple[str, Column]]) -> list[str]:
    """Brings a product up to date; returns the months (YYYY-MM) that were recomputed or removed.

    ``measures``: name -> (kind, value), kinds being those of KINDS."""
    path = product_path(root, domain, product)
    touched = written(touched_months(spark, refined_path, path), "lake", "touched")
    months = {f"{r.anio}-{r.mes}": r.signature for r in touched.collect()}  # a row a calendar month
    if not months:
        return []
    present = [m for m, signature in months.items() if signature is not None]
    held: set[str] = set()
    if present:
        folders = ["{}/anio={}/mes={}".format(refined_path, *m.split("-")) for m in present]
        rows = spark.read.schema(refined_schema).option("basePath", refined_path).parquet(*folders)
        partials = written(rows.groupBy(*dims, *MONTH).agg(
            *[KINDS[kind][0](value).alias(name) for name, (kind, value) in measures.items()]), "lake", "partials")
        write_partitioned(partials, path)
        held = {r.m for r in partials.select(F.concat_ws("-", *MONTH).alias("m")).distinct().collect()}
    remove_months(spark, path, [m for m in months if m not in held])
    (touched.withColumn("updated", F.unix_micros(F.current_timestamp()))
     .write.parquet(f"{path}/{STATE}/{uuid.uuid4().hex}"))
    return sorted(months)


def read_product(spark: SparkSession, root: str, domain: str, product: str,
                 schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(product_path(root, domain, product))


def merge_partials(partials: DataFrame, dims: list[str], kinds: dict[str, str]) -> DataFrame:
    """Totals over any rows of a product (spans of months, fewer dimensions), from partials alone."""
    return partials.groupBy(*dims).agg(*[KINDS[kind][1](name).alias(name) for name, kind in kinds.items()])
