"""Object sources (S3, S4): inventory of stored objects and the choice of
the largest eligible object per source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.timeutil import BYTES_PER_GIB, BYTES_PER_MIB, bytes_to_gb
from tributary.lake.store import list_files

# Fixed values that must equal the reference's: file names never taken as
# data, accepted extensions and the minimum size of a real microdata file.
IGNORED_NAMES = ("leeme.txt", "readme.txt", "leeme.md", ".gitkeep")
ELIGIBLE_EXTENSIONS = (".csv", ".txt", ".dta", ".sav")
MIN_BYTES = 100 * 1024


def object_inventory(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """S3: every object under ``root`` with size and modification time, and a name that matches
    ``glob``. Tasks list the folders (``store.list_files``); no object is opened."""
    df = list_files(spark, root)
    if glob:
        pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
        df = df.where(F.col("name").rlike(f"(?s)^(?:{pattern})$"))
    return df.select("object_key", "bytes", "modified",
                     (F.col("bytes") / F.lit(float(BYTES_PER_MIB))).alias("mib"),
                     (F.col("bytes") / F.lit(float(BYTES_PER_GIB))).alias("gib"),
                     bytes_to_gb(F.col("bytes")).alias("gb"))


def largest_object(candidates: DataFrame, min_bytes: int = MIN_BYTES,
                   ignored=IGNORED_NAMES, extensions=ELIGIBLE_EXTENSIONS) -> DataFrame:
    """Per source, the largest eligible object (ignore list, extension
    list, size floor), the distinct periods seen and a warning flag when more
    than one period is present. ``candidates``: source, period, path,
    file_name, bytes."""
    name = F.lower(F.col("file_name"))
    ext_ok = F.lit(False)
    for e in extensions:
        ext_ok = ext_ok | name.endswith(e)
    ok = candidates.where(~name.isin(*ignored) & ext_ok & (F.col("bytes") >= min_bytes))
    g = ok.groupBy("source").agg(
        F.max(F.struct("bytes", "path")).alias("_m"), F.count(F.lit(1)).alias("candidates"),
        F.array_sort(F.collect_set("period")).alias("_p"))
    return g.select("source", F.col("_m.path").alias("chosen_path"), F.col("_m.bytes").alias("chosen_bytes"),
                    "candidates", F.array_join("_p", ",").alias("periods"),
                    (F.size("_p") > 1).alias("multi_period"))
