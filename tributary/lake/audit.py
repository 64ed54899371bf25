"""Lake audits (J1-J3, A19, A22). Every check is a DataFrame of
(check, object_key, status, reason) rows; criteria roll up with bool_and.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.lake.layout import is_data, manifest_key, path_check
from tributary.operators.joins import broadcast_if_small

# Fixed values that must equal the reference's: audit criteria and the
# checks each one depends on.
#  1 raw data under <source>/anio=YYYY/mes=MM/dia=DD/      <- checks 1, 3, 5
#  2 reruns do not duplicate                               <- check 9
#  3 versioning active on the raw layer and evidenced      <- checks 2, 7
#  4 convention documented so anyone predicts a key        <- checks 3, 4, 6
#  5 raw layer immutable, never edited                     <- check 8
#  6 reproducible from a clean clone                       <- checks 1, 3, 4, 5, 6
CRITERIA = [(1, [1, 3, 5]), (2, [9]), (3, [2, 7]), (4, [3, 4, 6]), (5, [8]), (6, [1, 3, 4, 5, 6])]
CHECK_TITLES = {
    1: "layers exist", 2: "versioning as declared", 3: "keys follow the convention",
    4: "every data object has its manifest", 5: "content matches declared sha256",
    6: "every bucket has its readme", 7: "a previous version is readable",
    8: "no data object overwritten", 9: "no duplicated content",
}


def missing_manifest(objects: DataFrame, manifests: DataFrame, key: str = "object_key") -> DataFrame:
    """Data objects without their sibling manifest (left anti join)."""
    data = objects.where(is_data(F.col(key))).select(F.col(key).alias("object_key"))
    want = data.select("object_key", manifest_key("object_key").alias("_m"))
    have = manifests.select(F.col(key).alias("_m"))
    return want.join(have, "_m", "left_anti").select("object_key")


def manifest_status(objects: DataFrame, manifests: DataFrame, key: str = "object_key") -> DataFrame:
    """J1 as check rows: PASS for present, FAIL for missing (semi/anti split
    in one left join)."""
    data = objects.where(is_data(F.col(key))).select(F.col(key).alias("object_key"))
    want = data.select("object_key", manifest_key("object_key").alias("_m"))
    have = manifests.select(F.col(key).alias("_m"), F.lit(True).alias("_has")).distinct()
    j = want.join(have, "_m", "left")
    return j.select(F.lit(4).alias("check"), "object_key",
                    F.when(F.col("_has"), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
                    F.when(F.col("_has").isNull(), F.lit("no manifest")).alias("reason"))


def declared_vs_actual(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Declared layers (bucket, versioned) vs actual buckets (bucket,
    versioned, has_readme). Missing bucket or readme and missing versioning
    fail; versioning that was not asked for is only a note."""
    d = declared.select("bucket", F.col("versioned").alias("versioned_declared"), F.lit(True).alias("_d"))
    a = actual.select("bucket", F.col("versioned").alias("versioned_actual"), "has_readme",
                      F.lit(True).alias("_a"))
    j = d.join(a, "bucket", "full_outer")
    declared_ = F.coalesce("_d", F.lit(False))
    exists = F.coalesce("_a", F.lit(False))
    vd = F.coalesce("versioned_declared", F.lit(False))
    va = F.coalesce("versioned_actual", F.lit(False))
    readme = F.coalesce("has_readme", F.lit(False))
    reason = (F.when(declared_ & ~exists, F.lit("bucket missing"))
              .when(~declared_, F.lit("bucket not declared"))
              .when(vd & ~va, F.lit("versioning missing"))
              .when(~readme, F.lit("readme missing"))
              .when(~vd & va, F.lit("versioning not needed")))
    fail = (declared_ & ~exists) | (declared_ & vd & ~va) | (declared_ & exists & ~readme)
    note = ~fail & (~declared_ | (~vd & va))
    return j.select("bucket", declared_.alias("declared"), exists.alias("exists"),
                    vd.alias("versioned_declared"), va.alias("versioned_actual"), readme.alias("has_readme"),
                    F.when(fail, F.lit("FAIL")).when(note, F.lit("NOTE")).otherwise(F.lit("PASS")).alias("status"),
                    reason.alias("reason"))


def integrity_check(contents: DataFrame, manifests: DataFrame) -> DataFrame:
    """Recompute sha256 of every data object and compare it with the
    declared one; a missing declared hash is its own failure."""
    actual = contents.where(is_data(F.col("object_key"))).select(
        "object_key", F.sha2(F.col("content"), 256).alias("actual_sha256"))
    j = actual.join(manifests.select("object_key", "declared_sha256"), "object_key", "left")
    reason = (F.when(F.col("declared_sha256").isNull(), F.lit("no declared sha256"))
              .when(F.col("declared_sha256") != F.col("actual_sha256"), F.lit("sha256 mismatch")))
    return j.select("object_key", F.when(reason.isNull(), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
                    reason.alias("reason"))


def duplicate_content(contents: DataFrame) -> DataFrame:
    """Distinct keys holding identical content (same sha256). Grouping
    is by the 64-hex digest, so the shuffle never carries the content."""
    h = contents.where(is_data(F.col("object_key"))).select(
        "object_key", F.sha2(F.col("content"), 256).alias("sha256"))
    g = h.groupBy("sha256").agg(F.count(F.lit(1)).alias("objects"), F.min("object_key").alias("first_key"))
    return g.where(F.col("objects") > 1)


def integrity_of(objects: DataFrame, declared: DataFrame) -> DataFrame:
    """J3 on a content scan: (object_key, status, reason) of every stored data object against the
    declared (object_key, declared_sha256, declared_bytes), and of every declared object that is
    not stored any more."""
    actual = objects.where(F.col("class") == "data").select(
        "object_key", F.col("sha256").alias("_sha"), F.col("bytes").alias("_bytes"))
    j = actual.join(declared, "object_key", "full_outer")
    reason = (F.when(F.col("_sha").isNull(), F.lit("object missing"))
              .when(F.col("declared_sha256").isNull(), F.lit("no declared sha256"))
              .when(F.col("declared_bytes") != F.col("_bytes"), F.lit("size mismatch"))
              .when(F.col("declared_sha256") != F.col("_sha"), F.lit("sha256 mismatch")))
    return j.select("object_key", F.when(reason.isNull(), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
                    reason.alias("reason"))


def same_content(objects: DataFrame) -> DataFrame:
    """A19 on a content scan: (object_key, sha256, first_key) of data objects whose bytes another
    key before them holds too."""
    data = objects.where(F.col("class") == "data").select("object_key", "sha256")
    groups = (data.groupBy("sha256").agg(F.min("object_key").alias("first_key"),
                                         F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > 1).drop("_n"))
    return data.join(groups, "sha256").where(F.col("object_key") > F.col("first_key"))


def audit_stored(objects: DataFrame, documents: DataFrame, sources: list[str]) -> DataFrame:
    """Checks 3, 4, 5 and 9 of a lake that was written, as (check, object_key, status, reason).

    ``objects`` is the one content scan (``store.scan_objects``), ``documents`` the manifests that
    lie beside the objects (``manifests.read_manifests``)."""
    from tributary.lake.manifests import declared_hashes
    c3 = as_check(path_check(objects, sources), 3)
    c4 = manifest_status(objects, objects.where(F.col("class") == "manifest").select("object_key"))
    c5 = as_check(integrity_of(objects, declared_hashes(documents)), 5)
    c9 = same_content(objects).select(
        F.lit(9).alias("check"), "object_key", F.lit("FAIL").alias("status"),
        F.lit("same content under another key").alias("reason"))
    return c3.unionByName(c4).unionByName(c5).unionByName(c9)


def as_check(df: DataFrame, check: int, status_col: str = "status", key: str = "object_key",
             reason: str | None = "reason") -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.col(key).alias("object_key"),
                     F.col(status_col).alias("status"),
                     (F.col(reason) if reason else F.lit(None).cast("string")).alias("reason"))


def check_summary(checks: DataFrame, empty_passes: tuple[int, ...] = (9,)) -> DataFrame:
    """One row per check: passes iff it has rows and none FAIL (a check over
    zero data objects fails, except those in ``empty_passes``)."""
    g = checks.groupBy("check").agg(F.count(F.lit(1)).alias("rows"),
                                    F.count(F.when(F.col("status") == "FAIL", 1)).alias("failures"))
    all_checks = checks.sparkSession.createDataFrame([(c,) for c in CHECK_TITLES], "check int")
    j = all_checks.join(g, "check", "left")
    rows = F.coalesce(F.col("rows"), F.lit(0))
    fails = F.coalesce(F.col("failures"), F.lit(0))
    passed = (fails == 0) & ((rows > 0) | F.col("check").isin(*empty_passes))
    return j.select("check", rows.cast("bigint").alias("rows"), fails.cast("bigint").alias("failures"),
                    passed.alias("passed"))


def criteria_rollup(summary: DataFrame) -> DataFrame:
    """A criterion passes iff every check it depends on passes."""
    spark = summary.sparkSession
    crit = spark.createDataFrame([(c, deps) for c, deps in CRITERIA], "criterion int, checks array<int>")
    x = crit.select("criterion", F.array_join(F.col("checks"), ",").alias("depends_on"),
                    F.explode("checks").alias("check"))
    j = x.join(broadcast_if_small(summary.select("check", "passed")), "check", "left")
    return j.groupBy("criterion", "depends_on").agg(
        F.bool_and(F.coalesce(F.col("passed"), F.lit(False))).alias("passed"))
