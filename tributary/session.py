"""Session construction and shared scratch space.

Everything that writes (lake layers, delimited round trips, checkpoints) goes
under the cluster's shared checkpoint folder, read from ``spark.checkpoint.dir``.
A machine-local folder is created only when the session has none, which is the
case in unit tests and local benchmarks.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # lake partition values are zero-padded text (mes=08), never numbers
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Session settings every query relies on, applied to any session handed in
# (also the caller's own): the UTC wall clock. (Lowering
# spark.sql.codegen.hugeMethodLimit to the JIT's 8000-byte limit speeds up
# the very wide generator projections 5x but slows the typical fused stages
# more on balance, so the default is kept.)
QUERY_CONF = {
    "spark.sql.session.timeZone": "UTC",
}
DEFAULT_CONF.update(QUERY_CONF)


def apply_query_conf(spark: SparkSession) -> None:
    for k, v in QUERY_CONF.items():
        spark.conf.set(k, v)


def build_session(master: str | None = None, app: str = "tributary",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tributary-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), "tributary", *parts, uuid.uuid4().hex])


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the session's Python workers, which need not run where the
    repository is on the path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tributary-code-"), "tributary.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.join("tributary", os.path.relpath(path, package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def written(df: DataFrame, *name: str) -> DataFrame:
    """``df`` written to a fresh scratch folder and read back: its lineage is cut, and Catalyst
    knows its size from the files."""
    path = scratch_path(df.sparkSession, *name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
