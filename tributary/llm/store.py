"""Intermediate tables in the shared scratch folder, and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import scratch_path
from tributary.sources.tables import load

BROADCAST_BYTES = 32 << 20
#: Bits of the filter before a join with a table of unknown size (1 MB).
FILTER_BITS = 1 << 23
#: Rows of texts that go to a Python worker at once.
ARROW_ROWS = "256"


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators rely on, and the package for Python workers, which
    need not run where the repository is on the path."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="tributary-code-"), "tributary.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(package):
                for name in sorted(n for n in names if n.endswith(".py")):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("tributary", os.path.relpath(path, package)))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder of spark.checkpoint.dir and read it back.

    Cuts the lineage, so a lost executor costs only what it was computing."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint when the files behind ``df`` prove it small; else a shuffled join.

    Only for staged tables: their size is the bytes of the files written. The
    factor allows for Parquet's compression."""
    return F.broadcast(df) if 4 * estimated_bytes(df) <= most else df


def sifted(df: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``df`` that may match ``wanted`` on the columns ``on``, before an exact join.

    A bitmap of FILTER_BITS bits, whatever the number of keys, is broadcast: with
    few keys it spares most rows the shuffle, with very many it only lets more
    rows through."""
    block = 1 << 16

    def mark(batches):
        bits = np.zeros(FILTER_BITS, dtype=bool)
        for batch in batches:
            bits[batch.column(0).to_numpy()] = True
        for number in np.flatnonzero(bits.reshape(-1, block).any(axis=1)).tolist():
            packed = np.packbits(bits[number * block:(number + 1) * block])
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()),
                                              pa.array([packed.tobytes()], pa.binary())],
                                             names=["block", "bits"])

    def either(table: pa.Table) -> pa.Table:
        rows = np.stack([np.frombuffer(b.as_py(), np.uint8) for b in table.column("bits")])
        return pa.table({"block": table.column("block").slice(0, 1),
                         "bits": pa.array([np.bitwise_or.reduce(rows).tobytes()], pa.binary())})

    place = F.pmod(F.xxhash64(*on), F.lit(FILTER_BITS))
    found = (wanted.select(place.alias("place")).mapInArrow(mark, "block long, bits binary")
             .groupBy("block").applyInArrow(either, "block long, bits binary").collect())
    bitmap = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in found:
        bitmap[r.block * block // 8:(r.block + 1) * block // 8] = np.frombuffer(r.bits, np.uint8)
    shared = df.sparkSession.sparkContext.broadcast(bitmap)
    name = free_name(df.columns, "place")

    def sift(batches):
        bitmap = shared.value
        for batch in batches:
            at = batch.column(batch.num_columns - 1).to_numpy()
            hit = (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
            yield batch.filter(pa.array(hit.astype(bool)))

    marked = df.withColumn(name, place)
    return marked.mapInArrow(sift, marked.schema).drop(name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return load(spark, sf_dir, "documents", *(columns or ("doc_id", "text")))


def free_name(taken, base: str) -> str:
    """``base``, lengthened until no name in ``taken`` equals it in either case."""
    lower = {c.lower() for c in taken}
    while base.lower() in lower:
        base += "_"
    return base
