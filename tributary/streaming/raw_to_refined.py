"""Incremental raw -> refined refinement as a Structured Streaming job.

The file stream source picks up the raw files that arrived since the last
trigger (tracked in its checkpoint). Each micro-batch is merged into the
refined months it touches: rows whose key a month already holds are left out,
the rest is added, and the month is replaced. No watermark decides what is too
late, so a backfill of an old day reaches the refined layer like any other
file, in whatever order days and batches come; and because a merge finds its
own rows by key, a repeated micro-batch changes nothing. The cost of a batch
is its own rows and the months they touch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tributary.lake.layers import write_partitioned
from tributary.lake.load import raw_schema
from tributary.session import scratch_path

MONTH = ["anio", "mes"]


def refine_events(rows: DataFrame, event_time: str, keys: list[str], data_cols: list[str]) -> DataFrame:
    """De-duplicated records with their business month."""
    return (rows.dropDuplicates(keys)
            .select(*data_cols, F.date_format(event_time, "yyyy").alias("anio"),
                    F.date_format(event_time, "MM").alias("mes")))


def merge_months(batch: DataFrame, refined_path: str, event_time: str, keys: list[str],
                 data_schema: T.StructType) -> None:
    """Add a batch's new keys to the refined months they belong to.

    A key lies in one month, as its event time does not change; the first row
    of a key to arrive stays."""
    spark = batch.sparkSession
    new = refine_events(batch, event_time, keys, data_schema.names)
    months = [tuple(r) for r in new.select(*MONTH).distinct().collect()]  # one row per month
    if not months:
        return
    schema = T.StructType([*data_schema.fields, *(T.StructField(c, T.StringType()) for c in MONTH)])
    path = spark._jvm.org.apache.hadoop.fs.Path(refined_path)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path):
        touched = F.concat_ws("-", *MONTH).isin(["-".join(m) for m in months])
        held = spark.read.schema(schema).parquet(refined_path).where(touched)
        new = held.unionByName(new.join(held.select(*keys), keys, "left_anti"))
    # the months are read and replaced: the merged rows are written apart first
    apart = scratch_path(spark, "stream", "months")
    new.write.parquet(apart)
    write_partitioned(spark.read.schema(schema).parquet(apart), refined_path)


def start_raw_to_refined(spark: SparkSession, raw_path: str, data_schema: T.StructType,
                         refined_path: str, checkpoint_path: str, event_time: str, keys: list[str],
                         files_per_trigger: int = 1000, available_now: bool = True) -> StreamingQuery:
    stream = (spark.readStream.schema(raw_schema(data_schema))
              .option("maxFilesPerTrigger", files_per_trigger).parquet(raw_path))
    w = (stream.writeStream.option("checkpointLocation", checkpoint_path)
         .foreachBatch(lambda batch, _: merge_months(batch, refined_path, event_time, keys, data_schema)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def run_until_drained(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
