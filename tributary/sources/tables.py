"""Reading the driver's parquet tables (one file per table).

Columns are selected right at the scan so Catalyst prunes the parquet read
(`ReadSchema` lists only what the query uses)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.session import table_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
