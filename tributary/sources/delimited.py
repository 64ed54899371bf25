"""Delimited text sources and sinks.

Quoted fields may hold the delimiter and newlines, so records are parsed
with ``multiLine`` (a record is not a physical line). Spark reads such a file
in one task; ``split_delimited`` reads it by byte ranges, in as many tasks as
it has ranges. Pages fetched
separately are read as one multi-path scan with header validation, which
fails the job when any page's header differs from the declared schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators.joins import attach_one_row

# Fixed values that must equal the reference's: text tokens read as missing
# (the frame reader's default NA tokens).
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
               "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _csv_options(sep: str, header: bool) -> dict:
    return {"header": str(header).lower(), "sep": sep, "quote": '"', "escape": '"',
            "multiLine": "true", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false", "encoding": "UTF-8"}


def read_delimited(spark: SparkSession, paths, schema: T.StructType, sep: str = ",",
                   header: bool = True, corrupt_col: str | None = None,
                   validate_header: bool = True) -> DataFrame:
    """Quoted, multi-line delimited records with an explicit schema.
    Malformed records are kept (PERMISSIVE) and their raw text lands in
    ``corrupt_col`` when given, instead of failing the job."""
    r = spark.read.options(**_csv_options(sep, header)).option("mode", "PERMISSIVE")
    r = r.option("enforceSchema", str(not validate_header).lower())
    if corrupt_col:
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    paths = [paths] if isinstance(paths, str) else list(paths)
    return r.schema(schema).csv(paths)


def apply_null_tokens(df: DataFrame, tokens=NULL_TOKENS, cols: list[str] | None = None) -> DataFrame:
    """Map textual missing-value tokens to NULL (the CSV reader accepts only
    one ``nullValue``)."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.select(*[F.when(F.col(c).isin(*tokens), F.lit(None)).otherwise(F.col(c)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists",
                    partition_cols: list[str] | None = None) -> None:
    """Quoted delimited output, one file per task (and partition), header in
    every file."""
    w = (df.write.mode(mode).options(**_csv_options(sep, True))
         .option("quoteAll", "false").option("emptyValue", '""'))
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.csv(path)


def read_pages(spark: SparkSession, paths: list[str], schema: T.StructType, sep: str = ",") -> DataFrame:
    """Union of separately fetched pages with one header each; the job
    fails if any page header differs from the declared columns."""
    return read_delimited(spark, paths, schema, sep=sep, validate_header=True)


def page_audit(rows_per_page: DataFrame, page_size: int) -> DataFrame:
    """S2 audit: rows per page, short pages, and which pages a fetch loop
    that stops at the first short (or empty) page would have taken. An empty
    page has no row here: it is the first page number that is missing.
    ``rows_per_page``: page (from 0), rows."""
    first_short = rows_per_page.where(F.col("rows") < page_size).agg(F.min("page").alias("_stop"))
    pages = rows_per_page.select("page")
    first = rows_per_page.sparkSession.range(1).select(F.col("id").alias("page"))
    first_empty = (pages.select((F.col("page") + 1).alias("page")).unionByName(first)
                   .join(pages, "page", "left_anti").agg(F.min("page").alias("_empty")))
    return attach_one_row(rows_per_page, first_short, first_empty).select(
        "page", "rows", (F.col("rows") < page_size).alias("short"),
        ((F.col("_stop").isNull() | (F.col("page") <= F.col("_stop")))
         & (F.col("page") < F.col("_empty"))).alias("fetched"))


def rows_per_file(df: DataFrame) -> DataFrame:
    """Per-file record counts of a file scan (``_metadata`` column)."""
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count(F.lit(1)).alias("rows"))
