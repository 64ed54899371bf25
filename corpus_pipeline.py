"""A training-corpus pipeline: filter, de-duplicate, decontaminate and encode ``documents``.

Each stage reads all that the one before it kept, written as Parquet, and its
decisions take effect: toxic texts go, then all but one row of equal texts, then
all but one of near copies, then benchmark passages (with the texts that consist
of them mostly), and what is left is encoded. Stages return the columns of
``documents``; the last returns them with the pieces' ids in place of the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.decontaminate import decontaminate
from tributary.llm.exact_dedup import exact_dedup
from tributary.llm.jaccard_join import near_duplicates_removed
from tributary.llm.pieces import encoded
from tributary.llm.store import prepare, stage
from tributary.llm.toxicity import toxic_removed
from tributary.sources.tables import load


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxic_removed(docs, load(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_duplicates_removed(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars``, where present, follows the text that is left."""
    prepare(spark)
    clean = decontaminate(docs, load(spark, sf_dir, "benchmark"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                                 .otherwise(F.length("text").cast(kind)))
    return clean


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    out, names = encoded(docs)
    return out.select(*[c for c in docs.columns if c != "text"],
                      *(names[w] for w in ("ids", "n_tokens", "n_bytes", "ids_sha256",
                                           "round_trip")))


STAGES = [
    ("toxicity", toxicity_filter),
    ("exact_dedup", exact_copies),
    ("jaccard_join", near_copies),
    ("decontamination", benchmark_passages),
    ("pieces", piece_ids),
]

#: SQL cannot express the first and the last stage; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for number, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
