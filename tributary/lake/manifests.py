"""Manifest documents (S9): one nested JSON document beside each raw object.

A manifest tells where an object came from, how and when it was taken in, what it holds and
what was done to it. It is written under the object's key plus the manifest suffix, read back
as one table of nested rows, and is what the audits compare the stored objects with.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tributary.contract import LAKE_MANIFEST_SUFFIX, LakeLayout
from tributary.lake.layout import manifest_key
from tributary.lake.load import object_manifests
from tributary.lake.store import dealt, filesystem_of, list_files, put_objects

# Fixed values that must equal the reference's: the names of a manifest's fields.
SOURCE_FIELDS = ("slug", "nombre", "organismo", "dataset_id", "portal", "licencia", "atribucion")
MANIFEST_SCHEMA = (
    "clave_datos string, capa string, inmutable boolean, "
    "fuente struct<" + ", ".join(f"{f}: string" for f in SOURCE_FIELDS) + ">, "
    "ingesta struct<instante_utc: string, fecha_particion: string, origen: string, "
    "urls_descarga: array<string>, script: string, version_script: string>, "
    "contenido struct<formato: string, bytes: bigint, sha256: string, filas_datos: bigint, "
    "columnas_n: bigint, columnas: array<string>>, "
    "linaje struct<transformaciones: array<string>>")


def manifest_documents(objects: DataFrame, source_info: dict[str, Column] | None = None,
                       origin: str = "archivo", urls: Column | None = None,
                       transformations: tuple[str, ...] = (), script: str = "tributary.lake",
                       script_version: str = "1", layer: str = "raw", fmt: str = "csv",
                       layout: LakeLayout = LakeLayout()) -> DataFrame:
    """Nested manifests of ``objects`` (object_key, source, ingest_date, content).

    ``source_info`` gives further fields of SOURCE_FIELDS; the ones it lacks are null.
    ``transformations`` lists what happened to the bytes before they became the object (the
    raw layer itself changes nothing)."""
    info = source_info or {}
    urls = F.array() if urls is None else urls
    rows = object_manifests(objects, layout, layer, fmt, keep=[
        F.col("ingest_date"), urls.cast("array<string>").alias("_urls"),
        *[c.cast("string").alias(f"_{n}") for n, c in info.items()]])
    known = {"slug": F.col("source")} | {n: F.col(f"_{n}") for n in info}
    text = lambda v: F.lit(v).cast("string")
    return rows.select(
        F.col("object_key").alias("clave_datos"), F.col("layer").alias("capa"),
        F.col("immutable").alias("inmutable"),
        F.struct(*[known.get(f, text(None)).alias(f) for f in SOURCE_FIELDS]).alias("fuente"),
        F.struct(F.date_format("ingest_date", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("instante_utc"),
                 F.col("partition").alias("fecha_particion"), text(origin).alias("origen"),
                 F.col("_urls").alias("urls_descarga"), text(script).alias("script"),
                 text(script_version).alias("version_script")).alias("ingesta"),
        F.struct(F.col("format").alias("formato"), "bytes", "sha256",
                 F.col("data_lines").alias("filas_datos"), F.col("columns_n").alias("columnas_n"),
                 F.split("header", ",").alias("columnas")).alias("contenido"),
        F.struct(F.array(*[F.lit(t) for t in transformations]).cast("array<string>")
                 .alias("transformaciones")).alias("linaje"))


def put_manifests(documents: DataFrame, root: str) -> DataFrame:
    """Writes each document as a JSON file beside its object; see ``put_objects``."""
    return put_objects(documents.select(
        manifest_key("clave_datos").alias("object_key"),
        F.to_json(F.struct(*documents.columns), {"ignoreNullFields": "false"}).alias("content")),
        root, overwrite=True)


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """All manifest documents under ``root`` as nested rows, with the key of their file. A file that
    is no JSON document gives a row of nulls beside its key; one that holds an array, a row for each
    of its documents; a blank one, none."""
    files = list_files(spark, root).where(F.col("name").endswith(LAKE_MANIFEST_SUFFIX))

    def read(batches):
        disk, _ = filesystem_of(root)
        for batch in batches:
            texts = []
            for path in batch.column(0).to_pylist():
                with disk.open_input_stream(path, compression=None) as stream:
                    content = stream.read()
                try:
                    texts.append(content.decode(json.detect_encoding(content)).strip(" \t\r\n"))
                except UnicodeDecodeError:
                    texts.append("?")  # no JSON document
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(texts, pa.large_string()).cast(pa.string())],
                                             names=["manifest_key", "text"])

    read_back = (dealt(files.select("path", "object_key", "bytes"))
                 .mapInArrow(read, "manifest_key string, text string").where(F.col("text") != ""))
    document = StructType.fromDDL(MANIFEST_SCHEMA)
    many = F.from_json("text", ArrayType(document))
    one = F.array(F.from_json("text", document))
    none = F.array(F.lit(None).cast(document))
    found = F.when(F.startswith("text", F.lit("[")), F.coalesce(many, none)).otherwise(one)
    return (read_back.select("manifest_key", F.explode(found).alias("_doc"))
            .select("_doc.*", "manifest_key"))


def declared_hashes(documents: DataFrame) -> DataFrame:
    """(object_key, declared_sha256, declared_bytes) of the manifests that were read."""
    return documents.where(F.col("clave_datos").isNotNull()).select(
        F.col("clave_datos").alias("object_key"), F.col("contenido.sha256").alias("declared_sha256"),
        F.col("contenido.bytes").alias("declared_bytes"))
