"""Objects of the lake as files: immutable puts and a content scan.

An object is one file whose path below the lake's root is its key. Tasks put objects: the
content goes to a temporary name beside the key and is moved there when it is complete, so a
lost executor leaves no half object. A raw object is never overwritten: a key that exists is
``present`` when it holds the same bytes and a ``conflict`` otherwise.

``list_files`` lists the stored files by tasks. ``scan_objects`` reads every stored object once and
keeps one narrow row of it (key, bytes, sha256, class); all audits work on that table, so the
contents are hashed a single time.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
from functools import reduce

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.contract import LAKE_README_KEY
from tributary.lake.layout import classify
from tributary.session import ship_package, written

PIECE = 1 << 20
#: Folders listed or files opened, and bytes read, by a task; rows that it sends at once.
FILES, TASK_BYTES, ROWS = 1024, 128 << 20, 4096
PUTS = "object_key string, bytes long, sha256 string, outcome string"


class ObjectConflict(RuntimeError):
    pass


def filesystem_of(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI, also in the form ``file:/...`` that Hadoop prints."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


def stored_sha256(disk: pafs.FileSystem, path: str) -> str | None:
    """SHA-256 of a file read in pieces; None when there is none."""
    if disk.get_file_info(path).type == pafs.FileType.NotFound:
        return None
    digest = hashlib.sha256()
    with disk.open_input_stream(path, compression=None) as stream:
        while piece := stream.read(PIECE):
            digest.update(piece)
    return digest.hexdigest()


def put_objects(objects: DataFrame, root: str, overwrite: bool = False) -> DataFrame:
    """One file per row of ``objects`` (object_key, content as text or bytes).

    Returns the written table (object_key, bytes, sha256, outcome), outcome being ``written``,
    ``present`` or ``conflict``. With ``overwrite`` (refined and curated layers, manifests) an
    existing object of other content is replaced. Null content is an empty object."""
    ship_package(objects.sparkSession)
    rows = objects.select("object_key", F.coalesce(F.col("content").cast("binary"),
                                                   F.lit(b"")).alias("content"))

    def put(batches):
        disk, base = filesystem_of(root)
        for batch in batches:
            out = []
            for key, content in zip(*(c.to_pylist() for c in batch.columns)):
                path = posixpath.join(base, key)
                sha = hashlib.sha256(content).hexdigest()
                held = stored_sha256(disk, path)
                if held == sha:
                    outcome = "present"
                elif held is not None and not overwrite:
                    outcome = "conflict"
                else:
                    folder = posixpath.dirname(path)
                    disk.create_dir(folder, recursive=True)
                    part = posixpath.join(folder, f"_{uuid.uuid4().hex}.part")
                    with disk.open_output_stream(part, compression=None) as stream:
                        stream.write(content)
                    disk.move(part, path)
                    outcome = "written"
                out.append((key, len(content), sha, outcome))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4,
                                                (pa.string(), pa.int64(), pa.string(), pa.string()))],
                names=["object_key", "bytes", "sha256", "outcome"])

    return written(rows.mapInArrow(put, PUTS), "lake", "puts")


def refuse_conflicts(puts: DataFrame) -> DataFrame:
    """The puts, if none met another content under its key."""
    bad = puts.where(F.col("outcome") == "conflict").limit(1).collect()
    if bad:
        raise ObjectConflict(f"raw object {bad[0].object_key} exists with other content")
    return puts


def key_below(root: str, path: str = "path") -> Column:
    """The key of a stored file: its path below ``root``."""
    prefix = posixpath.join(filesystem_of(root)[1], "")
    start = F.instr(F.col(path), prefix) + len(prefix)
    return F.when(F.instr(F.col(path), prefix) > 0, F.substr(F.col(path), start)).otherwise(F.col(path))


def hidden(name: str, folder: bool) -> bool:
    """Names of files and folders that Spark's readers leave out too."""
    if folder and name.startswith(("_common_metadata", "_metadata")):
        return False
    return (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Every stored file under ``root``: a written table (path, name, object_key, bytes, modified).

    Tasks list the folders, one round for each level of them, and write what they find: the driver
    holds no file's status, however many there are. As with Spark's readers, hidden names and empty
    files are left out."""
    ship_package(spark)
    base = filesystem_of(root)[1].rstrip("/")

    def children(batches):
        disk, _ = filesystem_of(root)

        def found(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (
                    pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64()))],
                names=["path", "name", "folder", "bytes", "millis"])

        rows = []
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                for x in disk.get_file_info(pafs.FileSelector(folder)):
                    inner = x.type == pafs.FileType.Directory
                    if not hidden(x.base_name, inner) and (inner or x.size):
                        rows.append((x.path, x.base_name, inner, x.size or 0, (x.mtime_ns or 0) // 1_000_000))
                    if len(rows) == ROWS:
                        yield found(rows)
                        rows = []
        yield found(rows)

    folders, count, levels = spark.createDataFrame([(base or "/",)], "path string"), 1, []
    while count:
        levels.append(written(folders.repartition(1 + count // FILES).mapInArrow(
            children, "path string, name string, folder boolean, bytes long, millis long"), "lake", "listing"))
        folders = levels[-1].where("folder").select("path")
        count = folders.count()
    listed = reduce(DataFrame.unionByName, levels).where(~F.col("folder"))
    return listed.select("path", "name", key_below(root).alias("object_key"), "bytes",
                         F.timestamp_millis("millis").alias("modified"))


def dealt(files: DataFrame) -> DataFrame:
    """``files`` (with bytes) dealt to tasks by their number and size, to be opened there."""
    total = files.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    return files.repartition(1 + total.n // FILES + total.bytes // TASK_BYTES)


def scan_objects(spark: SparkSession, root: str) -> DataFrame:
    """Every object stored under ``root``: (object_key, bytes, sha256, class), read back from the
    files themselves and written as one narrow table. Objects are read in pieces."""
    files = dealt(list_files(spark, root).select("path", "object_key", "bytes"))

    def scan(batches):
        disk, _ = filesystem_of(root)
        for batch in batches:
            sha = []
            for path in batch.column(0).to_pylist():
                sha.append(stored_sha256(disk, path))
                if sha[-1] is None:
                    raise FileNotFoundError(path)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(sha, pa.string())],
                                             names=["object_key", "bytes", "sha256"])

    return written(files.mapInArrow(scan, "object_key string, bytes long, sha256 string")
                   .withColumn("class", classify("object_key")), "lake", "objects")


def has_readme(root: str) -> bool:
    disk, base = filesystem_of(root)
    return disk.get_file_info(posixpath.join(base, LAKE_README_KEY)).type == pafs.FileType.File
