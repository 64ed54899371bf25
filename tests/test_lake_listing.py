"""Listing and reading of stored files: by tasks, as Spark's readers would, whatever the number of files."""

import pytest
from pyspark.sql import functions as F

from tributary.lake import audit, manifests, store
from tributary.session import scratch_path
from tributary.sources.objects import object_inventory

SUFFIX = ".manifiesto.json"


def put(root, files):
    disk, base = store.filesystem_of(root)
    for key, content in files.items():
        disk.create_dir(f"{base}/{key}".rsplit("/", 1)[0], recursive=True)
        with disk.open_output_stream(f"{base}/{key}", compression=None) as f:
            f.write(content)


def test_listing_as_spark_lists(spark):
    root = scratch_path(spark, "test", "listing")
    put(root, {"a.txt": b"1", "s/x=1/b.txt": b"22", "s/x=1/c d %41 é.csv": b"333", "_k=2/e.txt": b"4", "empty.txt": b"",
               ".f.txt": b"5", "_g.txt": b"6", "s/_h/i.txt": b"7", "_metadata_j.txt": b"8", "k._COPYING_": b"9"})
    for glob in (None, "*.txt", "{a,b}.t?t", "[^a]*.txt"):
        r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        want = (r.option("pathGlobFilter", glob) if glob else r).load(root).select(
            store.key_below(root), "length", "modificationTime")
        got = object_inventory(spark, root, glob).select("object_key", "bytes", "modified")
        assert sorted(got.collect()) == sorted(tuple(x) for x in want.collect())


def test_the_driver_holds_no_list_of_the_objects(spark):
    """The tables read are the tasks' few lists, not the stored files."""
    root = scratch_path(spark, "test", "many")
    objects = spark.range(3000).select(
        F.format_string("s/anio=2024/d=%04d/s_%04d.txt", F.col("id") % 500, "id").alias("object_key"),
        F.lit("s").alias("source"), F.lit("2024-03-05").cast("date").alias("ingest_date"),
        F.col("id").cast("string").alias("content"))
    store.put_objects(objects, root)
    manifests.put_manifests(manifests.manifest_documents(objects), root)
    listed, read = object_inventory(spark, root, "*.txt"), manifests.read_manifests(spark, root)
    assert (listed.count(), read.count()) == (3000, 3000)
    assert len(listed.inputFiles()) < 100 and len(read.inputFiles()) < 100
    checks = audit.audit_stored(store.scan_objects(spark, root), read, ["s"])
    assert checks.groupBy("check").count().where("count = 3000").count() == 3
    assert checks.where("check = 5 and status = 'PASS'").count() == 3000


def test_manifests_as_spark_reads_them(spark):
    root = scratch_path(spark, "test", "documents")
    good = '{"clave_datos":"k","inmutable":true,"contenido":{"bytes":3,"columnas":["á","b"]}}'
    documents = [good.encode(), f"[{good},{good}]".encode(), b"[]", b" \n", b"{ not json", good.encode("utf-16"),
                 good.encode("utf-8-sig"), b'{"clave_datos":"k\xff"}', b'{"clave_datos":"k","contenido":{"bytes":"x"}}',
                 b'{"clave_datos":"k"} more', b"null", b"5", b'[{"clave_datos":"k"},{"inmutable":"z"}]', b"[1,2]", b""]
    put(root, {f"s/{k:02d}{SUFFIX}": d for k, d in enumerate(documents)} | {"s/other.json": good.encode()})
    want = (spark.read.schema(manifests.MANIFEST_SCHEMA).option("multiLine", "true")
            .option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{SUFFIX}").json(root)
            .select("*", F.col("_metadata.file_path").alias("path")).withColumn("key", store.key_below(root)).drop("path"))
    got = manifests.read_manifests(spark, root)
    assert got.dtypes[:-1] == want.dtypes[:-1] and got.columns[-1] == "manifest_key"
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_a_missing_root(spark):
    with pytest.raises(Exception, match="(?i)not.*(found|exist)|No such file|Cannot list"):
        object_inventory(spark, scratch_path(spark, "test", "missing")).collect()
