"""Concurrent loads, manifests beside their objects, and the audit of a lake that was written."""

import threading

import pytest
from pyspark.sql import functions as F

from tributary.lake import audit, load as lake_load, manifests, store
from tributary.session import scratch_path

SOURCES = ["wells"]


def day():
    return F.lit("2024-03-05").cast("date")


def batch(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "a string")


def test_a_load_that_meets_another_one_takes_the_next_lot(spark, monkeypatch):
    root = scratch_path(spark, "test", "claims")
    first, second = batch(spark, "x", "y"), batch(spark, "z")
    resolve, met = lake_load.resolve_lots, []

    def interleaved(*args, **kw):
        decided = resolve(*args, **kw).collect()  # decided before the other load begins
        frame = spark.createDataFrame(decided, "source string, anio string, mes string, dia string, "
                                               "sha string, action string, lot int")
        if not met:
            met.append(True)
            assert [r.lot for r in lake_load.load_raw(second, root, "s", day()).collect()] == [1]
        return frame
    monkeypatch.setattr(lake_load, "resolve_lots", interleaved)
    assert [(r.action, r.lot) for r in lake_load.load_raw(first, root, "s", day()).collect()] == [("load", 2)]
    monkeypatch.undo()
    back = lake_load.read_raw(spark, root, "s", first.schema)
    assert sorted((r.lote, r.a) for r in back.collect()) == [("01", "z"), ("02", "x"), ("02", "y")]
    assert [r.lot for r in lake_load.lot_register(spark, root).orderBy("lot").collect()] == [1, 2]


def test_loads_in_parallel(spark):
    root, out, errors = scratch_path(spark, "test", "parallel"), {}, []

    def load(k):
        try:
            out[k] = [r.lot for r in lake_load.load_raw(batch(spark, f"v{k}"), root, "s", day()).collect()]
        except Exception as e:  # noqa: BLE001 - reported below
            errors.append(e)
    threads = [threading.Thread(target=load, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    assert sorted(x for lots in out.values() for x in lots) == [1, 2, 3, 4]
    back = lake_load.read_raw(spark, root, "s", batch(spark, "").schema).collect()
    assert sorted(r.a for r in back) == ["v0", "v1", "v2", "v3"]
    assert {r.a: int(r.lote) for r in back} == {f"v{k}": lots[0] for k, lots in out.items()}


def test_a_crashed_load_is_taken_up_again_and_others_go_on(spark, monkeypatch):
    root = scratch_path(spark, "test", "crash")
    verify = lake_load.verify_read_back

    def crash(*args):
        raise OSError("driver lost")
    monkeypatch.setattr(lake_load, "verify_read_back", crash)
    with pytest.raises(OSError):
        lake_load.load_raw(batch(spark, "x"), root, "s", day())
    monkeypatch.setattr(lake_load, "verify_read_back", verify)
    actions = lambda v: [(r.action, r.lot) for r in lake_load.load_raw(batch(spark, v), root, "s", day()).collect()]
    assert actions("other") == [("load", 2)]
    assert actions("x") == [("load", 1)]
    assert actions("x") == [("skip", 1)]
    back = lake_load.read_raw(spark, root, "s", batch(spark, "").schema)
    assert sorted((r.lote, r.a) for r in back.collect()) == [("01", "x"), ("02", "other")]


def test_a_claim_is_created_once(spark):
    path = scratch_path(spark, "test", "claim") + "/01"
    assert lake_load.create_if_absent(spark, path, "a")
    assert not lake_load.create_if_absent(spark, path, "b")
    assert spark.read.text(path).first().value == "a"


@pytest.fixture
def lake(spark):
    root = scratch_path(spark, "test", "lake")
    rows = [(f"wells/anio=2024/mes=03/dia=0{k}/wells_2024030{k}.csv", "wells", f"2024-03-0{k}",
             f'id,name\n{k},"a\nb"\n') for k in range(1, 6)]
    objects = spark.createDataFrame(rows, "object_key string, source string, d string, content string") \
        .withColumn("ingest_date", F.to_date("d"))
    store.refuse_conflicts(store.put_objects(objects, root))
    manifests.put_manifests(manifests.manifest_documents(
        objects, {"nombre": F.lit("Wells")}, origin="portal", urls=F.array(F.lit("u1"), F.lit("u2")),
        transformations=("pages joined under one header",)), root)
    return root, objects


def failures(spark, root):
    checks = audit.audit_stored(store.scan_objects(spark, root), manifests.read_manifests(spark, root), SOURCES)
    return sorted((r.check, r.object_key[-12:], r.reason) for r in checks.where("status = 'FAIL'").collect())


def test_a_manifest_document(spark, lake):
    doc = manifests.read_manifests(spark, lake[0]).orderBy("clave_datos").first()
    assert doc.manifest_key == doc.clave_datos + ".manifiesto.json"
    assert doc.fuente.asDict() == {"slug": "wells", "nombre": "Wells", "organismo": None, "dataset_id": None,
                                   "portal": None, "licencia": None, "atribucion": None}
    assert doc.ingesta.urls_descarga == ["u1", "u2"] and doc.ingesta.fecha_particion == "anio=2024/mes=03/dia=01"
    assert doc.contenido.columnas == ["id", "name"] and doc.contenido.filas_datos == 2
    assert doc.linaje.transformaciones == ["pages joined under one header"]
    assert failures(spark, lake[0]) == []


def test_tampering_is_found(spark, lake):
    root, _ = lake
    disk, base = store.filesystem_of(root)
    at = lambda k: f"{base}/wells/anio=2024/mes=03/dia=0{k}/wells_2024030{k}.csv"
    with disk.open_output_stream(at(1), compression=None) as f:
        f.write(b'id,name\n9,"a\nb"\n')  # same length
    disk.delete_file(at(2))
    disk.create_dir(at(3).replace("dia=03", "dia=07").rsplit("/", 1)[0])
    disk.copy_file(at(3), at(3).replace("dia=03", "dia=07").replace("20240303", "20240307"))
    with disk.open_output_stream(at(4) + ".manifiesto.json", compression=None) as f:
        f.write(b"{ not json")
    assert failures(spark, root) == [
        (4, "20240307.csv", "no manifest"), (5, "20240301.csv", "sha256 mismatch"),
        (5, "20240302.csv", "object missing"), (5, "20240304.csv", "no declared sha256"),
        (5, "20240307.csv", "no declared sha256"), (9, "20240307.csv", "same content under another key")]


def test_raw_objects_are_immutable(spark, lake):
    root, objects = lake
    again = store.put_objects(objects, root)
    assert {r.outcome for r in again.collect()} == {"present"}
    changed = objects.withColumn("content", F.concat("content", F.lit("x")))
    with pytest.raises(store.ObjectConflict):
        store.refuse_conflicts(store.put_objects(changed, root))
    assert failures(spark, root) == []
    assert {r.outcome for r in store.put_objects(changed, root, overwrite=True).collect()} == {"written"}


def test_empty_objects_and_readme(spark):
    root = scratch_path(spark, "test", "empty")
    assert not store.has_readme(root)
    rows = spark.createDataFrame([("a/b", None), ("_LEEME.txt", "about")], "object_key string, content string")
    assert {(r.object_key, r.bytes) for r in store.put_objects(rows, root).collect()} == {("a/b", 0), ("_LEEME.txt", 5)}
    assert store.has_readme(root)
    none = spark.createDataFrame([], rows.schema)
    assert store.put_objects(none, root).count() == 0
