"""The load path: corrected batches, read-back cost, unregistered lots, late files, dirty numbers."""

import pytest
from pyspark.sql import functions as F

from tributary.contract import KeyValueContract
from tributary.functions.text import canonical_number
from tributary.lake import load as lake_load
from tributary.operators import aggregate as agg
from tributary.session import scratch_path
from tributary.streaming import raw_to_refined as refine

SCHEMA = "event_id long, ts timestamp, a string, b string"


def day(text="2024-03-05"):
    return F.lit(text).cast("date")


def rows(spark, *values):
    return spark.createDataFrame(list(values), "event_id long, t string, a string, b string").select(
        "event_id", F.to_timestamp("t").alias("ts"), "a", "b")


def test_a_value_that_moves_to_another_column_is_a_new_batch(spark):
    root = scratch_path(spark, "test", "moved")
    first = rows(spark, (1, "2024-03-05", "x", None))
    moved = rows(spark, (1, "2024-03-05", None, "x"))
    actions = lambda df: [(r.action, r.lot) for r in lake_load.load_raw(df, root, "s", day()).collect()]
    assert actions(first) == [("load", 1)]
    assert actions(first) == [("skip", 1)]
    assert actions(moved) == [("load", 2)]


def test_read_back_reads_only_the_folders_written(spark, monkeypatch):
    root, asked = scratch_path(spark, "test", "history"), []
    for k in range(3):
        plain = lake_load.fingerprint

        def seen(df, cols, keys=None):
            asked.append(sorted(f.split("/s/")[-1].rsplit("/", 1)[0] for f in df.inputFiles()))
            return plain(df, cols, keys)
        monkeypatch.setattr(lake_load, "fingerprint", seen)
        lake_load.load_raw(rows(spark, (k, "2024-03-05", "x", "y")), root, "s", day(f"2024-03-0{k + 1}"))
        monkeypatch.setattr(lake_load, "fingerprint", plain)
        assert set(asked[-1]) == {f"anio=2024/mes=03/dia=0{k + 1}/lote=01"}


def test_an_unregistered_lot_is_not_read(spark):
    root = scratch_path(spark, "test", "orphan")
    batch = rows(spark, (1, "2024-03-05", "x", "y"))
    lake_load.load_raw(batch, root, "s", day())
    orphan = f"{root}/s/anio=2024/mes=03/dia=05/lote=02"
    batch.write.parquet(orphan)
    assert lake_load.read_raw(spark, root, "s", batch.schema).count() == 1


def test_files_of_earlier_days_reach_the_refined_layer(spark):
    root, refined, ckpt = (scratch_path(spark, "test", x) for x in ("landing", "refined", "ckpt"))
    schema = rows(spark, (0, "2024-03-05", "", "")).schema
    batches = [[(k, f"2024-03-{d:02d}", "x", "y") for k in range(d, d + 3)] for d in (25, 3, 14)]
    for values in batches:  # late days, and keys that came before
        last = values[0][1][-2:]
        (rows(spark, *values).withColumns({"anio": F.lit("2024"), "mes": F.lit("03"), "dia": F.lit(last),
                                           "lote": F.lit("01")})
         .write.mode("append").partitionBy("anio", "mes", "dia", "lote").parquet(root))
        refine.run_until_drained(refine.start_raw_to_refined(spark, root, schema, refined, ckpt, "ts",
                                                             ["event_id"]))
    got = sorted(r.event_id for r in spark.read.parquet(refined).collect())
    assert got == sorted({v[0] for b in batches for v in b})
    again = rows(spark, *batches[0])
    refine.merge_months(again, refined, "ts", ["event_id"], schema)  # a repeated micro-batch
    assert sorted(r.event_id for r in spark.read.parquet(refined).collect()) == got


@pytest.mark.parametrize("text", ["1e25", "1e300", "-1e22"])
def test_huge_numbers_are_counted_and_never_fatal(spark, text):
    contract = KeyValueContract(key_col="k", value_col="v")
    pairs = agg.extract_pairs(spark.createDataFrame([("a", "1"), ("a", text), ("a", "x")],
                                                    "k string, v string"), contract)
    counts = {r.outcome: r.records for r in agg.discard_report(pairs).collect()}
    assert counts == {"valid": 1, "out_of_range": 1, "non_numeric": 1}
    assert [r["count"] for r in agg.mean_by_key(pairs).collect()] == [1]
    assert [r["count"] for r in agg.salted_mean(pairs, 3).collect()] == [1]


def test_canonical_number_of_huge_values(spark):
    got = spark.createDataFrame([(1.5e29,), (2.5,), (1e300,)], "v double").select(
        canonical_number("v").alias("t")).collect()
    assert [float(r.t) for r in got] == [1.5e29, 2.5, 1e300]


def test_a_fetch_stops_at_an_empty_page(spark):
    from tributary.sources.delimited import page_audit
    fetched = lambda *pages: [r.page for r in page_audit(
        spark.createDataFrame(list(pages), "page long, rows long"), 10).where("fetched").orderBy("page").collect()]
    assert fetched((0, 10), (1, 10), (3, 10)) == [0, 1]
    assert fetched((0, 10), (1, 4), (2, 10)) == [0, 1]
    assert fetched((1, 10)) == []


def test_only_raw_data_keys_are_immutable(spark):
    from tributary.lake.versions import immutability_audit
    log = spark.createDataFrame([(layer, key, v, "write") for layer in ("raw", "refined") for v in (1, 2)
                                 for key in ("s/a.csv", "_LEEME.txt", "s/a.csv.manifiesto.json")],
                                "layer string, object_key string, version_id long, kind string")
    assert [tuple(r) for r in immutability_audit(log).collect()] == [("raw", "s/a.csv", 2, "FAIL")]
