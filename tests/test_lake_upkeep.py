"""Reprocessing by dependency, curated products kept up by month, as-of joins and version reads."""

import random

import pytest
from pyspark.sql import functions as F

from tributary.lake import curated, lineage, load as lake_load, versions
from tributary.lake.layers import write_partitioned
from tributary.lake.store import filesystem_of
from tributary.operators.asof import asof_join
from tributary.session import scratch_path

RAW = "id long, on string, v double"


def months():
    return [F.substring("on", 1, 4).alias("anio"), F.substring("on", 6, 2).alias("mes")]


def rule(factor, least=0.0):
    return lambda raw: (raw.where((F.col("v") >= least) & F.col("on").isNotNull())
                        .groupBy("id", "on").agg((F.max("v") * factor).alias("v"))
                        .select("id", "v", *months()))


def business_date():
    return F.to_date("on")


def files(path):
    disk, base = filesystem_of(path)
    from pyarrow import fs
    found = disk.get_file_info(fs.FileSelector(base, recursive=True))
    return {f.path[len(base):] for f in found if f.path.endswith(".parquet")}


REFINED = "id long, v double, anio string, mes string"


@pytest.fixture
def raw_lake(spark):
    """Four ingestion days; the third corrects a row of January and brings March."""
    root = scratch_path(spark, "test", "raw")
    for day, rows in (("2024-02-01", [(1, "2024-01-03", 1.0), (2, "2024-01-20", 2.0), (9, None, 1.0)]),
                      ("2024-03-01", [(3, "2024-02-11", 3.0), (4, "2023-12-30", 4.0)]),
                      ("2024-04-01", [(5, "2024-03-05", 5.0), (2, "2024-01-20", 20.0)]),
                      ("2024-05-01", [(6, "2024-04-05", 6.0)])):
        lake_load.load_raw(spark.createDataFrame(rows, RAW), root, "s", F.lit(day).cast("date"))
    return root


def read(spark, path):
    return sorted(tuple(r) for r in spark.read.schema(REFINED).parquet(path).collect())


@pytest.mark.parametrize("least", [0.0, 5.5])
def test_rebuild_equals_a_full_rebuild_and_leaves_other_months(spark, raw_lake, least):
    schema = spark.createDataFrame([], RAW).schema
    refined, full = scratch_path(spark, "test", "refined"), scratch_path(spark, "test", "full")
    whole = lake_load.read_raw(spark, raw_lake, "s", schema)
    lineage.index_lots(spark, raw_lake, "s", schema, business_date())
    write_partitioned(rule(1)(whole), refined)
    before = files(refined)
    got = lineage.rebuild_since(spark, raw_lake, "s", schema, refined, rule(10, least), business_date(), "2024-04-01")
    assert got == ["2024-01", "2024-03", "2024-04"]
    kept = {f for f in before if "2023" in f or "mes=02" in f}
    assert kept and kept <= files(refined)
    write_partitioned(rule(10, least)(whole), full)
    want = [r for r in read(spark, full) if f"{r[2]}-{r[3]}" in got]
    assert [r for r in read(spark, refined) if f"{r[2]}-{r[3]}" in got] == want
    assert [r[1] for r in read(spark, refined) if f"{r[2]}-{r[3]}" not in got] == [3.0, 4.0]
    if least:
        assert not any("mes=03" in f for f in files(refined))  # a month without rows is gone


def test_rebuild_reads_contributing_lots_only(spark, raw_lake):
    schema = spark.createDataFrame([], RAW).schema
    lineage.index_lots(spark, raw_lake, "s", schema, business_date())
    index = lineage.lineage(spark, raw_lake, "s")
    wanted = spark.createDataFrame([("2024-03",)], "month string")
    lots = lineage.contributing_lots(index, wanted)
    assert [(r.mes, r.dia) for r in lots.collect()] == [("04", "01")]
    scan = lineage.read_lots(spark, raw_lake, "s", schema, lots)
    assert all("mes=04/dia=01" in f for f in scan.inputFiles())
    assert lineage.index_lots(spark, raw_lake, "s", schema, business_date()).count() == 0
    assert sum(r.rows for r in index.collect()) == 8
    assert lineage.lineage(spark, raw_lake, "other").count() == 0


def test_a_date_read_by_another_rule_moves_months(spark, raw_lake):
    schema = spark.createDataFrame([], RAW).schema
    refined = scratch_path(spark, "test", "moved")
    lineage.index_lots(spark, raw_lake, "s", schema, business_date())
    whole = lake_load.read_raw(spark, raw_lake, "s", schema)
    write_partitioned(rule(1)(whole), refined)
    later = F.date_format(F.add_months(F.to_date("on"), 1), "yyyy-MM-dd")
    since = F.concat("anio", "mes", "dia") >= "20240501"
    moved = lambda raw: rule(1)(raw.withColumn("on", F.when(since, later).otherwise(F.col("on"))))
    date = F.when(F.concat("anio", "mes", "dia") >= "20240501", F.add_months(F.to_date("on"), 1)).otherwise(F.to_date("on"))
    got = lineage.rebuild_since(spark, raw_lake, "s", schema, refined, moved, date, "2024-05-01")
    assert got == ["2024-04", "2024-05"]
    assert [(r[0], r[3]) for r in read(spark, refined)] == [(1, "01"), (2, "01"), (3, "02"), (4, "12"), (5, "03"), (6, "05")]


def test_a_curated_product_follows_its_months(spark):
    refined, root = scratch_path(spark, "test", "refined"), scratch_path(spark, "test", "curated")
    rows = [(k, float(k % 7), f"2024-{k % 4 + 1:02d}-05") for k in range(200)]
    frame = spark.createDataFrame(rows, "id long, v double, on string").select("id", "v", *months())
    measures = {"total": ("sum", F.col("v")), "n": ("count", F.lit(1)), "most": ("max", F.col("v"))}

    def update():
        return curated.update_product(spark, refined, frame.schema, root, "d", "p", [], measures)

    def product():
        schema = "total double, n bigint, most double, anio string, mes string"
        return curated.read_product(spark, root, "d", "p", schema)

    assert update() == []
    write_partitioned(frame, refined)
    assert update() == ["2024-01", "2024-02", "2024-03", "2024-04"] and update() == []
    held = files(f"{root}/d/p")
    write_partitioned(frame.where("mes = '02'").withColumn("v", F.col("v") + 1), refined)
    plain = spark.read.schema(frame.schema)
    assert curated.touched_months(spark, refined, f"{root}/d/p").count() == 1
    assert update() == ["2024-02"]
    now = files(f"{root}/d/p")
    assert {f for f in held if "_months" not in f and "mes=02" not in f} <= now
    full = plain.parquet(refined).groupBy("anio", "mes").agg(
        F.sum("v").alias("total"), F.count(F.lit(1)).alias("n"), F.max("v").alias("most"))
    cols = ["anio", "mes", "total", "n", "most"]
    assert sorted(map(tuple, product().select(cols).collect())) == sorted(map(tuple, full.select(cols).collect()))
    whole = curated.merge_partials(product(), [], {"total": "sum", "n": "count", "most": "max"}).first()
    assert tuple(whole) == tuple(full.agg(F.sum("total"), F.sum("n"), F.max("most")).first())
    lineage.remove_months(spark, refined, ["2024-03"])
    assert update() == ["2024-03"]
    assert sorted(r.mes for r in product().select("mes").collect()) == ["01", "02", "04"]


def latest(events, key, at):
    mine = [e for e in events if e[0] == key and key is not None and e[1] is not None and at is not None and e[1] <= at]
    return max(mine, key=lambda e: (e[1], e[2]))[2] if mine else None


def test_asof_join_against_brute_force(spark):
    rng = random.Random(3)
    keys = ["hot"] * 12 + ["a", "b", None]
    events = [(rng.choice(keys), rng.choice([None, *range(40)]), k) for k in range(400)]
    asked = [(rng.choice([*keys, "none"]), rng.choice([None, *range(-3, 45)]), 1000 + k) for k in range(300)]
    right = spark.createDataFrame(events, "k string, t int, v long")
    left = spark.createDataFrame(asked, "k string, t int, n long")
    got = asof_join(left, right, ["k"], "t", "t", ("v",))
    assert got.columns == ["k", "t", "n", "asof_t", "asof_v"]
    assert {r.n: r.asof_v for r in got.collect()} == {n: latest(events, k, t) for k, t, n in asked}
    assert asof_join(left, right.limit(0), ["k"], "t", "t").where("asof_v IS NOT NULL").count() == 0
    assert asof_join(left.limit(0), right, ["k"], "t", "t").count() == 0


def test_a_hot_key_is_spread_over_tasks(spark, monkeypatch):
    from tributary.operators import asof
    frame = spark.range(40_000).select(F.lit("k").alias("k"), F.col("id").alias("t"))
    seen, plain = [], asof.written
    monkeypatch.setattr(asof, "written", lambda df, *n: seen.append(plain(df, *n)) or seen[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart
    try:
        got = asof_join(frame.withColumn("n", F.col("t")), frame.withColumn("v", F.col("t") * 2), ["k"], "t", "t")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got.where("asof_v = 2 * n").count() == 40_000
    sizes = [r["count"] for r in seen[0].groupBy("_part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 0.5 * sum(sizes)


LOG = "layer string, object_key string, version_id long, instant long, kind string, bytes long"


def test_versions_by_id_and_instant(spark):
    log = spark.createDataFrame([("raw", "a", 1, 10, "write", 5), ("raw", "a", 2, 20, "delete", None),
                                 ("raw", "a", 3, 30, "write", 7), ("raw", "b", 4, 30, "write", 1)], LOG)
    wanted = spark.createDataFrame([("raw", "a", 1), ("raw", "a", 3), ("raw", "b", 9), ("raw", "a", 1)],
                                   "layer string, object_key string, version_id long")
    assert {(r.object_key, r.version_id): (r.state, r.bytes) for r in versions.read_versions(log, wanted).collect()} \
        == {("a", 1): ("previous", 5), ("a", 3): ("current", 7), ("b", 9): ("unknown", None)}
    asked = spark.createDataFrame([("raw", "a", t) for t in (5, 10, 25, 99)], "layer string, object_key string, at long")
    assert {r.at: (r.state, r.version_id) for r in versions.versions_at(log, asked).collect()} == {
        5: ("absent", None), 10: ("live", 1), 25: ("deleted", 2), 99: ("live", 3)}
