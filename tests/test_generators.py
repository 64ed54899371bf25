"""Generators at larger size (driven by sf0.1 tables): shares within
tolerance of the declared weights, deterministic fingerprints, no driver
collection of data-sized results."""

import pytest
from pyspark.sql import functions as F

from tributary.lake.load import fingerprint
from tributary.plans import fixtures as fx
from tributary.sources import generators as gen
from tributary.sources.tables import load

SF = "/root/testdata/sf0.1"


def test_skewed_records_follow_weights(spark):
    li = load(spark, SF, "lineitem", "l_orderkey", "l_linenumber")
    recs = gen.skewed_records(li, fx.lineitem_row_id(li))
    shares = {r["departamento"]: r["share"] for r in recs.groupBy("departamento").agg(
        (F.count(F.lit(1)) / F.lit(li.count())).alias("share")).collect()}
    total = sum(w for _, w in gen.DEPARTMENT_WEIGHTS)
    assert len(shares) == 20
    for k, w in gen.DEPARTMENT_WEIGHTS:
        assert shares[k] == pytest.approx(w / total, abs=0.005)


def test_generators_are_deterministic(spark):
    li = load(spark, SF, "lineitem", "l_orderkey", "l_linenumber")
    a = gen.skewed_records(li, fx.lineitem_row_id(li))
    b = gen.skewed_records(li, fx.lineitem_row_id(li))
    cols = a.columns
    assert fingerprint(a, cols).first()["fingerprint"] == fingerprint(b, cols).first()["fingerprint"]


def test_meter_readings_shape(spark):
    c = load(spark, SF, "customer", "c_custkey")
    m = gen.meter_readings(c, F.col("c_custkey"))
    r = m.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("quality_flag") == "OK").cast("double")).alias("ok"),
              F.avg((F.col("quality_flag") == "SIN_SENAL").cast("double")).alias("lost"),
              F.min("consumption_m3").alias("lo"), F.count_distinct("municipality").alias("mun")).first()
    assert r["n"] == c.count() * 168
    assert r["ok"] == pytest.approx(0.94, abs=0.005) and r["lost"] == pytest.approx(0.01, abs=0.002)
    assert r["lo"] >= 0 and r["mun"] == 4


def test_survey_null_rates(spark):
    li = load(spark, SF, "lineitem", "l_orderkey", "l_linenumber")
    s = gen.survey_rows(li, fx.lineitem_row_id(li))
    r = s.agg(F.avg(F.col("p6503").isNull().cast("double")).alias("text_null"),
              F.avg(F.col("p6501").isNull().cast("double")).alias("money_null"),
              F.avg(F.col("p6502").isNull().cast("double")).alias("int_null")).first()
    assert r["text_null"] == pytest.approx(0.10, abs=0.005)
    assert r["money_null"] == pytest.approx(0.25, abs=0.005)
    assert r["int_null"] == 0


def test_wide_text_word_counts(spark):
    o = load(spark, SF, "orders", "o_orderkey")
    w = gen.wide_text_rows(o, F.col("o_orderkey"))
    r = w.agg(F.min(F.size(F.split("descripcion_del_procedimiento", " "))).alias("lo"),
              F.max(F.size(F.split("descripcion_del_procedimiento", " "))).alias("hi")).first()
    assert (r["lo"], r["hi"]) == (12, 44)


def test_meter_readings_are_dealt_to_tasks(spark):
    """One split of the source does not become one task of all its readings."""
    c = load(spark, SF, "customer", "c_custkey").coalesce(1)
    m = gen.meter_readings(c, F.col("c_custkey"), hours=24)
    parts = m.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 2 * min(r["count"] for r in parts)
    assert sum(r["count"] for r in parts) == 24 * c.count()
