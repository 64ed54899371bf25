"""Golden test of the capacity operators against the published projection
inputs and results (12-month volume, replication, blocks, compression,
break-even, saturation horizon, capacity choice)."""

import pytest
from pyspark.sql import functions as F

from tributary.operators import capacity as cap

# Fixed values that must equal the reference's published inputs: sample size
# (GiB) and rows, full-source rows, yearly rows of the central CAGR span,
# upper-bound CAGR, measured expansion factor.
SAMPLE_GIB = 0.194714
SAMPLE_ROWS = 200_000
TOTAL_ROWS = 8_878_158
ROWS_2023, ROWS_2025 = 1_531_557, 1_934_805
G_UPPER = 0.312
K = 3.09


@pytest.fixture(scope="module")
def inputs(spark):
    g = (ROWS_2025 / ROWS_2023) ** 0.5 - 1
    stored = SAMPLE_GIB * TOTAL_ROWS / SAMPLE_ROWS * 1024 ** 3
    m = spark.createDataFrame([("procurement", TOTAL_ROWS, stored, K)],
                              "source string, rows bigint, stored_bytes double, k double")
    gr = spark.createDataFrame([("procurement", g, G_UPPER)], "source string, g double, g_upper double")
    return cap.capacity_inputs(m, gr).cache()


def test_twelve_month_volume(inputs):
    r = inputs.first()
    assert round(r["s0_gib"], 4) == 8.6435
    assert round(r["g"], 4) == 0.1240
    assert round(r["v12_gib"], 3) == 9.715


def test_replication_table(inputs):
    rows = {r["R"]: r for r in cap.replication_table(inputs).collect()}
    assert [round(rows[r]["physical_gib"], 3) for r in (1, 2, 3)] == [9.715, 19.43, 29.145]
    assert round(rows[1]["physical_gb"], 4) == 10.4314
    assert [round(rows[r]["cloud_usd_year"], 2) for r in (1, 2, 3)] == [2.88, 5.76, 8.64]
    assert rows[3]["tolerated_losses"] == 2 and rows[3]["min_nodes"] == 3


def test_blocks(inputs):
    b = {r["R"]: r for r in cap.block_count(inputs).collect()}
    assert b[1]["blocks_r1"] == 78 and b[3]["blocks"] == 234
    p = cap.partitioning_overhead(inputs).first()
    assert (p["single_file_blocks"], p["partitioned_blocks"], p["overhead_blocks"]) == (78, 82, 4)


def test_compression(inputs):
    c = {r["factor"]: r for r in cap.compression_scenarios(inputs).collect()}
    assert round(c[5.0]["physical_r3_gib"], 3) == 5.829
    assert c[5.0]["blocks_r1"] == 16
    assert round(c[5.0]["cloud_r3_usd_year"], 2) == 1.73


def test_breakeven(inputs):
    b = {r["threshold_usd"]: r for r in cap.replica_breakeven(inputs).collect()}
    assert b[100]["volume_gb"] == 362.3
    assert b[100]["times_12m_volume"] == 34.7
    assert b[100]["years_central"] == 30.4


def test_saturation_horizon(inputs):
    rows = {r["ram_gib"]: r for r in cap.saturation_horizon(inputs).collect()}
    assert rows[16.0]["horizon_years"] == -8.07
    assert round(rows[16.0]["need_gib"], 2) == 26.71


def test_monthly_round_trip(inputs):
    r = inputs.select(F.pow(1 + cap.monthly_rate(F.col("g")), 12).alias("x"), "g").first()
    assert r["x"] == pytest.approx(1 + r["g"], rel=1e-12)


def test_capacity_choice_meter_case(spark):
    needs = spark.createDataFrame([("meters", 5000, 9.95)], "source string, entities bigint, need_gib double")
    r = cap.capacity_choice(needs).first()
    assert r["ram_gib"] == 32.0
    assert r["entity_limit"] == 10452
    assert r["years_at_growth"] == 4.0


def test_annualized_rows(spark):
    readings = spark.createDataFrame([("meters", 840_000, 51.8 * 840_000, 4.71, 5000, 7.0)],
                                     "source string, rows bigint, stored_bytes double, k double, "
                                     "entities bigint, span_days double")
    r = cap.annualized_need(readings).first()
    assert r["rows_per_year"] == 43_800_000
    assert r["bytes_per_row"] == 51.8
    assert round(r["s0_year_gib"], 2) == 2.11


def test_horizon_rejects_non_positive_growth(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0)], "s0 double, k double, g double")
    r = df.select(cap.horizon(F.lit(10.0), F.col("k"), F.col("s0"), F.col("g")).alias("t"),
                  cap.horizon_status(F.col("s0"), F.col("k"), F.col("g")).alias("s")).first()
    assert r["t"] is None and r["s"] == "growth must be > 0"
