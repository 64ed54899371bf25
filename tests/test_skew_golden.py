"""Golden test of the shuffle/skew model against the published key profile
(20 keys, 20,000 valid records) and its published shuffle table."""

import pytest
from pyspark.sql import functions as F

from tributary.functions.hashing import java_hash
from tributary.operators import skew

# Fixed values that must equal the reference's published profile:
# key, record count, value sum, Java String.hashCode.
PROFILE = [
    ("BOGOTA D.C.", 6738, 378228155049.5896, -1083137933),
    ("ANTIOQUIA", 3618, 196761135551.40988, 681077993),
    ("VALLE DEL CAUCA", 2129, 114418053863.5902, -1675790982),
    ("CUNDINAMARCA", 1624, 85968461864.11998, 1956530568),
    ("SANTANDER", 1173, 64737680397.48004, 596768912),
    ("ATLANTICO", 1006, 53477498888.04003, -486935801),
    ("BOLIVAR", 603, 29185755064.040012, 779850813),
    ("NARINO", 598, 34966498191.49999, -1999349141),
    ("TOLIMA", 420, 20082944153.870007, -1814823732),
    ("HUILA", 397, 19020833941.320004, 69098321),
    ("CALDAS", 385, 23713341115.41001, 1980513544),
    ("CESAR", 226, 11345423659.609999, 64013346),
    ("BOYACA", 209, 10992942789.269993, 1965198131),
    ("CAUCA", 206, 10697301880.070005, 63896149),
    ("RISARALDA", 186, 9114535727.45, -1219245675),
    ("QUINDIO", 181, 9949449366.039995, 1376640385),
    ("META", 168, 7505912184.700001, 2362885),
    ("AMAZONAS", 62, 2642479078.6799974, -1116696266),
    ("GUAINIA", 36, 2192203414.06, 1084010640),
    ("VAUPES", 35, 1819117225.14, -1770220108),
]
VALID = 20000
MEAN_KEY_BYTES = 10.01615
MEAN_VALUE_BYTES = 12.8534


@pytest.fixture(scope="module")
def dist(spark):
    df = spark.createDataFrame([(k, n, s) for k, n, s, _ in PROFILE], "key string, count bigint, sum double")
    return df.select("key", "count", "sum", F.octet_length("key").cast("bigint").alias("key_bytes"),
                     java_hash("key").alias("java_hash"))


@pytest.fixture(scope="module")
def profile(spark):
    return spark.createDataFrame([(VALID, MEAN_KEY_BYTES, MEAN_VALUE_BYTES)],
                                 "valid bigint, mean_key_bytes double, mean_value_bytes double")


def test_java_hash_matches_published(dist):
    got = {r["key"]: r["java_hash"] for r in dist.collect()}
    assert got == {k: h for k, _, _, h in PROFILE}


def test_shuffle_estimate_m1(dist, profile):
    rows = {r["scenario"]: r for r in skew.shuffle_estimate(dist, profile, 1).collect()}
    assert rows["no_combiner"]["pairs"] == 20000
    assert round(rows["no_combiner"]["bytes"] / 1024, 1) == 485.7
    assert rows["combiner_upper_bound"]["pairs"] == 20
    assert round(rows["combiner_upper_bound"]["bytes"]) == 610
    assert rows["combiner_expected"]["pairs"] == 20
    assert round(rows["combiner_expected"]["bytes"]) == 610
    assert round(rows["combiner_expected"]["saving_pct"], 1) == 99.9


def test_shuffle_estimate_m6(dist, profile):
    rows = {r["scenario"]: r for r in skew.shuffle_estimate(dist, profile, 6).collect()}
    assert round(rows["combiner_expected"]["pairs"], 2) == 119.98
    assert round(rows["combiner_expected"]["bytes"], 1) == 3587.5


def test_partition_load_r3(dist):
    rows = skew.partition_load(dist, 3).collect()
    assert max(r["load"] for r in rows) == 10893
    assert round(rows[0]["ideal"]) == 6667
    assert round(max(r["imbalance"] for r in rows), 2) == 1.63


def test_partition_load_forces_two_reducers(dist):
    assert skew.partition_load(dist, 1).count() == 2


def test_skew_indicators(dist):
    r = skew.skew_indicators(dist).first()
    assert (r["max_count"], r["min_count"], r["keys"]) == (6738, 35, 20)
    assert round(r["top1_share"] * 100, 1) == 33.7
    assert round(r["top3_share"] * 100, 1) == 62.4
    assert round(r["max_to_mean"], 2) == 6.74


def test_salting_tradeoff(dist):
    rows = {r["metric"]: r for r in skew.salting_tradeoff(dist, 1, 3).collect()}
    assert rows["pairs"]["buckets"] == 7
    assert rows["pairs"]["after"] == 140
    assert round(rows["bytes"]["after"] / 1024, 1) == 4.3
    assert round(rows["max_load"]["after"]) == 7455
    assert round(rows["imbalance"]["before"], 2) == 1.63
    assert round(rows["imbalance"]["after"], 2) == 1.12
    assert round(rows["max_load"]["change_pct"]) == -32
    assert round(rows["bytes"]["change_pct"]) == 621


def test_top_keys(dist):
    rows = skew.top_keys(dist, 1).collect()
    assert [r["key"] for r in rows][:3] == ["BOGOTA D.C.", "ANTIOQUIA", "VALLE DEL CAUCA"]
    assert len(rows) == 10
    assert rows[0]["share_pct"] == pytest.approx(33.69, abs=0.005)
    assert all(r["expected_pairs"] == 1.0 for r in rows)
