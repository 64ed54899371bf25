"""Heavy-key salting, counts beside the sums, measured partials, nested widths, exact row duplicates."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tributary.operators import aggregate as agg, profile as prof, skew
from tributary.session import scratch_path

PAIR = "key string, value double, reason string"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def values(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def hot_pairs(spark):
    """Half of 40,000 records hold one key, a tenth another, the rest 2,000 keys."""
    i = F.col("id")
    key = F.when(i % 2 == 0, "hot").when(i % 10 == 1, "warm").otherwise(F.concat(F.lit("k"), i % 2003))
    return spark.range(40_000).select(key.alias("key"), (i % 97 / 4).alias("value"),
                                      F.lit(None).cast("string").alias("reason"))


def test_heavy_keys_only_are_salted(spark, hot_pairs):
    heavy = agg.heavy_keys(hot_pairs)
    assert set(heavy) == {"hot", "warm"}
    assert all(2 <= n <= agg.MOST_BUCKETS for n in heavy.values())
    assert values(agg.salted_mean(hot_pairs)) == values(agg.mean_by_key(hot_pairs))
    assert values(agg.salted_mean(hot_pairs, {"hot": 5})) == values(agg.mean_by_key(hot_pairs))
    assert values(agg.salted_mean(hot_pairs, {})) == values(agg.mean_by_key(hot_pairs))


def test_the_salted_halves_share_one_scan(spark, hot_pairs):
    path = scratch_path(spark, "test", "pairs")
    hot_pairs.write.parquet(path)
    df = agg.salted_mean(spark.read.parquet(path), {"hot": 8, "warm": 4})
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert final.count("FileScan") == 1


def test_no_records(spark):
    none = spark.createDataFrame([], PAIR)
    assert agg.heavy_keys(none) == {} and agg.salted_mean(none).count() == 0
    assert agg.merge_counted(agg.counted_partials(none, F.lit(0))).count() == 0


def test_counts_come_with_the_result(spark):
    rows = [("a", 1.0, None, 0), ("a", 2.0, None, 1), ("a", None, "short_row", 0), ("b", 5.0, None, 0),
            ("c", None, "non_numeric", 1), ("c", None, "non_numeric", 1)]
    pairs = spark.createDataFrame(rows, PAIR + ", split int")
    parts = agg.counted_partials(pairs, "split")
    seen = Observation("merge")
    broken = parts.withColumn("sum", F.when(~((F.col("key") == "a") & (F.col("split") == 1)), F.col("sum")))
    broken = broken.unionByName(spark.createDataFrame(
        [(9, None, "3.0", None, 0, 0, 0)], "split int, key string, sum string, count long, short_row long, "
                                           "non_numeric long, out_of_range long"))
    out = {r.key: r for r in agg.merge_counted(broken, observation=seen).collect()}
    got = {k: (r.mean, r["count"], r.partials, r.malformed_partials, r.short_row, r.non_numeric)
           for k, r in out.items()}
    assert got == {"a": (1.0, 1, 1, 1, 1, 0), "b": (5.0, 1, 1, 0, 0, 0), "c": (None, 0, 0, 0, 0, 2),
                   None: (None, 0, 0, 1, 0, 0)}
    assert seen.get == {"partials": 4, "malformed": 2}
    assert plan(agg.merge_counted(broken)).count("Exchange") <= 4


def test_measured_partials_by_file_block(spark):
    path = scratch_path(spark, "test", "blocks")
    frame = spark.range(3000).select(F.concat(F.lit("k"), F.col("id") % 7).alias("key"),
                                     F.col("id").cast("double").alias("value"))
    frame.repartition(5).write.parquet(path)
    got = skew.measured_partials(spark.read.parquet(path))
    assert {r.key: (r["count"], r.measured_pairs) for r in got.collect()} == {
        f"k{k}": (len(range(k, 3000, 7)), 5) for k in range(7)}
    error = skew.estimate_vs_measured(got, 5).collect()
    assert all(abs(r.pairs_error) < 1e-6 and abs(r.bytes_error) < 0.2 for r in error)


def brute(rows):
    return len(rows), len(rows) - len(set(rows))


def test_rows_that_share_a_hash_are_told_apart(spark, monkeypatch):
    rows = [(1, "a", None), (1, "a", None), (1, None, "a"), (2, "b", "x"), (3, "b", "x"), (2, "b", "x"),
            (None, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "n int, s string, t string")
    assert tuple(prof.row_duplicates(df).first())[:2] == brute(rows)
    monkeypatch.setattr(prof, "row_prefilter", lambda cols: F.lit(7).cast("bigint"))
    assert tuple(prof.row_duplicates(df).first())[:2] == brute(rows)
    monkeypatch.undo()
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")
    assert prof.row_duplicates(zeros).first().duplicate_rows == 1
    none = prof.row_duplicates(spark.createDataFrame([], df.schema)).first()
    assert none.duplicate_rows is None and none.rows is None
    clash = spark.createDataFrame([(1, 1), (1, 1)], "_hash int, n int")
    assert prof.row_duplicates(clash).first().duplicate_rows == 1


def width(v):
    """The declared text of a nested value, as its docstring says it."""
    if v is None:
        return 0
    if isinstance(v, dict):
        return 2 + max(0, 2 * len(v) - 1) + sum(width(k) + width(x) for k, x in v.items())
    if isinstance(v, (list, tuple)):
        return 2 + max(0, len(v) - 1) + sum(map(width, v))
    if isinstance(v, bool):
        return 4 if v else 5
    if isinstance(v, float):
        return len(str(int(v)) if v == int(v) else repr(v))
    return len(str(v).encode())


def memory(v):
    if isinstance(v, str):
        return 57 + len(v.encode())
    if isinstance(v, dict):
        return 64 + sum(memory(k) + memory(x) for k, x in v.items())
    if isinstance(v, (list, tuple)):
        return 64 + sum(map(memory, v))
    return 8


def test_nested_widths(spark):
    rows = [([1.5, 2.0, None], {"é": 1, "k": 22}, (1, "ab", [True, False]), [["x", None], [], None]),
            ([], {}, (None, None, None), []), (None, None, None, None),
            ([-0.25], {"": None}, (-7, "ünï", [None]), [["yy"]])]
    df = spark.createDataFrame(rows, "a array<double>, m map<string, int>, "
                                     "s struct<n: int, t: string, b: array<boolean>>, l array<array<string>>")
    got = {r.column_name: r for r in prof.expansion_ratio(df, "t").collect()}
    missing = {"t": 24, "b": 24, "x": 24}

    def mem(v, text=False):
        if v is None:
            return 24
        return memory(v)

    for i, c in enumerate("amsl"):
        cells = [r[i] for r in rows]
        stored = sum((2 + width(v) if v is not None else 0) + 1 for v in cells) + 2
        assert got[c].stored_bytes == stored, c
    assert got["a"].memory_bytes == sum(mem(r[0]) for r in rows)
    assert got["m"].memory_bytes == sum(mem(r[1]) for r in rows)
    # a null text or nested value inside a container points at the shared null object
    assert got["s"].memory_bytes == ((64 + 8 + 59 + 64 + 16) + (64 + 8 + 24 + missing["b"]) + 24
                                     + (64 + 8 + (57 + 5) + 64 + 8))
    assert got["l"].memory_bytes == (64 + (64 + 58 + missing["x"]) + 64 + 24) + 64 + 24 + (64 + 64 + 59)
    assert got["*"].memory_bytes == sum(got[c].memory_bytes for c in "amsl")
