"""Property tests: merge/salt equivalences, idempotent loading, number
round trips, lot resolution rules."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tributary.functions.text import canonical_number, parse_local_number, render_local_number
from tributary.lake import load as lake_load
from tributary.operators import aggregate as agg
from tributary.plans import fixtures as fx
from tributary.plans.catalog import TEXT_CONTRACT
from tributary.session import scratch_path
from tributary.sources.tables import load

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pairs(spark):
    l = fx.lineitem_text(spark, SF)
    return agg.extract_pairs(l, TEXT_CONTRACT, keep=[F.col("l_orderkey").alias("l_orderkey")]).cache()


def _sorted(df):
    return sorted(tuple(r) for r in df.select("key", "mean", "sum", "count").collect())


@pytest.mark.parametrize("splits", [1, 2, 7, 16])
def test_partial_merge_equals_direct(pairs, splits):
    direct = _sorted(agg.mean_by_key(pairs))
    parts = agg.partial_aggregates(pairs, F.col("l_orderkey") % splits)
    merged, malformed = agg.merge_partials(parts)
    assert _sorted(merged) == direct
    assert malformed.first()["malformed_partials"] == 0


def test_merging_merged_partials_is_stable(pairs):
    parts = agg.partial_aggregates(pairs, F.col("l_orderkey") % 5)
    once = parts.groupBy("key").agg(F.sum("sum").alias("sum"), F.sum("count").alias("count"))
    merged, _ = agg.merge_partials(once)
    assert _sorted(merged) == _sorted(agg.mean_by_key(pairs))


def test_missing_count_counts_one(spark):
    parts = spark.createDataFrame([("A", 10.0, None), ("A", 5.0, 2), ("B", None, 3)],
                                  "key string, sum double, count bigint")
    merged, malformed = agg.merge_partials(parts)
    assert [tuple(r) for r in merged.select("key", "sum", "count").collect()] == [("A", 15.0, 3)]
    assert malformed.first()["malformed_partials"] == 1


@pytest.mark.parametrize("buckets", [2, 3, 11])
def test_salted_equals_direct(pairs, buckets):
    assert _sorted(agg.salted_mean(pairs, buckets)) == _sorted(agg.mean_by_key(pairs))


def test_salt_rule():
    assert agg.salt_buckets(6738, 20000, 20) == 7
    assert agg.salt_buckets(10, 100, 10) == 2


@settings(max_examples=25, deadline=None)
@given(st.decimals(min_value=-10**9, max_value=10**9, places=2, allow_nan=False, allow_infinity=False))
def test_local_render_parse_round_trip(spark, x):
    v = float(x)
    r = spark.range(1).select(F.lit(v).alias("v")).select(
        parse_local_number(render_local_number(F.col("v"))).alias("p"),
        canonical_number(F.col("v")).alias("c")).first()
    assert r["p"] == pytest.approx(v, abs=1e-9)
    assert float(r["c"]) == pytest.approx(v, abs=1e-9)


def test_parse_rejects_junk(spark):
    df = spark.createDataFrame([("1.234,56",), ("n/d",), ("",), ("1_000",), ("1d",), ("nan",), ("9e999",),
                                ("$ 12,5",), ("-3,25 %",)], "t string")
    got = [r["p"] for r in df.select(parse_local_number("t").alias("p")).collect()]
    assert got == [1234.56, None, None, None, None, None, None, 12.5, -3.25]


def test_raw_load_is_idempotent_and_lots_advance(spark):
    root = scratch_path(spark, "test", "raw")
    e = load(spark, SF, "events", "event_id", "ts", "user_id", "event_type", "value")
    first = lake_load.load_raw(e, root, "events", F.to_date("ts"))
    assert {r["action"] for r in first.collect()} == {"load"}
    again = lake_load.load_raw(e, root, "events", F.to_date("ts"))
    assert {r["action"] for r in again.collect()} == {"skip"}
    back = lake_load.read_raw(spark, root, "events", e.schema)
    assert back.count() == e.count()
    changed = e.where(F.col("event_id") % 2 == 0)
    third = lake_load.load_raw(changed, root, "events", F.to_date("ts"))
    assert {(r["action"], r["lot"]) for r in third.collect()} == {("load", 2)}
    with pytest.raises(RuntimeError):
        lake_load.load_raw(changed.where(F.col("event_id") % 4 == 0), root, "events", F.to_date("ts"),
                           new_lot=False)


def test_lot_rules(spark):
    keys = ["day"]
    stored = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 4, "c"), (2, 1, "x")],
                                   "day int, lot int, sha string")
    incoming = spark.createDataFrame([(1, "b"), (1, "c"), (2, "y"), (3, "z")], "day int, sha string")
    got = {(r["day"], r["sha"]): (r["action"], r["lot"])
           for r in lake_load.resolve_lots(stored, incoming, keys).collect()}
    assert got[(1, "b")] == ("skip", 2)
    assert got[(1, "c")] == ("load", 3)      # lot 4 sits after the gap: not seen
    assert got[(2, "y")] == ("load", 2)
    assert got[(3, "z")] == ("load", 1)
    strict = {(r["day"], r["sha"]): (r["action"], r["lot"])
              for r in lake_load.resolve_lots(stored, incoming, keys, new_lot=False).collect()}
    assert strict[(1, "b")] == ("conflict", 1)
    assert strict[(3, "z")] == ("load", 1)


def test_lot_limit(spark):
    stored = spark.createDataFrame([(1, i, f"s{i}") for i in range(1, 100)], "day int, lot int, sha string")
    incoming = spark.createDataFrame([(1, "new")], "day int, sha string")
    r = lake_load.resolve_lots(stored, incoming, ["day"]).first()
    assert r["action"] == "fail"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.floats(min_value=-1e14, max_value=1e14, allow_nan=False, allow_infinity=False),
                min_size=1, max_size=20))
def test_arithmetic_width_equals_text_width(spark, xs):
    from tributary.operators.profile import canonical_sql, canonical_width_sql
    df = spark.createDataFrame([(x,) for x in xs + [0.5, -0.5, 1e-7, -2.0000001, 123.000001, 9.5e12]], "v double")
    rows = df.select(F.expr(canonical_width_sql("v")).alias("a"),
                     F.expr(f"octet_length({canonical_sql('v')})").alias("b"), "v").collect()
    assert all(r["a"] == r["b"] for r in rows), [tuple(r) for r in rows if r["a"] != r["b"]]


def test_rerun_after_unregistered_write_replaces_orphan(spark):
    """A lot whose data was written but never registered (driver lost between
    the two steps) is replaced on rerun, not duplicated."""
    root = scratch_path(spark, "test", "raw")
    e = load(spark, SF, "events", "event_id", "ts", "user_id", "event_type", "value").where(
        F.to_date("ts") == F.lit("2024-01-03").cast("date"))
    orphan = e.limit(5).select("*", F.lit("2024").alias("anio"), F.lit("01").alias("mes"),
                               F.lit("03").alias("dia"), F.lit("01").alias("lote"))
    orphan.write.partitionBy("anio", "mes", "dia", "lote").parquet(f"{root}/events")
    lake_load.load_raw(e, root, "events", F.to_date("ts"))
    back = lake_load.read_raw(spark, root, "events", e.schema)
    assert back.count() == e.count()


@pytest.mark.parametrize("table", ["orders", "documents", "lineitem"])
def test_single_pass_profile_equals_separate_operators(spark, table):
    from tributary.operators import profile as prof
    df = load(spark, SF, table)
    one = prof.profile_single_pass(df, table)
    separate = {"source_profile": prof.source_profile(df, table), "completeness": prof.completeness(df),
                "text_width_profile": prof.text_width_profile(df, table),
                "expansion_ratio": prof.expansion_ratio(df, table),
                "text_lengths": prof.text_lengths(df, table), "null_shares": prof.null_shares(df)}
    for k, d in separate.items():
        assert sorted(map(tuple, one[k].collect())) == sorted(map(tuple, d.collect())), k


def test_row_duplicates_null_semantics_both_paths(spark):
    from tributary.operators import profile as prof
    narrow = spark.createDataFrame([(1, 2.0), (1, 2.0), (None, None), (None, None), (2, None)], "a int, b double")
    assert tuple(prof.row_duplicates(narrow).first()) == (5, 2, 0.4)
    text = spark.createDataFrame([("x", None), ("x", None), (None, "x"), ("", None)], "a string, b string")
    assert tuple(prof.row_duplicates(text).first()) == (4, 1, 0.25)


def test_a_negative_zero_is_a_zero_whatever_the_row_holds(spark):
    from tributary.operators import profile as prof
    rows = spark.createDataFrame([(0.0, "x"), (-0.0, "x")], "a double, b string")
    assert prof.row_duplicates(rows).first()["duplicate_rows"] == 1
    assert prof.row_duplicates(rows.select("a")).first()["duplicate_rows"] == 1
