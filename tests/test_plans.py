"""Plan-shape tests: the physical plans Spark should pick."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tributary.lake import load as lake_load
from tributary.operators.joins import broadcast_if_small
from tributary.plans.catalog import QUERIES as OWN
from tributary.session import scratch_path
from tributary.sources import delimited
from tributary.sources.objects import object_inventory
from tributary.sources.tables import load

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_mean_by_key_has_partial_aggregate(spark):
    p = plan(E.queries()["mean_by_key"](spark, SF))
    assert "partial_sum" in p and "Exchange" in p


@pytest.mark.parametrize("name", sorted(OWN))
def test_no_python_udf_anywhere(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_reprocess_prunes_partitions(spark):
    root = scratch_path(spark, "test", "raw")
    e = load(spark, SF, "events", "event_id", "ts", "user_id", "event_type", "value")
    lake_load.load_raw(e, root, "events", F.to_date("ts"))
    df = lake_load.ingested_since(lake_load.read_raw(spark, root, "events", e.schema), "2024-01-20")
    p = plan(df)
    assert "PartitionFilters: [" in p and "concat(anio" in p
    assert df.count() == e.where(F.col("ts") >= "2024-01-20").count()


def test_inventory_does_not_read_content(spark):
    p = plan(object_inventory(spark, SF, "*.parquet"))
    assert "content" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_scan_prunes_columns(spark):
    p = plan(E.queries()["curated_value_by_region"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in p


def test_page_header_guard(spark):
    root = scratch_path(spark, "test", "pages")
    spark.createDataFrame([(1, "a")], "id long, name string").coalesce(1).write.option("header", True).csv(root + "/p1")
    spark.createDataFrame([(2, "b")], "id long, other string").coalesce(1).write.option("header", True).csv(root + "/p2")
    schema = "id long, name string"
    from pyspark.sql.types import _parse_datatype_string
    ok = delimited.read_pages(spark, [root + "/p1"], _parse_datatype_string(schema))
    assert ok.count() == 1
    with pytest.raises(Exception):
        delimited.read_pages(spark, [root + "/p1", root + "/p2"], _parse_datatype_string(schema)).collect()


def test_multiline_csv_round_trip(spark):
    df = E.queries()["src_delimited"](spark, SF)
    src = load(spark, SF, "documents", "doc_id", "text", "lang", "source")
    assert df.exceptAll(src).count() == 0 and src.exceptAll(df).count() == 0


def test_null_tokens_and_rows_per_file(spark):
    df = spark.createDataFrame([("NA", "x"), ("n/a", "NULL"), ("ok", None)], "a string, b string")
    got = [tuple(r) for r in delimited.apply_null_tokens(df).collect()]
    assert got == [(None, "x"), (None, None), ("ok", None)]
    root = scratch_path(spark, "test", "files")
    spark.range(10).repartition(2).write.parquet(root)
    counts = delimited.rows_per_file(spark.read.parquet(root)).collect()
    assert sum(r["rows"] for r in counts) == 10 and len(counts) == 2


def test_broadcast_only_when_small(spark):
    orders = load(spark, SF, "orders", "o_orderkey")
    region = load(spark, SF, "region")
    large = load(spark, SF, "lineitem")
    hinted = lambda df, most: "Broadcast" in plan(orders.hint("merge").join(
        broadcast_if_small(df, most), orders["o_orderkey"] == df[df.columns[0]]))
    assert hinted(region, 1 << 20)
    assert not hinted(large, 1 << 10)


def test_previous_version_keeps_two_rows_per_key_before_the_shuffle(spark):
    p = plan(E.queries()["previous_version"](spark, SF))
    assert p.count("WindowGroupLimit") == 2 and p.index("Final") < p.index("Partial")
