"""Registered queries: one per operator of SURVEY §2.

Each entry takes (spark, sf_dir) and returns a lazily evaluated DataFrame over
the driver tables (or data Spark derives from them). The matching DuckDB SQL
lives in ``tributary.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.contract import KeyValueContract
from tributary.functions.hashing import java_hash
from tributary.functions.numeric import round_half_up
from tributary.functions.text import (canonical_number, normalize_key, parse_local_number,
                                      render_local_number)
from tributary.lake.layers import curated_value_by_region
from tributary.operators import aggregate as agg
from tributary.plans import fixtures as fx
from tributary.sources.tables import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


TEXT_CONTRACT = KeyValueContract(key_col="raw_key", value_col="raw_value")


# --- S8 flagship -------------------------------------------------------------

@query("curated_value_by_region")
def q_curated_value_by_region(spark, sf):
    return curated_value_by_region(
        load(spark, sf, "lineitem", "l_orderkey", "l_extendedprice", "l_discount"),
        load(spark, sf, "orders"), load(spark, sf, "customer"),
        load(spark, sf, "nation"), load(spark, sf, "region"))


# --- P1, P2, P6, P7, P8 scalar functions -------------------------------------

@query("normalize_key")
def q_normalize_key(spark, sf):
    o = fx.orders_text(spark, sf)
    return o.select("o_orderkey", "raw_key", normalize_key("raw_key").alias("norm_key"))


@query("parse_local_number")
def q_parse_local_number(spark, sf):
    l = fx.lineitem_text(spark, sf)
    return l.select("l_orderkey", "l_linenumber", "raw_value",
                    parse_local_number("raw_value").alias("value"))


@query("render_local_number")
def q_render_local_number(spark, sf):
    o = load(spark, sf, "orders", "o_orderkey", "o_totalprice")
    return o.select("o_orderkey", "o_totalprice",
                    render_local_number("o_totalprice").alias("local_text"))


@query("canonical_number")
def q_canonical_number(spark, sf):
    l = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    v = round_half_up(F.col("l_extendedprice") / F.col("l_quantity"), 6)
    return l.select("l_orderkey", "l_linenumber", v.alias("value"),
                    canonical_number(v).alias("text"),
                    F.octet_length(canonical_number(v)).cast("bigint").alias("width"))


@query("java_hash")
def q_java_hash(spark, sf):
    c = load(spark, sf, "customer", "c_mktsegment").select(
        F.lit("c_mktsegment").alias("key_source"), F.col("c_mktsegment").alias("key"))
    p = load(spark, sf, "part", "p_name").select(
        F.lit("p_name").alias("key_source"), F.col("p_name").alias("key"))
    n = load(spark, sf, "nation", "n_name").select(
        F.lit("n_name").alias("key_source"), F.col("n_name").alias("key"))
    keys = c.unionByName(p).unionByName(n).distinct()
    return keys.select("key_source", "key", java_hash("key").alias("java_hash"))


# --- A1-A3, P3 keyed aggregation ---------------------------------------------

@query("mean_by_key")
def q_mean_by_key(spark, sf):
    pairs = agg.extract_pairs(fx.orders_text(spark, sf), TEXT_CONTRACT)
    return agg.mean_by_key(pairs)


@query("discard_report")
def q_discard_report(spark, sf):
    pairs = agg.extract_pairs(fx.lineitem_text(spark, sf), TEXT_CONTRACT)
    return agg.discard_report(pairs)


@query("partial_merge")
def q_partial_merge(spark, sf):
    l = fx.lineitem_text(spark, sf)
    pairs = agg.extract_pairs(l, TEXT_CONTRACT, keep=[(F.col("l_orderkey") % 16).alias("split")])
    partials = agg.counted_partials(pairs, "split")
    # a partial that lost its sum on the way: the first split's of every key
    lost = partials.withColumn("sum", F.when(F.col("split") != 0, F.col("sum")))
    return agg.merge_counted(lost)


@query("salted_mean")
def q_salted_mean(spark, sf):
    pairs = agg.extract_pairs(fx.lineitem_text(spark, sf), TEXT_CONTRACT)
    return agg.salted_mean(pairs)


# --- A4-A9, T1, J5 skew and shuffle model ------------------------------------

from tributary.operators import skew  # noqa: E402

SHUFFLE_MAPPERS = 6
REDUCERS = 3


def _dist(spark, sf, table, key, value):
    t = load(spark, sf, table, key, value)
    return skew.key_distribution(skew.pairs_from(t, F.col(key), F.col(value)))


@query("key_distribution")
def q_key_distribution(spark, sf):
    d = _dist(spark, sf, "part", "p_brand", "p_retailprice")
    from tributary.functions.numeric import round_exact
    return d.select("key", "count", round_exact(F.col("sum_exact"), 2).alias("sum"), "key_bytes",
                    "java_hash")


@query("skew_indicators")
def q_skew_indicators(spark, sf):
    return skew.skew_indicators(_dist(spark, sf, "events", "user_id", "value"))


@query("pair_size_profile")
def q_pair_size_profile(spark, sf):
    p = skew.pair_profile(agg.extract_pairs(fx.lineitem_text(spark, sf), TEXT_CONTRACT))
    return p.select("read", "valid", "discarded", "distinct_keys",
                    round_half_up(F.col("mean_key_bytes"), 6).alias("mean_key_bytes"),
                    round_half_up(F.col("mean_value_bytes"), 6).alias("mean_value_bytes"))


@query("shuffle_estimate")
def q_shuffle_estimate(spark, sf):
    li = load(spark, sf, "lineitem", "l_suppkey", "l_extendedprice")
    pairs = skew.pairs_from(li, F.col("l_suppkey"), F.col("l_extendedprice"))
    return skew.shuffle_estimate(skew.key_distribution(pairs), skew.pair_profile(pairs),
                                 SHUFFLE_MAPPERS, overhead=2)


@query("partition_load")
def q_partition_load(spark, sf):
    return skew.partition_load(_dist(spark, sf, "orders", "o_custkey", "o_totalprice"), REDUCERS)


@query("partition_load_spark")
def q_partition_load_spark(spark, sf):
    return skew.partition_load(_dist(spark, sf, "orders", "o_custkey", "o_totalprice"), REDUCERS,
                               partitioner="spark")


@query("salting_tradeoff")
def q_salting_tradeoff(spark, sf):
    return skew.salting_tradeoff(_dist(spark, sf, "lineitem", "l_returnflag", "l_extendedprice"),
                                 SHUFFLE_MAPPERS, REDUCERS)


@query("top_keys")
def q_top_keys(spark, sf):
    return skew.top_keys(_dist(spark, sf, "lineitem", "l_suppkey", "l_extendedprice"),
                         SHUFFLE_MAPPERS)


@query("estimate_vs_measured")
def q_estimate_vs_measured(spark, sf):
    """All of lineitem by supplier; a map task reads the lines of every SHUFFLE_MAPPERS-th order."""
    li = load(spark, sf, "lineitem", "l_orderkey", "l_suppkey", "l_extendedprice")
    pairs = li.select("l_orderkey", F.col("l_suppkey").cast("string").alias("key"),
                      F.col("l_extendedprice").alias("value"))
    measured = skew.measured_partials(pairs, F.col("l_orderkey") % SHUFFLE_MAPPERS)
    return skew.estimate_vs_measured(measured, SHUFFLE_MAPPERS)


# --- A10-A18, A20, A23, T2, T3, W6, J6, J7 profiling ---------------------------

from functools import reduce  # noqa: E402

from tributary.operators import profile as prof  # noqa: E402
from tributary.plans.schemas import TEXT_WIDTH_TABLES, WIDTH_TABLES  # noqa: E402
from tributary.sources.tables import TABLES  # noqa: E402


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


@query("source_profile")
def q_source_profile(spark, sf):
    return _union([prof.source_profile(load(spark, sf, t), t) for t in TABLES])


def completeness_input(spark, sf):
    """documents with injected gaps, left-joined to labels."""
    d = load(spark, sf, "documents")
    d = d.select("doc_id",
                 F.when(F.col("doc_id") % 97 != 0, F.col("text")).alias("text"),
                 F.when(F.col("doc_id") % 7 != 0, F.col("lang")).alias("lang"),
                 F.when(F.col("doc_id") % 11 != 0, F.col("source")).alias("source"),
                 "n_chars")
    return d.join(load(spark, sf, "labels"), "doc_id", "left")


@query("completeness")
def q_completeness(spark, sf):
    return prof.completeness(completeness_input(spark, sf))


@query("row_duplicates")
def q_row_duplicates(spark, sf):
    return prof.row_duplicates(load(spark, sf, "documents", "text", "lang", "source"))


@query("key_duplicates")
def q_key_duplicates(spark, sf):
    return prof.key_duplicates(load(spark, sf, "orders", "o_custkey"), "o_custkey")


@query("arrival_profile")
def q_arrival_profile(spark, sf):
    return prof.arrival_profile(load(spark, sf, "events", "ts", "event_type"), "ts", "event_type",
                                declared_frequency="continuous")


@query("text_width_profile")
def q_text_width_profile(spark, sf):
    return _union([prof.text_width_profile(load(spark, sf, t), t) for t in TEXT_WIDTH_TABLES])


@query("top_text_columns")
def q_top_text_columns(spark, sf):
    return prof.top_text_columns(_union([prof.text_lengths(load(spark, sf, t), t)
                                         for t in TEXT_WIDTH_TABLES]))


@query("expansion_ratio")
def q_expansion_ratio(spark, sf):
    return _union([prof.expansion_ratio(load(spark, sf, t), t) for t in WIDTH_TABLES])


def orders_with_gaps(spark, sf):
    o = load(spark, sf, "orders")
    return o.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 53 != 0, F.col("o_orderdate")))


@query("yearly_series")
def q_yearly_series(spark, sf):
    return prof.yearly_series(orders_with_gaps(spark, sf), "o_orderdate", sample_rows=1000)


GROWTH_CENTRAL = (1997, 2000)
GROWTH_UPPER = (1995, 2000)


@query("growth_rate")
def q_growth_rate(spark, sf):
    o = load(spark, sf, "orders", "o_orderdate", "o_orderpriority")
    return prof.growth_rate(o, "o_orderdate", "o_orderpriority", GROWTH_CENTRAL, GROWTH_UPPER)


@query("fetch_completeness")
def q_fetch_completeness(spark, sf):
    o = load(spark, sf, "orders", "o_orderkey", "o_orderdate")
    per_order = (load(spark, sf, "lineitem", "l_orderkey", "l_returnflag").groupBy("l_orderkey")
                 .agg(F.count(F.lit(1)).alias("_lines"),
                      F.sum(F.octet_length("l_returnflag")).cast("bigint").alias("_bytes")))
    year = F.year("o_orderdate").alias("year")
    requested = o.groupBy(year).agg((F.count(F.lit(1)) * 4).alias("requested_rows"))
    fetched = (per_order.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
               .groupBy(year).agg(F.sum("_lines").alias("fetched_rows"),
                                  F.sum("_bytes").alias("fetched_bytes")))
    # seals of every third year are of another file
    fetched = fetched.withColumn("sealed_bytes", F.col("fetched_bytes") + (F.col("year") % 3 == 0).cast("int"))
    return prof.fetch_completeness(requested, fetched, "year")


def capacity_measures(spark, sf):
    """Capacity sources: groups of orders by priority, measured with the
    width model."""
    return prof.source_measures(load(spark, sf, "orders"), F.col("o_orderpriority"))


@query("measurement_gate")
def q_measurement_gate(spark, sf):
    return prof.measurement_gate(capacity_measures(spark, sf), expected_sources=5)


@query("rank_disagreement")
def q_rank_disagreement(spark, sf):
    return prof.rank_disagreement(capacity_measures(spark, sf))


@query("latest_run")
def q_latest_run(spark, sf):
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return prof.latest_run(o, F.col("o_custkey") % 5, "o_orderdate", "o_orderkey",
                           F.col("o_orderstatus") == "F")


# declared dictionary of lineitem: one column is not delivered (l_shipdate
# missing) and two declared columns never arrive
DECLARED_LINEITEM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                     "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                     "l_comment", "l_shipmode"]


@query("schema_drift")
def q_schema_drift(spark, sf):
    return prof.schema_drift(load(spark, sf, "lineitem"), DECLARED_LINEITEM)


@query("common_across_runs")
def q_common_across_runs(spark, sf):
    o = load(spark, sf, "orders", "o_orderpriority", "o_orderdate")
    return prof.common_across_runs(o, F.col("o_orderpriority"), F.year("o_orderdate"))


# --- C1-C15 capacity -----------------------------------------------------------

from tributary.operators import capacity as cap  # noqa: E402


def capacity_growth(spark, sf):
    """Measured growth per capacity source: CAGR of yearly order rows over
    the central and the upper-bound span."""
    o = load(spark, sf, "orders", "o_orderdate", "o_orderpriority")
    y = F.year("o_orderdate")
    years = sorted({*GROWTH_CENTRAL, *GROWTH_UPPER})
    g = o.groupBy(F.col("o_orderpriority").alias("source")).agg(
        *[F.count(F.when(y == yr, 1)).alias(f"y{yr}") for yr in years])
    c0, c1 = GROWTH_CENTRAL
    u0, u1 = GROWTH_UPPER
    return g.select("source", prof.cagr(F.col(f"y{c0}"), F.col(f"y{c1}"), c1 - c0).alias("g"),
                    prof.cagr(F.col(f"y{u0}"), F.col(f"y{u1}"), u1 - u0).alias("g_upper"))


def capacity_inputs(spark, sf):
    return cap.capacity_inputs(capacity_measures(spark, sf), capacity_growth(spark, sf))


@query("project_full")
def q_project_full(spark, sf):
    o = load(spark, sf, "orders")
    sample = prof.source_measures(o.where(F.col("o_orderkey") % 10 == 0), F.col("o_orderpriority"))
    full = o.groupBy(F.col("o_orderpriority").alias("source")).agg(F.count(F.lit(1)).alias("full_rows"))
    return cap.project_full(sample, full)


@query("saturation_horizon")
def q_saturation_horizon(spark, sf):
    return cap.saturation_horizon(capacity_inputs(spark, sf))


@query("sensitivity")
def q_sensitivity(spark, sf):
    return cap.sensitivity(capacity_inputs(spark, sf))


@query("sign_stability")
def q_sign_stability(spark, sf):
    return cap.sign_stability(cap.sensitivity(capacity_inputs(spark, sf)))


@query("volume_by_month")
def q_volume_by_month(spark, sf):
    return cap.volume_by_month(capacity_inputs(spark, sf))


@query("replication_table")
def q_replication_table(spark, sf):
    return cap.replication_table(capacity_inputs(spark, sf))


@query("block_count")
def q_block_count(spark, sf):
    return cap.block_count(capacity_inputs(spark, sf))


@query("partitioning_overhead")
def q_partitioning_overhead(spark, sf):
    return cap.partitioning_overhead(capacity_inputs(spark, sf))


@query("compression_scenarios")
def q_compression_scenarios(spark, sf):
    return cap.compression_scenarios(capacity_inputs(spark, sf))


@query("growth_sensitivity")
def q_growth_sensitivity(spark, sf):
    return cap.growth_sensitivity(capacity_inputs(spark, sf))


@query("replica_breakeven")
def q_replica_breakeven(spark, sf):
    return cap.replica_breakeven(capacity_inputs(spark, sf))


@query("saving_levers")
def q_saving_levers(spark, sf):
    return cap.saving_levers(capacity_inputs(spark, sf))


def event_readings(spark, sf):
    """events as meter readings, one source per event type: rows, width-model
    bytes, k, distinct users (the metered entities) and span in days."""
    e = load(spark, sf, "events")
    m = prof.source_measures(e, F.col("event_type"))
    s = e.groupBy(F.col("event_type").alias("source")).agg(
        F.count_distinct("user_id").alias("entities"),
        (F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")).cast("double") / 8.64e10)
        .alias("span_days"))
    return m.join(s, "source")


@query("annualized_need")
def q_annualized_need(spark, sf):
    return cap.annualized_need(event_readings(spark, sf))


@query("capacity_choice")
def q_capacity_choice(spark, sf):
    r = event_readings(spark, sf)
    need = (F.col("stored_bytes") / F.col("rows") * (F.col("rows") / F.col("span_days") * 365)
            / F.lit(float(1024 ** 3)) * F.col("k"))
    return cap.capacity_choice(r.select("source", "entities", need.alias("need_gib")))


# --- lake: P9-P11, S3-S10, W1-W5, J1-J3, A19, A21, A22, U1 ----------------------

from tributary.lake import audit, load as lake_load, versions  # noqa: E402
from tributary.lake import layout, manifests, store  # noqa: E402
from tributary.session import scratch_path  # noqa: E402
from tributary.sources import objects as objsrc  # noqa: E402


@query("lake_path")
def q_lake_path(spark, sf):
    o = fx.document_objects(spark, sf)
    lot = (F.col("doc_id") % 3 + 1).cast("int")
    key = layout.raw_key(F.col("source"), F.col("ingest_date"), "txt", lot)
    return o.select("doc_id", F.lit("lake-raw").alias("bucket"), key.alias("object_key"),
                    layout.manifest_key(key).alias("manifest_key"))


@query("path_check")
def q_path_check(spark, sf):
    return layout.path_check(fx.broken_keys(spark, sf), fx.CONFIGURED_SOURCES)


@query("classify_object")
def q_classify_object(spark, sf):
    k = fx.mixed_keys(spark, sf)
    return k.select("doc_id", "object_key", layout.classify("object_key").alias("class"))


@query("object_inventory")
def q_object_inventory(spark, sf):
    """documents written to a lake as raw objects, and the listing of that lake."""
    root = scratch_path(spark, "lake", "objects")
    store.refuse_conflicts(store.put_objects(fx.lake_objects(spark, sf), root))
    return objsrc.object_inventory(spark, root, "*.txt").drop("modified")


@query("largest_object")
def q_largest_object(spark, sf):
    return objsrc.largest_object(fx.largest_object_candidates(spark, sf), min_bytes=8 * 1024)


EVENT_DATA_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _events_raw_lake(spark, sf):
    """Load events into a fresh raw layer (one ingestion day per event day)
    and return (root, read-back DataFrame)."""
    root = scratch_path(spark, "lake", "raw")
    e = load(spark, sf, "events", *EVENT_DATA_COLS)
    lake_load.load_raw(e, root, "events", F.to_date("ts"))
    return root, lake_load.read_raw(spark, root, "events", e.schema)


@query("raw_write_roundtrip")
def q_raw_write_roundtrip(spark, sf):
    _, back = _events_raw_lake(spark, sf)
    return back.select("event_id", "user_id", "event_type", "anio", "mes", "dia", "lote")


@query("reprocess_since")
def q_reprocess_since(spark, sf):
    _, back = _events_raw_lake(spark, sf)
    return lake_load.ingested_since(back, "2024-01-20").select("event_id", "anio", "mes", "dia")


@query("manifest")
def q_manifest(spark, sf):
    """A manifest document written beside every raw object of documents, and all of them read back
    from their files."""
    root = scratch_path(spark, "lake", "manifests")
    o = fx.lake_objects(spark, sf)
    manifests.put_manifests(manifests.manifest_documents(
        o, {"dataset_id": F.col("doc_id")}, urls=F.array(F.concat(F.lit("doc:"), F.col("doc_id"))),
        transformations=("text taken from its record",), fmt="txt"), root)
    back = manifests.read_manifests(spark, root)
    return back.select(
        F.col("clave_datos").alias("object_key"), "manifest_key", F.col("capa").alias("layer"),
        F.col("inmutable").alias("immutable"), F.col("fuente.slug").alias("source"),
        F.col("fuente.dataset_id").alias("dataset_id"), F.col("ingesta.instante_utc").alias("instant"),
        F.col("ingesta.fecha_particion").alias("partition"),
        F.array_join("ingesta.urls_descarga", ",").alias("urls"),
        F.col("contenido.formato").alias("format"), F.col("contenido.bytes").alias("bytes"),
        F.col("contenido.sha256").alias("sha256"), F.col("contenido.filas_datos").alias("data_lines"),
        F.col("contenido.columnas_n").alias("columns_n"),
        F.array_join("contenido.columnas", ",").alias("header"),
        F.array_join("linaje.transformaciones", ",").alias("lineage"))


@query("lake_audit")
def q_lake_audit(spark, sf):
    """documents written to a lake with their manifests, some objects altered, lost, copied to
    another key or left without a manifest, and the lake audited from what is stored."""
    root = scratch_path(spark, "lake", "audited")
    o = fx.lake_objects(spark, sf)
    manifests.put_manifests(manifests.manifest_documents(
        o.where(F.col("doc_id") % 89 != 0), fmt="txt"), root)
    store.refuse_conflicts(store.put_objects(fx.damaged_objects(o), root))
    return audit.audit_stored(store.scan_objects(spark, root), manifests.read_manifests(spark, root),
                              fx.CONFIGURED_SOURCES)


@query("lot_resolution")
def q_lot_resolution(spark, sf):
    """Every document as an object of its source and day: even ones are stored in lots, odd ones
    arrive. Fixture rule for gaps: every sixth day's second lot was never stored (all other rows
    of the table take part)."""
    o = fx.lake_objects(spark, sf).withColumn("day", (F.col("doc_id") % 28 + 1).cast("int"))
    keys = ["source", "day"]
    from tributary.operators.ordering import rank_within
    even = o.where(F.col("doc_id") % 2 == 0).select(*keys, "doc_id", F.sha2("content", 256).alias("sha"))
    stored = (rank_within(even, keys, [F.col("doc_id")], "lot")
              .where(~((F.col("day") % 6 == 0) & (F.col("lot") == 2)))
              .select(*keys, "lot", "doc_id", "sha"))
    # every odd document arrives; the texts are hashed first, so only hashes are moved
    odd = (o.where(F.col("doc_id") % 2 == 1)
           .select(*keys, "doc_id", F.sha2("content", 256).alias("sha")))
    lot1 = stored.where(F.col("lot") == 1).select(*keys, F.col("sha").alias("_sha1"))
    incoming = odd.join(lot1, keys, "left").select(
        *keys, F.when((F.col("doc_id") % 3 == 0) & F.col("_sha1").isNotNull(), F.col("_sha1"))
        .otherwise(F.col("sha")).alias("sha")).distinct()
    d = lake_load.resolve_lots(stored.select(*keys, "lot", "sha"), incoming, keys, new_lot=True)
    day = F.make_date(F.lit(2024), F.lit(1), F.col("day"))
    return d.select(*keys, F.col("sha").alias("incoming_sha256"), "action", "lot",
                    F.when(F.col("action") != "fail", layout.raw_key(F.col("source"), day, "txt", F.col("lot")))
                    .alias("object_key"))


@query("current_versions")
def q_current_versions(spark, sf):
    return versions.current_versions(fx.version_log(spark, sf))


@query("restored_versions")
def q_restored_versions(spark, sf):
    return versions.restored_versions(fx.version_log(spark, sf))


@query("previous_version")
def q_previous_version(spark, sf):
    return versions.previous_version(fx.version_log(spark, sf))


@query("immutability_audit")
def q_immutability_audit(spark, sf):
    return versions.immutability_audit(fx.version_log(spark, sf))


@query("timeline")
def q_timeline(spark, sf):
    return versions.timeline(fx.version_log(spark, sf))


@query("layer_summary")
def q_layer_summary(spark, sf):
    return versions.layer_summary(fx.version_log(spark, sf))


@query("event_log_union")
def q_event_log_union(spark, sf):
    log = fx.version_log(spark, sf)
    content = F.concat_ws(":", "object_key", F.col("version_id").cast("string"))
    writes = log.where(F.col("kind") == "write").drop("kind").withColumn("sha256", F.sha2(content, 256))
    deletes = log.where(F.col("kind") == "delete").drop("kind", "bytes")
    return versions.union_events(writes, deletes)


@query("read_version")
def q_read_version(spark, sf):
    """Every key's versions read by id: the one before its last write, and one it never had."""
    log = fx.version_log(spark, sf)
    before = versions.previous_version(log).select(*versions.KEY, F.col("previous_version_id").alias("version_id"))
    never = log.groupBy(*versions.KEY).agg((-F.max("version_id") - 1).alias("version_id"))
    last = log.groupBy(*versions.KEY).agg(F.max(F.struct("instant", "version_id")).alias("l")).select(
        *versions.KEY, F.col("l.version_id").alias("version_id"))
    return versions.read_versions(log, before.unionByName(never).unionByName(last))


@query("version_at")
def q_version_at(spark, sf):
    """What every object was half a day before each of its events."""
    log = fx.version_log(spark, sf)
    asked = log.select("layer", "object_key", F.col("version_id").alias("event"),
                       (F.col("instant") - F.expr("INTERVAL 12 HOURS")).alias("at"))
    return versions.versions_at(log, asked)


def _manifest_table(spark, sf):
    o = fx.lake_objects(spark, sf)
    return o.select("object_key", fx.declared_hashes(o).alias("declared_sha256"))


@query("missing_manifest")
def q_missing_manifest(spark, sf):
    o = fx.lake_objects(spark, sf)
    return audit.missing_manifest(o, fx.manifest_keys(spark, sf, o))


@query("declared_vs_actual")
def q_declared_vs_actual(spark, sf):
    return audit.declared_vs_actual(fx.declared_layers(spark, sf), fx.actual_buckets(spark, sf))


@query("integrity_check")
def q_integrity_check(spark, sf):
    return audit.integrity_check(fx.lake_objects(spark, sf), _manifest_table(spark, sf))


@query("duplicate_content")
def q_duplicate_content(spark, sf):
    return audit.duplicate_content(fx.lake_objects(spark, sf))


def lake_checks(spark, sf):
    """All nine lake checks as (check, object_key, status, reason) rows."""
    o = fx.lake_objects(spark, sf)
    dva = audit.declared_vs_actual(fx.declared_layers(spark, sf), fx.actual_buckets(spark, sf))
    c1 = dva.where("declared").select(
        F.lit(1).alias("check"), F.col("bucket").alias("object_key"),
        F.when(F.col("exists"), "PASS").otherwise("FAIL").alias("status"),
        F.when(~F.col("exists"), "bucket missing").alias("reason"))
    c2 = dva.where("declared AND exists").select(
        F.lit(2).alias("check"), F.col("bucket").alias("object_key"),
        F.when(F.col("versioned_declared") & ~F.col("versioned_actual"), "FAIL").otherwise("PASS").alias("status"),
        F.when(F.col("versioned_declared") & ~F.col("versioned_actual"), "versioning missing").alias("reason"))
    c3 = audit.as_check(layout.path_check(fx.broken_keys(spark, sf), fx.CONFIGURED_SOURCES), 3)
    c4 = audit.manifest_status(o, fx.manifest_keys(spark, sf, o))
    c5 = audit.as_check(audit.integrity_check(o, _manifest_table(spark, sf)), 5)
    c6 = dva.where("declared").select(  # a missing bucket has no readme either
        F.lit(6).alias("check"), F.col("bucket").alias("object_key"),
        F.when(F.col("has_readme"), "PASS").otherwise("FAIL").alias("status"),
        F.when(~F.col("has_readme"), "readme missing").alias("reason"))
    log = fx.version_log(spark, sf)
    c7 = versions.previous_version(log.where("layer = 'raw'")).select(
        F.lit(7).alias("check"), "object_key", F.lit("PASS").alias("status"), F.lit(None).cast("string").alias("reason"))
    c8 = audit.as_check(versions.immutability_audit(log), 8, reason=None)
    c9 = audit.duplicate_content(o).select(
        F.lit(9).alias("check"), F.col("first_key").alias("object_key"), F.lit("FAIL").alias("status"),
        F.lit("same content under another key").alias("reason"))
    return _union([c1, c2, c3, c4, c5, c6, c7, c8, c9])


@query("criteria_rollup")
def q_criteria_rollup(spark, sf):
    return audit.criteria_rollup(audit.check_summary(lake_checks(spark, sf)))


# --- S1, S2, S7, S11-S14, P4, P5 ---------------------------------------------------

from pyspark.sql import types as T  # noqa: E402

from tributary.functions.timeutil import coerce_ts  # noqa: E402
from tributary.lake import curated, lineage  # noqa: E402
from tributary.lake.layers import build_refined, write_partitioned  # noqa: E402
from tributary.sources import delimited, generators as gen, split_delimited  # noqa: E402

DOC_CSV_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                               T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])


@query("src_delimited")
def q_src_delimited(spark, sf):
    """documents written as quoted CSV (text with embedded newlines, commas
    and quotes) to the shared scratch folder and read back."""
    path = scratch_path(spark, "delimited", "documents")
    delimited.write_delimited(load(spark, sf, "documents", "doc_id", "text", "lang", "source"), path)
    return delimited.read_delimited(spark, path, DOC_CSV_SCHEMA)


@query("src_split_delimited")
def q_src_split_delimited(spark, sf):
    """The same files read by byte ranges that begin anywhere, also inside quoted fields."""
    path = scratch_path(spark, "delimited", "documents")
    delimited.write_delimited(load(spark, sf, "documents", "doc_id", "text", "lang", "source"), path)
    return split_delimited.read_split_delimited(spark, path, DOC_CSV_SCHEMA, range_bytes=1 << 20)


PAGE_SIZE = 1500


PAGE_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                            T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
                            T.StructField("page", T.LongType())])


@query("page_audit")
def q_page_audit(spark, sf):
    """events fetched as pages of PAGE_SIZE rows: written as one delimited
    page per directory, read back as one multi-path scan whose header is
    validated in every file, audited per page."""
    root = scratch_path(spark, "pages", "events")
    e = load(spark, sf, "events", "event_id", "user_id", "event_type", "value")
    e = e.withColumn("page", F.floor(F.col("event_id") / PAGE_SIZE).cast("bigint"))
    delimited.write_delimited(e, root, partition_cols=["page"])
    back = delimited.read_pages(spark, [root], PAGE_SCHEMA)
    pages = back.groupBy("page").agg(F.count(F.lit(1)).alias("rows"))
    return delimited.page_audit(pages, PAGE_SIZE)


@query("table_fingerprint")
def q_table_fingerprint(spark, sf):
    """A19 at table level: rows and an exact order-insensitive hash sum of
    every driver table (two loads of the same data agree)."""
    from tributary.functions.hashing import table_fingerprint_aggs
    return _union([load(spark, sf, t).agg(*table_fingerprint_aggs(load(spark, sf, t).columns))
                   .select(F.lit(t).alias("source"), "rows", "hash_sum") for t in TABLES])


def orders_raw_text(spark, sf):
    """orders as raw text records with every 10th order delivered twice and
    every 61st date unparseable."""
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    raw = o.select("o_orderkey", "o_custkey",
                   fx.dirty_local_number(F.col("o_totalprice"), k).alias("price_text"),
                   F.when(k % 61 == 0, F.lit("not a date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
                   .alias("date_text"),
                   fx.noisy_key(F.col("o_orderpriority"), k).alias("priority_raw"))
    return raw.unionByName(raw.where(k % 10 == 0))


REFINED_SCHEMA = ("o_custkey bigint, o_orderkey bigint, price double, business_date date, category string, "
                  "anio string, mes string")


@query("refined_build")
def q_refined_build(spark, sf):
    valid, _ = build_refined(orders_raw_text(spark, sf), "o_orderkey", "price_text", "date_text",
                             "priority_raw", keep=["o_custkey"])
    path = scratch_path(spark, "lake", "refined", "orders")
    write_partitioned(valid, path)
    return spark.read.schema(REFINED_SCHEMA).parquet(path)


QUARTER_LATE = "add_months(trunc(o_orderdate, 'quarter'), CASE WHEN o_custkey % 3 = 0 THEN 6 ELSE 3 END)"


@query("rebuild_since")
def q_rebuild_since(spark, sf):
    """orders ingested at quarters' ends (some a quarter late), refined by business month, and
    everything ingested since 1998-07-01 rebuilt by a corrected rule."""
    root, refined = scratch_path(spark, "lake", "raw"), scratch_path(spark, "lake", "refined", "orders")
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    lake_load.load_raw(o, root, "orders", F.expr(QUARTER_LATE))
    month = [F.date_format("o_orderdate", f).alias(c) for c, f in (("anio", "yyyy"), ("mes", "MM"))]

    def rule(factor):
        cents = F.round(F.col("o_totalprice").cast("decimal(18,2)") * factor, 2).cast("double")
        return lambda raw: raw.select("o_orderkey", cents.alias("price"), *month)
    lineage.index_lots(spark, root, "orders", o.schema, F.col("o_orderdate"))
    write_partitioned(rule(1)(lake_load.read_raw(spark, root, "orders", o.schema)), refined)
    lineage.rebuild_since(spark, root, "orders", o.schema, refined, rule(2), F.col("o_orderdate"), "1998-07-01")
    return spark.read.schema("o_orderkey bigint, price double, anio string, mes string").parquet(refined)


PRODUCT_SCHEMA = ("category string, revenue decimal(38,2), orders bigint, least double, greatest double, "
                  "anio string, mes string")


@query("curated_incremental")
def q_curated_incremental(spark, sf):
    """Order value by priority and business month as a curated product, updated after each of two
    deliveries of refined orders; the second one touches its own months only."""
    refined, root = scratch_path(spark, "lake", "refined", "orders"), scratch_path(spark, "lake", "curated")
    o = load(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice").select(
        "o_orderkey", F.col("o_orderpriority").alias("category"), F.col("o_totalprice").alias("price"),
        *[F.date_format("o_orderdate", f).alias(c) for c, f in (("anio", "yyyy"), ("mes", "MM"))])
    measures = {"revenue": ("sum", F.col("price").cast("decimal(18,2)")), "orders": ("count", F.lit(1)),
                "least": ("min", F.col("price")), "greatest": ("max", F.col("price"))}
    for delivery in (F.col("anio") < "1998", F.col("anio") >= "1998"):
        write_partitioned(o.where(delivery), refined)
        curated.update_product(spark, refined, o.schema, root, "sales", "value_by_priority", ["category"], measures)
    return curated.read_product(spark, root, "sales", "value_by_priority", PRODUCT_SCHEMA).withColumn(
        "revenue", F.col("revenue").cast("double"))


@query("refined_rejects")
def q_refined_rejects(spark, sf):
    _, rejected = build_refined(orders_raw_text(spark, sf), "o_orderkey", "price_text", "date_text",
                                "priority_raw", keep=["o_custkey"])
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("records"))


@query("bounded_sample")
def q_bounded_sample(spark, sf):
    o = load(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return o.orderBy("o_orderkey").limit(1000)


@query("coerce_ts")
def q_coerce_ts(spark, sf):
    e = load(spark, sf, "events", "event_id", "ts")
    i = F.col("event_id")
    text = (F.when(i % 53 == 0, F.lit("not a date"))
            .when(i % 59 == 0, F.lit("2024-02-30 10:00:00"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return e.select("event_id", text.alias("ts_text"), coerce_ts(text).alias("ts_parsed"))


@query("window_rate")
def q_window_rate(spark, sf):
    e = load(spark, sf, "events", "ts", "event_type")
    day = e.where((F.col("ts") >= F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))
                  & (F.col("ts") < F.lit("2024-01-06 00:00:00").cast("timestamp_ntz")))
    return day.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows")).select(
        "event_type", "rows", round_half_up(F.col("rows") / 24.0, 4).alias("rows_per_hour"))


@query("gen_skewed")
def q_gen_skewed(spark, sf):
    li = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber")
    return gen.skewed_records(li, fx.lineitem_row_id(li))


@query("gen_meter_readings")
def q_gen_meter_readings(spark, sf):
    return gen.meter_readings(load(spark, sf, "customer", "c_custkey"), F.col("c_custkey"))


@query("gen_wide_text")
def q_gen_wide_text(spark, sf):
    return gen.wide_text_rows(load(spark, sf, "orders", "o_orderkey"), F.col("o_orderkey"))


@query("gen_survey")
def q_gen_survey(spark, sf):
    li = load(spark, sf, "lineitem", "l_orderkey", "l_linenumber")
    return gen.survey_rows(li, fx.lineitem_row_id(li))


# --- streaming extension: raw -> refined ------------------------------------------

from tributary.streaming import raw_to_refined as stream_refine  # noqa: E402


@query("stream_refined_events")
def q_stream_refined_events(spark, sf):
    """events loaded into the raw layer, refined by a drained file stream
    (de-duplicated on event_id, merged by month), read back from the refined
    layer."""
    root, _ = _events_raw_lake(spark, sf)
    e = load(spark, sf, "events", *EVENT_DATA_COLS)
    refined = scratch_path(spark, "lake", "refined", "events")
    ckpt = scratch_path(spark, "stream", "refined-events")
    # the later half of the days is drained first: late days reach the refined layer too
    landing = scratch_path(spark, "lake", "landing", "events")
    raw = spark.read.schema(lake_load.raw_schema(e.schema)).parquet(f"{root}/events")
    for later in (True, False):
        (raw.where((F.col("dia") > "15") == F.lit(later)).write.mode("append")
         .partitionBy(*lake_load.PARTS, "lote").parquet(landing))
        q = stream_refine.start_raw_to_refined(spark, landing, e.schema, refined, ckpt, "ts", ["event_id"])
        stream_refine.run_until_drained(q)
    out = spark.read.schema("event_id bigint, ts timestamp, user_id bigint, event_type string, anio string, "
                            "mes string").parquet(refined)
    return out.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type",
                      "anio", "mes")
