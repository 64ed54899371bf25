"""Key-distribution, skew and shuffle-volume analysis.

Everything is computed from two small derived tables: the per-key
distribution (K rows, one partial+final aggregate over the data) and the
one-row pair profile. The model formulas then run as column arithmetic over
those K rows; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.hashing import hadoop_partition, java_hash, spark_partition
from tributary.functions.numeric import money, round_half_up, safe_ratio
from tributary.functions.text import canonical_number
from tributary.operators.joins import attach_one_row


def pairs_from(df: DataFrame, key: Column, value: Column) -> DataFrame:
    """(key text, value double) pairs from typed columns."""
    return df.select(key.cast("string").alias("key"), value.cast("double").alias("value"),
                     F.lit(None).cast("string").alias("reason"))


def key_distribution(pairs: DataFrame) -> DataFrame:
    """A4: count, exact sum, UTF-8 key bytes and Java hash per key."""
    d = (pairs.groupBy("key")
         .agg(F.count("value").alias("count"), F.sum(money(F.col("value"))).alias("_s"))
         .where(F.col("count") > 0))
    return d.select("key", "count", F.col("_s").cast("double").alias("sum"), F.col("_s").alias("sum_exact"),
                    F.octet_length("key").cast("bigint").alias("key_bytes"), java_hash("key").alias("java_hash"))


def pair_profile(pairs: DataFrame) -> DataFrame:
    """One row with read/valid/discarded counts and mean key / value
    bytes of the map output (value text + 2 for the count suffix)."""
    valid = F.col("value").isNotNull()
    return pairs.agg(
        F.count(F.lit(1)).alias("read"),
        F.count(F.when(valid, 1)).alias("valid"),
        F.count(F.when(~valid, 1)).alias("discarded"),
        F.count_distinct(F.when(valid, F.col("key"))).alias("distinct_keys"),
        F.sum(F.when(valid, F.octet_length("key"))).alias("_kb"),
        F.sum(F.when(valid, F.octet_length(canonical_number(F.col("value"))) + 2)).alias("_vb"),
    ).select("read", "valid", "discarded", "distinct_keys",
             (F.col("_kb") / F.col("valid")).alias("mean_key_bytes"),
             (F.col("_vb") / F.col("valid")).alias("mean_value_bytes"))


def _value_bytes(s: Column, c: Column) -> Column:
    """Bytes of the serialized combined value 'sum<TAB>count'."""
    return (F.octet_length(canonical_number(s)) + 1
            + F.length(F.bround(c, 0).cast("bigint").cast("string")))


def expected_pairs(n: Column, m: Column) -> Column:
    """Expected number of mappers that see a key occurring n times spread at
    random over m mappers: m(1 - (1 - 1/m)^n); 1 when m <= 1."""
    m = m.cast("double")
    return F.when(m <= 1, F.lit(1.0)).otherwise(m * (1 - F.pow(1 - 1 / m, n.cast("double"))))


def _expected_terms(dist: DataFrame, m: Column, overhead: int) -> DataFrame:
    e = expected_pairs(F.col("count"), m)
    return dist.select(
        e.alias("_e"),
        (e * (F.col("key_bytes") + _value_bytes(F.col("sum") / e,
                                                F.greatest(F.lit(1.0), F.col("count") / e))
              + overhead)).alias("_b"))


def shuffle_estimate(dist: DataFrame, profile: DataFrame, mappers: int,
                     overhead: int = 2) -> DataFrame:
    """Shuffle pairs and bytes without combiner, upper bound with
    combiner (every mapper sees every key) and expected with combiner."""
    m = F.lit(mappers)
    exp = _expected_terms(dist, m, overhead).agg(F.sum("_e").alias("exp_pairs"),
                                                 F.sum("_b").alias("exp_bytes"))
    upper = dist.agg(
        (F.count(F.lit(1)) * mappers).cast("double").alias("up_pairs"),
        F.avg(F.col("key_bytes") + _value_bytes(F.col("sum") / mappers,
                                                F.col("count") / mappers)).alias("_mean_up"))
    one = (attach_one_row(profile, exp, upper)
           .withColumn("nc_pairs", F.col("valid").cast("double"))
           .withColumn("nc_bytes", F.col("valid") * (F.col("mean_key_bytes")
                                                     + F.col("mean_value_bytes") + overhead))
           .withColumn("up_bytes", F.col("up_pairs") * (F.col("_mean_up") + overhead)))
    rows = F.explode(F.array(
        F.struct(F.lit("no_combiner").alias("scenario"), F.col("nc_pairs").alias("pairs"),
                 F.col("nc_bytes").alias("bytes")),
        F.struct(F.lit("combiner_upper_bound").alias("scenario"), F.col("up_pairs").alias("pairs"),
                 F.col("up_bytes").alias("bytes")),
        F.struct(F.lit("combiner_expected").alias("scenario"), F.col("exp_pairs").alias("pairs"),
                 F.col("exp_bytes").alias("bytes"))))
    out = one.select(F.lit(mappers).alias("mappers"), "nc_bytes", rows.alias("r"))
    return out.select("r.scenario", "mappers",
                      round_half_up(F.col("r.pairs"), 4).alias("pairs"),
                      round_half_up(F.col("r.bytes"), 4).alias("bytes"),
                      round_half_up((1 - F.col("r.bytes") / F.col("nc_bytes")) * 100, 4)
                      .alias("saving_pct"))


def partition_load(dist: DataFrame, reducers: int, weight: str = "count",
                   partitioner: str = "hadoop") -> DataFrame:
    """Load per reducer under the Hadoop partitioner ((hash & MAX) % R)
    or Spark's own (pmod(murmur3, R)); R is raised to 2 because R = 1 hides
    every imbalance. Empty reducers are reported with load 0."""
    r = max(reducers, 2)
    part = (hadoop_partition(F.col("java_hash"), r) if partitioner == "hadoop"
            else spark_partition(F.col("key"), r))
    loads = (dist.groupBy(part.alias("reducer"))
             .agg(F.sum(weight).cast("double").alias("load"), F.count(F.lit(1)).alias("keys")))
    total = dist.agg(F.sum(weight).cast("double").alias("_n"))
    slots = dist.sparkSession.range(r).select(F.col("id").cast("int").alias("reducer"))
    return (attach_one_row(slots.join(loads, "reducer", "left"), total)
            .select("reducer", F.coalesce("load", F.lit(0.0)).alias("load"),
                    F.coalesce("keys", F.lit(0)).cast("bigint").alias("keys"),
                    (F.col("_n") / r).alias("ideal"))
            .select("reducer", round_half_up(F.col("load"), 4).alias("load"), "keys",
                    round_half_up(F.col("ideal"), 4).alias("ideal"),
                    round_half_up(F.col("load") / F.col("ideal"), 4).alias("imbalance")))


def skew_indicators(dist: DataFrame) -> DataFrame:
    """A5: max, min, mean count per key, max/mean, top-1 and top-3 share.
    The top-3 uses TakeOrderedAndProject (per-partition top 3, then merge)."""
    totals = dist.agg(F.max("count").alias("max_count"), F.min("count").alias("min_count"),
                      F.sum("count").alias("records"), F.count(F.lit(1)).alias("keys"))
    top3 = (dist.orderBy(F.desc("count"), F.asc("key")).limit(3)
            .agg(F.sum("count").alias("_top3")))
    mean = F.col("records") / F.col("keys")
    return attach_one_row(totals, top3).select(
        "records", "keys", "max_count", "min_count",
        round_half_up(mean, 4).alias("mean_count"),
        round_half_up(F.col("max_count") / mean, 4).alias("max_to_mean"),
        round_half_up(F.col("max_count") / F.col("records"), 4).alias("top1_share"),
        round_half_up(F.col("_top3") / F.col("records"), 4).alias("top3_share"))


def salted_distribution(dist: DataFrame) -> DataFrame:
    """Split every key into S = max(2, ceil(max count / (N / K))) buckets
    ``key#b`` carrying count/S and sum/S (fractional, as the model does)."""
    s = dist.agg(F.greatest(F.lit(2), F.ceil(F.max("count") / (F.sum("count") / F.count(F.lit(1)))))
                 .cast("int").alias("S"))
    x = attach_one_row(dist, s)
    b = F.explode(F.sequence(F.lit(0), F.col("S") - 1)).alias("b")
    x = x.select("key", "count", "sum", "S", b)
    key_b = F.concat(F.col("key"), F.lit("#"), F.col("b").cast("string"))
    return x.select(key_b.alias("key"), (F.col("count") / F.col("S")).alias("count"),
                    (F.col("sum") / F.col("S")).alias("sum"), F.octet_length(key_b).alias("key_bytes"),
                    java_hash(key_b).alias("java_hash"), "S")


def salting_tradeoff(dist: DataFrame, mappers: int, reducers: int, overhead: int = 2) -> DataFrame:
    """Pairs, bytes, most loaded reducer and imbalance before vs after
    salting, with the % change."""
    salted = salted_distribution(dist)
    r = max(reducers, 2)
    m = F.lit(mappers)

    def summary(d: DataFrame, prefix: str) -> DataFrame:
        t = _expected_terms(d, m, overhead).agg(F.sum("_e").alias(f"{prefix}_pairs"),
                                               F.sum("_b").alias(f"{prefix}_bytes"))
        loads = (d.groupBy(hadoop_partition(F.col("java_hash"), r).alias("p"))
                 .agg(F.sum("count").alias("l"))
                 .agg(F.max("l").alias(f"{prefix}_max_load")))
        return attach_one_row(t, loads)

    ideal = dist.agg((F.sum("count") / r).alias("ideal"))
    s = salted.agg(F.max("S").alias("buckets"))
    one = attach_one_row(summary(dist, "b"), summary(salted, "a"), ideal, s)
    metric = F.explode(F.array(*[
        F.struct(F.lit(name).alias("metric"), before.alias("before"), after.alias("after"))
        for name, before, after in (
            ("pairs", F.col("b_pairs"), F.col("a_pairs")),
            ("bytes", F.col("b_bytes"), F.col("a_bytes")),
            ("max_load", F.col("b_max_load"), F.col("a_max_load")),
            ("imbalance", F.col("b_max_load") / F.col("ideal"), F.col("a_max_load") / F.col("ideal")))]))
    out = one.select("buckets", metric.alias("x"))
    return out.select("x.metric", "buckets",
                      round_half_up(F.col("x.before").cast("double"), 4).alias("before"),
                      round_half_up(F.col("x.after").cast("double"), 4).alias("after"),
                      round_half_up((F.col("x.after") / F.col("x.before") - 1) * 100, 2)
                      .alias("change_pct"))


def top_keys(dist: DataFrame, mappers: int, k: int = 10) -> DataFrame:
    """The k heaviest keys (ties by key) with share and expected pairs."""
    total = dist.agg(F.sum("count").alias("_n"))
    top = dist.orderBy(F.desc("count"), F.asc("key")).limit(k)
    w = Window.orderBy(F.desc("count"), F.asc("key"))  # over at most k rows
    return (attach_one_row(top, total)
            .select(F.row_number().over(w).cast("bigint").alias("rank"), "key", "count",
                    round_half_up(F.col("count") / F.col("_n") * 100, 4).alias("share_pct"),
                    round_half_up(expected_pairs(F.col("count"), F.lit(mappers)), 4)
                    .alias("expected_pairs")))


def measured_partials(pairs: DataFrame, split: Column | None = None, overhead: int = 2) -> DataFrame:
    """What a combiner really sends, per key: (key, count, sum, key_bytes, measured_pairs,
    measured_bytes), from one partial row per (input split, key).

    A split is what one map task reads: a block of an input file, as Spark cuts it, unless a column
    says which records were read together."""
    if split is None:
        pairs = pairs.withColumn("_split", F.concat_ws(":", F.input_file_name(),
                                                       F.input_file_block_start().cast("string")))
    else:
        pairs = pairs.withColumn("_split", split)
    partial = (pairs.groupBy("_split", "key")
               .agg(F.sum(money(F.col("value"))).alias("_s"), F.count("value").alias("_n"))
               .where(F.col("_n") > 0))
    sent = (F.octet_length("key") + _value_bytes(F.col("_s").cast("double"), F.col("_n")) + overhead)
    return partial.groupBy("key").agg(
        F.sum("_n").alias("count"), F.sum("_s").cast("double").alias("sum"),
        F.first(F.octet_length("key")).cast("bigint").alias("key_bytes"),
        F.count(F.lit(1)).alias("measured_pairs"), F.sum(sent).cast("bigint").alias("measured_bytes"))


def estimate_vs_measured(measured: DataFrame, mappers: int, overhead: int = 2) -> DataFrame:
    """The model's pairs and bytes (A7) beside the measured ones, per key, with the relative
    error (estimate - measured) / measured. ``measured``: see ``measured_partials``."""
    e = expected_pairs(F.col("count"), F.lit(mappers))
    size = e * (F.col("key_bytes") + _value_bytes(F.col("sum") / e, F.greatest(F.lit(1.0), F.col("count") / e))
                + overhead)
    rows = measured.select("key", "count", e.alias("_e"), "measured_pairs", size.alias("_b"), "measured_bytes")
    error = lambda est, real: round_half_up(safe_ratio(F.col(est) - F.col(real), F.col(real)), 6)
    return rows.select("key", "count", round_half_up(F.col("_e"), 4).alias("estimated_pairs"), "measured_pairs",
                       error("_e", "measured_pairs").alias("pairs_error"),
                       round_half_up(F.col("_b"), 4).alias("estimated_bytes"), "measured_bytes",
                       error("_b", "measured_bytes").alias("bytes_error"))
