"""Keyed aggregation (A1-A3): mean/sum/count by key, mergeable partials and
salted two-stage aggregation for hot keys.

All three produce the same (key, mean, sum, count) table. Spark already plans
a map-side partial aggregate below the shuffle (the combiner of a MapReduce
job), so A1 is the production path; A2 exposes the partial table so it can be
stored and merged any number of times; A3 spreads the heavy keys, and only
those, over buckets before the shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tributary.contract import KeyValueContract
from tributary.functions.numeric import MONEY_LIMIT, money, round_exact, round_half_up, safe_ratio
from tributary.functions.text import normalize_key, parse_text_number

#: Why a record is discarded (``extract_pairs``).
REASONS = ("short_row", "non_numeric", "out_of_range")


def extract_pairs(df: DataFrame, contract: KeyValueContract, keep=()) -> DataFrame:
    """Map side: text record -> (key, value, reason). ``reason`` is NULL for a
    valid pair and names why a record was discarded otherwise (P3).

    Built as separate projections (raw fields -> parsed number -> pair) so
    each text expression is evaluated once per record; the optimizer keeps
    the stages apart because the parsed value is used more than once."""
    raw = df.select(*keep, F.col(contract.key_col).alias("_k"), F.col(contract.value_col).alias("_v"))
    kept = raw.columns[:len(keep)]
    parsed = raw.select(*kept, "_k", "_v",
                        parse_text_number(F.col("_v"), contract.strip_symbols, contract.thousands,
                                          contract.decimal).alias("_d"))
    reason = (F.when(F.col("_v").isNull() | F.col("_k").isNull(), F.lit("short_row"))
              .when(F.col("_d").isNull() | ~(F.abs(F.col("_d")) < F.lit(float("inf"))), F.lit("non_numeric"))
              .when(F.abs(F.col("_d")) >= F.lit(MONEY_LIMIT), F.lit("out_of_range")))
    return parsed.select(
        *kept,
        normalize_key("_k", contract.normalize_key, contract.empty_key).alias("key"),
        F.when(reason.isNull(), F.col("_d")).alias("value"),
        reason.alias("reason"))


def discard_report(pairs: DataFrame) -> DataFrame:
    """P3 counters: one row per outcome (valid / short_row / non_numeric / out_of_range)."""
    return (pairs.groupBy(F.coalesce("reason", F.lit("valid")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("records")))


def finalize_mean(df: DataFrame, key: str, s: str, n: str, decimals: int = 2,
                  extra=()) -> DataFrame:
    """Reduce side: divide once at the end, fixed decimals, skip count = 0."""
    return (df.where(F.col(n) > 0)
            .select(F.col(key).alias("key"),
                    round_half_up(F.col(s).cast("double") / F.col(n), decimals).alias("mean"),
                    round_exact(F.col(s), decimals).alias("sum"),
                    F.col(n).cast("bigint").alias("count"), *extra))


def mean_by_key(pairs: DataFrame, key: str = "key", value: str = "value",
                decimals: int = 2) -> DataFrame:
    """A1: groupBy(key) -> partial HashAggregate, Exchange, final HashAggregate."""
    # no filter before the aggregate: NULL values are skipped by sum/count,
    # so the parse is not re-evaluated by a pushed-down predicate
    agg = pairs.groupBy(key).agg(F.sum(money(F.col(value))).alias("_s"), F.count(value).alias("_n"))
    return finalize_mean(agg, key, "_s", "_n", decimals)


def partial_aggregates(pairs: DataFrame, split_col, key: str = "key",
                       value: str = "value") -> DataFrame:
    """A2 map+combine: one (split, key, sum, count) row per split and key."""
    split = F.col(split_col) if isinstance(split_col, str) else split_col
    return (pairs.groupBy(split.alias("split"), F.col(key).alias("key"))
            .agg(F.sum(money(F.col(value))).alias("sum"), F.count(value).alias("count"))
            .where(F.col("count") > 0))


def counted_partials(pairs: DataFrame, split_col, key: str = "key", value: str = "value",
                     reasons: tuple[str, ...] = REASONS) -> DataFrame:
    """A2 + P3 in one pass: ``partial_aggregates`` with the discarded records of the split and key
    counted beside the sum, one column per reason. A key with discards only keeps its row."""
    split = F.col(split_col) if isinstance(split_col, str) else split_col
    return (pairs.groupBy(split.alias("split"), F.col(key).alias("key"))
            .agg(F.sum(money(F.col(value))).alias("sum"), F.count(value).alias("count"),
                 *[F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in reasons]))


def merge_partials(partials: DataFrame, decimals: int = 2) -> tuple[DataFrame, DataFrame]:
    """A2 merge: any number of partial tables (even re-merged ones) fold into
    the final table. A missing count means one record; partials without a
    usable sum are counted as malformed and left out.

    Returns (result, malformed_count)."""
    p = partials.select("key", F.col("sum").cast("decimal(28,6)").alias("sum"),
                        F.coalesce(F.col("count").cast("bigint"), F.lit(1).cast("bigint")).alias("count"))
    ok = F.col("sum").isNotNull()
    merged = p.groupBy("key").agg(F.sum(F.when(ok, F.col("sum"))).alias("_s"),
                                  F.sum(F.when(ok, F.col("count"))).alias("_n"),
                                  F.count(F.when(ok, 1)).alias("partials"))
    # one expression over the key and an aggregate output: it cannot be split
    # and pushed below the aggregate into the (re-evaluated) key expression
    merged = merged.where(F.when(F.col("key").isNull(), F.lit(False)).otherwise(F.col("partials") > 0))
    result = finalize_mean(merged, "key", "_s", "_n", decimals, extra=["partials"])
    malformed = p.agg(F.count(F.when(F.col("sum").isNull() | F.col("key").isNull(), 1))
                      .alias("malformed_partials"))
    return result, malformed


def merge_counted(partials: DataFrame, decimals: int = 2, observation: Observation | None = None) -> DataFrame:
    """A2 + P3: ``merge_partials`` with the counts of what was left out in the same pass.

    ``malformed_partials`` of the key and, when the partials carry them (``counted_partials``),
    its discarded records by reason stand beside its mean. They are aggregates like the sums, so
    a rerun task cannot count twice. Keys that only have such counts stay, with a NULL mean; a
    NULL key holds the malformed partials without one.

    ``observation`` additionally reports the totals (``partials``, ``malformed``) of the scan as a
    metric of the same job, for progress and logs: Spark counts a stage that is rerun after a lost
    executor again, so the columns are the result and the metric is not."""
    p = partials.withColumn("sum", F.col("sum").cast("decimal(28,6)")).withColumn(
        "count", F.coalesce(F.col("count").cast("bigint"), F.lit(1).cast("bigint")))
    used = F.col("count") > 0  # a split and key with discards only is no partial
    ok = F.col("sum").isNotNull() & F.col("key").isNotNull()
    if observation is not None:
        p = p.observe(observation, F.count(F.when(used, 1)).alias("partials"),
                      F.count(F.when(used & ~ok, 1)).alias("malformed"))
    left_out = [c for c in REASONS if c in p.columns]
    merged = p.groupBy("key").agg(
        F.sum(F.when(ok, F.col("sum"))).alias("_s"), F.sum(F.when(ok, F.col("count"))).alias("_n"),
        F.count(F.when(used & ok, 1)).alias("partials"),
        F.count(F.when(used & ~ok, 1)).alias("malformed_partials"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in left_out])
    n = F.coalesce(F.col("_n"), F.lit(0)).cast("bigint")
    return merged.select(
        "key", round_half_up(safe_ratio(F.col("_s"), n), decimals).alias("mean"),
        round_exact(F.col("_s"), decimals).alias("sum"), n.alias("count"), "partials",
        "malformed_partials", *left_out)


def salt_buckets(max_count: int, total: int, keys: int) -> int:
    """S = max(2, ceil(max key count / (N / K)))."""
    if total <= 0 or keys <= 0:
        return 2
    return max(2, math.ceil(max_count / (total / keys)))


#: A key is heavy when it holds at least this share of the records; there are at most 1 / share.
HEAVY_SHARE = 0.02
#: Counters of the sketch; a key's estimate is exact while keys are fewer.
COUNTERS = 4096
#: Buckets of one heavy key at most.
MOST_BUCKETS = 64


def heavy_keys(pairs: DataFrame, key: str = "key", share: float = HEAVY_SHARE,
               counters: int = COUNTERS) -> dict[str, int]:
    """S per heavy key: the keys that may hold ``share`` of all records (at most 2 / share), each
    with the buckets its count asks for, at most MOST_BUCKETS. One scan with a mergeable
    frequent-items sketch of bounded size: a partial sketch a task, merged like any aggregate."""
    most = math.ceil(2 / share)
    row = pairs.agg(F.expr(f"approx_top_k(`{key}`, {most}, {counters})").alias("top"),
                    F.count(key).alias("n"), F.approx_count_distinct(key).alias("keys")).first()
    return {e["item"]: min(MOST_BUCKETS, salt_buckets(e["count"], row["n"], row["keys"]))
            for e in row["top"] or () if e["count"] >= share * row["n"]}


def salted_mean(pairs: DataFrame, buckets: dict[str, int] | int | None = None, key: str = "key",
                value: str = "value", decimals: int = 2) -> DataFrame:
    """A3: the heavy keys in two stages, all others in one.

    Records of a heavy key are aggregated by (key, pmod(xxhash64(row), S)) with the key's own S
    (``heavy_keys``; an int gives them all the same), records of other keys by key alone, in one
    and the same shuffle. Only the heavy keys' partial rows, at most 2 / share * MOST_BUCKETS, are
    shuffled once more; both halves of the result read that first exchange."""
    s = buckets if isinstance(buckets, dict) else heavy_keys(pairs, key)
    if isinstance(buckets, int):
        s = dict.fromkeys(s, buckets)
    salt = F.lit(None).cast("bigint")
    for k, n in s.items():
        salt = F.when(F.col(key) == k, F.pmod(F.xxhash64(*[F.col(c) for c in pairs.columns]), F.lit(n))
                      ).otherwise(salt)
    first = (pairs.withColumn("_b", salt).groupBy(key, "_b")
             .agg(F.sum(money(F.col(value))).alias("_ps"), F.count(value).alias("_pn"),
                  # a result of the aggregate: filters on it stay above, so both halves share it
                  F.max("_b").alias("_salt")))
    light = first.where(F.col("_salt").isNull()).select(key, F.col("_ps").alias("_s"), F.col("_pn").alias("_n"))
    if not s:
        return finalize_mean(light, key, "_s", "_n", decimals)
    hot = (first.where(F.col("_salt").isNotNull()).groupBy(key)
           .agg(F.sum("_ps").alias("_s"), F.sum("_pn").alias("_n")))
    return finalize_mean(light.unionByName(hot), key, "_s", "_n", decimals)
