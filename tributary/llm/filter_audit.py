"""How quality filters overlap and depend on their order (operator 12).

Five filters look at every text; a document's failures are a mask of five bits. Four
depend on the text alone. The fifth (``E``: the text of some smaller id) depends on the
whole table and is kept up by a stream: all files are processed as available-now
micro-batches, the state holds, for each text, its least id so far and the masks counted
under it. A smaller id that arrives later retracts these masks from their part's counters
(negative counts) and enters them again as failing E.

A task first combines its own rows, so a text that a third of all rows hold reaches the
state as a few rows a task. Texts share state keys: about ``TEXTS_A_KEY`` to a key, their
number being set from the table's row count when the stream starts. The counters (part,
mask, labels) are appended to a file sink, whose log lists each micro-batch exactly once;
a stream that was stopped goes on from its checkpoint. The report over all 120 orders is
computed from the summed counters, of which there are at most 128 a part.

Defined results: a null text counts as empty, a null language as the part ``''``; a null
id neither fails E nor makes another row fail it; rows that repeat the least id do not fail
E; a document whose labels repeat counts as good (toxic) when one of them says so; other
columns, whatever their names, are not read; an empty table gives no rows; texts of any
length are taken whole.
"""

from __future__ import annotations

import pickle
from collections import Counter
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tributary.llm.store import broadcast_if_small, stage
from tributary.session import scratch_path

FILTERS = "ABCDE"
BIT = {letter: 1 << k for k, letter in enumerate(FILTERS)}
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 200, 50, 3
SYMBOLS = r"[#$%&*|]"
TEXTS_A_KEY = 256
#: Files of a micro-batch at least, and micro-batches at most.
MIN_FILES, MAX_BATCHES = 4, 16
#: Texts that a task combines before it passes them on.
COMBINED = 1 << 16

COUNTS = "part string, mask int, good boolean, toxic boolean, n long"


def text_mask(text: str) -> Column:
    """Bits of the failures that depend on the text alone (A to D)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(whole, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(F.array(F.struct(words.alias("w"), whole.alias("t"))), lambda x: (
        F.when(F.size(x.w) < MIN_WORDS, BIT["A"]).otherwise(0)
        + F.when(100 * F.size(F.array_distinct(x.w)) < MIN_DISTINCT_PERCENT * F.size(x.w),
                 BIT["B"]).otherwise(0)
        + F.when(100 * F.regexp_count(x.t, F.lit("[A-Z]"))
                 > MAX_CAPITAL_PERCENT * F.length(x.t), BIT["C"]).otherwise(0)
        + F.when(x.t.rlike(SYMBOLS), BIT["D"]).otherwise(0)))[0]


def marked_labels(labels: DataFrame) -> DataFrame:
    """(id, good, toxic) of documents with a label that counts."""
    return (labels.where(F.col("doc_id").isNotNull()
                         & ((F.col("quality") == 1) | (F.col("toxic") == 1)))
            .groupBy(F.col("doc_id").alias("id"))
            .agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
                 F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")))


def masked(docs: DataFrame, labels: DataFrame, keys: int) -> DataFrame:
    """One narrow row per document: key, digest, id, part, mask (A to D), good, toxic."""
    digest = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce("lang", F.lit("")).alias("part"),
                       digest.alias("digest"), text_mask("text").cast("int").alias("mask"))
    return rows.join(broadcast_if_small(labels), "id", "left").select(
        F.pmod(F.xxhash64("digest"), F.lit(keys)).alias("key"), "digest", "id", "part", "mask",
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"))


def failed(combo: tuple) -> tuple:
    part, mask, good, toxic = combo
    return part, mask | BIT["E"], good, toxic


def combined(batches):
    """A task's rows with each text's least id apart.

    Rows with a digest may still be found to fail E; rows without (an empty one) are
    settled: a smaller id is in the same task, or the id is null."""
    schema = None
    least: dict[bytes, tuple] = {}
    settled: Counter = Counter()
    route = None

    def passed_on():
        rows = [(key, digest, ident, *combo, n) for digest, (key, ident, held) in least.items()
                for combo, n in held.items()]
        if settled and route:
            rows += [(route[0], b"", route[1], *combo, n) for combo, n in settled.items()]
        least.clear()
        settled.clear()
        for k in range(0, len(rows), 8192):
            columns = zip(*rows[k:k + 8192])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in
                                              zip(columns, schema)], schema=schema)

    for batch in batches:
        if schema is None:
            schema = pa.schema([*batch.schema, ("n", pa.int64())])
        for key, digest, ident, *combo in zip(*(c.to_pylist() for c in batch.columns)):
            combo = tuple(combo)
            route = route or (key, ident)
            if ident is None:
                settled[combo] += 1
                continue
            old = least.get(digest)
            if old is None or ident < old[1]:
                least[digest] = (key, ident, Counter([combo]))
                if old:
                    for c, n in old[2].items():
                        settled[failed(c)] += n
            elif ident == old[1]:
                old[2][combo] += 1
            else:
                settled[failed(combo)] += 1
        if len(least) >= COMBINED:
            yield from passed_on()
    yield from passed_on()


def retracting(key: tuple, frames, state: GroupState):
    """Counter changes of a micro-batch's rows of one state key."""
    import pandas as pd  # not needed, and not held, by the other tasks
    held: dict[bytes, tuple] = pickle.loads(state.get[0]) if state.exists else {}
    change: Counter = Counter()
    for frame in frames:
        for _, digest, ident, part, mask, good, toxic, n in frame.itertuples(index=False):
            combo, digest = (part, int(mask), bool(good), bool(toxic)), bytes(digest)
            old = held.get(digest)
            if not digest:
                change[combo] += n
            elif old is None or ident < old[0]:
                for c, m in old[1].items() if old else ():
                    change[c] -= m
                    change[failed(c)] += m
                held[digest] = (ident, Counter({combo: n}))
                change[combo] += n
            elif ident == old[0]:
                old[1][combo] += n
                change[combo] += n
            else:
                change[failed(combo)] += n
    state.update((pickle.dumps(held),))
    rows = [(*combo, int(n)) for combo, n in change.items() if n]
    yield pd.DataFrame(rows, columns=["part", "mask", "good", "toxic", "n"])


def filter_counts(spark: SparkSession, path: str, labels: DataFrame,
                  files_a_batch: int | None = None, texts_a_key: int = TEXTS_A_KEY,
                  folder: str | None = None) -> DataFrame:
    """(part, mask, good, toxic, n) of the documents in the files of ``path``.

    ``folder`` (a new one in the shared scratch space unless given) keeps the stream's
    checkpoint and sink: a second call with it processes only files that came since."""
    table = spark.read.parquet(path)
    files = len(table.inputFiles())
    files_a_batch = files_a_batch or max(MIN_FILES, -(-files // MAX_BATCHES))
    folder = folder or scratch_path(spark, "llm", "filter_audit")
    keys = max(1, table.count() // texts_a_key)
    settings = spark.createDataFrame([(keys,)], "keys long")
    try:  # a stream that goes on keeps the keys of its state
        keys = spark.read.schema("keys long").parquet(f"{folder}/settings").first()[0]
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        settings.write.parquet(f"{folder}/settings")
    # as a pattern that only this path matches: a stream takes a plain path for a folder
    path = path.rstrip("/")
    stream = (spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_a_batch)
              .parquet(f"{path[:-1]}[{path[-1]}]"))
    rows = masked(stream, stage(marked_labels(labels), "labels"), keys)
    kind = table.schema["doc_id"].dataType.simpleString()
    changes = (rows.mapInArrow(combined, f"key long, digest binary, id {kind}, part string, "
                                         "mask int, good boolean, toxic boolean, n long")
               .groupBy("key")
               .applyInPandasWithState(retracting, COUNTS, "held binary", "append",
                                       GroupStateTimeout.NoTimeout))
    query = (changes.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{folder}/checkpoint")
             .trigger(availableNow=True).start(f"{folder}/changes"))
    query.awaitTermination()
    return (spark.read.schema(COUNTS).parquet(f"{folder}/changes")
            .groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
            .where(F.col("n") != 0))


def order_report(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the masks' counters."""
    steps = [f"named_struct('filter_order', '{order}', 'step', {k + 1}, 'filter', '{letter}', "
             f"'bit', {BIT[letter]}, 'before', {sum(BIT[x] for x in order[:k])})"
             for order in map("".join, permutations(FILTERS)) for k, letter in enumerate(order)]
    rows = counts.withColumn("s", F.explode(F.expr(f"array({', '.join(steps)})"))).select(
        "*", "s.*")
    mask, bit, before = F.col("mask"), F.col("bit"), F.col("before")
    fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0

    def total(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0))).cast("long").alias(name)

    by_step = rows.groupBy("part", "filter_order", "step", "filter").agg(
        total(~fails & ~gone, "kept"), total(fails & ~gone, "removed"),
        total(fails & gone, "redundant"), total(mask == bit, "unique_fails"),
        total(fails & ~gone & F.col("good"), "good_lost"),
        total(fails & ~gone & F.col("toxic"), "toxic_lost"))
    whole = Window.partitionBy("part", "filter")  # 120 rows
    return by_step.withColumn("shapley", F.sum("removed").over(whole)).drop("filter")


def filter_audit(spark: SparkSession, path: str, labels: DataFrame) -> DataFrame:
    return order_report(filter_counts(spark, path, labels))
