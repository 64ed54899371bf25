"""Importance resampling of documents towards a target corpus (operator 13).

Runs of 1 to ``size`` words are hashed into a fixed number of buckets. A bucket's gain is
the smoothed log ratio of its share in the target and in the documents; a document's weight
is the mean gain of its features; adding Gumbel noise that the id fixes and taking the
highest scores draws without replacement in proportion to the weights' exponentials.

Features are interned per block of words in an open-addressed NumPy table: a run's xxhash64
(computed for all runs of one length at once) names its first slot, the bytes of run and
slot are compared, and unlike ones probe on. A slot holds its bucket (one CRC-32 for each
distinct run) and its count; occurrences keep slot ids, by which gains are gathered. The
first pass over the texts adds the slots' counts up to the bucket counters (a row per task
and bucket, ``buckets`` rows in all), the second gathers gains per document. Both passes
send no text anywhere. Ranks come from a histogram of the scores, whole numbers within a
range that the gains bound, and an order inside one score value.

Defined results: a null text has no words; a document without features weighs 0; a null id
draws its noise from ``2024:`` alone and ranks after equal scores; rows that repeat an id get
ranks of their own, in no set order; an empty table gives no rows, an empty target T = 0;
runs never cross documents; other columns, whatever their names, are not read; a text of any
length is taken whole, in blocks of ``BLOCK`` words.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.store import stage
from tributary.llm.textops import LOWER, buffer_of, gathered, lookup, slices, word_bounds

BUCKETS, SIZE, SEED = 10_000, 1, 2024
MIN_WORDS, DRAWN_PERCENT = 20, 10
GATHERED = 2 << 20
#: Words whose runs are interned in one table.
BLOCK = 1 << 17
#: Runs of more bytes are hashed one at a time.
LONG_RUN = 512

IS_GAP = lookup(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61),
                       *range(0x7B, 0x80)]))

P1, P2, P3, P4, P5 = (np.uint64(p) for p in (  # the fixed primes of xxHash's 64-bit form
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
    0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


class Bytes:
    """Reads of 8, 4 and 1 bytes at arbitrary places of a buffer."""

    def __init__(self, data: np.ndarray) -> None:
        self.raw = np.concatenate([data, np.zeros(8, np.uint8)])
        n = len(self.raw)
        self.by8 = np.ndarray((n - 7,), "<u8", self.raw, strides=(1,))
        self.by4 = np.ndarray((n - 3,), "<u4", self.raw, strides=(1,))

    def same(self, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
        """Whether the ``length`` bytes at ``a`` and at ``b`` are equal."""
        out = np.ones(len(a), dtype=bool)
        for k in range(0, length - 7, 8):
            out &= self.by8[a + k] == self.by8[b + k]
        if length % 8:
            unused = np.uint64(8 * (8 - length % 8))
            at = length - length % 8
            out &= (self.by8[a + at] << unused) == (self.by8[b + at] << unused)
        return out


def xxhash64(data: Bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """xxHash (64 bits, seed 0) of the ``length`` bytes at each start."""
    if length > LONG_RUN:
        return np.array([xxhash.xxh64_intdigest(data.raw[s:s + length]) for s in starts.tolist()],
                        dtype=np.uint64)

    def rounded(held, lane):
        return turned(held + lane * P2, 31) * P1

    at, zero = 0, np.zeros(len(starts), np.uint64)
    if length >= 32:
        held = [zero + P1 + P2, zero + P2, zero, zero - P1]
        while at + 32 <= length:
            held = [rounded(h, data.by8[starts + at + 8 * k]) for k, h in enumerate(held)]
            at += 32
        out = sum((turned(h, by) for h, by in zip(held, (1, 7, 12, 18))), zero)
        for h in held:
            out = (out ^ rounded(zero, h)) * P1 + P4
    else:
        out = zero + P5
    out = out + np.uint64(length)
    while at + 8 <= length:
        out = turned(out ^ rounded(zero, data.by8[starts + at]), 27) * P1 + P4
        at += 8
    if at + 4 <= length:
        out = turned(out ^ (data.by4[starts + at].astype(np.uint64) * P1), 23) * P2 + P3
        at += 4
    while at < length:
        out = turned(out ^ (data.raw[starts + at].astype(np.uint64) * P5), 11) * P1
        at += 1
    out = (out ^ (out >> np.uint64(33))) * P2
    out = (out ^ (out >> np.uint64(29))) * P3
    return out ^ (out >> np.uint64(32))


class Interned:
    """An open-addressed table of the distinct byte runs of one block.

    ``slot`` gives each run's slot; a slot's ``bucket`` and ``count`` are valid where
    ``used``."""

    def __init__(self, data: Bytes, starts: np.ndarray, lengths: np.ndarray, buckets: int) -> None:
        size = 1 << max(4, (2 * len(starts)).bit_length())
        self.key = np.zeros(size, np.uint64)
        self.start = np.zeros(size, np.int64)
        self.length = np.full(size, -1, np.int64)
        self.slot = np.zeros(len(starts), np.int64)
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order])) + 1
        for mine in np.split(order, edges) if len(order) else []:
            length = int(lengths[mine[0]])
            self.slot[mine] = self._place(data, starts[mine], length)
        self.used = np.flatnonzero(self.length >= 0)
        self.bucket = np.zeros(size, np.int64)
        self.bucket[self.used] = [
            zlib.crc32(data.raw[s:s + n]) % buckets
            for s, n in zip(self.start[self.used].tolist(), self.length[self.used].tolist())]
        self.count = np.bincount(self.slot, minlength=size)

    def _place(self, data: Bytes, starts: np.ndarray, length: int) -> np.ndarray:
        keys = xxhash64(data, starts, length)
        mask = np.uint64(len(self.key) - 1)
        at = (keys & mask).astype(np.int64)
        waiting = np.arange(len(starts))
        while len(waiting):
            here = at[waiting]
            free = self.length[here] < 0
            if free.any():  # of several claims on a free slot the last one written holds
                slots, runs = here[free], waiting[free]
                self.start[slots] = starts[runs]
                claimed = np.zeros(0, bool) if not len(slots) else \
                    self.start[slots] == starts[runs]
                self.key[slots[claimed]] = keys[runs[claimed]]
                self.length[slots] = length
            like = np.flatnonzero((self.length[here] == length)
                                  & (self.key[here] == keys[waiting]))
            found = np.zeros(len(waiting), bool)
            found[like] = data.same(starts[waiting[like]], self.start[here[like]], length)
            waiting = waiting[~found]
            at[waiting] = (at[waiting] + 1) & int(mask)
        return at


def single_spaced(data: np.ndarray, offsets: np.ndarray):
    """The lower-cased words with one space before each that follows a gap: (bytes, starts,
    ends, the word number at which each text starts)."""
    starts, ends, first = word_bounds(data, offsets, IS_GAP)
    if not len(data):
        return data, starts, ends, first
    keep = ~IS_GAP[data]
    before = starts[starts > 0] - 1
    spaces = before[IS_GAP[data[before]]]
    keep[spaces] = True
    place = np.cumsum(keep) - 1
    clean = LOWER[data]
    clean[spaces] = 0x20
    return clean[keep], place[starts], place[ends - 1] + 1, first


def blocks(column: pa.Array, size: int, buckets: int):
    """For each block of words of the texts of a column: (first text, words and features per
    text of the slice, [(table, text of each feature)]), a text's numbers adding up over blocks."""
    data, offsets = buffer_of(column)
    for i, j in slices(offsets, GATHERED):
        raw = data[offsets[i]:offsets[j]]
        clean, starts, ends, first = single_spaced(raw, offsets[i:j + 1] - offsets[i])
        held, n = Bytes(clean), len(starts)
        text = np.repeat(np.arange(j - i), np.diff(first))
        words = np.diff(first)
        for lo in range(0, max(n, 1), BLOCK):
            begins, stops, texts = [], [], []
            for length in range(1, size + 1):
                run = np.arange(lo, max(lo, min(lo + BLOCK, n - length + 1)))
                run = run[text[run] == text[run + length - 1]] if len(run) else run
                begins.append(starts[run])
                stops.append(ends[run + length - 1] if len(run) else run)
                texts.append(text[run] if len(run) else run)
            begin, stop = np.concatenate(begins), np.concatenate(stops)
            table = Interned(held, begin, stop - begin, buckets)
            yield i, words if lo == 0 else np.zeros_like(words), table, np.concatenate(texts)


def bucket_counts(docs: DataFrame, text: str = "text", size: int = SIZE,
                  buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over the whole table: ``buckets`` numbers, whatever its rows."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in gathered(batches, GATHERED):
            for _, _, table, _ in blocks(batch.column(0), size, buckets):
                np.add.at(total, table.bucket[table.used], table.count[table.used])
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])],
                                         names=["bucket", "n"])

    rows = (docs.select(F.col(text)).mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(((t + 1) / (T + B)) / ((s + 1) / (S + B)))) per bucket, in doubles."""
    size = float(len(source))
    s, t = source.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + size) / ((s + 1) * (t.sum() + size))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text: str = "text",
            size: int = SIZE) -> DataFrame:
    """(id, n_words, n_features, weight) per row of ``docs``; other columns are not read."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def weigh(batches):
        gains = shared.value
        for batch in gathered(batches, GATHERED):
            n = batch.num_rows
            n_words, n_features, total = (np.zeros(n, np.int64) for _ in range(3))
            for i, words, table, texts in blocks(batch.column(1), size, len(gains)):
                n_words[i:i + len(words)] += words
                gain = gains[table.bucket[table.slot]]
                np.add.at(total, texts + i, gain)
                n_features += np.bincount(texts + i, minlength=n)
            weight = np.where(n_features > 0, total // np.maximum(n_features, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n_features), pa.array(weight)],
                names=["id", "n_words", "n_features", "weight"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(weigh, f"id {kind}, n_words long, n_features long, weight long")


def drawn(scored: DataFrame, min_words: int = MIN_WORDS, percent: int = DRAWN_PERCENT) -> DataFrame:
    """``scored`` (a staged table with id, n_words, score) with the rank of drawn rows."""
    able = F.col("n_words") >= min_words
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # one row per score value: their range is bounded by the gains', not by the rows
    ahead = (scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("ahead", F.coalesce(F.sum("n").over(higher), F.lit(0)))
             .withColumn("places", F.floor(percent * F.sum("n").over(whole) / 100))
             .where(F.col("ahead") < F.col("places")).select("score", "ahead", "places"))
    first = Window.partitionBy("score").orderBy(F.col("id").asc_nulls_last())
    near = scored.where(able).join(F.broadcast(ahead), "score")
    ranked = near.withColumn("rank", F.col("ahead") + F.row_number().over(first))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= F.col("places"), F.col("rank")))
    rest = (scored.where(~able).unionByName(
        scored.where(able).join(F.broadcast(ahead), "score", "left_anti")))
    return ranked.select(*scored.columns, F.col("rank").cast("long")).unionByName(
        rest.withColumn("rank", F.lit(None).cast("long")))


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text",
              size: int = SIZE, buckets: int = BUCKETS, seed: int = SEED,
              min_words: int = MIN_WORDS, percent: int = DRAWN_PERCENT) -> DataFrame:
    """Every document's id, n_features, weight, score and rank (null where it is not drawn)."""
    gains = bucket_gains(bucket_counts(docs, text, size, buckets),
                         bucket_counts(target, text, size, buckets))
    ident = F.coalesce(F.col("id").cast("string"), F.lit(""))
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), ident).cast("binary"), 256), 1, 8)
    share = (F.conv(head, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    scored = weights(docs, gains, id_col, text, size).withColumn(
        "score", F.col("weight") + F.floor(-1000 * F.log(-F.log(share))).cast("long"))
    return drawn(stage(scored, "scored"), min_words, percent).select(
        F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
