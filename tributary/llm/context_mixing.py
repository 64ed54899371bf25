"""Language-model scores by online logistic context mixing (operator 2).

A text is its lower-cased words, then an end. Written as bytes (a space after
each word, then a line feed) each byte is a path of yes/no decisions in a
Huffman tree of the corpus' bytes, and each decision is predicted by several
hashed contexts: the last two and four bytes, and the beginning of the word. The predictions are mixed in the logistic domain with weights that a gate
(the place in the word, and whether the longest context is known) selects; an
adaptive table then refines the mixture by the byte before and the prediction.
A word spelled this way is one of four predictors of the next token; the others
are the word's share of the training tokens, its share of the text's own tokens
so far, and the token that followed last time in this text. Shares that a second
gate (how far in the text) selects combine them. Each predictor is a proper
distribution over tokens, so the text's probability is the product over them.

What is learned, all from the training fold only:

* counts, over every whole training text: words, bytes, and for every context
  slot the decisions seen there. Tasks count locally and send sparse blocks,
  which are summed by block; only the finished prediction tables are broadcast
  (and, to learn, the counts as one byte each, exact below 128).
  They have a slot for each distinct training word, ``TABLES`` at least, up to
  2 ** ``MOST`` (a bound on memory, beyond which more contexts share slots);
* mixing weights, refinement and shares, in one online pass over every training
  text (``Course``): each task predicts a slice of its texts, then learns from it,
  and goes on. Weights are averaged by the decisions seen, outcomes and what each
  predictor contributed to the tokens are added up. A slice (2 MB, less of a small
  corpus) is predicted by the counts without its own, so that all is learned on
  unseen text. Tasks take the texts as they lie in the table, so that scores
  depend slightly on how it is cut into files;
* what this pass begins with: the same lessons from one distinct text in
  ``TUNING``, and more of a small corpus, so that some ``LEAST`` texts are met (one
  in eight at most). This part is cut into pieces of about ``PIECE`` bytes by a hash
  of the text; a task learns the weights of a piece online (one pass, small steps,
  in a fixed order), then the refinement and the shares under these.

The base score is a smoothed unigram model of words. Counts of frequent words
are broadcast up to ``FREQUENT`` of them; rarer words are resolved by a shuffle
on the word, where their occurrences meet their counts. An occurrence carries
how its probability grows with the word's share, so base and score are those of
the whole vocabulary, whatever FREQUENT is. No vocabulary is collected.

Defined results: null and empty texts have one token, the end. Rows with a null
id are held out. Rows that repeat an id or a text are scored each for itself.
Columns of the input other than the two named are not read. An empty table gives
no rows; without training texts the scores are those of the prior alone. A text
of any length is taken whole; a word may be so long that its probability is below
any number, and is kept as a logarithm.
"""

from __future__ import annotations

import copy
import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.store import partitions, stage
from tributary.llm.textops import (IS_WHITE, LOWER, SLICE_BYTES, buffer_of, gathered, ragged, slices,
                                   span_hashes, word_bounds)

FOLDS, FOLD = 5, 1
FREQUENT = 1 << 16
#: Of the training texts: one in TUNING begins to tune the mixture, and of small corpora about LEAST
#: texts; then all do.
TUNING, LEAST, PIECE = 64, 512, 1 << 21
#: Texts are predicted without the counts of a slice of about one part in APART of all bytes.
APART = 64
#: Least slots of the context tables (as powers of two): last two bytes, four, word beginning.
TABLES = (18, 21, 22)
#: The most slots of a table (as a power of two).
MOST = 25
#: Bytes of the word's beginning that the last context keeps.
PREFIX = 6
_SCALE, _RANGE, _BUCKETS, _STEP = 12.0, 127, 64, 4.0
_SPACE, _END = 0x20, 0x0A
_END_HASH = np.uint64(0x5851F42D4C957F2D)
_CHUNK = 1 << 15
_FLUSH_TOKENS = 1 << 22
_BLOCK = 1 << 16
#: Places of bytes whose cost is kept (as a power of two).
_KEPT = 20
#: Distinct bytes of a slice whose decisions are held at once.
_HELD = 1 << 20
_GATES, _DEPTHS = 16, 12
_FOLD_PARTS = 1 << 20
_PRIME = 0x2C1B3C6D


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")),
                             F.lit(FOLDS)) == FOLD, F.lit(True))


def table_powers(distinct: int) -> tuple[int, ...]:
    """Slots of the tables, as powers of two, for a vocabulary of ``distinct`` words."""
    two, four, beginning = TABLES
    power = max(beginning, min(MOST, int(distinct).bit_length()))
    return two, four + power - beginning, power


#: Counts that a byte stands for: every one below 128, then five to a doubling.
_COUNTS = np.concatenate([np.arange(128), np.floor(128 * 2 ** (np.arange(128) / 5))]).astype(np.float32)


def coded(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes, rounded down, so that a text left out is never thought to be still there."""
    return (np.searchsorted(_COUNTS, counts, "right") - 1).astype(np.uint8)


def logits(no: np.ndarray, yes: np.ndarray) -> np.ndarray:
    """The predictions after ``no`` and ``yes`` decisions, quantised."""
    return np.clip(np.rint(np.log((yes + 0.4) / (no + 0.4)) * _SCALE), -_RANGE, _RANGE).astype(np.int8)


def tunes(text: Column, share: float) -> Column:
    """Whether a training text tunes the mixture; copies of a text always do so alike."""
    return F.pmod(F.xxhash64(F.lit("tuning"), text), F.lit(_FOLD_PARTS)) < int(share * _FOLD_PARTS)


class Tree:
    """A Huffman tree of bytes: the decisions (node, bit) that lead to each byte; and the sizes of
    the tables that predict them."""

    def __init__(self, counts: np.ndarray, powers: tuple[int, ...] = TABLES) -> None:
        self.powers = powers
        self.table_first = np.concatenate([[0], np.cumsum([1 << p for p in powers])])
        heap = [(int(c) + 1, k, k) for k, c in enumerate(counts)]
        heapq.heapify(heap)
        parent: dict[int, tuple[int, int]] = {}
        node = 256
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            parent[a[2]], parent[b[2]] = (node, 0), (node, 1)
            heapq.heappush(heap, (a[0] + b[0], node, node))
            node += 1
        paths = []
        for k in range(256):
            path = []
            while k in parent:
                k, bit = parent[k]
                path.append((k - 256, bit))
            paths.append(path[::-1])
        self.paths = paths
        self.length = np.array([len(p) for p in paths], dtype=np.int32)
        self.first = np.cumsum(self.length, dtype=np.int32) - self.length
        self.flat_bit = np.array([bit for p in paths for _, bit in p], dtype=np.uint8)
        self.flat_node = np.array([n for p in paths for n, _ in p], dtype=np.uint32) \
            * np.uint32(0x9E3779B1)


def byte_stream(data: np.ndarray, offsets: np.ndarray):
    """Of concatenated texts: the bytes modelled, the place of each in its token, the first byte
    of each token (and the total), the first token of each text (and the total), and the tokens'
    hashes. A token is a word and a space, or the end of a text."""
    starts, ends, first = word_bounds(data, offsets)
    hashes = np.insert(span_hashes(data, starts, ends), first[1:], _END_HASH)
    size = np.insert(ends - starts + 1, first[1:], 1)
    begin = np.insert(starts, first[1:], 0)
    stop = np.cumsum(size)
    place = np.arange(int(size.sum()), dtype=np.int32)
    rank = place - np.repeat((stop - size).astype(np.int32), size)
    place += np.repeat((begin - stop + size).astype(np.int32), size)
    out = LOWER.take(data.take(place, mode="clip")) if len(data) else np.zeros(len(place), np.uint8)
    out[stop - 1] = _SPACE
    token_first = first + np.arange(len(first))
    out[stop[token_first[1:] - 1] - 1] = _END
    return out, rank, np.concatenate([[0], stop]), token_first, hashes


def _powers(n: int, kept: dict = {}) -> list[np.ndarray]:  # noqa: B006
    """The first ``n`` powers of _PRIME and of its inverse; those of a part of usual size are kept."""
    if n > 2 * SLICE_BYTES:
        return [np.cumprod(np.full(n, p, dtype=np.uint32), dtype=np.uint32)
                for p in (_PRIME, pow(_PRIME, -1, 1 << 32))]
    if not kept or len(kept[0]) < n:
        kept.update(enumerate(np.cumprod(np.full(n + n // 8, p, dtype=np.uint32), dtype=np.uint32)
                              for p in (_PRIME, pow(_PRIME, -1, 1 << 32))))
    return [kept[0][:n], kept[1][:n]]


def _contexts(stream: np.ndarray, rank: np.ndarray, text_first: np.ndarray) -> list[np.ndarray]:
    """Context hashes (uint32) of each byte, by table, and last the byte before it; a text
    begins as if after an end."""
    n = len(stream)
    before = []
    for back in range(1, 5):
        b = np.full(n, _END, dtype=np.uint32)
        b[back:] = stream[:-back] if n > back else b[back:]
        for k in range(back):
            at = text_first[:-1] + k
            b[at[at < text_first[1:]]] = _END
        before.append(b)
    one = before[0]
    two = one | (before[1] << np.uint32(8))
    four = two | (before[2] << np.uint32(16)) | (before[3] << np.uint32(24))
    # the word's beginning: a hash of at most PREFIX bytes before this one in the word, the sum of
    # (byte + 1) * _PRIME ** (how far before), which is a difference of running sums modulo 2 ** 32
    up, down = _powers(n)
    sums = np.zeros(n + 1, dtype=np.uint32)
    np.add(stream, np.uint32(1), out=sums[1:])
    sums[1:] *= down
    np.cumsum(sums[1:], dtype=np.uint32, out=sums[1:])
    begin = np.minimum(rank, PREFIX)
    prefix = sums.take(np.subtract(np.arange(n, dtype=np.int32), begin, out=begin))
    np.subtract(sums[:-1], prefix, out=prefix)
    prefix *= up
    prefix += np.minimum(rank, PREFIX + 1).astype(np.uint32) * np.uint32(0x297A2D39)
    return [two, four, prefix, one]


def repeats(stream: np.ndarray, contexts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first of the bytes that are alike in value and contexts, and of each byte which of these
    it is like: such bytes have the same decisions, which need be made once. And what tells these apart."""
    key = (contexts[1].astype(np.uint64) << np.uint64(32)) | contexts[2]
    key ^= stream.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    n = np.arange(len(key), dtype=np.int32)
    at = ((key * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(46)).view(np.int64)
    holder = np.empty(1 << 18, dtype=np.int32)
    holder[at[::-1]] = n[::-1]  # the first that has the place
    like = holder.take(at)
    other = np.flatnonzero(key.take(like) != key)  # bytes whose place another has
    code = pd.factorize(key.take(other))[0]
    like[other] = other[_firsts(code)].astype(np.int32).take(code)
    first = np.flatnonzero(like == n)
    n[first] = np.arange(len(first), dtype=np.int32)
    return first, n.take(like), key.take(first)


def _firsts(code: np.ndarray) -> np.ndarray:
    """Where each code comes first."""
    first = np.empty(int(code.max(initial=-1)) + 1, dtype=np.int64)
    first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    return first


class Bytes:
    """The distinct bytes of texts, and how often they occur; of each byte which of these it is like,
    and the ``layout`` of tokens and texts. Texts are taken in parts of bounded size."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, most: int = SLICE_BYTES,
                 layout: bool = True) -> None:
        parts, ends, texts = [], [0], [0]
        for i, j in slices(offsets, most):
            stream, rank, token_at, token_first, hashes = byte_stream(data[offsets[i]:offsets[j]],
                                                                      offsets[i:j + 1] - offsets[i])
            contexts = _contexts(stream, rank, token_at[token_first])
            first, code, key = repeats(stream, contexts)
            parts.append(([key, stream[first], np.bincount(code), rank[first], *(c[first] for c in contexts)],
                          *((code, token_at[1:] + ends[-1], token_first[1:] + texts[-1], hashes)
                            if layout else [None] * 4)))
            ends.append(ends[-1] + len(code))
            texts.append(texts[-1] + len(hashes))
        found, code, token_at, token_first, hashes = zip(*parts)
        if len(parts) > 1:  # parts have bytes in common
            begin = np.cumsum([0] + [len(x[0]) for x in found])
            found = [np.concatenate(x) for x in zip(*found)]
            like = pd.factorize(found[0])[0]
            first, times = _firsts(like), np.bincount(like, weights=found[2]).astype(np.int64)
            found = [x[first] for x in found]
            found[2], like = times, like.astype(np.int32)
            if layout:
                code = [like[a:b].take(c) for a, b, c in zip(begin, begin[1:], code)]
        else:
            found = found[0]
        self.key, self.stream, self.times, self.rank, *self.contexts = found
        if not layout:
            return
        self.code, self.hashes = np.concatenate(code), np.concatenate(hashes)
        self.token_at, self.token_first = (np.concatenate([[0], *x]) for x in (token_at, token_first))
        self.text_at = self.token_at[self.token_first]


def decisions(stream: np.ndarray, contexts: list[np.ndarray], tree: Tree, chunk: int = _CHUNK):
    """Chunks (first byte, decisions of each byte, table slots by context, bits); the slots are made
    one table at a time."""
    spread = [(c + np.uint32(k)) * np.uint32(0x85EBCA6B) for k, c in enumerate(contexts[:-1])]
    for lo in range(0, len(stream), chunk):
        part = stream[lo:lo + chunk]
        size = tree.length[part]
        first = np.cumsum(size, dtype=np.int32) - size
        at = np.repeat(tree.first[part] - first, size) + np.arange(int(size.sum()), dtype=np.int32)
        node, bit = tree.flat_node.take(at), tree.flat_bit.take(at)
        del at

        def slots(lo=lo, size=size, node=node):
            for k, power in enumerate(tree.powers):
                h = np.repeat(spread[k][lo:lo + chunk], size)
                h ^= node
                h *= np.uint32(0xC2B2AE35)
                h >>= np.uint32(32 - power)
                yield h

        yield lo, size, slots(), bit


def _in_order(key: np.ndarray) -> np.ndarray:
    """np.argsort(key, kind="stable") but for the order of the keys: equal ones come together."""
    bits = np.uint64(max(1, len(key)).bit_length())
    order = np.sort((key >> bits << bits) | np.arange(len(key), dtype=np.uint64))
    order &= (np.uint64(1) << bits) - np.uint64(1)
    found = key.take(order.view(np.int64))
    if np.any((found[1:] != found[:-1]) & (found[1:] >> bits == found[:-1] >> bits)):
        return np.argsort(key, kind="stable")
    return order.view(np.int64)


def token_predictors(hashes: np.ndarray, token_first: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token: its share of the tokens before it in the text, whether it follows as it
    did when the token before it last occurred in the text, and the gate (how far in the text)."""
    n = len(hashes)
    text, place = ragged(np.diff(token_first))
    # one key of text and token: the tokens that are alike in a text need only come together, in order
    key = (hashes ^ (text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    order = _in_order(key)
    same = np.zeros(n, dtype=bool)
    same[1:] = key[order][1:] == key[order][:-1]
    run = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
    earlier = np.empty(n, dtype=np.int64)
    earlier[order] = np.arange(n) - run
    share = earlier / np.maximum(place, 1)
    # the token that came after the last earlier occurrence of the token before this one
    last = np.full(n, -1, dtype=np.int64)
    last[order[1:]] = np.where(same[1:], order[:-1], -1)
    seen = np.full(n, -1, dtype=np.int64)
    seen[1:] = np.where(place[1:] > 0, last[:-1], -1)
    again = (seen >= 0) & (hashes[np.minimum(seen + 1, n - 1)] == hashes)
    gate = np.minimum(np.log2(place + 1).astype(np.int64), _DEPTHS - 1) * 2 + (seen >= 0)
    return share, again.astype(np.float64), gate


_FIRST = np.concatenate([[0], np.cumsum([1 << p for p in TABLES])])


class Counts:
    """Decisions seen in every slot of every table, as one dense array."""

    def __init__(self, powers: tuple[int, ...] = TABLES) -> None:
        self.first = 2 * np.concatenate([[0], np.cumsum([1 << p for p in powers])])
        self.total = np.zeros(int(self.first[-1]), dtype=np.uint32)

    def add(self, data: np.ndarray, offsets: np.ndarray, tree: Tree) -> None:
        if len(offsets) > 1:
            found = Bytes(data, offsets, layout=False)
            self.met(found.stream, found.contexts, found.times, tree)

    def met(self, stream, contexts, times, tree: Tree) -> None:
        times = times.astype(np.uint32)
        for lo, many, slots, bit in decisions(stream, contexts, tree):
            seen = np.repeat(times[lo:lo + _CHUNK], many)
            for k, slot in enumerate(slots):
                np.add.at(self.total[self.first[k]:self.first[k + 1]], 2 * slot.astype(np.int64) + bit, seen)

    def finished(self) -> np.ndarray:
        return self.total


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(text_col).alias("text"), held_out(id_col).alias("held_out"))


def _blocks(total: np.ndarray) -> pa.RecordBatch:
    """Sparse (slot, count) blocks of a dense count array."""
    found = []
    for lo in range(0, len(total), _BLOCK):
        part = total[lo:lo + _BLOCK]
        at = np.flatnonzero(part)
        if len(at):
            found.append((lo // _BLOCK, at.astype(np.uint16).tobytes(), part[at].astype(np.uint32).tobytes()))
    block, slots, counts = zip(*found) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(slots, pa.binary()),
                                       pa.array(counts, pa.binary())], names=["block", "slots", "counts"])


def count_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Staged (bucket, hashes, counts): training counts of all words, in blocks by hash; the
    bucket -1 holds counts of the bytes modelled."""
    buckets = 2 * partitions(docs.sparkSession)

    def scan(batches):
        waiting, held, histogram = [], 0, np.zeros(256, np.int64)

        def blocks():
            value, count = np.unique(np.concatenate(waiting), return_counts=True)
            bucket = (value % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            value, count, bucket = value[order], count[order], bucket[order]
            cut = np.flatnonzero(np.diff(bucket)) + 1
            first = np.concatenate([[0], cut])
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[first], pa.int64()),
                 pa.array([x.tobytes() for x in np.split(value, cut)], pa.binary()),
                 pa.array([x.astype(np.int64).tobytes() for x in np.split(count, cut)],
                          pa.binary())], names=["bucket", "hashes", "counts"])

        for batch in gathered(batches, SLICE_BYTES):
            train = np.flatnonzero(~batch.column(1).to_numpy(zero_copy_only=False))
            data, offsets = buffer_of(batch.column(0).take(pa.array(train)))
            for i, j in slices(offsets, 2 * SLICE_BYTES):
                part, own = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                stream, _, _, _, hashes = byte_stream(part, own)
                histogram += np.bincount(stream, minlength=256)
                waiting.append(hashes)
                held += len(hashes)
                if held >= _FLUSH_TOKENS:
                    yield blocks()
                    waiting, held = [], 0
        if held:
            yield blocks()
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1], pa.int64()), pa.array([np.arange(256, dtype=np.uint64).tobytes()],
                                                  pa.binary()),
             pa.array([histogram.tobytes()], pa.binary())], names=["bucket", "hashes", "counts"])

    def total(table: pa.Table) -> pa.Table:
        value = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table.column("hashes")])
        count = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column("counts")])
        value, where = np.unique(value, return_inverse=True)
        count = np.bincount(where, weights=count, minlength=len(value)).astype(np.int64)
        return pa.table({"bucket": table.column("bucket").slice(0, 1),
                         "hashes": pa.array([value.tobytes()], pa.binary()),
                         "counts": pa.array([count.tobytes()], pa.binary())})

    kind = "bucket long, hashes binary, counts binary"
    return stage(_source(docs, id_col, text_col).mapInArrow(scan, kind)
                 .groupBy("bucket").applyInArrow(total, kind), "words")


def word_totals(words: DataFrame) -> tuple[int, int, dict[int, int]]:
    """(tokens, distinct, {power of two: words whose count has it}) of the training fold."""
    def measure(batches):
        for batch in batches:
            for counts in batch.column(0):
                count = np.frombuffer(counts.as_py(), np.int64)
                power = np.log2(np.maximum(count, 1)).astype(np.int64)
                size = np.bincount(power)
                seen = np.flatnonzero(size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seen), pa.array(size[seen].astype(np.int64)),
                     pa.array(np.bincount(power, weights=count)[seen].astype(np.int64))],
                    names=["power", "words", "tokens"])

    rows = (words.where("bucket >= 0").select("counts")
            .mapInArrow(measure, "power long, words long, tokens long")
            .groupBy("power").agg(F.sum("words").alias("words"), F.sum("tokens").alias("tokens"))
            .collect())
    return (sum(r.tokens for r in rows), sum(r.words for r in rows),
            {r.power: r.words for r in rows})


def frequent_words(words: DataFrame, tokens: int, powers: dict[int, int]) -> Unigram:
    """All words of at least a certain count, at most FREQUENT of them."""
    least, held = 63, 0
    while least > 0 and held + powers.get(least - 1, 0) <= FREQUENT:
        least -= 1
        held += powers.get(least, 0)

    def pick(batches):
        for batch in batches:
            for hashes, counts in zip(batch.column(0), batch.column(1)):
                value = np.frombuffer(hashes.as_py(), np.uint64)
                count = np.frombuffer(counts.as_py(), np.int64)
                at = count >= 1 << least
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[at].view(np.int64)), pa.array(count[at])], names=["h", "c"])

    found = (words.where("bucket >= 0").select("hashes", "counts")
             .mapInArrow(pick, "h long, c long").toArrow())
    value = found.column("h").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(value)
    return Unigram(tokens, value[order], found.column("c").to_numpy()[order])


def context_tables(texts: DataFrame, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """All tables' predictions (logits, quantised to int8) and the counts behind them (coded, no and
    yes of each slot), from every training text."""
    shared = texts.sparkSession.sparkContext.broadcast(tree)

    def scan(batches):
        tree, total = shared.value, Counts(shared.value.powers)
        for batch in gathered(batches, 2 * SLICE_BYTES):
            data, offsets = buffer_of(batch.column(0))
            for i, j in slices(offsets, 2 * SLICE_BYTES):
                part, own = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                total.add(part, own, tree)
        yield _blocks(total.finished())

    def merge(table: pa.Table) -> pa.Table:
        total = np.zeros(_BLOCK, dtype=np.float64)
        for slots, counts in zip(table.column("slots"), table.column("counts")):
            total[np.frombuffer(slots.as_py(), np.uint16)] += np.frombuffer(counts.as_py(),
                                                                          np.uint32)
        return pa.table({"block": table.column("block").slice(0, 1),
                         "logits": pa.array([logits(total[0::2], total[1::2]).tobytes()], pa.binary()),
                         "seen": pa.array([coded(total).tobytes()], pa.binary())})

    found = stage(texts.mapInArrow(scan, "block long, slots binary, counts binary")
                  .groupBy("block").applyInArrow(merge, "block long, logits binary, seen binary"), "tables")
    tables = np.zeros(int(tree.table_first[-1]), dtype=np.int8)
    seen = np.zeros((len(tables), 2), dtype=np.uint8)
    for r in found.toLocalIterator():
        lo = r.block * (_BLOCK // 2)
        tables[lo:lo + _BLOCK // 2] = np.frombuffer(r.logits, np.int8)
        seen[lo:lo + _BLOCK // 2] = np.frombuffer(r.seen, np.uint8).reshape(-1, 2)
    return tables, seen


class Mixer:
    """Gated logistic mixing of the tables' predictions, and its adaptive refinement."""

    #: What is learned, in this order, each under what was learned before.
    LESSONS = ("weights", "refinement", "shares")

    def __init__(self, tree: Tree, tables: np.ndarray | None = None) -> None:
        self.tree, self.tables, self.seen, self.kept = tree, [], [], None
        #: Bytes of the slices that are left out of the counts which predict them.
        self.slice = 2 * SLICE_BYTES
        if tables is not None:
            self.attach(tables)
        self.weights = np.full((len(tree.powers), _GATES), 0.35 / _SCALE, dtype=np.float32)
        #: Shares of the unigram, the text's own words, its own sequences and the bytes, by gate.
        self.shares = np.tile([0.2, 0.1, 0.1, 0.6], (2 * _DEPTHS, 1))
        self.take("refinement", np.zeros(2 * 256 * _BUCKETS))

    def attach(self, tables: np.ndarray) -> Mixer:
        first = self.tree.table_first
        self.tables = [tables[first[k]:first[k + 1]] for k in range(len(self.tree.powers))]
        self.kept = None
        return self

    def keep(self) -> Mixer:
        """What bytes cost is kept from here on, the last of those that share a place."""
        self.kept = np.zeros(1 << _KEPT, dtype=np.uint64), np.full(1 << _KEPT, np.nan, dtype=np.float32)
        return self

    def attach_seen(self, seen: np.ndarray) -> Mixer:
        """Counts in place of predictions: texts that are counted there are predicted without them."""
        first = self.tree.table_first
        self.seen = [seen[first[k]:first[k + 1]] for k in range(len(self.tree.powers))]
        return self

    def _inputs(self, slots):
        return [t.take(s) for t, s in zip(self.tables, slots)]

    def _inputs_apart(self, slots, bit, times):
        """Inputs of decisions that occur so many ``times`` in a slice, without the slice's counts."""
        inputs = []
        for seen, slot in zip(self.seen, slots):
            if len(seen) > len(slot):  # only the slots that occur
                slot, distinct = pd.factorize(slot, size_hint=len(slot) // 2)
                seen = seen.take(distinct, axis=0)
            at = slot.astype(np.int64, copy=False)
            at *= 2
            at += bit
            rest = _COUNTS.take(seen.ravel())
            rest -= np.bincount(at, weights=times, minlength=len(rest))
            at >>= 1
            np.maximum(rest, 0, out=rest)
            inputs.append(logits(rest[0::2], rest[1::2]).take(at))
        return inputs

    def _decided_at_length(self, stream, contexts, times):
        """As _decided, where the decisions are too many to hold: the slice's counts are dense."""
        own = Counts(self.tree.powers)
        own.met(stream, contexts, times, self.tree)
        for lo, many, slots, bit in decisions(stream, contexts, self.tree):
            inputs = []
            for k, slot in enumerate(slots):
                rest = _COUNTS.take(self.seen[k].take(slot, axis=0))
                rest -= own.total[own.first[k]:own.first[k + 1]].reshape(-1, 2).take(slot, axis=0)
                np.maximum(rest, 0, out=rest)
                inputs.append(logits(rest[:, 0], rest[:, 1]))
            yield lo, many, inputs, bit

    def _decided(self, stream, contexts, times):
        """Chunks (first byte, decisions of each byte, inputs by table, bits) of bytes that occur so
        many ``times`` in a slice; apart from the slice's counts, if it is in the counts."""
        if not self.seen:
            for lo, many, slots, bit in decisions(stream, contexts, self.tree):
                yield lo, many, self._inputs(slots), bit
            return
        if len(stream) > _HELD:
            yield from self._decided_at_length(stream, contexts, times)
            return
        for _, many, slots, bit in decisions(stream, contexts, self.tree, max(1, len(stream))):
            inputs = self._inputs_apart(slots, bit, np.repeat(times.astype(np.float64), many))
            first = np.cumsum(many) - many
            for lo in range(0, len(stream), _CHUNK):
                i, j = first[lo], first[lo + _CHUNK] if lo + _CHUNK < len(stream) else len(bit)
                yield lo, many[lo:lo + _CHUNK], [x[i:j] for x in inputs], bit[i:j]

    @staticmethod
    def _gate(rank):
        """The gate of each byte's decisions where the last context is not known."""
        return (np.minimum(rank, _GATES // 2 - 1) * 2).astype(np.uint8)

    @staticmethod
    def _bucket(total):
        return np.clip(total * np.float32(_STEP) + np.float32(_BUCKETS // 2), 0,
                       np.float32(_BUCKETS - 0.5)).astype(np.int32)

    def learn(self, texts: list[str | None], unigram: Unigram) -> None:
        """All lessons, from one piece."""
        data, offsets = buffer_of(pa.array(texts, pa.large_string()))
        for lesson in self.LESSONS:
            self.take(lesson, self.gather(lesson, data, offsets, unigram))

    def gather(self, lesson: str, data: np.ndarray, offsets: np.ndarray, unigram: Unigram) -> np.ndarray:
        """What a piece of text contributes to a lesson: sums, to be added over the pieces."""
        parts = [(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                 for i, j in slices(offsets, min(self.slice, SLICE_BYTES // 2))]
        return {"weights": self._steps, "refinement": self._outcomes,
                "shares": lambda parts: self._contributions(parts, unigram)}[lesson](parts)

    def take(self, lesson: str, sums: np.ndarray) -> None:
        """Learn from the sums of all pieces."""
        if lesson == "weights":
            seen = sums[-_GATES:]
            mean = sums[:-_GATES].reshape(self.weights.shape) / np.maximum(seen, 1)
            self.weights = np.where(seen > 0, np.round(mean, 9), self.weights).astype(np.float32)
        elif lesson == "refinement":
            seen, ones = sums.reshape(2, 256, _BUCKETS)
            grid = 1 / (1 + np.exp(-(np.arange(_BUCKETS) - _BUCKETS // 2 + 0.5) / _STEP))
            p = np.clip((ones + 50 * grid) / (seen + 50), 1e-6, 1 - 1e-6)
            self.cost = np.log10(np.stack([1 - p, p], axis=-1)).astype(np.float32).ravel()
        else:
            summed = np.round(sums.reshape(2 * _DEPTHS, 4), 6) + [0.2, 0.1, 0.1, 1.0]
            self.shares = summed / summed.sum(axis=1, keepdims=True)

    def _mixed(self, parts):
        """Of each chunk of decisions: inputs by table, gates, bytes before, bits."""
        for data, offsets in parts:
            found = Bytes(data, offsets)
            last, place = found.contexts[-1].astype(np.int64), self._gate(found.rank)
            chunks = list(self._decided(found.stream, found.contexts, found.times))
            if not chunks:
                continue
            many, bits = (np.concatenate([c[k] for c in chunks]) for k in (1, 3))
            distinct = [np.concatenate(x) for x in zip(*(c[2] for c in chunks))]
            begin = np.cumsum(many) - many
            for lo in range(0, len(found.code), _CHUNK):
                part = found.code[lo:lo + _CHUNK]
                size = many[part]
                at = np.repeat(begin[part], size) + ragged(size)[1]
                inputs = np.stack([x[at].astype(np.float32) for x in distinct])
                gate = np.repeat(place[part], size) | (inputs[-1] != 0)
                yield inputs, gate, np.repeat(last[part], size), bits[at]

    def _steps(self, parts, step: int = 512) -> np.ndarray:
        """One online pass from the weights at hand: small batches in order, updated after each. The
        weights reached, times the decisions under each gate; then these."""
        weights, number, seen = self.weights.astype(np.float64), 0, np.zeros(_GATES)
        for inputs, gate, _, bit in self._mixed(parts):
            seen += np.bincount(gate, minlength=_GATES)
            for a in range(0, len(bit), step):
                x, g, y = inputs[:, a:a + step], gate[a:a + step], bit[a:a + step]
                total = (weights[:, g] * x).sum(axis=0)
                error = y - 1 / (1 + np.exp(-np.clip(total, -20, 20)))
                number += 1
                rate = 0.02 / _SCALE ** 2 / (1 + number / 2000)
                for k in range(len(x)):
                    weights[k] += rate * np.bincount(g, weights=error * x[k], minlength=_GATES)
        return np.concatenate([(weights * seen).ravel(), seen])

    def _outcomes(self, parts) -> np.ndarray:
        """Decisions and ones by the byte before and the prediction's bucket."""
        size = 256 * _BUCKETS
        sums = np.zeros((2, size))
        for inputs, gate, before, bit in self._mixed(parts):
            where = before * _BUCKETS + self._bucket((self.weights[:, gate] * inputs).sum(axis=0))
            sums[0] += np.bincount(where, minlength=size)
            sums[1] += np.bincount(where, weights=bit, minlength=size)
        return sums.ravel()

    def _contributions(self, parts, unigram: Unigram) -> np.ndarray:
        """Tokens that each predictor accounts for, by gate (expectation maximisation). A token is
        not counted among the training tokens that predict it."""
        rows = [self._predictions(data, offsets, unigram, apart=True)[:2] for data, offsets in parts]
        if not rows:
            return np.zeros(2 * _DEPTHS * 4)
        predicted, gate = (np.concatenate(x) for x in zip(*rows))
        shares = self.shares
        for _ in range(20):
            part = predicted + np.log10(shares)[gate]
            part = np.power(10.0, part - part.max(axis=1, keepdims=True))
            part /= part.sum(axis=1, keepdims=True)
            summed = np.stack([np.bincount(gate, weights=part[:, k], minlength=2 * _DEPTHS)
                               for k in range(4)], axis=1)
            shares = summed + [0.2, 0.1, 0.1, 1.0]
            shares /= shares.sum(axis=1, keepdims=True)
        return summed.ravel()

    def _predictions(self, data, offsets, unigram, apart=False, lesson=None):
        """(log10 probabilities by the four predictors, gate) of each token, and the texts' layout;
        a token may be so long that its probability is less than any number above 0. A ``lesson``
        is shown every decision."""
        found = Bytes(data, offsets)
        if self.kept is None or lesson is not None:
            per_byte = self._costs(found.stream, found.contexts, found.rank, found.times, lesson)
        else:
            keys, costs = self.kept
            at = (found.key * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _KEPT)
            per_byte = costs.take(at)
            new = np.flatnonzero((keys.take(at) != found.key) | np.isnan(per_byte))
            per_byte[new] = self._costs(found.stream[new], [c[new] for c in found.contexts], found.rank[new],
                                        found.times[new])
            keys[at[new]], costs[at[new]] = found.key[new], per_byte[new]
        spelled = np.add.reduceat(per_byte.take(found.code), found.token_at[:-1], dtype=np.float64)
        hashes = found.hashes
        share, again, gate = token_predictors(hashes, found.token_first)
        seen = unigram.counts(hashes)
        counted = np.maximum(seen - 1, 0) if apart else seen
        with np.errstate(divide="ignore"):
            shares = np.log10(np.stack([counted / max(1, unigram.tokens), share, again], axis=1))
        return (np.concatenate([shares, spelled[:, None]], axis=1), gate, seen, found.token_first,
                np.diff(found.text_at), hashes)

    def _costs(self, stream, contexts, rank, times, lesson=None) -> np.ndarray:
        """log10 probabilities of distinct bytes."""
        before, place = contexts[-1].astype(np.int32) * _BUCKETS, self._gate(rank)
        per_byte = np.empty(len(stream), dtype=np.float32)
        for lo, many, inputs, bit in self._decided(stream, contexts, times):
            gate = np.repeat(place[lo:lo + _CHUNK], many) | (inputs[-1] != 0)
            total = self.weights[0].take(gate) * inputs[0]
            for w, x in zip(self.weights[1:], inputs[1:]):
                total += w.take(gate) * x
            where = (np.repeat(before[lo:lo + _CHUNK], many) + self._bucket(total)) * 2 + bit
            per_byte[lo:lo + len(many)] = np.add.reduceat(self.cost.take(where), np.cumsum(many) - many)
            if lesson is not None:
                lesson.meet(inputs, gate, total, where, bit,
                            np.repeat(times[lo:lo + _CHUNK].astype(np.float32), many))
        return per_byte

    def scores(self, data: np.ndarray, offsets: np.ndarray, unigram):
        """Of each text: log10 probability and modelled bytes; and its tokens' counts, the first
        token of each text, the tokens' hashes, and the log10 of how much a token's probability
        would grow, were its word's share of the training tokens 1 instead of 0."""
        predicted, gate, seen, token_first, size, hashes = self._predictions(data, offsets, unigram)
        parts = [predicted[:, k] + share[gate] for k, share in enumerate(np.log10(self.shares).T)]
        most = np.maximum(np.maximum(parts[0], parts[1]), np.maximum(parts[2], parts[3]))
        mixed = most + np.log10(sum(np.power(10.0, part - most) for part in parts))
        growth = np.log10(self.shares[:, 0])[gate] - mixed
        return np.add.reduceat(mixed, token_first[:-1]), size, seen, token_first, hashes, growth


class Course:
    """One online pass over texts, from what a mixer has learned: each decision and each token is
    predicted without the text's slice, then learned from."""

    def __init__(self, mixer: Mixer) -> None:
        self.mixer = copy.copy(mixer)
        self.weights = mixer.weights.astype(np.float64)
        self.curve, self.decided = np.full(self.weights.shape, 1e5), np.zeros(_GATES)
        self.outcomes, self.tokens = np.zeros((2, 256 * _BUCKETS)), np.zeros((2 * _DEPTHS, 4))

    def meet(self, inputs, gate, total, where, bit, times) -> None:
        """Decisions that occur so many ``times``: the outcomes are counted, then the weights make a
        step against their error, the smaller the more was met."""
        p = 1 / (1 + np.exp(-np.clip(total, -20, 20)))
        error, slope = (bit - p) * times, p * (1 - p) * times
        gate = gate.astype(np.int64)
        self.decided += np.bincount(gate, weights=times, minlength=_GATES)
        no, yes = np.bincount(where, weights=times, minlength=2 * 256 * _BUCKETS).reshape(-1, 2).T
        self.outcomes += [no + yes, yes]
        for k, x in enumerate(inputs):
            curve = np.bincount(gate, weights=slope * x * x, minlength=_GATES)
            self.curve[k] += curve
            self.weights[k] += np.bincount(gate, weights=error * x, minlength=_GATES) \
                / (len(inputs) * (self.curve[k] + 8 * curve))
        self.mixer.weights = self.weights.astype(np.float32)

    def texts(self, data: np.ndarray, offsets: np.ndarray, unigram: Unigram):
        """A slice of texts. Of each token that is not frequent, what ``by_training_share`` needs, after
        its hash."""
        predicted, gate, seen, _, _, hashes = self.mixer._predictions(data, offsets, unigram, True, self)
        shares = np.log10(self.mixer.shares)
        predicted = predicted[:, 1:] + shares[gate, 1:]
        most = predicted.max(axis=1, keepdims=True)
        part = np.power(10.0, predicted - most)
        whole = part.sum(axis=1)
        part /= whole[:, None]
        self.tokens[:, 1:] += np.stack([np.bincount(gate, weights=x, minlength=2 * _DEPTHS) for x in part.T], axis=1)
        rest = most[:, 0] + np.log10(whole) - shares[gate, 0]
        tokens = [gate.astype(np.uint8), *(x.astype(np.float32) for x in (rest, part[:, 0], part[:, 1]))]
        rare, frequent = np.flatnonzero(seen == 0), np.flatnonzero(seen)
        self.tokens += by_training_share(seen[frequent], unigram.tokens, *(x[frequent] for x in tokens))
        return hashes[rare], *(x[rare] for x in tokens)

    def sums(self) -> list[np.ndarray]:
        """What was learned, by lesson, to be added over the tasks; outcomes in parts."""
        return [np.concatenate([(self.weights * self.decided).ravel(), self.decided]), self.tokens.ravel(),
                *np.split(self.outcomes.ravel(), range(4096, self.outcomes.size, 4096))]


def by_training_share(seen, total, gate, rest, own, sequence) -> np.ndarray:
    """How tokens that occur ``seen`` times of the ``total`` training tokens change what each predictor
    accounts for, by gate; a token is not counted among those that predict it. ``rest``: log10 of its
    probability by the other predictors over this one's share; ``own``, ``sequence``: the parts of it
    that the text's own words and sequences have."""
    with np.errstate(divide="ignore", over="ignore"):
        share = np.log10(np.maximum(seen - 1, 0) / max(1, total))
        part = 1 / (1 + np.power(10.0, rest - share))
    return np.stack([np.bincount(gate, weights=part * x, minlength=2 * _DEPTHS)
                     for x in (np.ones(len(gate)), -own, -sequence, own.astype(np.float64) + sequence - 1)], axis=1)


class Unigram:
    """Counts of the frequent words, of ``tokens`` training tokens."""

    def __init__(self, tokens: int, value: np.ndarray, count: np.ndarray) -> None:
        self.tokens, self.value, self.count = tokens, value, count

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """The count of each word; 0 for words that are not frequent."""
        if not len(self.value):
            return np.zeros(len(hashes), dtype=np.int64)
        where, distinct = pd.factorize(hashes)
        at = np.searchsorted(self.value, distinct)
        at[at == len(self.value)] = 0
        return np.where(self.value[at] == distinct, self.count[at], 0)[where]


def added_up(rows: DataFrame) -> np.ndarray | None:
    """The sum of arrays (part, sums), which come in parts: added in each task, then by part."""
    def within(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
                total[part] = total.get(part, 0) + np.frombuffer(sums.as_py(), np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
            names=["part", "sums"])

    def across(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x.as_py(), np.float64) for x in table.column("sums")], axis=0)
        return pa.table({"part": table.column("part").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    kind = "part long, sums binary"
    found = rows.mapInArrow(within, kind).groupBy("part").applyInArrow(across, kind).collect()
    parts = [np.frombuffer(r.sums, np.float64) for r in sorted(found, key=lambda r: r.part)]
    return np.concatenate(parts) if parts else None


def piece_words(tuning: DataFrame, words: DataFrame) -> DataFrame:
    """Staged (piece, hashes, counts): the training counts of all words of each piece of ``tuning``
    (piece, text), where they meet in the words' buckets."""
    buckets = 2 * partitions(tuning.sparkSession)

    def distinct(table: pa.Table) -> pa.Table:
        data, offsets = buffer_of(table.column("text").combine_chunks())
        value = np.unique(np.concatenate([byte_stream(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])[4]
                                          for i, j in slices(offsets, SLICE_BYTES)]))
        bucket = (value % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.flatnonzero(np.diff(bucket[order])) + 1
        first = np.concatenate([[0], cut])
        return pa.table({"piece": pa.array(np.full(len(first), table.column("piece")[0].as_py())),
                         "bucket": pa.array(bucket[order][first]),
                         "hashes": pa.array([x.tobytes() for x in np.split(value[order], cut)], pa.binary())})

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        value = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in right.column("hashes")]
                               or [np.zeros(0, np.uint64)])
        count = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in right.column("counts")]
                               or [np.zeros(0, np.int64)])
        order = np.argsort(value)
        known = Unigram(0, value[order], count[order])
        return pa.table({"piece": left.column("piece"), "hashes": left.column("hashes"),
                         "counts": pa.array([known.counts(np.frombuffer(x.as_py(), np.uint64)).tobytes()
                                             for x in left.column("hashes")], pa.binary())})

    wanted = tuning.groupBy("piece").applyInArrow(distinct, "piece long, bucket long, hashes binary")
    return stage(wanted.groupBy("bucket").cogroup(words.where("bucket >= 0").groupBy("bucket"))
                 .applyInArrow(meet, "piece long, hashes binary, counts binary"), "piece_words")


def contributions(tuning: DataFrame, counted: DataFrame, tokens: int, lesson: str, state, seen
                  ) -> np.ndarray | None:
    """What the pieces of ``tuning`` contribute to a lesson, added up; ``counted``: their words;
    ``state`` (a mixer) and ``seen`` (counts) are broadcasts."""
    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = left.sort_by("text").column("text").combine_chunks()
        value, count = (np.frombuffer(b"".join(right.column(c).to_pylist()), kind)
                        for c, kind in (("hashes", np.uint64), ("counts", np.int64)))
        order = np.argsort(value)
        sums = state.value.attach_seen(seen.value).gather(lesson, *buffer_of(texts),
                                                          Unigram(tokens, value[order], count[order]))
        cut = [x.tobytes() for x in np.split(sums, range(4096, len(sums), 4096))]
        return pa.table({"part": pa.array(range(len(cut)), pa.int64()), "sums": pa.array(cut, pa.binary())})

    return added_up(tuning.groupBy("piece").cogroup(counted.groupBy("piece"))
                    .applyInArrow(gather, "part long, sums binary"))


def tuned(mixer: Mixer, seen, tuning: DataFrame, words: DataFrame, tokens: int) -> Mixer:
    """``mixer``, with all lessons learned from ``tuning``, each in one pass."""
    counted = piece_words(tuning, words)
    for lesson in mixer.LESSONS:
        state = tuning.sparkSession.sparkContext.broadcast(mixer)
        sums = contributions(tuning, counted, tokens, lesson, state, seen)
        if sums is not None:
            mixer.take(lesson, sums)
    return mixer


def taught(mixer: Mixer, seen, texts: DataFrame, words: DataFrame, unigram: Unigram) -> Mixer:
    """``mixer``, with all lessons learned from all ``texts`` in one pass: each task takes its texts in
    their order. Tokens that are not frequent meet their counts in the words' buckets; the lessons' sums
    come to buckets below 0."""
    buckets = 2 * partitions(texts.sparkSession)
    shared = texts.sparkSession.sparkContext.broadcast((mixer, unigram))
    tokens = unigram.tokens
    kinds = (np.uint64, np.uint8, np.float32, np.float32, np.float32)
    names = ["bucket", "sums", "hashes", "gates", "rest", "own", "sequence"]
    kind = "bucket long, sums binary, " + ", ".join(f"{n} binary" for n in names[2:])

    def scan(batches):
        mixer, unigram = shared.value
        course, waiting, held = Course(mixer), [], 0
        course.mixer.attach_seen(seen.value)

        def rare():
            columns = [np.concatenate(x) for x in zip(*waiting)]
            bucket = (columns[0] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.diff(bucket[order])) + 1
            first = bucket[order][np.concatenate([[0], cut])]
            return pa.RecordBatch.from_arrays(
                [pa.array(first), pa.nulls(len(first), pa.binary())]
                + [pa.array([x.tobytes() for x in np.split(c[order], cut)], pa.binary()) for c in columns],
                names=names)

        for batch in gathered(batches, 2 * SLICE_BYTES):
            data, offsets = buffer_of(batch.column(0))
            for i, j in slices(offsets, mixer.slice):
                found = course.texts(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], unigram)
                if len(found[0]):
                    waiting.append(found)
                    held += len(found[0])
                if held >= _FLUSH_TOKENS // 4:
                    yield rare()
                    waiting, held = [], 0
        if held:
            yield rare()
        sums = course.sums()
        yield pa.RecordBatch.from_arrays(
            [pa.array(-1 - np.arange(len(sums))), pa.array([x.tobytes() for x in sums], pa.binary())]
            + [pa.nulls(len(sums), pa.binary())] * 5, names=names)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return pa.table({"place": pa.array([], pa.int64()), "value": pa.array([], pa.float64())})
        bucket = left.column("bucket")[0].as_py()
        if bucket < 0:
            part, sums = -1 - bucket, np.sum([np.frombuffer(x.as_py(), np.float64)
                                              for x in left.column("sums")], axis=0)
        else:
            value, count = (np.frombuffer(b"".join(right.column(c).to_pylist()), kind)
                            for c, kind in (("hashes", np.uint64), ("counts", np.int64)))
            order = np.argsort(value)
            known = Unigram(tokens, value[order], count[order])
            part, sums = 1, np.zeros((2 * _DEPTHS, 4))
            for row in zip(*(left.column(n) for n in names[2:])):
                hashes, *token = (np.frombuffer(x.as_py(), kind) for x, kind in zip(row, kinds))
                sums += by_training_share(known.counts(hashes), tokens, *token)
        return pa.table({"place": pa.array(first[part] + np.arange(sums.size)), "value": pa.array(sums.ravel())})

    first = np.cumsum([0] + [x.size for x in Course(mixer).sums()])
    found = (texts.mapInArrow(scan, kind).groupBy("bucket")
             .cogroup(words.where("bucket >= 0").groupBy("bucket"))
             .applyInArrow(meet, "place long, value double")
             .groupBy("place").agg(F.sum("value").alias("value")).toArrow())
    sums = np.zeros(first[-1])
    sums[found.column("place").to_numpy()] = found.column("value").to_numpy()
    if sums.any():
        weights, shares = (len(mixer.tree.powers) + 1) * _GATES, 2 * _DEPTHS * 4
        mixer.take("weights", sums[:weights])
        mixer.take("refinement", sums[weights + shares:])
        mixer.take("shares", sums[weights:weights + shares])
    return mixer


def score_texts(docs: DataFrame, mixer: Mixer, tables, unigram: Unigram, distinct: int, id_col: str,
                text_col: str) -> tuple[DataFrame, float]:
    """Staged rows: one per text with what is known of it, and blocks (bucket, hashes, refs, growth)
    of rare words."""
    buckets = 2 * partitions(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((mixer, unigram))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                         held_out(id_col).alias("held_out"))
    bottom = np.log10(unigram.tokens + 0.5 * (distinct + 1))
    names = ["id", "held_out", "row", "n_tokens", "known", "base", "score", "modelled", "bucket",
             "hashes", "refs", "growth"]
    id_type = source.schema["id"].dataType.simpleString()

    def scan(batches):
        mixer, unigram = shared.value
        mixer.attach(tables.value).keep()
        row, arrow_id = TaskContext.get().partitionId() << 40, pa.null()
        waiting, held = [], 0

        def rare():
            hashes, refs, growth = (np.concatenate(x) for x in zip(*waiting))
            bucket = (hashes % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            hashes, refs, growth, bucket = hashes[order], refs[order], growth[order], bucket[order]
            cut = np.flatnonzero(np.diff(bucket)) + 1
            first = np.concatenate([[0], cut])
            m = len(first)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(m, arrow_id), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.int64()),
                 pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()),
                 pa.nulls(m, pa.float64()), pa.nulls(m, pa.int64()),
                 pa.array(bucket[first], pa.int64()),
                 pa.array([x.tobytes() for x in np.split(hashes, cut)], pa.binary()),
                 # the first text's number, then how far on each text is
                 pa.array([x[:1].tobytes() + (x - x[0]).astype(np.uint32).tobytes()
                           for x in np.split(refs, cut)], pa.binary()),
                 pa.array([x.tobytes() for x in np.split(growth, cut)], pa.binary())], names=names)

        for batch in gathered(batches, SLICE_BYTES):
            arrow_id = batch.column(0).type
            data, offsets = buffer_of(batch.column(1))
            for i, j in slices(offsets, SLICE_BYTES):
                part, own = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                m = j - i
                score, size, seen, token_first, hashes, growth = mixer.scores(part, own, unigram)
                text = np.repeat(np.arange(m), np.diff(token_first))
                found = seen > 0
                base = np.bincount(text[found], weights=np.log10(seen[found] + 0.5),
                                   minlength=m).astype(np.float64)  # without a known word: integers
                known = np.bincount(text[found], minlength=m)
                if not found.all():
                    waiting.append((hashes[~found], row + text[~found], growth[~found]))
                    held += int((~found).sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, m), batch.column(2).slice(i, m),
                     pa.array(row + np.arange(m)), pa.array(np.diff(token_first)),
                     pa.array(known.astype(np.int64)), pa.array(base), pa.array(score),
                     pa.array(size.astype(np.int64)), pa.nulls(m, pa.int64()),
                     *[pa.nulls(m, pa.binary())] * 3], names=names)
                row += m
                if held >= _FLUSH_TOKENS // 4:
                    yield rare()
                    waiting, held = [], 0
        if held:
            yield rare()

    return stage(source.mapInArrow(
        scan, f"id {id_type}, held_out boolean, row long, n_tokens long, known long, base double, "
              "score double, modelled long, bucket long, hashes binary, refs binary, "
              "growth binary"), "scored"), bottom


def resolve_rare(scored: DataFrame, words: DataFrame, tokens: int) -> DataFrame:
    """(row, more_base, more_known, more_score): what rare words add to each text, where they meet
    their counts; buckets send it on in packed blocks of texts."""
    blocks = partitions(words.sparkSession)
    packed = {"block": pa.int64(), "rows": pa.binary(), "base": pa.binary(), "known": pa.binary(),
              "score": pa.binary()}

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return pa.table({name: pa.array([], kind) for name, kind in packed.items()})
        hashes = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in left.column("hashes")])
        refs = np.concatenate([np.frombuffer(x.as_py()[:8], np.int64)
                               + np.frombuffer(x.as_py()[8:], np.uint32) for x in left.column("refs")])
        growth = np.concatenate([np.frombuffer(x.as_py(), np.float64) for x in left.column("growth")])
        count = np.zeros(len(hashes), dtype=np.int64)
        for h, c in zip(right.column("hashes"), right.column("counts")):
            value, total = np.frombuffer(h.as_py(), np.uint64), np.frombuffer(c.as_py(), np.int64)
            at = np.searchsorted(value, hashes)
            at[at == len(value)] = 0
            count += np.where(value[at] == hashes, total[at], 0)
        row, where = np.unique(refs, return_inverse=True)
        with np.errstate(divide="ignore"):  # log10 of 1 + 10 ** growth * share
            more = np.logaddexp(0, np.log(10) * growth + np.log(count / max(1, tokens))) / np.log(10)
        # texts that are neighbours go to one block
        block = (((row >> 10).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) \
            .astype(np.int64) % blocks
        order = np.argsort(block, kind="stable")
        cut = np.flatnonzero(np.diff(block[order])) + 1
        columns = [row, np.bincount(where, weights=np.log10(count + 0.5), minlength=len(row)),
                   np.bincount(where, weights=count > 0, minlength=len(row)),
                   np.bincount(where, weights=more, minlength=len(row))]
        return pa.table([pa.array(block[order][np.concatenate([[0], cut])])] + [
            pa.array([x.tobytes() for x in np.split(c[order], cut)], pa.binary()) for c in columns],
            names=list(packed))

    def add(table: pa.Table) -> pa.Table:
        # the buckets' blocks in one order, so that sums do not depend on their arrival
        table = table.sort_by([("rows", "ascending"), ("base", "ascending"), ("score", "ascending")])
        refs, base, known, score = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (
            ("rows", np.int64), ("base", np.float64), ("known", np.float64), ("score", np.float64)))
        row, where = np.unique(refs, return_inverse=True)
        base, known, score = (np.bincount(where, weights=x, minlength=len(row)) for x in (base, known, score))
        return pa.table({"row": pa.array(row), "more_base": pa.array(base),
                         "more_known": pa.array(known.astype(np.int64)), "more_score": pa.array(score)})

    rare = scored.where(F.col("row").isNull()).select("bucket", "hashes", "refs", "growth")
    return (rare.groupBy("bucket").cogroup(words.where("bucket >= 0").groupBy("bucket"))
            .applyInArrow(meet, "block long, rows binary, base binary, known binary, score binary")
            .groupBy("block").applyInArrow(add, "row long, more_base double, more_known long, more_score double"))


def context_mixing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    words = count_words(docs, id_col, text_col)
    tokens, distinct, powers = word_totals(words)
    histogram = np.zeros(256, dtype=np.int64)
    for r in words.where("bucket = -1").collect():
        histogram[np.frombuffer(r.hashes, np.uint64).astype(int)] += np.frombuffer(r.counts, np.int64)
    tree = Tree(histogram, table_powers(distinct))
    texts = docs.where(~held_out(id_col)).select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tables, seen = map(docs.sparkSession.sparkContext.broadcast, context_tables(texts, tree))
    unigram = frequent_words(words, tokens, powers)
    share = min(1 / 8, max(1 / TUNING, LEAST / max(1, texts.count())))
    pieces = max(1, int(histogram.sum() * share) // PIECE)
    tuning = stage(texts.where(tunes(F.col("text"), share)).distinct()
                   .select(F.pmod(F.xxhash64(F.lit("piece"), "text"), F.lit(pieces)).alias("piece"), "text"),
                   "tuning")
    mixer = Mixer(tree)
    mixer.slice = int(min(mixer.slice, max(1 << 12, histogram.sum() // APART)))
    mixer = taught(tuned(mixer, seen, tuning, words, tokens), seen, texts, words, unigram)
    scored, bottom = score_texts(docs, mixer, tables, unigram, distinct, id_col, text_col)
    rare = stage(resolve_rare(scored, words, tokens), "rare")
    known = F.col("known") + F.coalesce("more_known", F.lit(0))
    score = F.col("score") + F.coalesce("more_score", F.lit(0.0))
    return (scored.where(F.col("row").isNotNull()).hint("merge").join(rare, "row", "left")
            .select(F.col("id").alias(id_col), "held_out", "n_tokens", known.alias("n_known"),
                    F.lit(tokens).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("more_base", F.lit(0.0))
                     - F.col("n_tokens") * float(bottom)).alias("base_score"),
                    score.alias("score"), (-score / float(np.log10(2)) / F.col("modelled"))
                    .alias("bits_per_byte")))
