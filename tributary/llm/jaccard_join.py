"""Exact n-gram Jaccard join in the metric space of shingle sets (operator 1).

The Jaccard distance d(x, y) = 1 - |x & y| / |x | y| is a metric on sets. The
join finds all d <= 1 - threshold, in regions:

* identical sets are one point (a class), represented by its smallest id;
* pivots are single shingles. A set is at distance 1 - 1/|x| of the pivots it
  contains and 1 of all others; its Voronoi region is the first pivot it
  contains in one global order (rare pivots first: the most frequent shingles,
  found by bounded per-task counts, come last);
* a set within the threshold of x misses at most |x| - ceil(t |x|) elements of
  x, so it contains one of x's first |x| - ceil(t |x|) + 1 pivots. That is the
  window: x is replicated to those regions only, and no link is lost, whatever
  the order of pivots;
* sizes give a second window: |x| and |y| differ at most by the factor t; and
  the place of a pivot in x's order a third one: the first pivot that x and y
  share at place p leaves at most |x| - p common elements, which bounds |y|.
  Members that reach no other one of their region by these leave it;
* a region with few members is joined at once; in a middling one each member is
  compared with its nearest candidate first, and then only candidates that
  would join different components. A large region is split again with a member
  set as pivot: members within the threshold are linked to this centre, and by
  the triangle inequality only those go on whose distance to it lets them reach
  a member that is not linked. So a group of copies costs about one exact
  comparison for each member and never all its pairs. What is large after
  ROUNDS of this is dealt out as pairs of blocks, so that no task holds more
  than LARGE_REGION members of one region;
* a sketch of parity bits bounds each pair's distance from below; every pair
  that it leaves is compared exactly, on whole sets of 64-bit shingle hashes.

Sets are identified by 64 bits, and by 64 others where unlike sets share the
first: none is taken for another below a collision in 128 bits.

Links between classes are enough for components: links inside a large region
that its centre already connects are not listed.

Null and empty texts and texts without words have no shingles and link with
nothing. Rows with equal ids share one component; a null id keeps a null
component and represents no class. The input's other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.components import components
from tributary.llm.store import broadcast_if_small, partitions, sifted, stage
from tributary.llm.textops import (SLICE_BYTES, buffer_of, mix, ngram_hashes, slices, span_hashes,
                                   word_bounds)

SHINGLE, NUM, DEN = 5, 80, 100
#: Frequent shingles that are ordered last, and the occurrences in one task that report one.
FREQUENT, REPORT = 1 << 18, 3
#: Least and most bytes of a set's parity sketch; between them two bits for each element.
SKETCH, LARGEST_SKETCH = 128, 1 << 14
#: Members of a region whose pairs are listed where it is found; members of a region that one
#: task compares by sketches; rounds of splitting larger ones by centres.
SMALL_REGION, LARGE_REGION, ROUNDS = 4, 4096, 4
#: Members of small regions that one task compares region by region.
TASK_MEMBERS = 1 << 15
_REPORT_FLUSH, _FLUSH, _BLOCK, _CELLS = 1 << 21, 1 << 19, 64, 1 << 24


def prefix_length(n: int, num: int, den: int) -> int:
    return n + (-num * n) // den + 1


def shingle_sets(column: pa.Array, size: int):
    """The sorted distinct shingle hashes of each text."""
    data, offsets = buffer_of(column)
    for i, j in slices(offsets, SLICE_BYTES):
        part, own = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        starts, ends, first = word_bounds(part, own)
        words = span_hashes(part, starts, ends)
        grams = ngram_hashes(words, size)
        for k in range(j - i):
            a, z = int(first[k]), int(first[k + 1])
            if z - a >= size:
                yield np.unique(grams[a:z - size + 1])
            elif z > a:
                yield ngram_hashes(words[a:z], z - a)
            else:
                yield grams[:0]


def _identity(found: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a set."""
    return (int(np.bitwise_xor.reduce(mix(found * np.uint64(3)))),
            int(mix(found + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)))


def _sketch(found: np.ndarray) -> bytes:
    """Parities of the numbers of elements that fall to each bit of the sketch.

    Sizes are powers of two and places are low bits, so the halves of a sketch
    joined by exclusive-or are the sketch of half the size."""
    size = min(LARGEST_SKETCH, max(SKETCH, 1 << max(0, (len(found) // 4 - 1).bit_length())))
    place = (mix(found) & np.uint64(8 * size - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=8 * size) & 1).tobytes()


def _folded(sketch: bytes, size: int) -> np.ndarray:
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, size // 8), axis=0)


def _key(digests: tuple[int, int], clashing: frozenset) -> int:
    """What a set is joined by: its first digest, or the second where unlike sets share the first."""
    return digests[1] if digests[0] in clashing else digests[0]


def most_partner(n, place, num: int, den: int):
    """The size of the largest set that one of ``n`` elements can link to, if the first pivot they
    share is at ``place`` (from 0): they share at most n - place elements."""
    return (n - place) * (num + den) // num - n


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Staged (id, n, d1, d2, sketch, shingles, counts): one row per text, and rows with a
    null ``n`` that report shingles frequent within a task."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()

    def scan(batches):
        waiting, held, arrow_id = [], 0, None
        names = ["id", "n", "d1", "d2", "sketch", "shingles", "counts"]

        def report():
            flat, count = np.unique(np.concatenate(waiting), return_counts=True)
            often = count >= REPORT
            blob = (flat[often].tobytes(), count[often].astype(np.int64).tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(1, arrow_id), *[pa.nulls(1, pa.int64())] * 3, pa.nulls(1, pa.binary()),
                 pa.array([blob[0]], pa.binary()), pa.array([blob[1]], pa.binary())],
                names=names)

        for batch in batches:
            arrow_id = batch.column(0).type
            n, d1, d2, sketch = [], [], [], []
            for found in shingle_sets(batch.column(1), size):
                a, b = _identity(found) if len(found) else (0, 0)
                n.append(len(found))
                d1.append(_signed(a))
                d2.append(_signed(b))
                sketch.append(_sketch(found))
                waiting.append(found)
                held += len(found)
                if held >= _REPORT_FLUSH:
                    yield report()
                    waiting, held = [], 0
            rows = len(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, pa.int64()) for x in (n, d1, d2)],
                 pa.array(sketch, pa.binary()), pa.nulls(rows, pa.binary()),
                 pa.nulls(rows, pa.binary())], names=names)
        if held:
            yield report()

    return stage(source.mapInArrow(
        scan, f"id {id_type}, n long, d1 long, d2 long, sketch binary, "
              "shingles binary, counts binary"), "signatures")


def frequent_shingles(signed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and their ranks (0: least frequent of them).

    They only order pivots: any choice gives the same links."""
    def unpack(batches):
        for batch in batches:
            for s, c in zip(batch.column(0), batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(s.as_py(), dtype=np.int64)),
                     pa.array(np.frombuffer(c.as_py(), dtype=np.int64))], names=["shingle", "c"])

    top = (signed.where(F.col("n").isNull()).select("shingles", "counts")
           .mapInArrow(unpack, "shingle long, c long")
           .groupBy("shingle").agg(F.sum("c").alias("c"))
           .orderBy(F.desc("c"), "shingle").limit(FREQUENT).select("shingle").toArrow())
    found = top.column("shingle").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(found)
    return found[order], (len(found) - 1 - order).astype(np.int64)


def _first_pivots(found: np.ndarray, frequent: np.ndarray, rank: np.ndarray,
                  most: int) -> np.ndarray:
    if len(frequent):
        at = np.searchsorted(frequent, found)
        at[at == len(frequent)] = 0
        late = frequent[at] == found
        if late.any():
            return np.concatenate([found[~late],
                                   found[late][np.argsort(rank[at[late]], kind="stable")]])[:most]
    return found[:most]


def partnered(group: np.ndarray, n: np.ndarray, most: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which members of the groups (sorted by group, then n) have another one in reach: each one's
    size between the other's least and most."""
    m = len(n)
    span = np.int64(1) << 32
    place = group * span
    at = place + n
    lo = np.searchsorted(at, place + -(-num * n // den))
    hi = np.searchsorted(at, place + np.minimum(most, span - 1), "right")
    tables = [most]  # tables[k][i]: the largest of 2 ** k values from i
    longest = int((hi - lo).max(initial=0))
    while 1 << len(tables) <= longest:
        half, last = 1 << (len(tables) - 1), tables[-1]
        tables.append(np.maximum(last, np.concatenate([last[half:], np.full(min(half, m), -1)])))

    def largest(i, j):
        length = np.maximum(j - i, 0)
        level = np.log2(np.maximum(length, 1)).astype(np.int64)
        out = np.full(m, -1, np.int64)
        for k, table in enumerate(tables):
            mine = np.flatnonzero((level == k) & (length > 0))
            out[mine] = np.maximum(table[i[mine]], table[j[mine] - (1 << k)])
        return out

    me = np.arange(m)
    return np.maximum(largest(lo, np.minimum(hi, me)), largest(np.maximum(lo, me + 1), hi)) >= n


def region_members(docs: DataFrame, text_col: str, size: int, num: int, den: int,
                   frequent: np.ndarray, rank: np.ndarray, clashing: frozenset) -> DataFrame:
    """Staged candidates of all regions: pairs of class keys (region null), or the members
    (region, a) of regions with more than SMALL_REGION members.

    An entry carries the set's size and the pivot's place in its order. Members that can link to
    no other one of their region by these are dropped before anything is written."""
    spark = docs.sparkSession
    buckets = 2 * partitions(spark)
    shared = spark.sparkContext.broadcast((frequent, rank))

    def replicate(batches):
        frequent, rank = shared.value
        pivots, keys, sizes, held, seen = [], [], [], 0, set()

        def blocks():
            p, k, m = (np.concatenate(x) for x in (pivots, keys, sizes))
            bucket = (p % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, p, k, m = bucket[order], p[order], k[order], m[order]
            cut = np.flatnonzero(np.diff(bucket)) + 1
            first = np.concatenate([[0], cut])
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[first], pa.int64()),
                 *[pa.array([x.tobytes() for x in np.split(column, cut)], pa.binary())
                   for column in (p, k, m)]], names=["bucket", "pivots", "keys", "sizes"])

        for batch in batches:
            for found in shingle_sets(batch.column(0), size):
                if not len(found):
                    continue
                key = _key(_identity(found), clashing)
                if key in seen:
                    continue
                seen.add(key)
                n = len(found)
                mine = _first_pivots(found, frequent, rank, prefix_length(n, num, den))
                pivots.append(mine)
                keys.append(np.full(len(mine), key, dtype=np.uint64))
                sizes.append(np.arange(len(mine), dtype=np.int64) | np.int64(n) << np.int64(32))
                held += len(mine)
                if held >= _FLUSH:
                    yield blocks()
                    pivots, keys, sizes, held = [], [], [], 0
        if held:
            yield blocks()

    def groups(p):
        first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]])) if len(p) else np.zeros(0, int)
        return first, np.diff(np.concatenate([first, [len(p)]]))

    def join(table: pa.Table) -> pa.Table:
        p, k = (np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table.column(c)])
                for c in ("pivots", "keys"))
        m = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column("sizes")])
        order = np.lexsort((k, m, p))  # by size within a pivot
        p, k, m = p[order], k[order], m[order]
        new = np.ones(len(p), dtype=bool)
        new[1:] = (p[1:] != p[:-1]) | (k[1:] != k[:-1])
        first, count = groups(p[new])
        kept = np.flatnonzero(new)[np.repeat(count > 1, count)]
        p, k, m = p[kept], k[kept], m[kept]
        n, place = m >> np.int64(32), m & np.int64(0xFFFFFFFF)
        most = most_partner(n, place, num, den)
        first, count = groups(p)
        able = partnered(np.repeat(np.arange(len(count)), count), n, most, num, den)
        p, k, n, most = p[able], k[able], n[able], most[able]
        first, count = groups(p)
        left, right = [k[:0]], [k[:0]]
        for members in range(2, SMALL_REGION + 1):
            at = first[count == members]
            i, j = np.triu_indices(members, 1)
            step = max(1, _FLUSH // len(i))
            for lo in range(0, len(at), step):
                x, y = ((at[lo:lo + step, None] + z).ravel() for z in (i, j))
                near = ((num * n[y] <= den * n[x]) & (num * n[x] <= den * n[y])
                        & (n[y] <= most[x]) & (n[x] <= most[y]))
                a, b = k[x[near]], k[y[near]]
                both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
                left.append(both[:, 0])
                right.append(both[:, 1])
        a, b = np.concatenate(left), np.concatenate(right)
        if len(a):
            both = np.unique(np.stack([a, b], axis=1), axis=0)
            a, b = both[:, 0], both[:, 1]
        big = np.repeat(count > SMALL_REGION, count)
        # a region is named by its members, so that pivots with the same members are one region
        name = np.add.reduceat(mix(k + np.uint64(7)), first) if len(first) else k
        region = np.repeat(name, count)[big].view(np.int64)
        if len(region):
            region, member = np.unique(np.stack([region, k[big].view(np.int64)], axis=1), axis=0).T
        else:
            member = region
        return pa.table({
            "region": pa.concat_arrays([pa.nulls(len(a), pa.int64()),
                                        pa.array(np.ascontiguousarray(region), pa.int64())]),
            "a": pa.array(np.concatenate([np.ascontiguousarray(a).view(np.int64), member])),
            "b": pa.concat_arrays([pa.array(np.ascontiguousarray(b).view(np.int64), pa.int64()),
                                   pa.nulls(len(region), pa.int64())])})

    entries = docs.select(text_col).mapInArrow(
        replicate, "bucket long, pivots binary, keys binary, sizes binary")
    found = entries.groupBy("bucket").applyInArrow(join, "region long, a long, b long")
    return stage(found, "regions")


def judge(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Staged (a, b, star, na, nb, least, near) of key pairs: a lower bound of their distance.

    Elements are dealt to parity bits, about two for each; bits that differ are a
    lower bound of the symmetric difference, so ``near`` is false only where the
    pair cannot link. Pairs that are not near are kept only as star pairs."""
    one = classes.select(F.col("key").alias("a"), F.col("n").alias("na"),
                         F.col("sketch").alias("sa"))
    two = classes.select(F.col("key").alias("b"), F.col("n").alias("nb"),
                         F.col("sketch").alias("sb"))

    def bound(batches):
        for batch in batches:
            na, nb = (batch.column(k).to_numpy() for k in (3, 4))
            apart = np.abs(na - nb)
            for k, (x, y) in enumerate(zip(batch.column(5).to_pylist(), batch.column(6).to_pylist())):
                size = min(len(x), len(y))
                bits = np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum(dtype=np.int64)
                apart[k] = max(apart[k], int(bits))
            common = (na + nb - apart) // 2  # at most
            near = den * common >= num * (na + nb - common)
            out = pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(1 - common / np.maximum(1, na + nb - common)),
                 pa.array(near)], names=["a", "b", "star", "na", "nb", "least", "near"])
            yield out.filter(pa.array(near | batch.column(2).to_numpy(zero_copy_only=False)))

    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "star", "na", "nb", "sa", "sb")
    return stage(joined.mapInArrow(bound, "a long, b long, star boolean, na long, nb long, "
                                          "least double, near boolean"), "judged")


def compare(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str,
            size: int, clashing: frozenset) -> DataFrame:
    """Staged (a, b, na, nb, common) of distinct key pairs (a, b), on whole sets."""
    keys = (pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    wanted = stage(classes.join(keys, "key").select("rep", "key"), "wanted")
    mine = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("text"))
    mine = (sifted(mine, wanted, ["rep"]).hint("merge").join(wanted, "rep").select("key", "text"))

    def whole_sets(batches):
        for batch in batches:
            keys = batch.column(0).to_pylist()
            rows = [(k, found) for k, found in zip(keys, shingle_sets(batch.column(1), size))
                    if len(found) and _signed(_key(_identity(found), clashing)) == k]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in rows], pa.int64()),
                 pa.array([x.tobytes() for _, x in rows], pa.binary())], names=["key", "found"])

    sets = stage(mine.mapInArrow(whole_sets, "key long, found binary"), "sets")
    one = sets.select(F.col("key").alias("a"), F.col("found").alias("fa"))
    two = sets.select(F.col("key").alias("b"), F.col("found").alias("fb"))

    def meet(batches):
        for batch in batches:
            common = []
            for x, y in zip(batch.column(4), batch.column(5)):
                x = np.frombuffer(x.as_buffer(), np.uint64)
                y = np.frombuffer(y.as_buffer(), np.uint64)
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                common.append(int((y[at] == x).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(common, pa.int64())],
                                             names=["a", "b", "na", "nb", "common"])

    joined = (pairs.select("a", "b", "na", "nb").join(one, "a").join(two, "b")
              .select("a", "b", "na", "nb", "fa", "fb"))
    return stage(joined.mapInArrow(meet, "a long, b long, na long, nb long, common long"),
                 "compared")


def dealt(members: DataFrame) -> DataFrame:
    """(cell, side, key): the members (region, key, members) of each region as the cells that one task
    compares. A region is one cell (side 2); one of more than LARGE_REGION members is dealt out as
    pairs of blocks of half as many, members of different blocks having sides 0 and 1."""
    one = members.where(F.col("members") <= LARGE_REGION).select(
        F.xxhash64("region").alias("cell"), F.lit(2).alias("side"), "key")
    blocks = F.ceil(2 * F.col("members") / LARGE_REGION).cast("int")
    block, other = F.col("block"), F.col("other")
    many = (members.where(F.col("members") > LARGE_REGION)
            .withColumn("block", F.pmod(F.xxhash64("key"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select(F.xxhash64("region", F.least(block, other), F.greatest(block, other)).alias("cell"),
                    F.when(block == other, 2).otherwise((block > other).cast("int")).alias("side"), "key"))
    return one.unionByName(many)


def region_pairs(members: DataFrame, count: int, classes: DataFrame, num: int, den: int,
                 components_of: DataFrame | None = None) -> DataFrame:
    """(a, b): pairs of the regions' ``count`` members (region, key, members) that their sketches do
    not rule out.

    Without components: of each member only the pair with its nearest earlier
    member, a forest. With them: all pairs that join different components. A task compares
    the cells of a bucket, one after the other (see ``dealt``)."""
    buckets = max(partitions(members.sparkSession), count // TASK_MEMBERS)
    rows = dealt(members).join(classes.select("key", "n", "sketch"), "key")
    if components_of is not None:
        rows = rows.join(components_of, F.col("key") == F.col("node"), "left") \
            .withColumn("component", F.coalesce("component", "key"))
    else:
        rows = rows.withColumn("component", F.col("key"))
    rows = rows.select(F.pmod("cell", F.lit(buckets)).alias("bucket"), "cell", "side", "key", "n",
                       "sketch", "component")
    forest = components_of is None

    def pairs(table: pa.Table) -> pa.Table:
        cell, key, n, group, side = (table.column(c).to_numpy()
                                     for c in ("cell", "key", "n", "component", "side"))
        order = np.lexsort((key, n, cell))
        cut = np.flatnonzero(np.diff(cell[order])) + 1
        sketch = table.column("sketch").combine_chunks()
        left, right = [], []
        for mine in np.split(order, cut):
            a, b = within(key[mine], n[mine], group[mine], side[mine], sketch.take(pa.array(mine)).to_pylist())
            left.append(a)
            right.append(b)
        a, b = np.concatenate(left), np.concatenate(right)
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    def within(key, n, group, side, sketch):
        """The pairs of one cell, whose members are sorted by size."""
        width = np.array([len(x) for x in sketch])  # grows with n
        levels = {}  # by size: the first member with so large a sketch, and all folded to it
        left, right = [], []
        lo = 0
        while lo < len(key):
            first = int(np.searchsorted(n, -(-int(n[lo]) * num // den)))  # smaller ones cannot link
            size = int(width[first])
            if size not in levels:
                low = int(np.searchsorted(width, size))
                levels[size] = low, np.stack([_folded(x, size) for x in sketch[low:]])
            low, rows = levels[size]
            hi = min(len(key), lo + max(1, min(_BLOCK, _CELLS // (size * (lo + 1 - first)))),
                     int(np.searchsorted(width, width[lo], "right")))
            i, j = np.arange(lo, hi), np.arange(first, hi)
            lo = hi
            apart = np.maximum(np.bitwise_count(rows[i - low][:, None] ^ rows[j - low][None])
                               .sum(axis=2, dtype=np.int64), np.abs(n[i, None] - n[None, j]))
            both = n[i, None] + n[None, j]
            common = (both - apart) // 2
            near = (den * common >= num * (both - common)) & (j[None] < i[:, None]) \
                & (group[i, None] != group[None, j]) \
                & ((side[i, None] == 2) | (side[i, None] != side[None, j]))
            if forest:
                best = np.where(near, apart, np.iinfo(np.int64).max).argmin(axis=1)
                x = np.flatnonzero(near[np.arange(len(i)), best])
                y = best[x]
            else:
                x, y = np.nonzero(near)
            left.append(key[i[x]])
            right.append(key[j[y]])
        return np.concatenate(left), np.concatenate(right)

    return rows.groupBy("bucket").applyInArrow(pairs, "a long, b long").distinct()


def all_links(found: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str,
              size: int, num: int, den: int, clashing: frozenset) -> DataFrame:
    """(a, b): links of class keys that connect whatever the candidates of ``found`` connect."""
    reach, links = 1 - num / den, []
    union = F.col("na") + F.col("nb") - F.col("common")
    linked = F.lit(den) * F.col("common") >= F.lit(num) * union
    sizes = classes.select("key", "n")

    def met_links(pairs: DataFrame) -> DataFrame:
        met = compare(pairs.select("a", "b")
                      .join(sizes.select(F.col("key").alias("a"), F.col("n").alias("na")), "a")
                      .join(sizes.select(F.col("key").alias("b"), F.col("n").alias("nb")), "b"),
                      classes, docs, id_col, text_col, size, clashing)
        links.append(met.where(linked).select("a", "b"))
        return met

    small = found.where(F.col("region").isNull()).select("a", "b", F.lit(False).alias("star"))
    left = stage(found.where(F.col("region").isNotNull())
                 .select("region", F.col("a").alias("key")).distinct()
                 .join(classes.select("key").distinct(), "key", "left_semi"), "members")
    for number in range(ROUNDS + 1):
        counted = left.join(left.groupBy("region").agg(
            F.count(F.lit(1)).alias("members"),
            F.min_by("key", F.xxhash64("key", F.lit(number))).alias("centre")), "region")
        counted = stage(counted, "regions")
        large = F.lit(number < ROUNDS) & (F.col("members") > LARGE_REGION)
        big = (counted.where(large & (F.col("key") != F.col("centre")))
               .select("region", "key", F.least("key", "centre").alias("a"),
                       F.greatest("key", "centre").alias("b")))
        rest = counted.where(~large).select("region", "key", "members")
        waiting = rest.count()
        pairs = (small.unionByName(big.select("a", "b", F.lit(True).alias("star")))
                 .groupBy("a", "b").agg(F.max("star").alias("star")))
        judged = judge(pairs, classes, num, den)
        forest = region_pairs(rest, waiting, classes, num, den)
        met = met_links(judged.where("near").select("a", "b").unionByName(forest).distinct())
        if waiting:
            joined = stage(components(reduce(DataFrame.unionByName, links)), "components")
            met_links(region_pairs(rest, waiting, classes, num, den, joined))
        # members of large regions that are linked to the centre stay only if, by the triangle
        # inequality, they can still link to a member that is not
        placed = (big.join(judged.select("a", "b", "least"), ["a", "b"])
                  .join(met.select("a", "b", (1 - F.col("common") / union).alias("exact"),
                                   linked.alias("linked")), ["a", "b"], "left")
                  .select("region", "key", F.coalesce("exact", "least").alias("d"),
                          F.coalesce("linked", F.lit(False)).alias("linked")))
        placed = stage(placed, "placed")
        edge = placed.where(~F.col("linked")).groupBy("region").agg(F.min("d").alias("nearest"))
        left = stage(placed.join(edge, "region")
                     .where(~F.col("linked") | (F.col("d") >= F.col("nearest") - reach - 1e-9))
                     .select("region", "key").distinct(), "members")
        if left.isEmpty():
            break
        small = small.limit(0)
    return reduce(DataFrame.unionByName, links).distinct()


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id.

    Two rows link when den * |x & y| >= num * |x | y|; component_id is the
    smallest id reachable by links, the row's own included."""
    signed = signatures(docs, id_col, text_col, size)
    frequent, rank = frequent_shingles(signed)
    rows = signed.where(F.col("n").isNotNull())
    classes = stage(rows.where(F.col("n") > 0).groupBy("n", "d1", "d2", "sketch")
                    .agg(F.min("id").alias("rep")).where(F.col("rep").isNotNull()), "classes")
    # first digests that unlike sets share: about one in 2 ** 65 pairs of sets
    clashing = frozenset(r.d1 % (1 << 64) for r in classes.groupBy("d1").agg(
        F.count(F.lit(1)).alias("sets")).where(F.col("sets") > 1).collect())
    shared = F.col("d1").isin([_signed(x) for x in clashing]) if clashing else F.lit(False)
    classes = classes.withColumn("key", F.when(shared, F.col("d2")).otherwise(F.col("d1")))
    found = region_members(docs, text_col, size, num, den, frequent, rank, clashing)
    links = all_links(found, classes, docs, id_col, text_col, size, num, den, clashing)
    named = classes.select("key", "rep")
    edges = (links.join(named.select(F.col("key").alias("a"), F.col("rep").alias("ra")), "a")
             .join(named.select(F.col("key").alias("b"), F.col("rep").alias("rb")), "b"))
    joined = components(edges, "ra", "rb")
    placed = (classes.hint("merge").join(stage(joined, "components"),
                                         F.col("rep") == F.col("node"), "left")
              .select("n", "d1", "d2", F.coalesce("component", "rep").alias("component_id")))
    return (rows.select("id", "n", "d1", "d2")
            .hint("merge").join(stage(placed, "placed"), ["n", "d1", "d2"], "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "id").alias("component_id")))


def near_duplicates_removed(docs: DataFrame, id_col: str = "doc_id",
                            text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id.

    Rows without shingles and rows with a null id all stay; rows that share the id that
    stays all stay."""
    ids = jaccard_join(docs, id_col, text_col).where(
        F.col("component_id").eqNullSafe(F.col(id_col))).select(F.col(id_col).alias("kept"))
    keep = broadcast_if_small(stage(ids.distinct(), "kept"))
    return docs.join(keep, docs[id_col].eqNullSafe(keep["kept"]), "left_semi")
