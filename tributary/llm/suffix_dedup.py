"""Removal of repeated byte strings with a sparse, range-partitioned suffix array (operator 5).

A byte is removed when a string of ``width`` bytes that covers it also starts
elsewhere in the corpus, the same text included. Sorting every suffix would
move the corpus many times over, so the suffix array is sparse:

1. every window of ``width`` bytes names one anchor inside it, the leftmost
   position whose hashed ``KEY`` bytes are least. Equal windows name the same
   anchor, about one position in 70 is one, and only anchors whose KEY bytes
   occur twice can lie in a repeated window: one shuffle of anchor hashes;
2. for these, the suffix from the anchor and the bytes before it that its
   windows need are shuffled by *sampled splitters* on the suffix's leading
   eight bytes (``repartitionByRange``). Equal leading bytes share a bucket, so
   no group is cut by a boundary;
3. a bucket is sorted by multikey refinement, eight bytes at a time, only
   ties being refined further. Suffixes that agree on KEY bytes are neighbours;
   their windows are compared at equal offsets from the anchor;
4. an anchor text that occurs very often (``HOT``) would make one bucket large.
   Its windows are counted by their own hash instead: an aggregate combined
   before the shuffle, and a join back that has one row for each hash.

Work is done once for each distinct text (by SHA-256); copies share results,
and a text of at least ``width`` bytes that has a copy is removed whole without
being read again. Results are judged on the input, not on what is left.

Null and empty texts and texts shorter than ``width`` keep everything. Rows
with equal or null ids are kept apart. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.store import partitions, sifted, stage
from tributary.llm.textops import SLICE_BYTES, buffer_of, ragged, slices, window_hashes

WIDTH, KEY = 200, 64
#: Occurrences of an anchor's bytes from which its windows are counted by themselves.
HOT = 1 << 17
_FLUSH = 1 << 19
#: Windows compared at once in a bucket.
_WINDOWS = 1 << 21
#: Bytes of contexts sorted at once within a bucket (a tie group is never cut).
_SORT_BYTES = 16 << 20


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by prefix and suffix minima of blocks."""
    n = len(x)
    padded = np.concatenate([x, np.full(-n % width, np.iinfo(np.uint64).max, dtype=np.uint64)])
    blocks = padded.reshape(-1, width)
    prefix = np.minimum.accumulate(blocks, axis=1).ravel()
    suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[:n - width + 1], prefix[width - 1:n])


def anchors(data: np.ndarray, offsets: np.ndarray, width: int, key: int):
    """Runs of windows of concatenated texts that name the same anchor.

    Arrays (text, anchor position, first window, past last window, anchor hash);
    positions are those in ``data``."""
    span = width - key + 1
    out = []
    last = np.repeat(offsets[1:], np.diff(offsets)) - width  # last window start of each byte's text
    for lo in range(0, max(0, len(data) - width + 1), SLICE_BYTES):
        hi = min(len(data) - width + 1, lo + SLICE_BYTES)
        hashes = window_hashes(data[lo:hi + width - 1], key)
        least = _sliding_least(hashes, span)
        start = np.arange(lo, hi)
        valid = start <= last[lo:hi]
        new = np.ones(hi - lo, dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
        edge = offsets[(offsets >= lo) & (offsets < hi)] - lo
        new[edge] = True
        first = np.flatnonzero(new & valid)
        if not len(first):
            continue
        stop = np.append(np.flatnonzero(new | ~valid), hi - lo)
        end = stop[np.searchsorted(stop, first, "right")]
        place = np.empty(len(first), dtype=np.int64)
        step = 1 + (SLICE_BYTES // span)
        for k in range(0, len(first), step):
            at = first[k:k + step]
            place[k:k + step] = at + hashes[at[:, None] + np.arange(span)].argmin(axis=1)
        more = np.flatnonzero(end - 1 > place)  # ties: later windows name a later position
        parts = [(place, first, np.minimum(end, place + 1), hashes[place])]
        for k in more.tolist():
            i, j, value = int(first[k]), int(end[k]), hashes[place[k]]
            ties = np.flatnonzero(hashes[i:j + span - 1] == value) + i
            ties = ties[np.searchsorted(ties, int(place[k]) + 1):]
            begin = np.concatenate([[int(place[k]) + 1], ties[:-1] + 1])
            keep = begin < j
            ties, begin = ties[keep], begin[keep]
            parts.append((ties, begin, np.minimum(ties + 1, j), np.full(len(ties), value)))
        place, first, end, value = (np.concatenate(x) for x in zip(*parts))
        out.append((place + lo, first + lo, end + lo, value))
    if not out:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, np.zeros(0, np.uint64)
    place, first, end, value = (np.concatenate(x) for x in zip(*out))
    text = np.searchsorted(offsets, first, "right") - 1
    return text, place, first, end, value


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).alias("id"), text.alias("text"),
                       F.unhex(F.sha2(text, 256)).alias("digest"))


def repeated_anchors(texts: DataFrame, width: int, key: int, hot: int) -> DataFrame:
    """Staged (digest, places, hots): positions of anchors whose bytes occur twice or more,
    and those that occur at least ``hot`` times, by text."""
    buckets = 2 * partitions(texts.sparkSession)

    def scan(batches):
        seen, waiting, held = set(), [], 0

        def blocks():
            value, ref, place = (np.concatenate(x) for x in zip(*waiting))
            bucket = (value % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            cut = np.flatnonzero(np.diff(bucket)) + 1
            first = np.concatenate([[0], cut])
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[first], pa.int64()),
                 *[pa.array([x.tobytes() for x in np.split(y[order], cut)], pa.binary())
                   for y in (value, ref, place)]], names=["bucket", "hashes", "refs", "places"])

        for batch in batches:
            digests = batch.column(1).to_pylist()
            fresh = [k for k, d in enumerate(digests) if d not in seen and not seen.add(d)]
            column = batch.column(0).take(pa.array(fresh, pa.int64()))
            data, offsets = buffer_of(column)
            refs = np.frombuffer(b"".join(digests[k][:16] for k in fresh), "V16")
            for i, j in slices(offsets, SLICE_BYTES):
                own = offsets[i:j + 1] - offsets[i]
                text, place, _, _, value = anchors(data[offsets[i]:offsets[j]], own, width, key)
                waiting.append((value, refs[i + text], (place - own[text]).astype(np.uint32)))
                held += len(value)
                if held >= _FLUSH:
                    yield blocks()
                    waiting, held = [], 0
        if held:
            yield blocks()

    def meet(table: pa.Table) -> pa.Table:
        value, ref, place = (np.concatenate([np.frombuffer(x.as_py(), kind)
                                             for x in table.column(name)])
                             for name, kind in (("hashes", np.uint64), ("refs", "V16"),
                                                ("places", np.uint32)))
        halves = ref.view(np.uint64).reshape(-1, 2)
        order = np.lexsort((place, halves[:, 1], halves[:, 0], value))
        value, ref, place = value[order], ref[order], place[order]
        new = np.ones(len(value), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (ref[1:] != ref[:-1]) | (place[1:] != place[:-1])
        value, ref, place = value[new], ref[new], place[new]
        _, group, count = np.unique(value, return_inverse=True, return_counts=True)
        often = count[group]
        ref, place, often = ref[often > 1], place[often > 1], often[often > 1]
        return pa.table({"ref": pa.array(ref.tolist() and [x.tobytes() for x in ref], pa.binary()),
                         "place": pa.array(place.astype(np.int64)), "hot": pa.array(often >= hot)})

    found = (texts.select("text", "digest")
             .mapInArrow(scan, "bucket long, hashes binary, refs binary, places binary")
             .groupBy("bucket").applyInArrow(meet, "ref binary, place long, hot boolean"))
    return stage(found.groupBy("ref").agg(
        F.sort_array(F.collect_list(F.when(~F.col("hot"), F.col("place")))).alias("places"),
        F.sort_array(F.collect_list(F.when(F.col("hot"), F.col("place")))).alias("hots")),
        "anchors")


def _anchor_runs(batch, column: str, width: int, key: int):
    """For each text of (text, ref, places, hots): its wanted anchors as
    (row, data, position, first window, past last window)."""
    data, offsets = buffer_of(batch.column(0))
    wanted = batch.column(batch.schema.get_field_index(column))
    for i, j in slices(offsets, SLICE_BYTES):
        part, own = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        text, place, first, end, _ = anchors(part, own, width, key)
        asked = np.concatenate([np.asarray(wanted[i + k].as_py(), dtype=np.int64) + own[k]
                                for k in range(j - i)])
        keep = np.isin(place, asked)
        yield i, part, own, text[keep], place[keep], first[keep], end[keep]


def _run_ranges(flags: np.ndarray, base: np.ndarray, first: np.ndarray):
    """Maximal runs of set flags of each context (context, from, past), where a context's flags
    begin at ``base`` and its first window is ``first``."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at, at
    row = np.searchsorted(base, at, "right") - 1
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) != 1) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(at)) - 1
    start = first[row] + at - base[row]
    return row[begin], start[begin], start[last] + 1


def repeated_windows(texts: DataFrame, width: int, key: int) -> DataFrame:
    """(ref, first, past): runs of repeated windows of anchors that are not hot.

    ``texts`` has (text, ref, places, hots)."""
    def contexts(batches):
        for batch in batches:
            refs = batch.column(1).to_pylist()
            for i, part, own, text, place, first, end in _anchor_runs(batch, "places", width, key):
                raw = part.tobytes()
                lead = [raw[p:p + 8] for p in place.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lead, pa.binary()),
                     pa.array([refs[i + t] for t in text.tolist()], pa.binary()),
                     pa.array(first - own[text], pa.int64()), pa.array(place - first, pa.int64()),
                     pa.array([raw[a:b + width - 1] for a, b in zip(first.tolist(), end.tolist())],
                              pa.binary())],
                    names=["lead", "ref", "first", "before", "context"])

    def sorted_groups(data, begin, before):
        """Multikey sort of the suffixes at the anchors; the tie group of each."""
        n = len(begin)
        group, order, open_ = np.zeros(n, np.int64), np.arange(n), np.arange(n)
        for column in range(0, key, 8):
            if not len(open_):
                break
            rows = order[open_]
            at = (begin + before)[rows][:, None] + np.arange(column, column + 8)
            word = data[at].astype(np.uint8).reshape(-1, 8).copy().view(">u8").ravel() \
                .astype(np.uint64)
            inner = np.lexsort((word, group[open_]))
            order[open_] = rows[inner]
            word, old = word[inner], group[open_]
            new = np.zeros(len(open_), dtype=bool)
            new[1:] = (word[1:] != word[:-1]) & (old[1:] == old[:-1])
            split = np.zeros(n, dtype=bool)
            split[open_] = new
            edge = np.ones(n, dtype=bool)
            edge[1:] = group[1:] != group[:-1]
            group = np.cumsum(edge | split) - 1
            size = np.bincount(group)
            open_ = np.flatnonzero(size[group] > 1)
        return group, order

    def compare(rows):
        lead, ref, first, before, context = (x.combine_chunks() if isinstance(x, pa.ChunkedArray)
                                             else x for x in rows.columns)
        data, offsets = buffer_of(context)
        begin, length = offsets[:-1], np.diff(offsets)
        first, before = first.to_numpy(), before.to_numpy()
        group, order = sorted_groups(data, begin, before)
        size = np.bincount(group)
        kept = order[size[group] > 1]
        tie = group[size[group] > 1]
        count = length[kept] - width + 1  # windows of each context
        base = np.cumsum(count) - count
        total = int(count.sum())
        value = np.empty(total, dtype=np.uint64)
        for i, j in slices(np.concatenate([[0], np.cumsum(length[kept])]), SLICE_BYTES):
            row, rank = ragged(length[kept[i:j]])
            hashes = window_hashes(data[begin[kept[i:j]][row] + rank], width)
            row, rank = ragged(count[i:j])
            inner = np.cumsum(length[kept[i:j]]) - length[kept[i:j]]
            value[base[i]:base[i] + len(row)] = hashes[inner[row] + rank]
        place = ref.take(pa.array(kept))
        halves = np.frombuffer(b"".join(place.to_pylist()), np.uint64).reshape(-1, 2)
        flags = np.zeros(total, dtype=bool)
        # windows are compared at equal offsets from the anchor: some offsets at a time
        reach = before[kept]
        step = max(1, _WINDOWS * width // max(1, total))
        for low in range(0, width, step):
            lo = np.maximum(0, reach - (low + step - 1))
            hi = np.minimum(count, reach - low + 1)
            row, rank = ragged(np.maximum(0, hi - lo))
            if not len(row):
                continue
            rank += lo[row]
            at, start = base[row] + rank, first[kept][row] + rank
            by = np.lexsort((start, halves[row, 1], halves[row, 0], value[at], reach[row] - rank,
                             tie[row]))
            row, at, start = row[by], at[by], start[by]
            offset = reach[row] - (at - base[row])
            same = ((tie[row][1:] == tie[row][:-1]) & (offset[1:] == offset[:-1])
                    & (value[at][1:] == value[at][:-1]))
            other = same & ((start[1:] != start[:-1])
                            | (halves[row[1:]] != halves[row[:-1]]).any(axis=1))
            # a window is repeated when its equal-valued run holds another place
            run = np.cumsum(np.concatenate([[True], ~same])) - 1
            many = np.zeros(run[-1] + 1, dtype=bool)
            many[run[1:][other]] = True
            flags[at] = many[run]
        g, a, b = _run_ranges(flags, base, first[kept])
        return pa.RecordBatch.from_arrays([place.take(pa.array(g)), pa.array(a, pa.int64()),
                                           pa.array(b, pa.int64())], names=["ref", "first", "past"])

    def bucket(batches):
        waiting, held = [], 0
        for batch in batches:
            waiting.append(batch)
            held += batch.nbytes
            if held >= _SORT_BYTES:
                table = pa.Table.from_batches(waiting).combine_chunks()
                lead = table.column(0)
                final, cut = lead[len(table) - 1], len(table) - 1
                while cut > 0 and lead[cut - 1] == final:
                    cut -= 1
                if cut:
                    yield compare(table.slice(0, cut))
                rest = table.slice(cut).combine_chunks()
                waiting, held = rest.to_batches(), rest.nbytes if cut else 0
        if waiting:
            yield compare(pa.Table.from_batches(waiting).combine_chunks())

    cut = texts.select("text", "ref", "places").mapInArrow(
        contexts, "lead binary, ref binary, first long, before long, context binary")
    return (cut.repartitionByRange(partitions(texts.sparkSession), "lead")
            .sortWithinPartitions("lead")
            .mapInArrow(bucket, "ref binary, first long, past long"))


def repeated_hot_windows(texts: DataFrame, width: int, key: int) -> DataFrame:
    """(ref, first, past) for the anchors that occur very often, by counting windows."""
    def windows(batches):
        for batch in batches:
            refs = batch.column(1).to_pylist()
            for i, part, own, text, place, first, end in _anchor_runs(batch, "hots", width, key):
                row, rank = ragged(end - first)
                start = first[row] + rank
                hashes = window_hashes(part, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[start].view(np.int64)),
                     pa.array([refs[i + t] for t in text[row].tolist()], pa.binary()),
                     pa.array(start - own[text[row]], pa.int64())], names=["value", "ref", "first"])

    spread = stage(texts.where(F.size("hots") > 0).select("text", "ref", "hots")
                   .mapInArrow(windows, "value long, ref binary, first long")
                   .dropDuplicates(["value", "ref", "first"]), "hot")
    many = spread.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("value")
    return (spread.join(many, "value", "left_semi")
            .select("ref", "first", (F.col("first") + 1).alias("past")))


def _merged(starts, ends) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(zip(starts, ends)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(e, out[-1][1])
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, width: int = WIDTH,
                   key: int = KEY, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(rows, cuts): staged (id, digest, n, copies) of every row, and staged
    (text, digest, spans) of the texts without copies that lose some bytes."""
    if key % 8 or not 0 < key <= width:
        raise ValueError("key must be a multiple of 8 and at most width")
    whole = _rows(docs, id_col, text_col)
    rows = stage(whole.select("id", "digest", F.octet_length("text").cast("long").alias("n")),
                 "rows")
    classes = stage(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"),
                                               F.min("id").alias("rep")), "classes")
    found = repeated_anchors(whole, width, key, hot)
    wanted = (classes.withColumn("ref", F.substring("digest", 1, 16)).join(found, "ref")
              .select(F.col("digest").alias("d"), "rep", "ref", "copies", "places", "hots"))
    wanted = stage(wanted, "wanted")
    maybe = sifted(whole, wanted.select(F.col("d").alias("digest"), F.col("rep").alias("id")),
                   ["digest", "id"])
    texts = stage(maybe.hint("merge").join(wanted, (F.col("digest") == F.col("d"))
                                           & F.col("id").eqNullSafe(F.col("rep")))
                  .select("text", "ref", "places", "hots", "digest", "copies"), "texts")
    runs = repeated_windows(texts, width, key).unionByName(repeated_hot_windows(texts, width, key))
    spans = stage(runs.groupBy("ref").agg(
        F.collect_list(F.struct("first", (F.col("past") + (width - 1)).alias("past")))
        .alias("spans")), "spans")
    cuts = (texts.where("copies = 1").select("text", "digest", "ref")
            .hint("merge").join(spans, "ref").select("text", "digest", "spans"))
    return rows.join(classes.select("digest", "copies"), "digest"), cuts


def _cut(cuts: DataFrame) -> DataFrame:
    """(digest, n_removed, n_spans, kept) of the cut texts."""
    def scan(batches):
        for batch in batches:
            removed, count, kept = [], [], []
            for text, spans in zip(batch.column(0), batch.column(2)):
                raw = text.as_py()
                spans = _merged(*zip(*((s["first"], s["past"]) for s in spans.as_py())))
                edges = [0, *[x for s in spans for x in s], len(raw)]
                removed.append(sum(e - s for s, e in spans))
                count.append(len(spans))
                kept.append(b"".join(raw[edges[k]:edges[k + 1]] for k in range(0, len(edges), 2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
                 pa.array(kept, pa.binary())], names=["digest", "n_removed", "n_spans", "kept"])
    return cuts.mapInArrow(scan, "digest binary, n_removed long, n_spans long, kept binary")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = WIDTH, key: int = KEY, hot: int = HOT) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows, cuts = repeated_spans(docs, id_col, text_col, width, key, hot)
    done = stage(_cut(cuts).select("digest", "n_removed", "n_spans",
                                   F.sha2("kept", 256).alias("kept_sha256")), "cut")
    gone = (F.col("copies") > 1) & (F.col("n") >= width)
    nothing = hashlib.sha256(b"").hexdigest()
    return (rows.hint("merge").join(done, "digest", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_bytes"),
                    F.when(gone, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0)))
                    .cast("long").alias("n_removed"),
                    F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0)))
                    .cast("long").alias("n_spans"),
                    F.when(gone, F.lit(nothing))
                    .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest"))))
                    .alias("kept_sha256")))


def brute_force(texts: list[str | None], width: int = WIDTH) -> list[tuple[int, int, int, str]]:
    """What ``suffix_dedup`` must return, by counting every window (for tests)."""
    from collections import Counter
    raw = [(t or "").encode() for t in texts]
    count = Counter(x[k:k + width] for x in raw for k in range(len(x) - width + 1))
    out = []
    for x in raw:
        hit = bytearray(len(x))
        for k in range(len(x) - width + 1):
            if count[x[k:k + width]] > 1:
                hit[k:k + width] = b"\1" * width
        runs = sum(h and not (k and hit[k - 1]) for k, h in enumerate(hit))
        out.append((len(x), sum(hit), runs,
                    hashlib.sha256(bytes(b for b, h in zip(x, hit) if not h)).hexdigest()))
    return out
