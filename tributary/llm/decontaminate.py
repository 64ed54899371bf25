"""Benchmark decontamination with a generalised suffix automaton (operator 10).

The normalised words of the benchmark items are put into one suffix automaton
per block of items (a block has a bounded number of words, so what is
broadcast is bounded; the documents pass once for each block). Training words
stream through it and the length of the longest match that ends at each word
is tracked. A match of at least ``window`` words covers windows of its items;
an item shorter than that counts only when it occurs whole. Words covered by
any match are hit.

Words of the documents are hashed without making Python objects, and only
runs of words that all occur in the benchmark are walked, so the automaton's
cost follows the benchmark's words found and not the corpus.

Null, empty and word-free texts have no words and no hits; items without
words are never found; repeated items are each reported. Repeated rows are
each reported.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.store import free_name, stage
from tributary.llm.textops import SLICE_BYTES, buffer_of, lookup, slices, span_hashes, word_bounds

WINDOW = 10
#: Bytes of item text in one automaton; more items are handled in more passes.
BLOCK_BYTES = 8 << 20
#: Gaps between words: every ASCII character but digits and letters.
IS_GAP = lookup(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61),
                       *range(0x7B, 0x80)]))


class Automaton:
    """Generalised suffix automaton of the items' words, with the items of each factor."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int) -> None:
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.whole: dict[int, set[str]] = {}
        paths = []
        for name, words in items:
            state, path = 0, []
            for w in words:
                state = self._extend(state, w)
                path.append(state)
            if path and len(path) < window:
                self.whole.setdefault(state, set()).add(name)
            elif path:
                paths.append((name, words))
        self.items: list[set[str]] = [set() for _ in self.next]
        for name, words in paths:
            state = 0
            for w in words:
                state = self.next[state][w]
                up = state
                while up > 0 and self.len[up] >= window and name not in self.items[up]:
                    self.items[up].add(name)
                    up = self.link[up]
        self.shortest = min([window, *(self.len[s] for s in self.whole)])

    def _extend(self, last: int, w: int) -> int:
        """Append word ``w`` after state ``last``; returns the state of the longer prefix."""
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, w, q)
        new = self._state(self.len[last] + 1, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][w]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._clone(p, w, q)
        return new

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(0)
        self.len.append(length)
        return len(self.len) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = self._state(self.len[p] + 1, dict(self.next[q]))
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def walk(self, words: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit words (start, end) and the items whose windows occur."""
        state = length = 0
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        for i, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.len[state]
            if w not in self.next[state]:
                continue
            state = self.next[state][w]
            length += 1
            if length >= self.window:
                spans.append((i + 1 - length, i + 1))
                up = state
                while self.len[self.link[up]] >= self.window:
                    up = self.link[up]
                found |= self.items[up]
            up = state if self.len[state] <= length else self.link[state]
            while up > 0 and self.whole:
                if up in self.whole:
                    spans.append((i + 1 - self.len[up], i + 1))
                    found |= self.whole[up]
                up = self.link[up]
        return spans, found


def build(rows: list[tuple[str, str | None]], window: int) -> tuple[np.ndarray, Automaton]:
    """(sorted word hashes, automaton over their numbers) of (item id, text) rows."""
    data, offsets = buffer_of(pa.array([t or "" for _, t in rows], pa.large_string()))
    starts, ends, first = word_bounds(data, offsets, IS_GAP)
    vocabulary, ids = np.unique(span_hashes(data, starts, ends), return_inverse=True)
    ids = ids.tolist()
    return vocabulary, Automaton([(name, ids[first[k]:first[k + 1]])
                                  for k, (name, _) in enumerate(rows)], window)


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def match(column: pa.Array, vocabulary: np.ndarray, automaton: Automaton):
    """For each text: number of words, hit word spans, byte bounds of the spans, items."""
    data, offsets = buffer_of(column)
    for i, j in slices(offsets, 4 * SLICE_BYTES):
        part, own = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        starts, ends, first = word_bounds(part, own, IS_GAP)
        hashes = span_hashes(part, starts, ends)
        at = np.searchsorted(vocabulary, hashes)
        at[at == len(vocabulary)] = 0
        known = vocabulary[at] == hashes if len(vocabulary) else np.zeros(len(at), bool)
        ids = np.where(known, at, -1)
        # maximal runs of known words within one text
        cut = np.zeros(len(known) + 1, dtype=bool)
        cut[first] = True
        begin, stop = known.copy(), known.copy()
        begin[1:] &= ~known[:-1] | cut[1:-1]
        stop[:-1] &= ~known[1:] | cut[1:-1]
        begin, stop = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        long = stop - begin >= automaton.shortest
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        for b, e in zip(begin[long].tolist(), stop[long].tolist()):
            hit, found = automaton.walk(ids[b:e].tolist())
            if hit:
                k = int(np.searchsorted(first, b, "right")) - 1
                spans.setdefault(k, []).extend((b + x, b + y) for x, y in hit)
                items.setdefault(k, set()).update(found)
        for k in range(j - i):
            own_spans = _merge(spans.get(k, []))
            yield (int(first[k + 1] - first[k]),
                   [(x - int(first[k]), y - int(first[k])) for x, y in own_spans],
                   [(int(starts[x]) - int(own[k]), int(ends[y - 1]) - int(own[k]))
                    for x, y in own_spans],
                   sorted(items.get(k, ())))


FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("bytes", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_ARROW = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))),
                    ("bytes", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of bounded bytes; each block alone is held by the driver."""
    rows = items.select(F.col(id_col).cast("string").alias("item"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        yield [(r.item or "", r.text) for r in part.collect()]


def find_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                 text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                 keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` (or its columns ``keep``) with a struct column of what was found in each
    text, and that column's name. Items in several blocks: one pass over the
    documents for each, staged, joining the spans of earlier blocks."""
    spark = docs.sparkSession
    name = free_name(docs.columns, "found")
    columns = keep if keep is not None else docs.columns
    out = docs.withColumn(name, F.lit(None).cast(FOUND))
    for number, rows in enumerate(_blocks(items, item_id, item_text)):
        out = stage(out, "matched") if number else out
        shared = spark.sparkContext.broadcast(build(rows, window))

        def scan(batches, shared=shared):
            vocabulary, automaton = shared.value
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text_col))
                before = batch.column(batch.schema.get_field_index(name)).to_pylist() \
                    if batch.column(batch.schema.get_field_index(name)).null_count < len(batch) \
                    else [None] * len(batch)
                found = []
                for old, (n, spans, places, names) in zip(
                        before, match(texts, vocabulary, automaton), strict=True):
                    if old:
                        spans = _merge(spans + [tuple(x) for x in old["spans"]])
                        places = _merge(places + [tuple(x) for x in old["bytes"]])
                        names = sorted({*names, *old["items"]})
                    found.append({"n_words": n, "spans": spans, "bytes": places, "items": names})
                arrays = [pa.array(found, _ARROW) if f.name == name else batch.column(k)
                          for k, f in enumerate(batch.schema)]
                yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

        out = out.mapInArrow(scan, out.schema)
    return out.select(*[F.col(f"`{c}`") for c in columns], name), name


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found, name = find_matches(docs.select(id_col, text_col), items, window, text_col,
                               keep=[id_col])
    hit = F.aggregate(f"{name}.spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return found.select(
        F.col(id_col), F.col(f"{name}.n_words").alias("n_words"), hit.alias("n_hit"),
        F.size(f"{name}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{name}.items", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                  max_coverage: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the benchmark passages.

    Spans of hit words are cut out of the text; a row of which more than
    ``max_coverage`` of the words are hit is dropped. Other rows are returned
    unchanged, with all their columns."""
    found, name = find_matches(docs, items, window, text_col)
    hit = F.aggregate(f"{name}.spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    kept = found.where(hit <= F.lit(max_coverage) * F.col(f"{name}.n_words"))
    raw = F.col(text_col).cast("binary")
    # what lies between the spans, each a byte range of the text
    edges = F.concat(F.array(F.lit(0).cast("long")), F.flatten(f"{name}.bytes"),
                     F.array(F.octet_length(text_col).cast("long")))
    pieces = F.transform(F.sequence(F.lit(0), F.size(f"{name}.bytes")),
                         lambda k: F.substring(raw, (edges[2 * k] + 1).cast("int"),
                                               (edges[2 * k + 1] - edges[2 * k]).cast("int")))
    joined = F.aggregate(pieces, F.lit(b""), lambda a, p: F.concat(a, p)).cast("string")
    return kept.select(*[F.when(hit > 0, joined).otherwise(F.col(f"`{c}`")).alias(c)
                         if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def brute_force(texts: list[str | None], items: list[tuple[str, str | None]],
                window: int = WINDOW) -> list[tuple[int, int, int, str, bool]]:
    """What ``contamination`` must return, by direct comparison (for tests)."""
    import re
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = {k: k + 32 for k in range(65, 91)}
    split = lambda t: word.findall((t or "").translate(lower))
    out = []
    for t in texts:
        w, hit, seen = split(t), set(), set()
        for name, item in items:
            x = split(item)
            size = min(window, len(x))
            wanted = {tuple(x[k:k + size]) for k in range(len(x) - size + 1)} if size else set()
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in wanted:
                    hit.update(range(k, k + size))
                    seen.add(name)
        out.append((len(w), len(hit), len(seen),
                    hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest(), bool(hit)))
    return out
