"""Vectorised text primitives shared by the corpus operators.

Everything works on the UTF-8 bytes of an Arrow string column: one uint8
buffer plus the byte offset at which each text starts. Words are hashed with a
polynomial over the whole buffer (prefix sums modulo 2**64), so no Python
object is made per word. Buffers are cut into slices of a bounded number of
bytes; only a single word or text longer than a slice makes one larger.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Arrow's own allocators keep freed memory; the system's gives large blocks back.
pa.set_memory_pool(pa.system_memory_pool())

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
WHITE = bytes([0x20, *range(0x09, 0x0E)])


def lookup(members: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(members)] = True
    return out


IS_WHITE = lookup(WHITE)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
LOWER_VALUE = BYTE_VALUE[LOWER]


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            inverse = pow(_BASE, -1, 1 << 64)
            for name, base in (("up", _BASE), ("down", inverse)):
                table = np.full(n, base, dtype=np.uint64)
                table[0] = 1
                setattr(self, name, np.cumprod(table, dtype=np.uint64))


POWERS = _Powers()


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type)
                              or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    n = len(column)
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1] \
        if offsets is not None and n else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(offsets: np.ndarray, most: int):
    """Ranges (i, j) of texts that hold at most ``most`` bytes, or one text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def gathered(batches, most: int):
    """Record batches joined until they hold ``most`` bytes."""
    waiting, held = [], 0
    for batch in batches:
        waiting.append(batch)
        held += batch.nbytes
        if held >= most:
            yield _joined(waiting)
            waiting, held = [], 0
    if waiting:
        yield _joined(waiting)


def _joined(waiting: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(waiting) == 1:
        return waiting[0]
    table = pa.Table.from_batches(waiting).combine_chunks()
    return pa.RecordBatch.from_arrays([c.combine_chunks() for c in table.columns],
                                      names=table.schema.names)


def word_bounds(data: np.ndarray, offsets: np.ndarray, is_gap: np.ndarray = IS_WHITE
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the word number at which each text starts."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64),
                np.zeros(len(offsets), np.int64))
    gap = is_gap[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    start, end = ~gap, ~gap
    start[1:] &= gap[:-1] | edge[1:n]
    end[:-1] &= gap[1:] | edge[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                values: np.ndarray = LOWER_VALUE) -> np.ndarray:
    """64-bit hashes of byte spans that are sorted and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right"))
        j = max(j, i + 1)
        lo, hi = int(starts[i]), int(ends[j - 1])
        POWERS.need(hi - lo + 1)
        total = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(values[data[lo:hi]] * POWERS.up[:hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((total[e] - total[s]) * POWERS.down[s]
                       + (e - s).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        i = j
    return out


def window_hashes(data: np.ndarray, width: int, values: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """Hash of the ``width`` bytes that start at each position (fewer at the end: none)."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.empty(n, dtype=np.uint64)
    for lo in range(0, n, SLICE_BYTES):
        hi = min(n, lo + SLICE_BYTES)
        m = hi - lo
        POWERS.need(m + width)
        total = np.zeros(m + width, dtype=np.uint64)
        np.cumsum(values[data[lo:hi + width - 1]] * POWERS.up[:m + width - 1], out=total[1:])
        out[lo:hi] = (total[width:] - total[:m]) * POWERS.down[:m]
    return mix(out)


_ROLE = mix(np.arange(11, 11 + 64, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)


def ngram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words that start at each word (across text edges too)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, size * 0x589965CC75374CC3 & _MASK, dtype=np.uint64)
    for k in range(size):
        total += words[k:k + n] * _ROLE[k]
    return mix(total)


def ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of the given sizes: the group of each element and its rank in it."""
    group = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return group, np.arange(len(group)) - np.repeat(first, counts)
