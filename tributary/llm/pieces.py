"""SentencePiece encoding and decoding by suffix-array matching (operator 9).

The model is a public SentencePiece BPE file with byte fallback; it is read,
never trained. Texts are encoded in batches of bounded size, all steps over
whole arrays:

1. texts are cut into chunks where no piece can span (before a run of word
   marks, around characters that no longer piece holds), and each distinct
   chunk of the batch is encoded once;
2. the distinct chunks are concatenated and indexed by a suffix array on their
   first 16 characters, the longest piece;
3. every piece is looked up by binary search, which gives its range of
   occurrences; each occurrence is an edge (position, length, piece);
4. the edges, sorted by position, are relaxed: starting from single characters,
   every chunk joins the two neighbours whose edge has the best score, until
   none is left. That is the order in which byte-pair merges apply, so the
   result is the model's own segmentation. All places of the best piece are
   joined in one round; where a longer piece outranks one it contains, one
   place at a time;
5. characters without a piece become byte pieces.

Decoding joins the pieces' bytes and turns word marks into spaces; it returns
the text, except that a literal word mark (U+2581) comes back as a space.

Null and empty texts have no ids. Repeated rows are each encoded; ids of a text
do not depend on the batch it is in.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.store import free_name
from tributary.llm.textops import BYTE_VALUE, buffer_of, gathered, ragged, slices, span_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = 0x2581
LONGEST = 16
BATCH_BYTES = 2 << 20


class Pieces:
    """The vocabulary as arrays."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(k) for k in range(size)]
        special = [model.is_byte(k) or model.is_control(k) or model.is_unknown(k)
                   for k in range(size)]
        self.byte_id = np.zeros(256, dtype=np.int32)
        for k in range(size):
            if model.is_byte(k):
                self.byte_id[int(names[k][3:5], 16)] = k
        score = {names[k]: model.get_score(k) for k in range(size) if not special[k]}
        normal = [k for k in range(size) if not special[k]]
        longer = [k for k in normal if len(names[k]) > 1]
        if max(len(names[k]) for k in normal) > LONGEST:
            raise ValueError(f"a piece is longer than {LONGEST} characters")
        self.chars = np.array([[ord(c) for c in names[k]] + [0] * (LONGEST - len(names[k]))
                               for k in longer], dtype=np.uint32)
        self.length = np.array([len(names[k]) for k in longer], dtype=np.int64)
        self.ids = np.array(longer, dtype=np.int32)
        # rank: 0 is the best score; equal scores share a rank
        order = np.unique([-score[names[k]] for k in longer], return_inverse=True)[1]
        self.rank = np.full(size, np.iinfo(np.int32).max, dtype=np.int32)
        self.rank[self.ids] = order
        self.alone = np.zeros(size, dtype=bool)  # pieces that a longer, better piece contains
        number = {names[k]: k for k in normal}
        for k in longer:
            for cut in range(2, len(names[k])):
                for part in (names[k][:cut], names[k][-cut:]):
                    if part in number and score[names[k]] >= score[part]:
                        self.alone[number[part]] = True
        single = sorted((ord(names[k]), k) for k in normal if len(names[k]) == 1)
        self.single = np.array([c for c, _ in single], dtype=np.uint32)
        self.single_id = np.array([k for _, k in single], dtype=np.int32)
        mark = chr(MARK)
        self.cut_at_marks = not any(mark in n.lstrip(mark) for n in map(names.__getitem__, longer))
        joined = set(self.chars.ravel().tolist())
        self.cut_byte = np.array([b < 0x80 and b != 0x20 and b not in joined
                                  for b in range(256)])
        out = [bytes([int(names[k][3:5], 16)]) if model.is_byte(k) else
               b"" if special[k] else names[k].replace(mark, " ").encode() for k in range(size)]
        self.out = np.frombuffer(b"".join(out), dtype=np.uint8)
        self.out_length = np.array([len(x) for x in out], dtype=np.int64)
        self.out_first = np.cumsum(self.out_length) - self.out_length


def _keys(codes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Columns of uint64 that hold the first LONGEST codes from each position."""
    per, n = 64 // bits, len(codes) - LONGEST
    columns = []
    for first in range(0, LONGEST, per):
        key = np.zeros(n, dtype=np.uint64)
        for k in range(first, min(first + per, LONGEST)):
            key = (key << np.uint64(bits)) | codes[k:k + n]
        columns.append(key)
    return columns


def _ranges(columns: list[np.ndarray], low: list[np.ndarray], high: list[np.ndarray]
            ) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of [low, high] in lexicographically sorted columns, for all pieces."""
    lo = np.zeros(len(low[0]), dtype=np.int64)
    hi = np.full(len(low[0]), len(columns[0]), dtype=np.int64)
    for k, column in enumerate(columns):
        if k == 0:
            a, z = np.searchsorted(column, low[0]), np.searchsorted(column, high[0], "right")
            lo, hi = a.astype(np.int64), z.astype(np.int64)
            continue
        # only pieces that reach into this column still have an open range
        at = np.flatnonzero((lo < hi) & (low[k - 1] == high[k - 1]))
        for bound, side in ((low[k], lo), (high[k], hi)):
            a, z = lo[at].copy(), hi[at].copy()
            while (a < z).any():
                mid = (a + z) // 2
                open_ = a < z
                value = column[np.minimum(mid, len(column) - 1)]
                right = (value < bound[at]) if side is lo else (value <= bound[at])
                a = np.where(open_ & right, mid + 1, a)
                z = np.where(open_ & ~right, mid, z)
            if side is lo:
                new_lo = a
            else:
                new_hi = a
        lo[at], hi[at] = new_lo, new_hi
    return lo, hi


def match_pieces(codes: np.ndarray, chunk_end: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Table [position, length] of the piece that occurs there, or -1."""
    table = np.full((len(codes), LONGEST + 1), -1, dtype=np.int32)
    present = np.unique(codes)
    alphabet = present[np.isin(present, pieces.chars)]
    if not len(alphabet):
        return table
    bits = 8 if len(alphabet) < 255 else 16 if len(alphabet) < 65535 else 32
    at = np.searchsorted(alphabet, pieces.chars)
    at[at == len(alphabet)] = 0
    inside = (alphabet[at] == pieces.chars) | (pieces.chars == 0)
    usable = inside.all(axis=1)
    wanted = np.where(pieces.chars[usable] == 0, 0, at[usable] + 1).astype(np.uint64)
    length, ids = pieces.length[usable], pieces.ids[usable]
    own = np.searchsorted(alphabet, codes)
    own[own == len(alphabet)] = 0
    own = np.where(alphabet[own] == codes, own + 1, 0).astype(np.uint64)
    columns = _keys(np.concatenate([own, np.zeros(LONGEST, np.uint64)]), bits)
    order = np.lexsort(columns[::-1])  # the suffix array
    columns = [c[order] for c in columns]
    per, full = 64 // bits, np.uint64((1 << bits) - 1)
    top = np.where(np.arange(LONGEST) < length[:, None], wanted, full)
    pack = lambda rows, k: np.bitwise_or.reduce(
        rows[:, k:k + per] << (np.uint64(bits) * np.arange(per - 1, -1, -1, dtype=np.uint64)), axis=1)
    steps = range(0, LONGEST, per)
    lo, hi = _ranges(columns, [pack(wanted, k) for k in steps], [pack(top, k) for k in steps])
    row, rank = ragged(np.maximum(hi - lo, 0))
    place, size = order[lo[row] + rank], length[row]
    edge = np.argsort(place, kind="stable")
    place, size, row = place[edge], size[edge], row[edge]
    fits = place + size <= chunk_end[place]
    table[place[fits], size[fits]] = ids[row[fits]]
    return table


def relax(table: np.ndarray, chunk: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Joins neighbours by the best edge, round by round: (starts, lengths) of all symbols."""
    worst = np.iinfo(np.int32).max
    done_start, done_length = [], []
    start, length = np.arange(len(table)), np.ones(len(table), dtype=np.int64)
    while len(start):
        own = chunk[start]
        both = length[:-1] + length[1:]
        joinable = (own[1:] == own[:-1]) & (both <= LONGEST)
        edge = np.where(joinable, table[start[:-1], np.minimum(both, LONGEST)], -1)
        rank = np.append(np.where(edge >= 0, pieces.rank[edge], worst), worst)
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        best = np.minimum.reduceat(rank, first)
        sizes = np.diff(np.append(first, len(start)))
        best_of = np.repeat(best, sizes)
        idle = best_of == worst
        if idle.any():  # these chunks are final
            done_start.append(start[idle])
            done_length.append(length[idle])
            live = ~idle
            start, length, rank, best_of = start[live], length[live], rank[live], best_of[live]
            edge = np.append(edge, -1)[live]
            own = own[live]
            if not len(start):
                break
        else:
            edge = np.append(edge, -1)
        hit = rank == best_of
        at = np.flatnonzero(hit)
        # overlapping places: every other one of a run, from the left
        new_run = np.ones(len(at), dtype=bool)
        new_run[1:] = np.diff(at) != 1
        run = np.flatnonzero(new_run)
        parity = (np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0
        first_hit = np.ones(len(at), dtype=bool)
        first_hit[1:] = own[at[1:]] != own[at[:-1]]
        at = at[parity & (first_hit | ~pieces.alone[edge[at]])]
        length[at] += length[at + 1]
        keep = np.ones(len(start), dtype=bool)
        keep[at + 1] = False
        start, length = start[keep], length[keep]
    if not done_start:
        return start, length
    start, length = np.concatenate(done_start), np.concatenate(done_length)
    order = np.argsort(start)
    return start[order], length[order]


def encode(column: pa.Array, pieces: Pieces):
    """Yields (first text, flat ids, ids per text) for slices of a string column."""
    data, offsets = buffer_of(column)
    for i, j in slices(offsets, BATCH_BYTES):
        own = offsets[i:j + 1] - offsets[i]
        some = np.diff(own) > 0
        # a space before each text that is not empty
        raw = np.insert(data[offsets[i]:offsets[j]], own[:-1][some], 0x20)
        own = own + np.concatenate([[0], np.cumsum(some)])
        mark = np.flatnonzero((raw[:-2] == 0xE2) & (raw[1:-1] == 0x96) & (raw[2:] == 0x81))
        if len(mark):  # a literal word mark is a space to the model
            raw[mark] = 0x20
            gone = np.sort(np.concatenate([mark + 1, mark + 2]))
            own = own - np.searchsorted(gone, own)
            raw = np.delete(raw, gone)
        n = len(raw)
        if not n:
            yield i, np.zeros(0, np.int32), np.zeros(j - i, np.int64)
            continue
        cut = np.zeros(n + 1, dtype=bool)
        cut[own] = True
        alone = pieces.cut_byte[raw]
        cut[:-1] |= alone
        cut[1:] |= alone
        if pieces.cut_at_marks:
            space = raw == 0x20
            cut[1:-1] |= space[1:] & ~space[:-1]
        bounds = np.flatnonzero(cut)
        hashes = span_hashes(raw, bounds[:-1], bounds[1:], BYTE_VALUE)
        _, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        size = (bounds[1:] - bounds[:-1])[sample]
        row, rank = ragged(size)
        text = raw[bounds[sample][row] + rank]
        head = (text & 0xC0) != 0x80
        chunk = row[head]
        codes = np.frombuffer(text.tobytes().decode("utf-8").encode("utf-32-le"),
                              dtype=np.uint32).copy()
        codes[codes == 0x20] = MARK
        counts = np.bincount(chunk, minlength=len(sample))
        chunk_end = np.cumsum(counts)[chunk]
        table = match_pieces(codes, chunk_end, pieces)
        start, length = relax(table, chunk, pieces)
        # ids of the symbols; single characters without a piece become bytes
        ids = table[start, length]
        one = length == 1
        at = np.searchsorted(pieces.single, codes[start[one]])
        at[at == len(pieces.single)] = 0
        ids[one] = np.where(pieces.single[at] == codes[start[one]], pieces.single_id[at], -1)
        first_byte = np.flatnonzero(head)
        width = np.diff(np.append(first_byte, len(text)))
        many = np.where(ids < 0, width[start], 1)
        symbol, inner = ragged(many)
        flat = ids[symbol]
        lost = flat < 0
        flat[lost] = pieces.byte_id[text[first_byte[start[symbol[lost]]] + inner[lost]]]
        per_chunk = np.bincount(chunk[start], weights=many, minlength=len(sample)).astype(np.int64)
        first = np.cumsum(per_chunk) - per_chunk
        row, rank = ragged(per_chunk[which])
        all_ids = flat[first[which][row] + rank]
        upto = np.concatenate([[0], np.cumsum(per_chunk[which])])
        ends = upto[np.searchsorted(bounds, own)]
        yield i, all_ids, np.diff(ends)


def decode(flat: np.ndarray, counts: np.ndarray, pieces: Pieces) -> list[bytes]:
    """The bytes of each id sequence, without the space that encoding puts in front."""
    size = pieces.out_length[flat]
    row, rank = ragged(size)
    data = pieces.out[pieces.out_first[flat][row] + rank].tobytes()
    upto = np.concatenate([[0], np.cumsum(size)])
    ends = upto[np.concatenate([[0], np.cumsum(counts)])].tolist()
    return [data[a:b][1:] if data[a:a + 1] == b" " else data[a:b]
            for a, b in zip(ends[:-1], ends[1:])]


def encoded(docs: DataFrame, model: str = MODEL, text_col: str = "text") -> tuple[DataFrame, dict]:
    """``docs`` with columns appended: ids, n_tokens, n_bytes (byte pieces), round_trip
    (decoding gives the text back). Returns the new columns' names by these words."""
    names = {w: free_name(docs.columns, w) for w in ("ids", "n_tokens", "n_bytes", "round_trip",
                                                     "ids_sha256")}
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model))

    def scan(batches):
        pieces = shared.value
        is_byte = np.zeros(len(pieces.rank), dtype=bool)
        is_byte[pieces.byte_id] = True
        for batch in gathered(batches, BATCH_BYTES):
            column = batch.column(batch.schema.get_field_index(text_col))
            data, offsets = buffer_of(column)
            raw = data.tobytes()
            for i, flat, counts in encode(column, pieces):
                upto = np.concatenate([[0], np.cumsum(counts)])
                back = decode(flat, counts, pieces)
                own = [raw[offsets[i + k]:offsets[i + k + 1]] for k in range(len(counts))]
                part = batch.slice(i, len(counts))
                bytes_upto = np.concatenate([[0], np.cumsum(is_byte[flat])])
                ids = flat.astype("<i4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [*part.columns,
                     pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(flat)),
                     pa.array(counts, pa.int64()), pa.array(np.diff(bytes_upto[upto]), pa.int64()),
                     pa.array([a == b for a, b in zip(back, own)], pa.bool_()),
                     pa.array([hashlib.sha256(ids[4 * a:4 * b]).hexdigest()
                               for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())], pa.string())],
                    names=[*part.schema.names, *names.values()])

    kinds = (T.ArrayType(T.IntegerType()), T.LongType(), T.LongType(), T.BooleanType(),
             T.StringType())
    schema = T.StructType([*docs.schema.fields,
                           *(T.StructField(n, k) for n, k in zip(names.values(), kinds))])
    return docs.mapInArrow(scan, schema), names


def decoded(tokens: DataFrame, model: str = MODEL, ids_col: str = "ids") -> tuple[DataFrame, str]:
    """``tokens`` with the text of its ids appended, and that column's name; null ids: empty."""
    name = free_name(tokens.columns, "text")
    shared = tokens.sparkSession.sparkContext.broadcast(Pieces(model))

    def scan(batches):
        pieces = shared.value
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            counts = np.array([len(r or ()) for r in rows], dtype=np.int64)
            flat = np.array([x for r in rows for x in r or ()], dtype=np.int64)
            texts = [b.decode("utf-8", "replace") for b in decode(flat, counts, pieces)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, name])

    return tokens.mapInArrow(scan, T.StructType([*tokens.schema.fields,
                                                 T.StructField(name, T.StringType())])), name


def piece_encoding(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row: id, ids, n_tokens, n_bytes, ids_sha256 (of the ids as 32-bit little-endian
    integers), round_trip."""
    out, names = encoded(docs.select(id_col, text_col), model, text_col)
    return out.select(id_col, *(F.col(names[w]).alias(w) for w in
                                ("ids", "n_tokens", "n_bytes", "ids_sha256", "round_trip")))
