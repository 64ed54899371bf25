"""Archives, the filter audit, resampling, and patterns on very long texts, against brute force."""

import gzip
import hashlib
import io
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import SF001
from pyspark.sql import functions as F

from tributary.llm import context_mixing as mixing
from tributary.llm import filter_audit as audit
from tributary.llm import line_dedup as lines
from tributary.llm import resample, store, warc
from tributary.llm import secrets as keys
from tributary.session import scratch_path


@pytest.fixture(autouse=True)
def prepared(spark):
    store.prepare(spark)


# --- WARC ---------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, status string, path string, digest string, id int"
LONG = "<p>" + "x" * 1500


def page_rows():
    rows = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, "http://a/é\n x", "short"), (4, None, "short"),
            (5, "http://a/5", None), (6, "u", ""), (7, "u", LONG + "é"), (7, "u", LONG + "é"), (8, "u", "é" * 400_000),
            (None, "u", LONG), (None, "v", "only" * 400), (9, "u", "a" * 999), (10, "u", "a" * 999),
            (11, "u", "\r\n\r\n" * 300), (12, "u", "\r\n\r\n" * 300), (13, "u", "WARC/1.1\r\n\r\n")]
    return [(*r, "s", "p", "d", 0) for r in rows + [(100 + k, "h", "hot" * 500) for k in range(40)]]


def expected(rows):
    out = []
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        same = [j for j, _, other, *_ in rows if (other or "") == (html or "") and j is not None]
        top = max(same, default=None)
        again = len(body) >= 1000 and top is not None and (i is None or i < top)
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response",
                    top if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("broadcast", [store.BROADCAST_BYTES, 0])
def test_archives(spark, monkeypatch, broadcast):
    monkeypatch.setattr(warc, "HOT_SHARE", 0.5)
    rows = page_rows()
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    files = warc.write_archives(pages, archive_bytes=3_000, broadcast_bytes=broadcast)
    assert files.agg(F.sum("n_records")).first()[0] == len(rows) and files.count() > 3
    found = store.stage(warc.read_archives(files, keep_payload=True), "found")
    assert {r.status for r in found.collect()} == {"ok"}
    got = found.where("record_type <> 'warcinfo'")
    ident = lambda v: None if v in (None, "urn:page:none") else int(v.split(":")[-1])
    assert sorted(((ident(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, ident(r.refers_to))
                   for r in got.collect()), key=repr) == expected(rows)
    bodies = {ident(r.record_id): bytes(r.payload) for r in got.where("record_type = 'response'").collect()}
    assert bodies[8] == ("é" * 400_000).encode() and bodies[12] == b"\r\n\r\n" * 300
    urls = {ident(r.record_id): r.target_uri for r in got.collect()}
    assert urls[3] == "http://a/é%0A%20x" and urls[4] is None
    assert warc.unresolved_revisits(found).count() == 0
    lost = found.where("record_id <> 'urn:page:2'")
    assert [(r.refers_to, r.revisits) for r in warc.unresolved_revisits(lost).collect()] == [("urn:page:2", 2)]


def test_pages_read_back(spark):
    rows = page_rows()
    got = warc.page_archives(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got),
                  key=repr) == expected(rows)
    none = warc.page_archives(spark.createDataFrame([], PAGES))
    assert none.count() == 0 and dict(none.dtypes)["page_id"] == "bigint"


def one(ident, body):
    return warc.page_record(ident, "u", body, None, "2024-01-01T00:00:00Z")


def statuses(data, piece=64):
    return [(r[3], r[8]) for r in warc.records(io.BytesIO(data), "p", True, piece)]


def test_records_are_what_other_readers_see():
    data = one("1", b"abc") + one("2", b"")
    plain = gzip.decompress(data)
    assert plain.count(b"WARC/1.1\r\n") == 2 and plain.endswith(b"\r\n\r\n\r\n\r\n")
    head, rest = plain.split(b"\r\n\r\n", 1)
    size = int(re.search(rb"Content-Length: (\d+)", head).group(1))
    assert rest[:size].endswith(b"\r\n\r\nabc") and rest[size:size + 4] == b"\r\n\r\n"


@pytest.mark.parametrize("piece", [1, 7, 64, 1 << 16])
def test_damage_is_reported_and_passed_over(piece):
    a, b, c = one("1", b"a" * 300), one("2", bytes(range(256)) * 40), one("3", b"c" * 10)
    good = [("urn:page:1", "ok"), ("urn:page:2", "ok"), ("urn:page:3", "ok")]
    assert statuses(a + b + c, piece) == good
    assert statuses(b"", piece) == []
    assert statuses(a + b[:-40], piece)[0] == good[0] and statuses(a + b[:-40], piece)[1][1] == "truncated"
    broken = bytearray(b)
    broken[len(b) // 2] ^= 0xFF
    got = statuses(a + bytes(broken) + c, piece)
    assert got[0] == good[0] and got[-1] == good[2] and got[1][1] == "corrupt"
    whole = gzip.decompress(b)
    swapped = gzip.compress(whole.replace(bytes(range(200, 210)), b"0123456789", 1))
    assert statuses(a + swapped + c, piece)[1] == ("urn:page:2", "block digest")
    short = gzip.compress(whole.replace(b"Content-Length: 1", b"Content-Length: 2", 1))
    assert statuses(a + short + c, piece)[1][1] in ("truncated", "malformed")
    assert statuses(gzip.compress(b"no record") + c, piece) == [(None, "truncated"), good[2]]


def test_offsets_lead_to_members():
    data = b"".join(one(str(k), bytes([k]) * (k * 37)) for k in range(20))
    for r in warc.records(io.BytesIO(data), "p", True, 100):
        assert statuses(data[r[1]:])[0] == (r[3], "ok")


# --- filter audit -------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, id int, part string, mask int, n long"
LABELS = "doc_id long, quality int, toxic int, good string"


def doc_rows():
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["aa", "Bb", "c", "dd", "é"]) for _ in range(n)) for n in (3, 150, 200, 260)]
    texts += [" ".join(f"w{k}" for k in range(230)), "x # y", "LOUD " * 250, "\x0b a b \t", None, ""]
    rows = [(rng.choice([*range(60), None]), rng.choice(texts), rng.choice(["en", "de", None])) for _ in range(150)]
    rows += [(k, "hot copy", "en") for k in range(200, 260)] + [(7, "hot copy", "de"), (7, "hot copy", "de")]
    rows.append((300, "long " * 60_000, "en"))
    rng.shuffle(rows)
    return rows


def audited(rows, labels):
    good = {i for i, q, _, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t, _ in labels if t == 1} - {None}
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    docs = []
    for i, t, lang in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": i is not None and i > least[t]}
        docs.append((lang or "", {f for f in fails if fails[f]}, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            gone = [next((f for f in order if f in d[1]), None) for d in mine]
            for k, f in enumerate(order):
                here = [d for d, g in zip(mine, gone) if g == f]
                shapley[f] += len(here)
                out[part, "".join(order), k + 1] = [
                    sum(g is None or order.index(g) > k for g in gone), len(here),
                    sum(f in d[1] and order.index(g) < k for d, g in zip(mine, gone)),
                    sum(d[1] == {f} for d in mine), sum(d[2] for d in here), sum(d[3] for d in here)]
        for (p, order, k), row in out.items():
            if p == part:
                row.append(shapley[order[k - 1]])
    return out


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def reported(df):
    return {(r.part, r.filter_order, r.step): [r[c] for c in COUNTS] for r in df.collect()}


@pytest.mark.parametrize("files", [1, 100])
def test_filter_audit(spark, files):
    """Many micro-batches (smaller ids keep arriving) and a single one give what brute force gives."""
    rows = doc_rows()
    labels = [(k, k % 2, (k + 1) % 3, "g") for k in range(0, 60, 2)] + [(4, 1, 1, "g"), (None, 1, 1, "g"), (6, None, 1, "g")]
    path = scratch_path(spark, "test", "documents")
    spark.createDataFrame([(*r, 0, "p", 1, 2) for r in rows], DOCS).repartition(6).write.parquet(path)
    counts = audit.filter_counts(spark, path, spark.createDataFrame(labels, LABELS), files_a_batch=files,
                                 texts_a_key=4)
    assert reported(audit.order_report(counts)) == audited(rows, labels)


def test_the_audit_goes_on_where_it_stopped(spark):
    rows, labels = doc_rows(), [(k, 1, 1, "g") for k in range(30)]
    path, folder = scratch_path(spark, "test", "documents"), scratch_path(spark, "test", "audit")
    marked = spark.createDataFrame(labels, LABELS)
    rows.sort(key=lambda r: -(r[0] or 0))  # every copy's least id comes last
    for half in (rows[:100], rows[100:]):
        spark.createDataFrame([(*r, 0, "p", 1, 2) for r in half], DOCS).repartition(2).write.mode("append").parquet(path)
        counts = audit.filter_counts(spark, path, marked, files_a_batch=1, folder=folder)
    assert reported(audit.order_report(counts)) == audited(rows, labels)
    again = audit.filter_counts(spark, path, marked, folder=folder)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, counts.collect()))


def test_an_empty_table_has_no_parts(spark):
    path = scratch_path(spark, "test", "documents")
    spark.createDataFrame([], DOCS).write.parquet(path)
    assert audit.filter_audit(spark, path, spark.createDataFrame([], LABELS)).count() == 0


def test_a_single_file_is_streamed(spark):
    got = audit.filter_counts(spark, f"{SF001}/documents.parquet", spark.read.parquet(f"{SF001}/labels.parquet"))
    assert got.agg(F.sum("n")).first()[0] == spark.read.parquet(f"{SF001}/documents.parquet").count()


# --- resampling -----------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = "doc_id long, text string, id int, n_words int, weight double, score string, bucket int"


def features(text, size):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[k:k + n]) for n in range(1, size + 1) for k in range(len(words) - n + 1)]


def drawn_by_hand(docs, target, size, buckets, least, percent):
    at = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for count, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for f in features(text, size)[1]:
                count[at(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets)
                                       / ((s[b] + 1) * (t.sum() + buckets)))) for b in range(buckets)]
    out = []
    for i, text in docs:
        words, found = features(text, size)
        weight = sum(gain[at(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, len(words) >= least])
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    chosen = {id(r): k + 1 for k, r in enumerate(order[:percent * len(order) // 100])}
    return sorted(((*r[:4], chosen.get(id(r))) for r in out), key=repr)


def text_rows():
    rng = random.Random(9)
    vocabulary = ["Aa", "b9", "ünï", "ccc", "d" * 40, "e" * 600, "fG-h", "日本語"]
    return [(k, "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n"]) for _ in range(rng.randrange(0, 60))))
            for k in range(120)] + [(500, None), (501, ""), (None, "aa " * 30), (503, "word " * 40_000)]


@pytest.mark.parametrize("size,block", [(1, resample.BLOCK), (3, 50)])
def test_resampling(spark, monkeypatch, size, block):
    monkeypatch.setattr(resample, "BLOCK", block)
    monkeypatch.setattr(resample, "GATHERED", 3000)
    rows, target = text_rows(), ["aa ccc b9", "日本語 Aa aa", None]
    docs = spark.createDataFrame([(*r, 1, 2, 0.5, "s", 3) for r in rows], TEXTS).repartition(3)
    bench = spark.createDataFrame([(k, t, 1, 2, 0.5, "s", 3) for k, t in enumerate(target)], TEXTS)
    got = resample.resampled(docs, bench, size=size, buckets=97, percent=30)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == drawn_by_hand(rows, target, size, 97, 20, 30)


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "w " * 25, 0, 0, 0.0, "", 0)] * 5, TEXTS)
    none = docs.limit(0)
    got = resample.resampled(docs, none, percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2] and len(got) == 5
    assert resample.resampled(none, docs).count() == 0


def test_hashes_are_xxhash():
    raw = np.frombuffer(random.Random(2).randbytes(4000), np.uint8)
    data, starts = resample.Bytes(raw), np.arange(0, 3000, 41)
    for n in [*range(1, 40), 63, 64, 65, 200, resample.LONG_RUN, resample.LONG_RUN + 1]:
        want = [xxhash.xxh64_intdigest(raw[s:s + n].tobytes()) for s in starts]
        assert [int(x) for x in resample.xxhash64(data, starts, n)] == want


def test_unlike_runs_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(resample, "xxhash64", lambda data, starts, n: np.full(len(starts), 7, np.uint64))
    words = ["ab", "cd", "ab", "longer", "longes", "ab", "x", "longer" * 3]
    column = pa.array([" ".join(words)])
    (_, n, table, _), = resample.blocks(column, 1, 1000)
    assert n.tolist() == [len(words)]
    assert [table.bucket[s] for s in table.slot] == [zlib.crc32(w.encode()) % 1000 for w in words]
    assert sorted(table.count[table.used].tolist()) == [1, 1, 1, 1, 1, 3]


# --- very long texts -----------------------------------------------------------------------

def test_patterns_on_long_repetitions(spark):
    """A million repetitions of whatever a pattern repeats, and a text of 10 MB."""
    n = 1_000_000
    rows = [(1, "a." * n), (2, "a." * n + "b:80"), (3, "a" * n), (4, "AKIA" + "A1" * n), (5, "0f" * n),
            (6, "token" + " " * n + "=" + "x" * n), (7, "https://" + "a." * n), (8, "aB3/" * n),
            (9, "ASIA" + "Z9" * n), (10, ("www.host-1.example.com:8080 plain words " * 260_000)[:10_000_000]),
            (11, "a" * 64 + ".b:80"), (12, "a..b:80 x.:80 .y:80 k9.example:8080")]
    got = {r.doc_id: r for r in keys.secret_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[k].n_access for k in (4, 5)] == [1, 0] and got[5].n_hex == 1 and got[6].n_assign == 1
    assert len(got) == len(rows)


OLD_HOST = re.compile(r"(?<![A-Za-z0-9.-])[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+)+:[0-9]{2,5}")


def test_the_flat_host_pattern_finds_what_the_nested_one_did():
    flat = re.compile(keys.PATTERNS["endpoint"][0].replace("(?:[a-z][a-z0-9+]{1,15}://[A-Za-z0-9.:@/_-]{6,}+|", "(?:", 1))
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "b9", ".", "..", ":", "80", ":8080", " ", "-", "é", "c" * 63, "d" * 64])
                       for _ in range(rng.randrange(1, 14)))
        assert [m.span() for m in flat.finditer(text)] == [m.span() for m in OLD_HOST.finditer(text)], text


# --- lines under one hash --------------------------------------------------------------------

def test_unlike_lines_under_one_hash(spark, monkeypatch):
    """A first hash that many lines share changes nothing: the second one takes its place."""
    monkeypatch.setattr(lines, "_hash", lambda line: F.pmod(F.xxhash64(line), F.lit(3)))
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(8)) for _ in range(60)]
    rows = [(k, "\n".join(" ".join(rng.choice(words) for _ in range(12)) for _ in range(3))) for k in range(20)]
    rows += [(100 + k, rows[k][1]) for k in range(5)] + [(200, None), (201, "  "), (202, "")]
    got = {r.doc_id: (r.doc_id, r.n_lines, list(r.kept_lines))
           for r in lines.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i, _ in rows] == lines.brute_force(rows)


def test_recall_on_edited_lines(spark):
    """Lines with random edits: of the pairs that brute force links, at least 0.95 end together."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 11)))
    rows = []
    for k in range(150):
        base = [word() for _ in range(rng.randrange(8, 40))]
        for c in range(3):
            mine = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 9))):
                mine[rng.randrange(len(mine))] = word()
            rows.append((10 * k + c, " ".join(mine)))
    got = {r.doc_id: r.n_kept for r in lines.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {i: len(kept) for i, _, kept in lines.brute_force(rows)}
    dropped = [i for i in want if not want[i]]
    assert len(dropped) > 80
    assert sum(not got[i] for i in dropped) >= 0.95 * len(dropped)
    assert all(want[i] == 0 for i in got if not got[i])


# --- rare words in the language model ---------------------------------------------------------

@pytest.mark.parametrize("frequent", [0, 40])
def test_the_score_does_not_depend_on_how_many_words_are_broadcast(spark, monkeypatch, frequent):
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 7))) for _ in range(400)]
    rows = [(k, " ".join(words[int(rng.random() ** 2 * 400)] for _ in range(rng.randrange(0, 80)))) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {r.doc_id: (r.n_known, r.base_score, r.score) for r in mixing.context_mixing(docs).collect()}
    monkeypatch.setattr(mixing, "FREQUENT", frequent)
    got = {r.doc_id: (r.n_known, r.base_score, r.score) for r in mixing.context_mixing(docs).collect()}
    assert all(got[k][0] == whole[k][0] and np.allclose(got[k][1:], whole[k][1:], rtol=1e-9) for k in whole)


def test_tables_grow_with_the_vocabulary():
    sizes = [mixing.table_powers(n) for n in (0, 10 ** 6, 10 ** 7, 10 ** 8, 10 ** 12)]
    assert sizes[0] == sizes[1] == mixing.TABLES
    assert all(a <= b for x, y in zip(sizes, sizes[1:]) for a, b in zip(x, y))
    assert sizes[2][2] == 24 and sizes[-1][2] == mixing.MOST


def test_outcomes_are_sums_over_pieces():
    """The refinement does not depend on how the tuning part is cut, nor on repeated bytes."""
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab cd") for _ in range(rng.randrange(0, 90))) for _ in range(60)]
    layout = lambda ts: mixing.buffer_of(pa.array(ts, pa.large_string()))
    tree = mixing.Tree(np.ones(256, dtype=np.int64))
    whole, cut = mixing.Counts(), mixing.Counts()
    whole.add(*layout(texts), tree)
    for k in range(0, 60, 20):
        cut.add(*layout(texts[k:k + 20]), tree)
    assert np.array_equal(whole.finished(), cut.finished())
    assert whole.finished().sum() == 3 * tree.length[mixing.byte_stream(*layout(texts))[0]].sum()
    mixer = mixing.Mixer(tree, (np.random.default_rng(1).integers(-127, 128, int(tree.table_first[-1]))).astype(np.int8))
    none = mixing.Unigram(0, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    one = mixer.gather("refinement", *layout(texts), none)
    assert np.array_equal(one, sum(mixer.gather("refinement", *layout(texts[k:k + 20]), none) for k in range(0, 60, 20)))
    alone = [mixer.scores(*layout([t]), none)[0][0] for t in texts]
    assert np.allclose(mixer.scores(*layout(texts), none)[0], alone, rtol=1e-9)


def test_copies_score_alike_however_the_tuning_part_is_cut(spark, monkeypatch):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 7))) for _ in range(300)]
    rows = [(k, " ".join(words[int(rng.random() ** 2 * 300)] for _ in range(rng.randrange(1, 60)))) for k in range(400)]
    docs = spark.createDataFrame(rows + [(k + 1000, rows[3][1]) for k in range(200)], "doc_id long, text string")
    monkeypatch.setattr(mixing, "PIECE", 1 << 9)
    score = {r.doc_id: r.score for r in mixing.context_mixing(docs).collect()}
    assert len(score) == 600 and all(s < 0 and math.isfinite(s) for s in score.values())
    assert np.allclose([score[k + 1000] for k in range(200)], score[3], rtol=1e-12)
