"""Exact copies, near copies, repeated lines and repeated byte strings against brute force."""

import random
import re

import pytest
from conftest import SF001

from tributary.llm import exact_dedup as exact
from tributary.llm import jaccard_join as jaccard
from tributary.llm import line_dedup as lines
from tributary.llm import store
from tributary.llm import suffix_dedup as suffix
from tributary.llm.components import components

SCHEMA = "doc_id long, text string"
CLASHING = SCHEMA + ", digest string, id string, row long, keep int, hot int, `order` int, size int"


@pytest.fixture(autouse=True)
def settings(spark):
    store.prepare(spark)


def clashing(spark, rows):
    return spark.createDataFrame([(*r, "d", "i", 1, 2, 3, 4, 5) for r in rows], CLASHING)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(7, 7), (None, 3)]
    edges += [(500, k) for k in range(501, 600)]  # a star
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


ROWS = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (5, "b"), (None, "a"), (None, "z"),
        (None, "z"), (6, "é" * 50_000), (7, "é" * 50_000), (8, "A")] + [(100 + k, "hot") for k in range(60)]


def test_exact_groups(spark):
    got = exact.exact_groups(clashing(spark, ROWS)).collect()
    assert len(got) == len(ROWS)
    text = {i: t or "" for i, t in ROWS if i is not None}
    for r in got:
        if r.doc_id is None:
            continue
        same = [i for i, t in ROWS if (t or "") == text[r.doc_id]]
        assert r.group_size == len(same)
        assert r.keep_id == max(i for i in same if i is not None)
    assert sum(r.kept for r in got) == len({t or "" for _, t in ROWS})
    assert exact.exact_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_exact_dedup_keeps_columns_and_one_row(spark):
    docs = clashing(spark, ROWS)
    kept = exact.exact_dedup(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert len(got) == len({t or "" for _, t in ROWS})
    best = {}
    for i, t in ROWS:
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    assert {r.text or "": -1 if r.doc_id is None else r.doc_id for r in got} == best
    assert exact.exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def near_rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 7)))
    rows, passage = [], [word() for _ in range(30)]
    for k in range(60):
        body = [word() for _ in range(rng.randrange(0, 80))]
        if k % 3 == 0:
            body = body[:10] + passage + body[10:]
        rows.append((10 * k, " ".join(body)))
        for c in range(rng.randrange(0, 4)):
            copy = list(body)
            for _ in range(rng.randrange(0, 5)):
                if copy:
                    copy[rng.randrange(len(copy))] = word()
            rows.append((10 * k + c + 1, " ".join(copy).upper() if c % 2 else "\t".join(copy)))
    big = [word() for _ in range(120)]
    for k in range(40):
        rows.append((5000 + k, " ".join(big[:k % 7] + big[8:] + [word()])))
    return rows + [(9000, None), (9001, ""), (9002, " \n"), (9003, "one two"), (9004, "ONE  two"),
                   (9005, "x " * 30_000), (9006, "one two three four five")]


def brute_components(rows):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({k: k + 32 for k in range(65, 91)}))
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(low.get(find(k), i), i)
    return {i: (len(sets[k]), low[find(k)]) for k, (i, _) in enumerate(rows)}


@pytest.mark.parametrize("small, large", [(32, 4096), (2, 4096), (2, 4)])
def test_jaccard_join(spark, monkeypatch, small, large):
    monkeypatch.setattr(jaccard, "SMALL_REGION", small)
    monkeypatch.setattr(jaccard, "LARGE_REGION", large)
    rows = near_rows()
    got = jaccard.jaccard_join(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("text", "Body"),
                               text_col="Body").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_jaccard_join_edges(spark):
    assert jaccard.jaccard_join(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, None), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"),
            (4, "a b c d e f")]
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id)
                 for r in jaccard.jaccard_join(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 2, 3), (1, 0, 1), (2, 0, 2), (3, 2, 3), (3, 2, 3), (4, 2, 3)]
    kept = jaccard.near_duplicates_removed(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [1, 2, 3, 3]


def test_line_dedup(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.where("doc_id < 120").collect()]
    rows += [(9001, None), (9002, ""), (9003, "a\n\na"), (9004, "x " * 30 + "\n" + "x " * 29 + "y"),
             (9005, "\n".join(["the same line of words here"] * 300)), (9006, "y" * 5000),
             (9007, "y" * 5000 + "z")]
    got = {r.doc_id: (r.doc_id, r.n_lines, list(r.kept_lines))
           for r in lines.line_dedup(clashing(spark, rows)).collect()}
    assert [got[i] for i, _ in rows] == lines.brute_force(rows)
    left = {r.doc_id: r.text for r in lines.lines_removed(clashing(spark, rows))
            .where("doc_id > 9000").collect()}
    assert left[9001] is None and left[9002] == "" and left[9005].count("\n") == 0
    assert lines.line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("group", [4, 32])
def test_every_pair_of_a_band_is_compared(spark, monkeypatch, group):
    """Unlike lines share a long phrase; those alike are seldom an end of the bands they share."""
    monkeypatch.setattr(lines, "GROUP", group, raising=False)
    rng, rows = random.Random(7), []
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    phrase = [word() for _ in range(14)]
    for k in range(0, 240, 2):
        own = [word() for _ in range(6)]
        rows += [(k, " ".join(phrase + own + [word()])), (k + 1, " ".join(phrase + own + [word()]))]
    got = {r.doc_id: (r.doc_id, r.n_lines, list(r.kept_lines))
           for r in lines.line_dedup(clashing(spark, rows)).collect()}
    want = lines.brute_force(rows)
    assert sum(not kept for _, _, kept in want) == 120
    assert [got[i] for i, _ in rows] == want


def byte_rows():
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh é") for _ in range(900))
    rows = []
    for k in range(100):
        text = ""
        for _ in range(rng.randrange(0, 4)):
            a = rng.randrange(0, 700)
            text += base[a:a + rng.randrange(0, 300)]
            text += "".join(rng.choice("xyz") for _ in range(rng.randrange(0, 90)))
        rows.append((k, text))
    return rows + [(900, None), (901, ""), (902, "ab" * 400), (903, "a" * 1000), (904, base),
                   (905, base), (906, "q" * 199), (907, "q" * 100), (908, "k" * 200)]


@pytest.mark.parametrize("setting", [{}, {"hot": 3}, {"width": 40, "key": 16, "hot": 5}])
def test_suffix_dedup(spark, monkeypatch, setting):
    if setting:
        monkeypatch.setattr(suffix, "_WINDOWS", 50)  # few offsets at a time
    rows = byte_rows()
    got = {r.doc_id: tuple(r)[1:] for r in
           suffix.suffix_dedup(clashing(spark, rows), **setting).collect()}
    want = suffix.brute_force([t for _, t in rows], setting.get("width", suffix.WIDTH))
    assert [got[i] for i, _ in rows] == want


def test_suffix_dedup_edges(spark):
    assert suffix.suffix_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    text = "".join(chr(97 + k * k % 26) for k in range(300))
    got = suffix.suffix_dedup(spark.createDataFrame([(1, text), (1, text), (None, "b")], SCHEMA))
    assert sorted(tuple(r)[1:3] for r in got.collect()) == [(1, 0), (300, 300), (300, 300)]
    with pytest.raises(ValueError):
        suffix.repeated_spans(spark.createDataFrame([], SCHEMA), "doc_id", "text", 40, 12)


def test_anchors_in_slices(monkeypatch):
    """A long text cut into slices names the same anchors for the same windows."""
    import numpy as np
    data = np.frombuffer(random.Random(6).randbytes(5000) + b"ab" * 1500, dtype=np.uint8)
    offsets = np.array([0, 700, 700, 5200, len(data)])

    def by_window():
        out = {}
        for text, place, first, end, _ in zip(*suffix.anchors(data, offsets, 40, 16)):
            out.update({w: (int(text), int(place)) for w in range(first, end)})
        return out

    whole = by_window()
    monkeypatch.setattr(suffix, "SLICE_BYTES", 257)
    assert by_window() == whole
    assert set(whole) == {w for a, b in zip(offsets[:-1], offsets[1:]) for w in range(a, b - 39)}


def test_sketches_bound_the_difference():
    import numpy as np
    rng = np.random.default_rng(1)
    for n in (5, 400, 600, 1100, 5000, 70_000):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[n // 5:], rng.integers(0, 1 << 63, n // 3).astype(np.uint64)]))
        x, y = jaccard._sketch(a), jaccard._sketch(b)
        size = min(len(x), len(y))
        bits = int(np.bitwise_count(jaccard._folded(x, size) ^ jaccard._folded(y, size)).sum())
        assert bits <= len(np.setxor1d(a, b)) and jaccard.SKETCH <= len(x) <= jaccard.LARGEST_SKETCH
        assert (jaccard._folded(x, jaccard.SKETCH) ==
                jaccard._folded(jaccard._folded(x, size).tobytes(), jaccard.SKETCH)).all()
