"""Every window of a line's characters counts in its set, wherever it begins."""

import pytest
from pyspark.sql import functions as F

from tributary.llm import line_dedup as lines

K = lines.SHINGLE


def test_every_window_is_in_the_set(spark):
    texts = ["The quick brown fox jumps over it", "x" * 40 + "y" + "z" * 40, "short", "a b", "exactly 12 ch", "  ",
             "", " lead and trail  ", "é😀" * 15 + " ü", "tail\r", "😀" * 11, "a b\u0085c" * 6]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, line string")
    got = {r.i: r.s for r in rows.select("i", lines.line_shingles(F.col("line")).alias("s")).collect()}
    for i, x in enumerate(texts):
        windows = [x[k:k + K] for k in range(max(1, len(x) - K + 1))] if x.strip(" ") else []
        assert got[i] == windows, x


def test_words_that_differ_inside_are_seen(spark):
    """Alike in every window from a word's start and from each 12th character on, but not in all:
    a blank more in front of long words moves each later window."""
    a = " ".join(f"{k:02d}" + "abcdefghijklmnopqrstuv"[k:] + "abcdefghijklmnopqrstuv"[:k] for k in range(8))
    rows = [(1, a), (2, a + " end"), (3, "".join(reversed(a))), (4, a.replace(" ", "  ")), (5, a)]
    got = [(r.doc_id, r.n_lines, r.kept_lines) for r in lines.line_dedup(
        spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == lines.brute_force(rows)
    assert dict((i, k) for i, _, k in got) == {1: [0], 2: [], 3: [0], 4: [0], 5: []}


def test_sets_of_candidates_are_lines_and_only_theirs_are_shuffled(spark, monkeypatch):
    """A set is many times its line: neither staged nor shuffled. The lines are sifted before their join."""
    rows = [(k, f"{k:06d} " + " ".join(f"w{k * j % 977:03d}" for j in range(1, 60))) for k in range(400)]
    rows += [(1000 + k, rows[k + 1][1] + " end") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found, signed = lines.identified(docs, "doc_id", "text")
    wanted = lines.stage(lines.band_members(signed).select("key").distinct(), "wanted")
    plans, stage = {}, lines.stage

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return stage(df, name)
    monkeypatch.setattr(lines, "stage", noted)
    sets = lines.line_sets(found, wanted)
    assert sets.columns == ["key", "line", "size"]
    assert all(len({r.line[k:k + K] for k in range(len(r.line) - K + 1)}) == r.size for r in sets.collect())
    # the bitmap is below the join with the wanted keys
    assert plans["sets"].index("Join Inner") < plans["sets"].index("bit_get") and "LeftSemi" not in plans["sets"]
    ends = lines.band_members(signed).join(sets.select("key", "size", F.lit(2 ** 31 - 1).alias("most")), "key")
    assert lines.verified_links(lines._listed(ends, "band").distinct(), sets).count() == 4


@pytest.mark.parametrize("length", [1, K - 1, K, K + 1, K + 6, K + 7, K + 8, 5 * K])
def test_signatures_meet_every_window(spark, length):
    """The least hashes are those of the set, wherever the last row of windows ends."""
    text = "".join(chr(97 + k * k % 23) if k % 5 else "é" for k in range(length))
    row = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = lines.split_lines(row, "doc_id", "text")
    h = found.select(lines.line_set(F.col("line")).alias("h")).first().h
    assert len(h) == len({text[k:k + K] for k in range(max(1, length - K + 1))})
    least = [min(x ^ lines._constant(k) for x in h) for k in range(lines.BANDS * lines.ROWS)]
    want = spark.createDataFrame([tuple(least)], [f"m{k}" for k in range(len(least))]).select(
        *[F.xxhash64(F.lit(b), *[f"m{k}" for k in range(b * lines.ROWS, (b + 1) * lines.ROWS)])
          for b in range(lines.BANDS)]).first()
    assert lines.signatures(found).first().bands == list(want)


def test_links_are_verified_without_distinct_sets_first(spark, monkeypatch):
    """An intersection is distinct by itself; windows that repeat in a line count once."""
    rows = [(1, "abcdefghijklmnopqrstuvwx" * 4), (2, "abcdefghijklmnopqrstuvwx" * 6), (3, "x" * 90), (4, "x" * 40),
            (5, "abcdefghijklmnopqrstuvwx" * 4 + "0123456789" * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lines.split_lines(docs, "doc_id", "text")
    sets = found.select("key", "line", F.size(lines.line_set(F.col("line"))).alias("size"))
    pairs = sets.select(F.col("key").alias("a")).join(sets.select(F.col("key").alias("b"))).where("a < b")
    plans, stage = {}, lines.stage

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return stage(df, name)
    monkeypatch.setattr(lines, "stage", noted)
    of = {r.key: r.id for r in found.collect()}
    assert {tuple(sorted((of[r.a], of[r.b]))) for r in lines.verified_links(pairs, sets).collect()} == {(1, 2), (3, 4)}
    assert "array_intersect" in plans["links"] and plans["links"].count("array_distinct") <= 2  # of the sizes given


def test_a_window_enters_one_bin_in_place_of_every_permutation(spark, monkeypatch):
    """The least hash under each permutation is read from the bins' least hashes, also where most bins
    are empty; no generated method is too long for the JVM to compile (8,000 bytes)."""
    import re
    rows = [(k, "".join(chr(97 + (k * 31 + j * j * (k % 7 + 1)) % 26) for j in range(k * k // 3 + 1))) for k in range(40)]
    found = lines.split_lines(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    plans, stage = {}, lines.stage

    def noted(df, name):
        explain = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString
        plans[name] = [df._jdf.queryExecution().explainString(explain(mode)) for mode in ("extended", "codegen")]
        return stage(df, name)
    monkeypatch.setattr(lines, "stage", noted)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else no code is generated before the run
    try:
        signed = {r.key: r.bands for r in lines.signatures(found).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", plans["signatures"][1])]
    assert sizes and max(sizes) < 8000
    aggregate = re.search(r"\n *\+?-? *Aggregate .*", plans["signatures"][0]).group()
    assert " ^ " not in aggregate and "FILTER" in aggregate
    hashes = {r.key: r.h for r in found.select("key", lines.line_set(F.col("line")).alias("h")).collect()}
    assert set(signed) == set(hashes)
    least = [(key, *[min(x ^ lines._constant(k) for x in h) for k in range(lines.BANDS * lines.ROWS)])
             for key, h in hashes.items()]
    names = [f"m{k}" for k in range(lines.BANDS * lines.ROWS)]
    want = spark.createDataFrame(least, ["key", *names]).select("key", F.array(
        *[F.xxhash64(F.lit(b), *names[b * lines.ROWS:(b + 1) * lines.ROWS]) for b in range(lines.BANDS)]).alias("bands"))
    assert {r.key: r.bands for r in want.collect()} == signed
