"""Quoted delimited files read by byte ranges, against the reader that takes a file whole."""

import csv
import io
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from tributary.lake.store import filesystem_of
from tributary.session import scratch_path
from tributary.sources import delimited, split_delimited as split

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("note", T.StringType())])


def put(root, name, data: bytes):
    disk, base = filesystem_of(root)
    disk.create_dir(base, recursive=True)
    with disk.open_output_stream(f"{base}/{name}", compression=None) as out:
        out.write(data)


def rendered(rows, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    writer.writerow(["id", "text", "note"])
    for r in rows:
        writer.writerow(r)
    return out.getvalue()


def values(df):
    return sorted(((r.id, r.text, r.note) for r in df.collect()), key=repr)


def some_rows(n, seed=1):
    rng = random.Random(seed)
    pieces = ['"', "\n", ",", "a", "bc", "é", " ", '""', "\n\n", "x" * 40]
    return [(k, "".join(rng.choice(pieces) for _ in range(rng.randrange(9))) + "w", f"n{k}") for k in range(n)]


def test_record_breaks_against_the_csv_reader():
    for seed in range(40):
        text = rendered(some_rows(30, seed))
        data = text.encode()
        whole = [r for r in csv.reader(io.StringIO(text, newline=""))]
        for size in (1, 7, 64, 333):
            got, state = [], False
            states = np.bitwise_xor.accumulate((np.frombuffer(data, np.uint8) == 34).astype(np.uint8))
            for start in range(0, len(data), size):
                state = bool(states[start - 1]) if start else False
                for found, _ in split.range_records(io.BytesIO(data), start, min(start + size, len(data)),
                                                    state, 34, piece=11):
                    got += [x.as_py().decode() for x in found]
            assert "".join(got) == text, (seed, size)
            assert [next(csv.reader(io.StringIO(x, newline=""))) for x in got] == whole


@pytest.mark.parametrize("range_bytes", [50, 1000, 1 << 20])
def test_rows_equal_the_whole_file_reader(spark, range_bytes):
    root = scratch_path(spark, "test", "split")
    put(root, "a.csv", rendered(some_rows(120)).encode())
    put(root, "b.csv", rendered(some_rows(40, 2), "\r\n").encode())
    put(root, "c.csv", rendered(some_rows(3, 3)).rstrip("\n").encode())
    put(root, "d.csv", b"id,text,note\n")
    put(root, "e.csv", b"")
    put(root, "f.csv", b'id,text,note\n7,,""\n\n8,"",x\n')
    got = values(split.read_split_delimited(spark, root, SCHEMA, range_bytes=range_bytes))
    assert got == values(delimited.read_delimited(spark, root, SCHEMA))


def test_one_file_is_read_by_many_tasks(spark):
    root = scratch_path(spark, "test", "large")
    rows = [(k, ('line one of %d\nline "two", and more words\n' % k) * 6, "n") for k in range(60_000)]
    data = rendered(rows).encode()
    put(root, "big.csv", data)
    df = split.read_split_delimited(spark, root, SCHEMA, range_bytes=1 << 20)
    assert len(data) > 16 << 20
    assert df.rdd.getNumPartitions() == -(-len(data) // (1 << 20))
    busy = df.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert sum(busy) == len(rows) and min(busy) > 0
    assert df.count() == len(rows) and df.where("text like '%two%' and note = 'n'").count() == len(rows)
    assert delimited.read_delimited(spark, root, SCHEMA).exceptAll(df).count() == 0


def test_a_long_field_over_many_ranges(spark):
    root = scratch_path(spark, "test", "long")
    rows = [(1, "a\n" * 4000 + 'q"', "x"), (2, "b", "y"), (3, "\n" * 500, "z")]
    put(root, "a.csv", rendered(rows).encode())
    got = split.read_split_delimited(spark, root, SCHEMA, range_bytes=100)
    assert values(got) == sorted(rows, key=repr)


def test_malformed_records_and_headers(spark):
    root = scratch_path(spark, "test", "bad")
    put(root, "a.csv", b"id,text,note\n1,a,b\nx,c,d\n2,e\n")
    got = split.read_split_delimited(spark, root, SCHEMA, corrupt_col="bad")
    assert {(r.id, r.bad) for r in got.collect()} == {(1, None), (None, "x,c,d"), (2, "2,e")}
    put(root, "b.csv", b"id,other,note\n1,a,b\n")
    with pytest.raises(Exception, match="header of"):
        split.read_split_delimited(spark, root, SCHEMA).collect()
    put(root, "c.csv.gz", b"x")
    with pytest.raises(ValueError, match="compressed"):
        split.read_split_delimited(spark, root, SCHEMA, glob="*")
