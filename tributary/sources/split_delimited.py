"""Quoted delimited files read by many tasks.

Whether a newline ends a record depends on the quotes before it, so a quoted file cannot be cut
at any newline. It can be cut anywhere once the state at the cut is known, and that state is the
parity of the quotes before it:

1. every byte range of every file counts its quotes (a task a range);
2. the ranges' parities, one row a range, are combined from the front of each file: that gives
   the state at which each range begins;
3. every range parses alone: it passes over what belongs to the record before it, and reads on
   beyond its end until its last record is complete.

The text is read twice and never shuffled. A quote inside a quoted field is written twice, and a
field that holds quotes is quoted (RFC 4180); compressed files have no ranges and are refused.
"""

from __future__ import annotations

import csv

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.lake.store import filesystem_of
from tributary.session import ship_package, written

RANGE_BYTES = 128 << 20
PIECE = 4 << 20
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".xz")

RANGES = "path string, start long, stop long, length long"


def byte_ranges(spark: SparkSession, paths, range_bytes: int = RANGE_BYTES,
                glob: str = "*.csv") -> DataFrame:
    """(path, start, stop, length) of all ranges of the files under ``paths``; a file's last range
    may be shorter. Files are listed, not read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(paths).select("path", "length")
             .where(F.col("length") > 0))
    refused = files.where(F.lower("path").rlike("(" + "|".join(c.replace(".", r"\.") for c in COMPRESSED) + ")$"))
    bad = refused.limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0].path} is compressed: it can only be read whole")
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1,
                                 F.lit(range_bytes).cast("bigint")))
    return (files.select("path", start.alias("start"), "length")
            .select("path", "start", F.least(F.col("start") + range_bytes, F.col("length")).alias("stop"), "length"))


def _each_in_its_task(ranges: DataFrame) -> DataFrame:
    return ranges.repartition(max(1, ranges.count()))


def range_states(ranges: DataFrame, quote: str = '"') -> DataFrame:
    """The ranges with ``open``: whether a quoted field is open where the range begins."""
    mark = quote.encode()

    def count(batches):
        for batch in batches:
            odd = []
            for path, start, stop, _ in zip(*(c.to_pylist() for c in batch.columns)):
                disk, name = filesystem_of(path)
                n = 0
                with disk.open_input_file(name) as file:
                    file.seek(start)
                    while start < stop:
                        piece = file.read(min(PIECE, stop - start))
                        if not piece:
                            break
                        n += piece.count(mark)
                        start += len(piece)
                odd.append(n % 2)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(odd, pa.int64())],
                                             names=[*batch.schema.names, "odd"])

    counted = written(_each_in_its_task(ranges).mapInArrow(count, f"{RANGES}, odd long"), "csv", "quotes")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("open", F.coalesce(F.sum("odd").over(before) % 2, F.lit(0)) == 1).drop("odd")


def record_breaks(data: np.ndarray, is_open: bool, quote: int) -> tuple[np.ndarray, bool]:
    """Places after the newlines that end a record, and the state after the bytes."""
    inside = np.bitwise_xor.accumulate((data == quote).astype(np.uint8)) if len(data) else data
    closed = inside == (1 if is_open else 0)
    breaks = np.flatnonzero((data == 0x0A) & closed) + 1
    return breaks, bool(is_open ^ (bool(inside[-1]) if len(data) else False))


def range_records(file, start: int, stop: int, is_open: bool, quote: int, piece: int = PIECE):
    """Batches of the records that begin in [start, stop), as Arrow arrays of text with their line
    ends, and whether the first one begins the file."""
    at, held, owned, first = start, b"", start == 0, start == 0
    if start:
        file.seek(start - 1)
        owned = file.read(1) == b"\n" and not is_open
    file.seek(start)
    begin = start  # where the bytes of ``held`` begin
    while True:
        data = file.read(piece)
        if not data:
            if owned and held and begin < stop:
                yield pa.array([held], pa.binary()), first
            return
        breaks, is_open = record_breaks(np.frombuffer(data, np.uint8), is_open, quote)
        if not owned:  # what is left of the record before
            if not len(breaks) or at + int(breaks[0]) >= stop:
                if len(breaks) or at >= stop:
                    return
                at += len(data)
                continue
            data = data[int(breaks[0]):]
            at += int(breaks[0])
            breaks, begin, owned = breaks[1:] - breaks[0], at, True
        joined = held + data
        ends = breaks + len(held)
        starts = np.concatenate([[0], ends])[:-1] if len(ends) else ends
        mine = int(np.count_nonzero(begin + starts < stop))
        if mine:
            offsets = np.concatenate([[0], ends[:mine]]).astype(np.int32)
            yield pa.Array.from_buffers(pa.binary(), mine, [
                None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(joined)]), first
            first = False
        at += len(data)
        if len(ends):
            held, begin = joined[int(ends[-1]):], begin + int(ends[-1])
        else:
            held = joined
        if begin >= stop:
            return


def read_split_delimited(spark: SparkSession, paths, schema: T.StructType, sep: str = ",",
                         header: bool = True, corrupt_col: str | None = None,
                         range_bytes: int = RANGE_BYTES, glob: str = "*.csv") -> DataFrame:
    """The rows of quoted delimited files (fields may hold delimiters and newlines), a task a
    byte range. With ``header`` every file's first record must name the schema's columns. Records
    that do not fit the schema are kept, their text in ``corrupt_col`` when given."""
    ship_package(spark)
    ranges = written(range_states(byte_ranges(spark, paths, range_bytes, glob)), "csv", "ranges")
    names = [f.name for f in schema.fields]

    def parse(batches):
        for batch in batches:
            for path, start, stop, _, is_open in zip(*(c.to_pylist() for c in batch.columns)):
                disk, name = filesystem_of(path)
                with disk.open_input_file(name) as file:
                    for found, first in range_records(file, start, stop, is_open, ord('"')):
                        if first and header:
                            got = next(csv.reader([found[0].as_py().decode().rstrip("\r\n")], delimiter=sep))
                            if got != names:
                                raise ValueError(f"header of {path} is {got}, not {names}")
                            found = found.slice(1)
                        text = pc.replace_substring_regex(found, "\r?\n$", "")
                        text = text.filter(pc.greater(pc.binary_length(text), 0))
                        for k in range(0, len(text), 4096):
                            yield pa.RecordBatch.from_arrays([text.slice(k, 4096)], names=["record"])

    records = _each_in_its_task(ranges).mapInArrow(parse, "record binary")
    fields = list(schema.fields)
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    if corrupt_col:
        fields.append(T.StructField(corrupt_col, T.StringType()))
        options["columnNameOfCorruptRecord"] = corrupt_col
    row = F.from_csv(F.col("record").cast("string"), F.lit(T.StructType(fields).toDDL()), options)
    return records.select(row.alias("row")).select("row.*")
