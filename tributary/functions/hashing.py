"""Hash functions (P6, A19) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MOD32 = 4294967296  # 2**32
_SIGN32 = 2147483648  # 2**31


def java_hash(c) -> Column:
    """Java ``String.hashCode`` (signed 32 bit) over the key's code points.

    h = (31*h + code point) mod 2^32 folded left over the characters, then
    reinterpreted as signed. Runs as a higher-order function inside codegen.
    """
    c = F.col(c) if isinstance(c, str) else c
    # one split into characters (the empty text gives one empty piece, which is skipped)
    pieces = F.filter(F.split(c, ""), lambda x: x != "")
    codes = F.transform(pieces, lambda x: F.ascii(x).cast("bigint"))
    h = F.aggregate(codes, F.lit(0).cast("bigint"), lambda a, x: (a * 31 + x) % _MOD32)
    signed = F.when(h >= _SIGN32, h - _MOD32).otherwise(h)
    return F.when(c.isNull(), F.lit(None)).otherwise(signed.cast("int"))


def hadoop_partition(hash_col: Column, reducers: int) -> Column:
    """Default Hadoop partitioner: (hash & MAX_INT) % R."""
    return (hash_col.cast("bigint").bitwiseAND(F.lit(0x7FFFFFFF)) % F.lit(reducers)).cast("int")


def spark_partition(key: Column, partitions: int) -> Column:
    """Spark's own hash partitioning of a key: pmod(murmur3(key), n)."""
    return F.pmod(F.hash(key), F.lit(partitions))


def null_safe_row_text(cols: list[str]) -> Column:
    """An injective text encoding of a row: each field is length-prefixed and
    NULL has its own marker, so distinct rows never encode alike."""
    parts = [F.coalesce(F.concat(F.char_length(F.col(c).cast("string")).cast("string"),
                                  F.lit(":"), F.col(c).cast("string")), F.lit("N"))
             for c in cols]
    return F.concat_ws("|", *parts)


def row_fingerprint(cols: list[str]) -> Column:
    """SHA-256 of the injective row encoding: a fixed 32-byte grouping key."""
    return F.sha2(null_safe_row_text(cols), 256)


def row_hashes(cols: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row, as exact decimals. Spark's hash skips NULLs,
    so each column's null flag is hashed beside it: a value that moves to
    another column changes both."""
    fields = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    return (F.xxhash64(*fields).cast("decimal(38,0)"),
            F.xxhash64(F.lit("second"), *reversed(fields)).cast("decimal(38,0)"))


def table_fingerprint_aggs(cols: list[str]) -> list[Column]:
    """Order-insensitive fingerprint of a whole table: count plus exact
    (decimal, non-overflowing) sums of two 64-bit row hashes."""
    one, two = row_hashes(cols)
    return [F.count(F.lit(1)).alias("rows"),
            F.concat_ws(":", F.coalesce(F.sum(one), F.lit(0)).cast("string"),
                        F.coalesce(F.sum(two), F.lit(0)).cast("string")).alias("hash_sum")]
