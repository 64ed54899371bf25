"""Source profiling (A10-A18, A20, A23, T2, T3): one wide aggregate pass
per table, reshaped to long form with ``explode(array(struct))`` so the
result has one row per column or per group, never a driver loop over data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.numeric import round_half_up, safe_ratio
from tributary.functions.text import canonical_number
from tributary.functions.timeutil import hours_between
from tributary.operators.joins import attach_one_row, broadcast_if_small
from tributary.session import written

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)
TEXT = (T.StringType,)
TIMES = (T.TimestampType, T.TimestampNTZType)

# Declared in-memory width model (bytes) of a loaded frame: every numeric,
# time or boolean cell is one 8-byte slot; a text cell is an 8-byte pointer
# plus a string object (49-byte header + UTF-8 payload); a missing text cell
# points at the shared NULL object, counted at 16 bytes.
# A nested cell (array, map or struct) is a pointer to a container object that
# holds the cells of its elements, keys or fields; as delimited text it is a
# quoted, bracketed list of their texts (a map's entries as key:value).
SLOT_BYTES = 8
STRING_HEADER_BYTES = 49
NULL_OBJECT_BYTES = 16
CONTAINER_BYTES = 56
NESTED = (T.ArrayType, T.MapType, T.StructType)


def type_name(dt: T.DataType) -> str:
    return dt.simpleString()


def is_text(dt: T.DataType) -> bool:
    return isinstance(dt, TEXT)


# --- A10 ---------------------------------------------------------------------

def source_profile(df: DataFrame, name: str) -> DataFrame:
    """A10: rows, columns, text columns, text share and a type -> count list."""
    fields = df.schema.fields
    counts: dict[str, int] = {}
    for f in fields:
        counts[type_name(f.dataType)] = counts.get(type_name(f.dataType), 0) + 1
    n_text = sum(1 for f in fields if is_text(f.dataType))
    types = ",".join(f"{k}:{v}" for k, v in sorted(counts.items()))
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("source"), "rows", F.lit(len(fields)).alias("columns"),
        F.lit(n_text).alias("text_columns"),
        round_half_up(F.lit(n_text / len(fields) if fields else 0.0), 3).alias("text_share"),
        F.lit(types).alias("types"))


# --- A11 ---------------------------------------------------------------------

def _is_missing(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    m = F.col(c).isNull()
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        m = m | F.isnan(F.col(c))
    return m


def _null_aggs(df: DataFrame) -> list[Column]:
    return [F.avg(_is_missing(df, c).cast("double")).alias(f"_n{i}") for i, c in enumerate(df.columns)]


def _null_long(one: DataFrame, cols: list[str]) -> DataFrame:
    long = F.explode(F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column_name"),
                                        F.col(f"_n{i}").alias("share"))
                               for i, c in enumerate(cols)]))
    return one.select("rows", long.alias("x")).select("rows", "x.pos", "x.column_name", "x.share")


def null_shares(df: DataFrame) -> DataFrame:
    """Long form (position, column, null share) from one aggregate pass."""
    return _null_long(df.agg(*_null_aggs(df), F.count(F.lit(1)).alias("rows")), df.columns)


def _completeness_from(s: DataFrame) -> DataFrame:
    return s.agg(
        F.first("rows").alias("rows"),
        F.count(F.lit(1)).alias("columns"),
        round_half_up(F.avg("share"), 4).alias("null_share_mean"),
        round_half_up(F.max("share"), 4).alias("null_share_max"),
        F.max(F.struct("share", (-F.col("pos")).alias("neg_pos"), "column_name"))["column_name"]
        .alias("worst_column"),
        F.count(F.when(F.col("share") == 1.0, 1)).alias("all_null_columns"),
        F.count(F.when(F.col("share") > 0.5, 1)).alias("over_half_columns"))


def completeness(df: DataFrame) -> DataFrame:
    """Mean / max null share, worst column (first column on ties),
    columns 100 % null and columns over 50 % null."""
    return _completeness_from(null_shares(df))


# --- A12, A13 ----------------------------------------------------------------

def row_prefilter(cols: list[str]) -> Column:
    """A cheap 64-bit hash of a row: rows that differ may share it, equal rows always do."""
    return F.xxhash64(*[F.col(_q(c)) for c in cols])


def row_duplicates(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Full-row duplicates beyond the first occurrence (NULLs equal, and
    a zero equals a negative zero), exactly.

    A first pass counts 64-bit row hashes, eight bytes a row and one partial row per task
    and hash. Only rows whose hash occurs more than once go on: they are grouped by their
    columns themselves, so unlike rows that share a hash are told apart. A row repeated
    very often costs one record per task in both aggregates."""
    cols = cols or df.columns
    plain = df.select(*[
        F.when(F.col(_q(c)) == 0, F.lit(0.0)).otherwise(F.col(_q(c))).alias(c)
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else F.col(_q(c))
        for c in cols])
    mark = "_hash"
    while mark in plain.columns:
        mark += "_"
    counts = written(plain.groupBy(row_prefilter(cols).alias(mark)).agg(F.count(F.lit(1)).alias("n")),
                     "profile", "row_hashes")
    repeated = written(counts.where(F.col("n") > 1).select(mark), "profile", "repeated_hashes")
    total = counts.agg(F.sum("n").alias("_rows"))
    candidates = plain.withColumn(mark, row_prefilter(cols)).join(
        broadcast_if_small(repeated), mark, "left_semi").drop(mark)
    groups = candidates.groupBy(*[F.col(_q(c)) for c in cols]).agg(F.count(F.lit(1)).alias("_n"))
    out = attach_one_row(groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_dup")), total)
    return out.select(
        F.col("_rows").cast("bigint").alias("rows"),
        F.when(F.col("_rows").isNotNull(), F.col("_dup")).cast("bigint").alias("duplicate_rows"),
        round_half_up(safe_ratio(F.col("_dup"), F.col("_rows")), 4).alias("duplicate_share"))


def key_duplicates(df: DataFrame, key: str) -> DataFrame:
    """Rows repeating an earlier key value (NULL keys form one group)."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("dup")).select(
        F.col("rows").cast("bigint").alias("rows"),
        F.col("dup").cast("bigint").alias("key_duplicates"),
        round_half_up(safe_ratio(F.col("dup"), F.col("rows")), 4).alias("key_duplicate_share"))


# --- A14 ---------------------------------------------------------------------

def arrival_profile(df: DataFrame, ts_col: str, group_col: str | None = None,
                    as_of: Column | None = None, declared_frequency: str | None = None) -> DataFrame:
    """First / last record, span in hours, records per hour, lag in days
    to ``as_of`` (default: the latest timestamp of the whole table), declared
    frequency. Only parseable timestamps count; span 0 -> rate NULL. A missing
    column gives one row, a group without a parseable timestamp its row, with
    a note and no figures."""
    if ts_col not in df.columns:
        return df.sparkSession.range(1).select(
            F.lit("*").alias("source"), F.lit(0).cast("bigint").alias("rows"),
            *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("first_ts", "last_ts")],
            *[F.lit(None).cast("double").alias(c) for c in ("span_hours", "rows_per_hour", "lag_days")],
            F.lit(declared_frequency).cast("string").alias("declared_frequency"),
            F.lit(f"column {ts_col} missing").alias("note"))
    ts = F.col(ts_col)
    keys = [F.col(group_col).alias("source")] if group_col else [F.lit("*").alias("source")]
    g = df.groupBy(*keys).agg(
        F.count(ts).alias("rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    ref = df.agg(F.max(ts).alias("_as_of")) if as_of is None else \
        df.sparkSession.range(1).select(as_of.cast("timestamp_ntz").alias("_as_of"))
    span = hours_between(F.col("last_ts"), F.col("first_ts"))
    return attach_one_row(g, ref).select(
        "source", "rows", "first_ts", "last_ts",
        round_half_up(span, 2).alias("span_hours"),
        F.when(span > 0, round_half_up(F.col("rows") / span, 2)).alias("rows_per_hour"),
        round_half_up(hours_between(F.col("_as_of"), F.col("last_ts")) / 24, 2).alias("lag_days"),
        F.lit(declared_frequency).cast("string").alias("declared_frequency"),
        F.when(F.col("rows") == 0, F.lit(f"column {ts_col} without parseable dates")).alias("note"))


# --- A15, T2 -----------------------------------------------------------------

def _text_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_text(f.dataType)]


def _len_aggs(df: DataFrame) -> list[Column]:
    return [F.avg(F.char_length(c)).alias(f"_l{i}") for i, c in enumerate(_text_cols(df))]


def _len_long(one: DataFrame, name: str, text_cols: list[str]) -> DataFrame:
    if not text_cols:
        return one.sparkSession.createDataFrame(
            [], "source string, pos int, column_name string, mean_len double")
    long = F.explode(F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("column_name"),
                                        F.col(f"_l{i}").cast("double").alias("mean_len"))
                               for i, c in enumerate(text_cols)]))
    return one.select(F.lit(name).alias("source"), long.alias("x")).select(
        "source", "x.pos", "x.column_name", "x.mean_len")


def text_lengths(df: DataFrame, name: str) -> DataFrame:
    """Long form (table, position, column, mean characters) over text columns."""
    aggs = _len_aggs(df)
    one = df.agg(*aggs) if aggs else df.limit(0)
    return _len_long(one, name, _text_cols(df))


def _text_width_from(lens: DataFrame, df_schema: T.StructType, name: str, wide_chars: int) -> DataFrame:
    fields = df_schema.fields
    distinct_types = len({type_name(f.dataType) for f in fields})
    n_text = sum(1 for f in fields if is_text(f.dataType))
    s = lens.agg(F.avg("mean_len").alias("m"), F.count(F.when(F.col("mean_len") > wide_chars, 1))
                 .alias("w"))
    return s.select(F.lit(name).alias("source"), F.lit(distinct_types).alias("distinct_types"),
                    F.lit(len(fields)).alias("columns"), F.lit(n_text).alias("text_columns"),
                    round_half_up(F.col("m"), 2).alias("mean_text_len"),
                    F.col("w").alias("wide_text_columns"))


def text_width_profile(df: DataFrame, name: str, wide_chars: int = 80) -> DataFrame:
    """Distinct types, columns, text columns, mean of the per-column mean
    lengths (NULL when there is no text column) and columns wider than 80."""
    return _text_width_from(text_lengths(df, name), df.schema, name, wide_chars)


def top_text_columns(lengths: DataFrame, k: int = 5) -> DataFrame:
    """The k widest text columns of each table (ties by column position);
    the window runs over the long form, one row per column."""
    w = Window.partitionBy("source").orderBy(F.desc("mean_len"), F.asc("pos"))
    return (lengths.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .where(F.col("rank") <= k)
            .select("source", "rank", "column_name", round_half_up(F.col("mean_len"), 4).alias("mean_len")))


# --- A16 width model ------------------------------------------------------------
# Width expressions are generated as SQL text: one ``F.expr`` per aggregate
# keeps plan construction to a handful of driver->JVM calls even for wide
# tables, where building Column trees call by call dominated the run time.

def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def canonical_sql(c: str) -> str:
    """P7 as Spark SQL text (same rule as ``functions.text.canonical_number``)."""
    v = f"CAST({c} AS DOUBLE)"
    fixed = f"CAST(CAST(round(TRY_CAST({v} AS DECIMAL(38,9)), 6) AS DECIMAL(38,6)) AS STRING)"
    frac = (f"coalesce(regexp_replace(regexp_replace({fixed}, '0+$', ''), '\\\\.$', ''), "
            f"CAST({v} AS STRING))")
    return (f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} = floor({v}) AND abs({v}) < 1e15 "
            f"THEN CAST(CAST({v} AS BIGINT) AS STRING) ELSE {frac} END")


def scaled_sql(x: str) -> str:
    """round(x, 6) as an exact count of millionths (BIGINT) for |x| < 9e12,
    through the same decimal(38,9) step as ``canonical_number``."""
    v = f"CAST({x} AS DOUBLE)"
    return (f"CASE WHEN abs({v}) < 9e12 THEN "
            f"CAST(round(CAST({v} AS DECIMAL(38,9)), 6) * 1000000 AS BIGINT) END")


def canonical_width_sql(x: str, scaled: str | None = None) -> str:
    """octet_length(canonical text) computed arithmetically: integer digits,
    sign, and the significant digits of the 6-decimal fraction (from the
    scaled value), instead of formatting the text and stripping zeros with
    two regexes per cell. Values beyond 9e12 take the text route.
    ``scaled``: a column already holding ``scaled_sql(x)``."""
    v = f"CAST({x} AS DOUBLE)"
    u = scaled or f"({scaled_sql(x)})"
    f = f"(abs({u}) % 1000000)"
    frac = (f"CASE WHEN {f} = 0 THEN 0 WHEN {f} % 100000 = 0 THEN 2 WHEN {f} % 10000 = 0 THEN 3 "
            f"WHEN {f} % 1000 = 0 THEN 4 WHEN {f} % 100 = 0 THEN 5 WHEN {f} % 10 = 0 THEN 6 ELSE 7 END")
    ints = f"char_length(CAST(abs({u}) DIV 1000000 AS STRING)) + CASE WHEN {u} < 0 THEN 1 ELSE 0 END"
    return (f"CASE WHEN {v} = floor({v}) AND abs({v}) < 1e15 "
            f"THEN char_length(CAST(CAST({v} AS BIGINT) AS STRING)) "
            f"WHEN {u} IS NOT NULL THEN {ints} + {frac} "
            f"ELSE octet_length({canonical_sql(x)}) END")


def csv_width_sql(c: str, dt: T.DataType, scaled: str | None = None) -> str:
    """Bytes of a cell written as delimited text (without its delimiter)."""
    x = _q(c)
    if is_text(dt):
        w = (f"octet_length({x}) + CASE WHEN {x} RLIKE '[,\"\\r\\n]' "
             f"THEN 2 + (char_length({x}) - char_length(replace({x}, '\"', ''))) ELSE 0 END")
    elif isinstance(dt, NESTED):
        w = f"2 + {text_width_sql(x, dt)}"
    else:
        w = text_width_sql(x, dt, scaled)
    return f"CAST(CASE WHEN {x} IS NULL THEN 0 ELSE {w} END AS BIGINT)"


def _sum_over(array: str, each, depth: int) -> str:
    """The sum of ``each(element)`` over an array, as SQL; ``depth`` names the variables."""
    e, t = f"e{depth}", f"t{depth}"
    return f"aggregate({array}, CAST(0 AS BIGINT), ({t}, {e}) -> {t} + CAST({each(e)} AS BIGINT))"


def text_width_sql(x: str, dt: T.DataType, scaled: str | None = None, depth: int = 0) -> str:
    """Bytes of the plain text of a value, nested values recursively: brackets, one comma between
    elements or fields, one colon in a map's entry; a null inside takes no bytes."""
    def inner(y: str, kind: T.DataType) -> str:
        return f"CASE WHEN {y} IS NULL THEN 0 ELSE {text_width_sql(y, kind, depth=depth + 1)} END"

    if is_text(dt):
        return f"octet_length({x})"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return canonical_width_sql(x, scaled)
    if isinstance(dt, NUMERIC):
        return f"char_length(CAST({x} AS STRING))"
    if isinstance(dt, TIMES):
        return (f"19 + CASE WHEN CAST(extract(SECOND FROM {x}) * 1000000 AS BIGINT) % 1000000 <> 0 "
                f"THEN 7 ELSE 0 END")
    if isinstance(dt, T.DateType):
        return "10"
    if isinstance(dt, T.BooleanType):
        return f"CASE WHEN {x} THEN 4 ELSE 5 END"
    if isinstance(dt, T.ArrayType):
        return (f"2 + greatest(size({x}) - 1, 0) + "
                + _sum_over(x, lambda e: inner(e, dt.elementType), depth))
    if isinstance(dt, T.MapType):
        return (f"2 + greatest(2 * size({x}) - 1, 0) + "
                + _sum_over(f"map_keys({x})", lambda e: inner(e, dt.keyType), depth) + " + "
                + _sum_over(f"map_values({x})", lambda e: inner(e, dt.valueType), depth))
    if isinstance(dt, T.StructType):
        parts = [f"({inner(f'{x}.{_q(f.name)}', f.dataType)})" for f in dt.fields]
        return " + ".join([str(2 + max(0, len(parts) - 1)), *parts])
    return f"octet_length(to_json(named_struct('v', {x})))"


def memory_sql(x: str, dt: T.DataType, depth: int = 0) -> str:
    """In-memory bytes of a value: its slot and, for text and nested values, the object behind it."""
    null = SLOT_BYTES + NULL_OBJECT_BYTES
    if is_text(dt):
        return f"CASE WHEN {x} IS NULL THEN {null} ELSE {SLOT_BYTES + STRING_HEADER_BYTES} + octet_length({x}) END"
    if not isinstance(dt, NESTED):
        return str(SLOT_BYTES)

    def cells(array: str, kind: T.DataType) -> str:
        if not is_text(kind) and not isinstance(kind, NESTED):
            return f"{SLOT_BYTES} * size({array})"
        return _sum_over(array, lambda e: memory_sql(e, kind, depth + 1), depth)

    if isinstance(dt, T.ArrayType):
        held = cells(x, dt.elementType)
    elif isinstance(dt, T.MapType):
        held = cells(f"map_keys({x})", dt.keyType) + " + " + cells(f"map_values({x})", dt.valueType)
    else:
        held = " + ".join(f"({memory_sql(f'{x}.{_q(f.name)}', f.dataType, depth + 1)})"
                          for f in dt.fields) or "0"
    return f"CASE WHEN {x} IS NULL THEN {null} ELSE {SLOT_BYTES + CONTAINER_BYTES} + {held} END"


def has_payload(dt: T.DataType) -> bool:
    """Whether cells of the type hold more than their slot."""
    return is_text(dt) or isinstance(dt, NESTED)


def text_memory_sql(c: str) -> str:
    """In-memory bytes of a text cell (pointer + object)."""
    return f"CAST({memory_sql(_q(c), T.StringType())} AS BIGINT)"


def csv_width(df: DataFrame, c: str) -> Column:
    return F.expr(csv_width_sql(c, df.schema[c].dataType))


FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _width_stage(df: DataFrame) -> DataFrame:
    """Add the exact scaled value of every fractional cell once (``_u{i}``)."""
    fields = df.schema.fields
    return df.select("*", *[F.expr(scaled_sql(_q(f.name))).alias(f"_u{i}")
                            for i, f in enumerate(fields) if isinstance(f.dataType, FRACTIONAL)])


def _width_aggs(fields) -> list[Column]:
    aggs = []
    for i, f in enumerate(fields):
        scaled = f"_u{i}" if isinstance(f.dataType, FRACTIONAL) else None
        aggs.append(F.expr(f"sum({csv_width_sql(f.name, f.dataType, scaled)} + 1)").alias(f"_s{i}"))
        if has_payload(f.dataType):
            aggs.append(F.expr(f"sum(CAST({memory_sql(_q(f.name), f.dataType)} AS BIGINT))").alias(f"_m{i}"))
    return aggs


def _expansion_long(one: DataFrame, fields) -> DataFrame:
    items, st, me = [], [], []
    for i, f in enumerate(fields):
        hdr = len(f.name.encode("utf-8")) + 1
        s_i = f"coalesce(_s{i}, 0) + {hdr}"
        m_i = f"coalesce(_m{i}, 0)" if has_payload(f.dataType) else f"rows * {SLOT_BYTES}"
        st.append(s_i)
        me.append(m_i)
        lit = f.name.replace("'", "\\'")
        items.append(f"named_struct('column_name', '{lit}', 'stored', CAST({s_i} AS BIGINT), "
                     f"'mem', CAST({m_i} AS BIGINT), 'shallow', CAST(rows * {SLOT_BYTES} AS BIGINT))")
    items.append(f"named_struct('column_name', '*', 'stored', CAST({' + '.join(st)} AS BIGINT), "
                 f"'mem', CAST({' + '.join(me)} AS BIGINT), "
                 f"'shallow', CAST(rows * {SLOT_BYTES * len(fields)} AS BIGINT))")
    long = one.select("source", "rows", F.expr(f"explode(array({', '.join(items)}))").alias("x"))
    return long.select(
        "source", "x.column_name", "rows",
        F.col("x.stored").alias("stored_bytes"), F.col("x.mem").alias("memory_bytes"),
        round_half_up(F.col("x.mem") / F.col("x.stored"), 4).alias("k"),
        round_half_up(F.col("x.shallow") / F.col("x.stored"), 4).alias("k_shallow"))


def expansion_ratio(df: DataFrame, name: str, group: Column | None = None) -> DataFrame:
    """Stored bytes (delimited text incl. header and one delimiter per
    cell) vs in-memory bytes (declared width model), per column and in total
    ('*'), deep (with the payload of text and nested cells) and shallow (pointers
    only). Fixed-width slots are counted as 8 x rows instead of summed row by row."""
    fields = df.schema.fields
    keys = [group.alias("source")] if group is not None else [F.lit(name).alias("source")]
    one = _width_stage(df).groupBy(*keys).agg(F.expr("count(1)").alias("rows"), *_width_aggs(fields))
    return _expansion_long(one, fields)


def profile_single_pass(df: DataFrame, name: str, wide_chars: int = 80) -> dict[str, DataFrame]:
    """A10 + A11 + A15 + A16 from ONE aggregate pass over the table: null
    shares, text lengths and width sums are computed together, the one-row
    result is cut from lineage with a reliable checkpoint, and every profile
    is reshaped from it (no re-scan per profile)."""
    fields = df.schema.fields
    one = (_width_stage(df)
           .agg(F.count(F.lit(1)).alias("rows"), *_null_aggs(df), *_len_aggs(df), *_width_aggs(fields))
           .withColumn("source", F.lit(name))
           .checkpoint(eager=True))
    shares = _null_long(one, df.columns)
    lens = _len_long(one, name, _text_cols(df))
    n_text = len(_text_cols(df))
    types: dict[str, int] = {}
    for f in fields:
        types[type_name(f.dataType)] = types.get(type_name(f.dataType), 0) + 1
    source = one.select(
        F.lit(name).alias("source"), "rows", F.lit(len(fields)).alias("columns"),
        F.lit(n_text).alias("text_columns"),
        round_half_up(F.lit(n_text / len(fields) if fields else 0.0), 3).alias("text_share"),
        F.lit(",".join(f"{k}:{v}" for k, v in sorted(types.items()))).alias("types"))
    return {"source_profile": source, "null_shares": shares, "completeness": _completeness_from(shares),
            "text_lengths": lens, "text_width_profile": _text_width_from(lens, df.schema, name, wide_chars),
            "expansion_ratio": _expansion_long(one, fields)}


def text_payload_share(df: DataFrame, group: Column) -> DataFrame:
    """Share of in-memory bytes held by text payload, per group."""
    fields = df.schema.fields
    text = [f.name for f in fields if is_text(f.dataType)]
    payload = " + ".join(f"coalesce(octet_length({_q(c)}), 0)" for c in text) or "0"
    mem = " + ".join([text_memory_sql(c) for c in text] + [str(SLOT_BYTES * (len(fields) - len(text)))])
    return df.groupBy(group.alias("source")).agg(F.expr(f"sum({payload}) / sum({mem})").alias("text_share"))


# --- A17, A18 -------------------------------------------------------------------

def yearly_series(df: DataFrame, date_col: str, sample_rows: int = 1000) -> DataFrame:
    """Rows per year (NULL year = unparseable/missing dates), share of
    all rows, and expected rows per year in a sample of ``sample_rows``."""
    g = df.groupBy(F.year(date_col).alias("year")).agg(F.count(F.lit(1)).alias("rows"))
    tot = g.agg(F.sum("rows").alias("_n"))
    share = F.col("rows") / F.col("_n")
    return attach_one_row(g, tot).select(
        "year", "rows", round_half_up(share, 4).alias("share"),
        round_half_up(share * sample_rows, 2).alias("expected_in_sample"))


def cagr(start: Column, end: Column, years: int) -> Column:
    """(end / start)^(1 / years) - 1; NULL when start is 0 or missing."""
    return F.pow(safe_ratio(end, start), F.lit(1.0 / years)) - 1


def annual_to_monthly(g: Column) -> Column:
    return F.pow(1 + g, F.lit(1.0 / 12)) - 1


def growth_rate(df: DataFrame, date_col: str, group_col: str, central: tuple[int, int],
                upper: tuple[int, int]) -> DataFrame:
    """CAGR over a central span and an upper-bound span per group, the
    equivalent monthly rate and its round trip (1+gm)^12. The last year is
    reported as partial when the data stops before December."""
    y = F.year(date_col)
    years = sorted({*central, *upper})
    g = df.groupBy(F.col(group_col).alias("source")).agg(
        *[F.count(F.when(y == yr, 1)).alias(f"y{yr}") for yr in years])
    last = df.agg(F.max(date_col).alias("_last"))
    gc = cagr(F.col(f"y{central[0]}"), F.col(f"y{central[1]}"), central[1] - central[0])
    gu = cagr(F.col(f"y{upper[0]}"), F.col(f"y{upper[1]}"), upper[1] - upper[0])
    gm = annual_to_monthly(gc)
    return attach_one_row(g, last).select(
        "source", F.col(f"y{central[0]}").alias("rows_start"), F.col(f"y{central[1]}").alias("rows_end"),
        round_half_up(gc, 6).alias("g_central"), round_half_up(gu, 6).alias("g_upper"),
        round_half_up(gm, 6).alias("g_monthly"),
        round_half_up(F.pow(1 + gm, F.lit(12.0)), 6).alias("monthly_round_trip"),
        F.when(F.month("_last") < 12, F.year("_last")).alias("partial_year"))


# --- A20 -------------------------------------------------------------------------

def fetch_completeness(requested: DataFrame, fetched: DataFrame, key: str,
                       tolerance: float = 0.999) -> DataFrame:
    """A fetch can be reused when its rows reach ``tolerance`` x the requested rows and
    its bytes equal those of its seal. ``fetched``: key, fetched_rows, fetched_bytes,
    sealed_bytes (NULL: never sealed)."""
    j = requested.join(fetched, key, "left")
    f = F.coalesce(F.col("fetched_rows"), F.lit(0)).cast("bigint")
    same = F.coalesce(F.col("fetched_bytes") == F.col("sealed_bytes"), F.lit(False))
    return j.select(key, F.col("requested_rows").cast("bigint").alias("requested_rows"),
                    f.alias("fetched_rows"),
                    round_half_up(safe_ratio(f, F.col("requested_rows")), 6).alias("ratio"),
                    same.alias("bytes_equal"),
                    ((f >= F.col("requested_rows") * tolerance) & same).alias("complete"))


# --- capacity sources (feeds A23, T3 and the C operators) -----------------------

def source_measures(df: DataFrame, group: Column) -> DataFrame:
    """Per group: rows, stored bytes, memory bytes, k, text share."""
    e = expansion_ratio(df, "", group).where(F.col("column_name") == "*")
    t = text_payload_share(df, group)
    return e.join(t, "source").select(
        "source", "rows", "stored_bytes", "memory_bytes",
        (F.col("memory_bytes") / F.col("stored_bytes")).alias("k"), "text_share")


def measurement_gate(measures: DataFrame, expected_sources: int) -> DataFrame:
    """Exactly n sources, every k > 1, all k distinct (2 decimals),
    sizes > 0, and the widest-text source has the largest k."""
    k2 = round_half_up(F.col("k"), 2)
    return measures.agg(
        (F.count(F.lit(1)) == expected_sources).alias("n_sources_ok"),
        F.bool_and(F.col("k") > 1).alias("all_k_above_1"),
        (F.count_distinct(k2) == F.count(F.lit(1))).alias("k_distinct"),
        F.bool_and(F.col("stored_bytes") > 0).alias("sizes_positive"),
        (F.max(F.struct("text_share", "source"))["source"]
         == F.max(F.struct("k", "source"))["source"]).alias("widest_text_has_max_k"),
    ).select("*", (F.col("n_sources_ok") & F.col("all_k_above_1") & F.col("k_distinct")
                   & F.col("sizes_positive") & F.col("widest_text_has_max_k")).alias("passed"))


def rank_disagreement(measures: DataFrame) -> DataFrame:
    """Leader by text share vs leader by k (ties by source name)."""
    return measures.agg(
        F.max(F.struct("text_share", "source"))["source"].alias("text_leader"),
        F.max(F.struct("k", "source"))["source"].alias("k_leader"),
    ).select("*", (F.col("text_leader") == F.col("k_leader")).alias("agree"))


# --- W6, J6, J7 ---------------------------------------------------------------------

def latest_run(df: DataFrame, machine: Column, stamp: str, run_id: str, failed: Column) -> DataFrame:
    """Last archived run per machine (latest stamp, ties by run id) and
    failures per machine. max(struct) is a partial aggregate, so a machine
    holding a third of all runs is still reduced map-side."""
    g = df.groupBy(machine.alias("machine")).agg(
        F.count(F.lit(1)).alias("runs"), F.count(F.when(failed, 1)).alias("failures"),
        F.max(F.struct(F.col(stamp).alias("s"), F.col(run_id).alias("r"))).alias("_l"))
    return g.select("machine", "runs", "failures", F.col("_l.s").alias("latest_stamp"),
                    F.col("_l.r").alias("latest_run_id"))


def schema_drift(df: DataFrame, declared: list[str]) -> DataFrame:
    """Declared dictionary vs the schema actually read, with each actual column's
    non-null values (one pass over the table; a declared name that is read but never
    filled is ``empty``)."""
    spark = df.sparkSession
    d = spark.createDataFrame([(c,) for c in declared], "column_name string").withColumn("declared", F.lit(True))
    one = df.agg(*[F.count(F.col(_q(c))).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    a = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(True).alias("actual"),
                 F.col(f"_c{i}").alias("values")) for i, c in enumerate(df.columns)])).alias("x")).select("x.*")
    j = d.join(a, "column_name", "full_outer")
    return j.select("column_name", F.coalesce("declared", F.lit(False)).alias("declared"),
                    F.coalesce("actual", F.lit(False)).alias("actual"), "values",
                    F.when(F.col("declared") & F.col("actual"),
                           F.when(F.col("values") > 0, "ok").otherwise("empty"))
                    .when(F.col("declared"), "missing").otherwise("undeclared").alias("status"))


def common_across_runs(df: DataFrame, source: Column, run: Column) -> DataFrame:
    """Per source and run the records counted, whether the source is in every run (the
    intersection of the per-run source sets), and whether all its runs count alike.

    One aggregate of (source, run); the rest works on its few rows. Runs come from the data."""
    counts = (df.groupBy(source.alias("source"), run.alias("run"))
              .agg(F.count(F.lit(1)).alias("records")))
    per_source = counts.groupBy("source").agg(
        F.count(F.lit(1)).alias("runs_present"),
        (F.min("records") == F.max("records")).alias("equal_in_all"),
        F.sort_array(F.collect_list(F.struct("run", "records"))).alias("_runs"))
    total = counts.agg(F.count_distinct("run").alias("_all"))
    out = attach_one_row(per_source, total)
    return out.select("source", "runs_present",
                      (F.col("runs_present") == F.col("_all")).alias("in_every_run"), "equal_in_all",
                      F.explode("_runs").alias("_r")) \
        .select("source", F.col("_r.run").alias("run"), F.col("_r.records").alias("records"),
                "runs_present", "in_every_run", "equal_in_all")
