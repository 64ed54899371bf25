"""DuckDB oracle SQL, one statement per registered query (same column names).

Tables are the driver's pre-registered views. Fixture rules are restated
with ``tributary.plans.sqlkit``; nothing here runs on Spark.
"""

from __future__ import annotations

from tributary.plans.sqlkit import (canonical, dirty_number, java_hash, local, noisy_key,
                                    norm_key, parse_number, rnd, rnd_exact)

ORACLE: dict[str, str] = {}

LI_RID = "(l_orderkey * 8 + l_linenumber)"

ORDERS_TEXT = (f"SELECT o_orderkey, {noisy_key('o_orderpriority', 'o_orderkey')} AS raw_key, "
               f"{dirty_number('o_totalprice', 'o_orderkey')} AS raw_value FROM orders")
LINEITEM_TEXT = (f"SELECT l_orderkey, l_linenumber, l_returnflag AS raw_key, "
                 f"{dirty_number('l_extendedprice', LI_RID)} AS raw_value FROM lineitem")


def pairs_sql(text_sql: str, keep: str = "") -> str:
    keep = (keep + ", ") if keep else ""
    return (f"SELECT {keep}{norm_key('raw_key')} AS key, "
            f"CASE WHEN raw_value IS NULL OR raw_key IS NULL THEN NULL "
            f"ELSE {parse_number('raw_value')} END AS value, "
            f"CASE WHEN raw_value IS NULL OR raw_key IS NULL THEN 'short_row' "
            f"WHEN {parse_number('raw_value')} IS NULL THEN 'non_numeric' END AS reason "
            f"FROM ({text_sql}) t")


def mean_sql(src: str, s: str = "SUM(CAST(value AS DECIMAL(28,6)))", n: str = "COUNT(*)",
             extra: str = "", where: str = "WHERE value IS NOT NULL") -> str:
    extra = (", " + extra) if extra else ""
    return (f"SELECT key, {rnd(f'CAST({s} AS DOUBLE) / {n}', 2)} AS mean, "
            f"{rnd_exact(s, 2)} AS sum, CAST({n} AS BIGINT) AS count{extra} "
            f"FROM ({src}) p {where} GROUP BY key")


ORACLE["curated_value_by_region"] = f"""
WITH po AS (
  SELECT l_orderkey,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS rev,
         COUNT(*) AS lines
  FROM lineitem GROUP BY l_orderkey)
SELECT r_name AS region, strftime(o_orderdate, '%Y') AS anio, strftime(o_orderdate, '%m') AS mes,
       {rnd_exact('SUM(rev)', 2)} AS revenue,
       COUNT(*) AS orders, CAST(SUM(lines) AS BIGINT) AS lines,
       {rnd('CAST(SUM(rev) AS DOUBLE) / COUNT(*)', 2)} AS avg_order_value
FROM po JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
GROUP BY 1, 2, 3"""

ORACLE["normalize_key"] = (f"SELECT o_orderkey, raw_key, {norm_key('raw_key')} AS norm_key "
                           f"FROM ({ORDERS_TEXT}) t")

ORACLE["parse_local_number"] = (f"SELECT l_orderkey, l_linenumber, raw_value, "
                                f"{parse_number('raw_value')} AS value FROM ({LINEITEM_TEXT}) t")

ORACLE["render_local_number"] = (f"SELECT o_orderkey, o_totalprice, {local('o_totalprice')} AS local_text "
                                 f"FROM orders")

_V = rnd("l_extendedprice / l_quantity", 6)
ORACLE["canonical_number"] = (f"SELECT l_orderkey, l_linenumber, v AS value, {canonical('v')} AS text, "
                              f"strlen({canonical('v')}) AS width "
                              f"FROM (SELECT l_orderkey, l_linenumber, {_V} AS v FROM lineitem) t")

ORACLE["java_hash"] = f"""
SELECT key_source, key, {java_hash('key')} AS java_hash FROM (
  SELECT DISTINCT * FROM (
    SELECT 'c_mktsegment' AS key_source, c_mktsegment AS key FROM customer
    UNION ALL SELECT 'p_name', p_name FROM part
    UNION ALL SELECT 'n_name', n_name FROM nation) u) d"""

ORACLE["mean_by_key"] = mean_sql(pairs_sql(ORDERS_TEXT))

ORACLE["discard_report"] = (f"SELECT COALESCE(reason, 'valid') AS outcome, COUNT(*) AS records "
                            f"FROM ({pairs_sql(LINEITEM_TEXT)}) p GROUP BY 1")

ORACLE["partial_merge"] = f"""
WITH parts AS (
  SELECT split, key, CASE WHEN split <> 0 THEN SUM(CAST(value AS DECIMAL(28,6))) END AS s, COUNT(value) AS c,
         COUNT(*) FILTER (WHERE reason = 'short_row') AS short_row,
         COUNT(*) FILTER (WHERE reason = 'non_numeric') AS non_numeric
  FROM ({pairs_sql(LINEITEM_TEXT, 'l_orderkey % 16 AS split')}) p GROUP BY 1, 2),
g AS (SELECT key, SUM(s) AS s, SUM(CASE WHEN s IS NOT NULL THEN c ELSE 0 END) AS n,
             COUNT(*) FILTER (WHERE c > 0 AND s IS NOT NULL) AS partials,
             COUNT(*) FILTER (WHERE c > 0 AND s IS NULL) AS malformed_partials,
             CAST(SUM(short_row) AS BIGINT) AS short_row, CAST(SUM(non_numeric) AS BIGINT) AS non_numeric
      FROM parts GROUP BY key)
SELECT key, CASE WHEN n > 0 THEN {rnd('CAST(s AS DOUBLE) / n', 2)} END AS mean, {rnd_exact('s', 2)} AS sum,
       CAST(n AS BIGINT) AS count, partials, malformed_partials, short_row, non_numeric,
       CAST(0 AS BIGINT) AS out_of_range FROM g"""

ORACLE["salted_mean"] = mean_sql(pairs_sql(LINEITEM_TEXT))


# --- A4-A9, T1, J5 ------------------------------------------------------------

def dist_sql(pairs: str) -> str:
    return (f"SELECT key, COUNT(*) AS count, CAST(SUM(CAST(value AS DECIMAL(28,6))) AS DOUBLE) AS sum, "
            f"SUM(CAST(value AS DECIMAL(28,6))) AS sum_exact, strlen(key) AS key_bytes, {java_hash('key')} AS java_hash "
            f"FROM ({pairs}) p WHERE value IS NOT NULL GROUP BY key")


def kv(table: str, key: str, value: str) -> str:
    return f"SELECT CAST({key} AS VARCHAR) AS key, CAST({value} AS DOUBLE) AS value FROM {table}"


def vbytes(s: str, c: str) -> str:
    return (f"(strlen({canonical(s)}) + 1 + "
            f"length(CAST(CAST(round_even({c}, 0) AS BIGINT) AS VARCHAR)))")


def epairs(n: str, m: int) -> str:
    return "1.0" if m <= 1 else f"({m} * (1 - pow(1 - 1 / {float(m)}, CAST({n} AS DOUBLE))))"


def exp_terms(dist: str, m: int, overhead: int) -> str:
    return (f"SELECT e AS _e, e * (key_bytes + {vbytes('sum / e', 'greatest(1.0, count / e)')} "
            f"+ {overhead}) AS _b FROM (SELECT *, {epairs('count', m)} AS e FROM ({dist}) d0) d1")


ORACLE["key_distribution"] = (f"SELECT key, count, {rnd_exact('sum_exact', 2)} AS sum, key_bytes, java_hash "
                              f"FROM ({dist_sql(kv('part', 'p_brand', 'p_retailprice'))}) d")

ORACLE["skew_indicators"] = f"""
WITH dist AS ({dist_sql(kv('events', 'user_id', 'value'))}),
t AS (SELECT MAX(count) AS max_count, MIN(count) AS min_count, CAST(SUM(count) AS BIGINT) AS records,
             COUNT(*) AS keys FROM dist),
top3 AS (SELECT SUM(count) AS top3 FROM (SELECT count FROM dist ORDER BY count DESC, key LIMIT 3) x)
SELECT records, keys, max_count, min_count, {rnd('records / keys', 4)} AS mean_count,
       {rnd('max_count / (records / keys)', 4)} AS max_to_mean,
       {rnd('max_count / records', 4)} AS top1_share, {rnd('top3 / records', 4)} AS top3_share
FROM t, top3"""

ORACLE["pair_size_profile"] = f"""
SELECT COUNT(*) AS read, COUNT(value) AS valid, COUNT(*) - COUNT(value) AS discarded,
       COUNT(DISTINCT CASE WHEN value IS NOT NULL THEN key END) AS distinct_keys,
       {rnd('SUM(CASE WHEN value IS NOT NULL THEN strlen(key) END) / COUNT(value)', 6)} AS mean_key_bytes,
       {rnd(f"SUM(CASE WHEN value IS NOT NULL THEN strlen({canonical('value')}) + 2 END) / COUNT(value)", 6)}
         AS mean_value_bytes
FROM ({pairs_sql(LINEITEM_TEXT)}) p"""

_M, _R = 6, 3
_LI_SUPP = kv('lineitem', 'l_suppkey', 'l_extendedprice')
ORACLE["shuffle_estimate"] = f"""
WITH dist AS ({dist_sql(_LI_SUPP)}),
prof AS (SELECT COUNT(*) AS valid, SUM(strlen(key)) / COUNT(*) AS mk,
                SUM(strlen({canonical('value')}) + 2) / COUNT(*) AS mv
         FROM ({_LI_SUPP}) p WHERE value IS NOT NULL),
ex AS (SELECT SUM(_e) AS exp_pairs, SUM(_b) AS exp_bytes FROM ({exp_terms('SELECT * FROM dist', _M, 2)}) t),
up AS (SELECT CAST(COUNT(*) * {_M} AS DOUBLE) AS up_pairs,
              AVG(key_bytes + {vbytes(f'sum / {_M}', f'count / {_M}')}) AS mean_up FROM dist),
one AS (SELECT CAST(valid AS DOUBLE) AS nc_pairs, valid * (mk + mv + 2) AS nc_bytes,
               up_pairs, up_pairs * (mean_up + 2) AS up_bytes, exp_pairs, exp_bytes FROM prof, ex, up),
r AS (SELECT 'no_combiner' AS scenario, nc_pairs AS pairs, nc_bytes AS bytes, nc_bytes FROM one
      UNION ALL SELECT 'combiner_upper_bound', up_pairs, up_bytes, nc_bytes FROM one
      UNION ALL SELECT 'combiner_expected', exp_pairs, exp_bytes, nc_bytes FROM one)
SELECT scenario, {_M} AS mappers, {rnd('pairs', 4)} AS pairs, {rnd('bytes', 4)} AS bytes,
       {rnd('(1 - bytes / nc_bytes) * 100', 4)} AS saving_pct FROM r"""


def hadoop_part(h: str, r: int) -> str:
    return f"CAST((CAST({h} AS BIGINT) & 2147483647) % {r} AS INTEGER)"


ORACLE["partition_load"] = f"""
WITH dist AS ({dist_sql(kv('orders', 'o_custkey', 'o_totalprice'))}),
loads AS (SELECT {hadoop_part('java_hash', _R)} AS reducer, CAST(SUM(count) AS DOUBLE) AS load,
                 COUNT(*) AS keys FROM dist GROUP BY 1),
slots AS (SELECT CAST(range AS INTEGER) AS reducer FROM range({_R})),
tot AS (SELECT CAST(SUM(count) AS DOUBLE) AS n FROM dist)
SELECT s.reducer, {rnd('COALESCE(load, 0.0)', 4)} AS load, CAST(COALESCE(keys, 0) AS BIGINT) AS keys,
       {rnd(f'n / {_R}', 4)} AS ideal, {rnd(f'COALESCE(load, 0.0) / (n / {_R})', 4)} AS imbalance
FROM slots s LEFT JOIN loads l ON s.reducer = l.reducer, tot"""


def _salt_summary(dist: str, prefix: str) -> str:
    return f"""(SELECT * FROM
  (SELECT SUM(_e) AS {prefix}_pairs, SUM(_b) AS {prefix}_bytes FROM ({exp_terms(dist, _M, 2)}) t) a,
  (SELECT MAX(l) AS {prefix}_max_load FROM (SELECT {hadoop_part('java_hash', _R)} AS p, SUM(count) AS l
     FROM ({dist}) d GROUP BY 1) x) b)"""


_SALT_DIST = dist_sql(kv('lineitem', 'l_returnflag', 'l_extendedprice'))
_SALTED = f"""
SELECT key, count, sum, strlen(key) AS key_bytes, {java_hash('key')} AS java_hash, S FROM (
  SELECT key || '#' || CAST(b AS VARCHAR) AS key, count / S AS count, sum / S AS sum, S FROM (
    SELECT d.key, d.count, d.sum, s.S, unnest(range(0, s.S)) AS b
    FROM ({_SALT_DIST}) d,
         (SELECT CAST(greatest(2, ceil(MAX(count) / (SUM(count) / COUNT(*)))) AS INTEGER) AS S
          FROM ({_SALT_DIST}) d2) s) x) y"""
ORACLE["salting_tradeoff"] = f"""
WITH one AS (SELECT * FROM {_salt_summary(_SALT_DIST, 'b')} bb, {_salt_summary(_SALTED, 'a')} aa,
       (SELECT SUM(count) / {_R} AS ideal FROM ({_SALT_DIST}) d) i,
       (SELECT MAX(S) AS buckets FROM ({_SALTED}) s) s),
m AS (SELECT 'pairs' AS metric, buckets, b_pairs AS before, a_pairs AS after FROM one
      UNION ALL SELECT 'bytes', buckets, b_bytes, a_bytes FROM one
      UNION ALL SELECT 'max_load', buckets, b_max_load, a_max_load FROM one
      UNION ALL SELECT 'imbalance', buckets, b_max_load / ideal, a_max_load / ideal FROM one)
SELECT metric, buckets, {rnd('CAST(before AS DOUBLE)', 4)} AS before, {rnd('CAST(after AS DOUBLE)', 4)} AS after,
       {rnd('(after / before - 1) * 100', 2)} AS change_pct FROM m"""

ORACLE["top_keys"] = f"""
WITH dist AS ({dist_sql(_LI_SUPP)}), tot AS (SELECT SUM(count) AS n FROM dist)
SELECT row_number() OVER (ORDER BY count DESC, key) AS rank, key, count,
       {rnd('count / n * 100', 4)} AS share_pct, {rnd(epairs('count', _M), 4)} AS expected_pairs
FROM (SELECT * FROM dist ORDER BY count DESC, key LIMIT 10) t, tot"""

ORACLE["estimate_vs_measured"] = f"""
WITH part AS (SELECT l_orderkey % {_M} AS split, CAST(l_suppkey AS VARCHAR) AS key, COUNT(*) AS n,
                     CAST(SUM(CAST(l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS s
              FROM lineitem GROUP BY 1, 2),
k AS (SELECT key, CAST(SUM(n) AS BIGINT) AS count, strlen(key) AS key_bytes, COUNT(*) AS measured_pairs,
             CAST(SUM(strlen(key) + {vbytes('s', 'n')} + 2) AS BIGINT) AS measured_bytes
      FROM part GROUP BY key),
t AS (SELECT CAST(l_suppkey AS VARCHAR) AS key,
             CAST(SUM(CAST(l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS sum FROM lineitem GROUP BY 1),
m AS (SELECT k.*, e, e * (key_bytes + {vbytes('sum / e', 'greatest(1.0, count / e)')} + 2) AS b
      FROM (SELECT k.*, sum, {epairs('count', _M)} AS e FROM k JOIN t USING (key)) k)
SELECT key, count, {rnd('e', 4)} AS estimated_pairs, measured_pairs,
       {rnd('(e - measured_pairs) / measured_pairs', 6)} AS pairs_error,
       {rnd('b', 4)} AS estimated_bytes, measured_bytes,
       {rnd('(b - measured_bytes) / measured_bytes', 6)} AS bytes_error FROM m"""


# --- A10-A18, A20, A23, T2, T3, W6, J6, J7 ------------------------------------

from decimal import ROUND_HALF_UP, Decimal  # noqa: E402

from tributary.plans.schemas import (DRIVER_SCHEMAS, TEXT_WIDTH_TABLES,  # noqa: E402
                                     WIDTH_TABLES)
from tributary.plans.sqlkit import expansion  # noqa: E402


def _half_up(x: float, n: int) -> float:
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-n), rounding=ROUND_HALF_UP))


def _source_profile(t: str) -> str:
    cols = DRIVER_SCHEMAS[t]
    counts: dict[str, int] = {}
    for _, typ in cols:
        counts[typ] = counts.get(typ, 0) + 1
    n_text = sum(1 for _, typ in cols if typ == "string")
    types = ",".join(f"{k}:{v}" for k, v in sorted(counts.items()))
    share = _half_up(n_text / len(cols), 3)
    return (f"SELECT '{t}' AS source, COUNT(*) AS rows, CAST({len(cols)} AS INTEGER) AS columns, "
            f"CAST({n_text} AS INTEGER) AS text_columns, CAST({share} AS DOUBLE) AS text_share, "
            f"'{types}' AS types FROM {t}")


ORACLE["source_profile"] = " UNION ALL ".join(_source_profile(t) for t in DRIVER_SCHEMAS)

_COMPLETE_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
_COMPLETE_SRC = """
SELECT d.doc_id, CASE WHEN d.doc_id % 97 <> 0 THEN text END AS text,
       CASE WHEN d.doc_id % 7 <> 0 THEN lang END AS lang,
       CASE WHEN d.doc_id % 11 <> 0 THEN source END AS source, n_chars, quality, toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
_SHARES = " UNION ALL ".join(
    f"SELECT {i} AS pos, '{c}' AS column_name, "
    f"AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS share FROM c0"
    for i, c in enumerate(_COMPLETE_COLS))
ORACLE["completeness"] = f"""
WITH c0 AS ({_COMPLETE_SRC}), s AS ({_SHARES})
SELECT (SELECT COUNT(*) FROM c0) AS rows, COUNT(*) AS columns,
       {rnd('AVG(share)', 4)} AS null_share_mean, {rnd('MAX(share)', 4)} AS null_share_max,
       (SELECT column_name FROM s ORDER BY share DESC, pos LIMIT 1) AS worst_column,
       COUNT(*) FILTER (WHERE share = 1.0) AS all_null_columns,
       COUNT(*) FILTER (WHERE share > 0.5) AS over_half_columns
FROM s"""

ORACLE["row_duplicates"] = f"""
SELECT CAST(SUM(n) AS BIGINT) AS rows, CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows,
       {rnd('SUM(n - 1) / SUM(n)', 4)} AS duplicate_share
FROM (SELECT COUNT(*) AS n FROM documents GROUP BY text, lang, source) g"""

ORACLE["key_duplicates"] = f"""
SELECT CAST(SUM(n) AS BIGINT) AS rows, CAST(SUM(n - 1) AS BIGINT) AS key_duplicates,
       {rnd('SUM(n - 1) / SUM(n)', 4)} AS key_duplicate_share
FROM (SELECT COUNT(*) AS n FROM orders GROUP BY o_custkey) g"""

_SPAN = "CAST(epoch_us(last_ts) - epoch_us(first_ts) AS DOUBLE) / 3.6e9"
ORACLE["arrival_profile"] = f"""
WITH g AS (SELECT event_type AS source, COUNT(ts) AS rows, MIN(ts) AS first_ts, MAX(ts) AS last_ts
           FROM events GROUP BY 1),
r AS (SELECT MAX(ts) AS as_of FROM events)
SELECT source, rows, first_ts, last_ts, {rnd(_SPAN, 2)} AS span_hours,
       CASE WHEN {_SPAN} > 0 THEN {rnd(f'rows / ({_SPAN})', 2)} END AS rows_per_hour,
       {rnd('CAST(epoch_us(as_of) - epoch_us(last_ts) AS DOUBLE) / 3.6e9 / 24', 2)} AS lag_days,
       'continuous' AS declared_frequency,
       CASE WHEN rows = 0 THEN 'column ts without parseable dates' END AS note
FROM g, r"""


def _text_lengths(t: str) -> str:
    text = [c for c, typ in DRIVER_SCHEMAS[t] if typ == "string"]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS source, {i} AS pos, '{c}' AS column_name, "
        f"CAST(AVG(length({c})) AS DOUBLE) AS mean_len FROM {t}" for i, c in enumerate(text))


def _text_width(t: str) -> str:
    cols = DRIVER_SCHEMAS[t]
    n_text = sum(1 for _, typ in cols if typ == "string")
    distinct = len({typ for _, typ in cols})
    return (f"SELECT '{t}' AS source, CAST({distinct} AS INTEGER) AS distinct_types, "
            f"CAST({len(cols)} AS INTEGER) AS columns, CAST({n_text} AS INTEGER) AS text_columns, "
            f"{rnd('AVG(mean_len)', 2)} AS mean_text_len, "
            f"COUNT(*) FILTER (WHERE mean_len > 80) AS wide_text_columns FROM ({_text_lengths(t)}) l")


ORACLE["text_width_profile"] = " UNION ALL ".join(_text_width(t) for t in TEXT_WIDTH_TABLES)

ORACLE["top_text_columns"] = f"""
SELECT source, rank, column_name, {rnd('mean_len', 4)} AS mean_len FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY mean_len DESC, pos) AS rank
  FROM ({' UNION ALL '.join(_text_lengths(t) for t in TEXT_WIDTH_TABLES)}) l) r
WHERE rank <= 5"""

ORACLE["expansion_ratio"] = " UNION ALL ".join(
    f"SELECT * FROM ({expansion(f'SELECT * FROM {t}', DRIVER_SCHEMAS[t], t)}) e{i}"
    for i, t in enumerate(WIDTH_TABLES))

_ORDERS_GAPS = "SELECT o_orderkey, CASE WHEN o_orderkey % 53 <> 0 THEN o_orderdate END AS o_orderdate FROM orders"
ORACLE["yearly_series"] = f"""
WITH g AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS rows FROM ({_ORDERS_GAPS}) o GROUP BY 1),
t AS (SELECT SUM(rows) AS n FROM g)
SELECT year, rows, {rnd('rows / n', 4)} AS share, {rnd('rows / n * 1000', 2)} AS expected_in_sample FROM g, t"""


def _cagr(a: str, b: str, years: int) -> str:
    return f"(pow(CASE WHEN {a} = 0 THEN NULL ELSE CAST({b} AS DOUBLE) / {a} END, 1.0 / {years}) - 1)"


_GC = _cagr("y1997", "y2000", 3)
_GU = _cagr("y1995", "y2000", 5)
_GM = f"(pow(1 + {_GC}, 1.0 / 12) - 1)"
ORACLE["growth_rate"] = f"""
WITH g AS (SELECT o_orderpriority AS source,
                  COUNT(*) FILTER (WHERE year(o_orderdate) = 1995) AS y1995,
                  COUNT(*) FILTER (WHERE year(o_orderdate) = 1997) AS y1997,
                  COUNT(*) FILTER (WHERE year(o_orderdate) = 2000) AS y2000
           FROM orders GROUP BY 1),
l AS (SELECT MAX(o_orderdate) AS last FROM orders)
SELECT source, y1997 AS rows_start, y2000 AS rows_end, {rnd(_GC, 6)} AS g_central, {rnd(_GU, 6)} AS g_upper,
       {rnd(_GM, 6)} AS g_monthly, {rnd(f'pow(1 + {_GM}, 12.0)', 6)} AS monthly_round_trip,
       CASE WHEN month(last) < 12 THEN CAST(year(last) AS INTEGER) END AS partial_year
FROM g, l"""

ORACLE["fetch_completeness"] = f"""
WITH req AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) * 4 AS requested_rows
             FROM orders GROUP BY 1),
fet AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS fetched_rows
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT r.year, CAST(requested_rows AS BIGINT) AS requested_rows,
       CAST(COALESCE(fetched_rows, 0) AS BIGINT) AS fetched_rows,
       CASE WHEN requested_rows = 0 THEN NULL
            ELSE {rnd('CAST(COALESCE(fetched_rows, 0) AS DOUBLE) / requested_rows', 6)} END AS ratio,
       r.year % 3 <> 0 AND fetched_rows IS NOT NULL AS bytes_equal,
       COALESCE(fetched_rows, 0) >= requested_rows * 0.999 AND r.year % 3 <> 0
         AND fetched_rows IS NOT NULL AS complete
FROM req r LEFT JOIN fet f ON r.year = f.year"""

_ORD_COLS = DRIVER_SCHEMAS["orders"]
_TEXT_PAYLOAD = " + ".join(f"COALESCE(strlen({c}), 0)" for c, t in _ORD_COLS if t == "string")
_MEM_ROW = " + ".join(
    (f"CASE WHEN {c} IS NULL THEN 24 ELSE 57 + strlen({c}) END" if t == "string" else "8")
    for c, t in _ORD_COLS)
CAPACITY_MEASURES = f"""
SELECT e.source, e.rows, e.stored_bytes, e.memory_bytes,
       CAST(e.memory_bytes AS DOUBLE) / e.stored_bytes AS k, ts.text_share
FROM ({expansion('SELECT * FROM orders', _ORD_COLS, 'orders', group='o_orderpriority')}) e
JOIN (SELECT o_orderpriority AS source, SUM({_TEXT_PAYLOAD}) / SUM({_MEM_ROW}) AS text_share
      FROM orders GROUP BY 1) ts ON e.source = ts.source
WHERE e.column_name = '*'"""

ORACLE["measurement_gate"] = f"""
WITH m AS ({CAPACITY_MEASURES}),
g AS (SELECT COUNT(*) = 5 AS n_sources_ok, bool_and(k > 1) AS all_k_above_1,
             COUNT(DISTINCT {rnd('k', 2)}) = COUNT(*) AS k_distinct,
             bool_and(stored_bytes > 0) AS sizes_positive,
             (SELECT source FROM m ORDER BY text_share DESC, source DESC LIMIT 1)
               = (SELECT source FROM m ORDER BY k DESC, source DESC LIMIT 1) AS widest_text_has_max_k
      FROM m)
SELECT *, n_sources_ok AND all_k_above_1 AND k_distinct AND sizes_positive AND widest_text_has_max_k AS passed
FROM g"""

ORACLE["rank_disagreement"] = f"""
WITH m AS ({CAPACITY_MEASURES}),
a AS (SELECT (SELECT source FROM m ORDER BY text_share DESC, source DESC LIMIT 1) AS text_leader,
             (SELECT source FROM m ORDER BY k DESC, source DESC LIMIT 1) AS k_leader)
SELECT text_leader, k_leader, text_leader = k_leader AS agree FROM a"""

ORACLE["latest_run"] = """
SELECT machine, runs, failures, latest_stamp, latest_run_id FROM (
  SELECT o_custkey % 5 AS machine,
         COUNT(*) OVER (PARTITION BY o_custkey % 5) AS runs,
         COUNT(*) FILTER (WHERE o_orderstatus = 'F') OVER (PARTITION BY o_custkey % 5) AS failures,
         o_orderdate AS latest_stamp, o_orderkey AS latest_run_id,
         row_number() OVER (PARTITION BY o_custkey % 5 ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) x WHERE rn = 1"""

_DECLARED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
             "l_comment", "l_shipmode"]
_ACTUAL = " UNION ALL ".join(f"SELECT '{c}' AS column_name, COUNT({c}) AS values FROM lineitem"
                             for c, _ in DRIVER_SCHEMAS["lineitem"])
ORACLE["schema_drift"] = f"""
WITH d AS (SELECT unnest([{', '.join(repr(c) for c in _DECLARED)}]) AS column_name),
a AS ({_ACTUAL})
SELECT COALESCE(d.column_name, a.column_name) AS column_name,
       d.column_name IS NOT NULL AS declared, a.column_name IS NOT NULL AS actual, a.values,
       CASE WHEN d.column_name IS NULL THEN 'undeclared' WHEN a.column_name IS NULL THEN 'missing'
            WHEN a.values > 0 THEN 'ok' ELSE 'empty' END AS status
FROM d FULL OUTER JOIN a ON d.column_name = a.column_name"""

ORACLE["common_across_runs"] = """
WITH c AS (SELECT o_orderpriority AS source, year(o_orderdate) AS run, COUNT(*) AS records
           FROM orders GROUP BY 1, 2)
SELECT source, CAST(run AS INTEGER) AS run, records, COUNT(*) OVER s AS runs_present,
       COUNT(*) OVER s = (SELECT COUNT(DISTINCT run) FROM c) AS in_every_run,
       MIN(records) OVER s = MAX(records) OVER s AS equal_in_all
FROM c WINDOW s AS (PARTITION BY source)"""


# --- C1-C15 ----------------------------------------------------------------------

def D(x) -> str:
    return f"CAST({x} AS DOUBLE)"


_GIB = D(1024 ** 3)
_GM = "(pow(1 + g, 1.0 / 12) - 1)"
CAP_INPUTS = f"""
SELECT m.source, m.rows, CAST(m.stored_bytes AS DOUBLE) / {_GIB} AS s0_gib, m.k, gr.g, gr.g_upper,
       CAST(m.stored_bytes AS DOUBLE) / {_GIB} * pow(1 + (pow(1 + gr.g, 1.0 / 12) - 1), 12.0) AS v12_gib
FROM ({CAPACITY_MEASURES}) m JOIN (
  SELECT source, {_cagr('y1997', 'y2000', 3)} AS g, {_cagr('y1995', 'y2000', 5)} AS g_upper FROM (
    SELECT o_orderpriority AS source,
           COUNT(*) FILTER (WHERE year(o_orderdate) = 1995) AS y1995,
           COUNT(*) FILTER (WHERE year(o_orderdate) = 1997) AS y1997,
           COUNT(*) FILTER (WHERE year(o_orderdate) = 2000) AS y2000
    FROM orders GROUP BY 1) y) gr ON m.source = gr.source"""


def horizon_sql(usable: str, k: str, s0: str, g: str) -> str:
    return f"CASE WHEN {s0} > 0 AND {k} > 0 AND {g} > 0 THEN ln({usable} / ({k} * {s0})) / ln(1 + {g}) END"


_SAMPLE_M = CAPACITY_MEASURES.replace("FROM orders", "FROM (SELECT * FROM orders WHERE o_orderkey % 10 = 0) orders")
ORACLE["project_full"] = f"""
WITH s AS ({_SAMPLE_M}), f AS (SELECT o_orderpriority AS source, COUNT(*) AS full_rows FROM orders GROUP BY 1)
SELECT s.source, s.rows AS sample_rows, full_rows, {rnd('full_rows / s.rows', 4)} AS factor,
       {rnd('stored_bytes * (full_rows / s.rows)', 2)} AS s0_bytes, {rnd('k', 4)} AS k,
       {rnd('stored_bytes * (full_rows / s.rows) * k', 2)} AS memory_bytes
FROM s JOIN f ON s.source = f.source"""

ORACLE["saturation_horizon"] = f"""
WITH i AS ({CAP_INPUTS}),
sc AS (SELECT {D('ram')} AS ram_gib, {D(0.35)} AS reserved FROM (VALUES (8.0), (16.0), (32.0)) v(ram))
SELECT source, ram_gib, reserved, {rnd('ram_gib * (1 - reserved)', 4)} AS usable_gib,
       {rnd('k * s0_gib', 9)} AS need_gib, {rnd('g', 6)} AS g,
       {rnd(horizon_sql('ram_gib * (1 - reserved)', 'k', 's0_gib', 'g'), 2)} AS horizon_years,
       CASE WHEN s0_gib <= 0 OR k <= 0 THEN 'no size' WHEN g <= 0 THEN 'growth must be > 0' ELSE 'ok' END AS status
FROM i, sc"""

_REF_USABLE = D(16.0 * (1 - 0.35))
_SENS = f"""
WITH i AS ({CAP_INPUTS}),
gs AS (SELECT 'growth' AS sweep, 'g=' || v AS setting, {D('v')} AS gv FROM (VALUES ('0.01'), ('0.02'), ('0.04'), ('0.08'), ('0.16'), ('0.32')) t(v)),
ks AS (SELECT 'k' AS sweep, 'k*' || v AS setting, {D('v')} AS km FROM (VALUES ('0.5'), ('1.0'), ('2.0'), ('4.0')) t(v)),
rs AS (SELECT 'reserved' AS sweep, 'reserved=' || f || ',ram=' || r AS setting, {D('f')} AS fr, {D('r')} AS ram
       FROM (VALUES ('0.25'), ('0.35'), ('0.5')) a(f), (VALUES ('8.0'), ('16.0'), ('32.0')) b(r)),
top AS (SELECT source FROM i ORDER BY k * s0_gib DESC, source DESC LIMIT 1),
allg AS (
  SELECT source, sweep, setting, {horizon_sql(_REF_USABLE, 'k', 's0_gib', 'gv')} AS t FROM i, gs
  UNION ALL SELECT source, sweep, setting, {horizon_sql(_REF_USABLE, 'k * km', 's0_gib', 'g')} FROM i, ks
  UNION ALL SELECT i.source, sweep, setting, {horizon_sql('ram * (1 - fr)', 'k', 's0_gib', 'g')}
            FROM i JOIN top ON i.source = top.source, rs)
SELECT source, sweep, setting, {rnd('t', 2)} AS horizon_years FROM allg"""
ORACLE["sensitivity"] = _SENS

ORACLE["sign_stability"] = f"""
SELECT source, COUNT(*) AS cells, COUNT(*) FILTER (WHERE horizon_years < 0) AS negative_cells,
       bool_and(horizon_years < 0) OR bool_and(horizon_years > 0) AS stable,
       COALESCE(array_to_string(list_sort(list(setting) FILTER (WHERE horizon_years < 0)), ';'), '')
         AS negative_settings
FROM ({_SENS}) s WHERE horizon_years IS NOT NULL GROUP BY source"""

ORACLE["volume_by_month"] = f"""
WITH i AS (SELECT source, s0_gib, {_GM} AS gm FROM ({CAP_INPUTS}) x)
SELECT source, CAST(month AS INTEGER) AS month,
       {rnd(f'(s0_gib * pow(1 + gm, {D("month")})) * {_GIB}', 2)} AS volume_bytes,
       {rnd(f'(s0_gib * (pow(1 + gm, {D("month")}) - pow(1 + gm, {D("month - 1")}))) * {_GIB}', 4)} AS increment_bytes
FROM i, range(1, 13) t(month)"""

_GB = f"(v12_gib * R * {_GIB} / {D(10 ** 9)})"
ORACLE["replication_table"] = f"""
SELECT source, R, {rnd('v12_gib', 9)} AS logical_gib, {rnd('v12_gib * R', 9)} AS physical_gib,
       {rnd(_GB, 9)} AS physical_gb, {rnd('v12_gib * R - v12_gib', 9)} AS extra_vs_r1_gib,
       R - 1 AS tolerated_losses, R AS min_nodes,
       {rnd(f'{_GB} * 0.023::DOUBLE * 12', 9)} AS cloud_usd_year,
       {rnd(f'{_GB} * 0.023::DOUBLE * 12 * 3144.14::DOUBLE', 6)} AS cloud_local_year,
       {rnd(f'{_GB} / 1000 * 12.0::DOUBLE', 9)} AS disk_usd,
       {rnd(f'{_GB} / 1000 * 12.0::DOUBLE * 3.0::DOUBLE', 9)} AS disk_tco_usd
FROM ({CAP_INPUTS}) i, (VALUES (1), (2), (3)) r(R)"""

_BLOCK = D(128 * 1024 * 1024)


def blocks_sql(gib: str) -> str:
    return f"CAST(ceil({gib} * {_GIB} / {_BLOCK}) AS BIGINT)"


ORACLE["block_count"] = f"""
SELECT source, R, {blocks_sql('v12_gib')} AS blocks_r1, {blocks_sql('v12_gib')} * R AS blocks,
       {rnd(f"(v12_gib - ({blocks_sql('v12_gib')} - 1) * {D(128 / 1024)}) / {D(128 / 1024)}", 6)} AS last_block_fill
FROM ({CAP_INPUTS}) i, (VALUES (1), (2), (3)) r(R)"""

ORACLE["partitioning_overhead"] = f"""
WITH i AS ({CAP_INPUTS}),
inc AS (SELECT source, {rnd(f'(s0_gib * (pow(1 + {_GM}, {D("month")}) - pow(1 + {_GM}, {D("month - 1")}))) * {_GIB}', 4)} AS inc
        FROM i, range(1, 13) t(month)),
mb AS (SELECT source, CAST(SUM(greatest(ceil(inc / {_BLOCK}), 0)) AS BIGINT) AS monthly_blocks FROM inc GROUP BY 1)
SELECT i.source, {blocks_sql('v12_gib')} AS single_file_blocks, {blocks_sql('s0_gib')} AS base_blocks,
       monthly_blocks, {blocks_sql('s0_gib')} + monthly_blocks AS partitioned_blocks,
       {blocks_sql('s0_gib')} + monthly_blocks - {blocks_sql('v12_gib')} AS overhead_blocks,
       ({blocks_sql('s0_gib')} + monthly_blocks) * 3 AS partitioned_blocks_r3
FROM i JOIN mb ON i.source = mb.source"""

ORACLE["compression_scenarios"] = f"""
SELECT source, factor, {rnd('v12_gib / factor', 9)} AS logical_gib, {rnd('v12_gib / factor * 3', 9)} AS physical_r3_gib,
       {blocks_sql('v12_gib / factor')} AS blocks_r1,
       {rnd(f'v12_gib / factor * 3 * {_GIB} / {D(10 ** 9)} * 0.023::DOUBLE * 12', 9)} AS cloud_r3_usd_year
FROM ({CAP_INPUTS}) i, (VALUES (5.0::DOUBLE), (10.0::DOUBLE)) f(factor)"""

_GMA = "(pow(1 + ga, 1.0 / 12) - 1)"
ORACLE["growth_sensitivity"] = f"""
WITH x AS (SELECT source, s0_gib, 'measured' AS scenario, g AS ga FROM ({CAP_INPUTS}) i
           UNION ALL SELECT source, s0_gib, 'upper_bound', g_upper FROM ({CAP_INPUTS}) i
           UNION ALL SELECT source, s0_gib, 'zero', 0.0::DOUBLE FROM ({CAP_INPUTS}) i)
SELECT source, scenario, {rnd('ga', 6)} AS g_annual, {rnd(_GMA, 6)} AS g_monthly,
       {rnd(f's0_gib * pow(1 + {_GMA}, 12.0)', 9)} AS v12_gib,
       {rnd(f's0_gib * pow(1 + {_GMA}, 12.0) * 3', 9)} AS physical_r3_gib FROM x"""

_VGB = "(threshold_usd / (0.023::DOUBLE * 12))"
_FACTOR = f"({_VGB} / (v12_gib * {_GIB} / {D(10 ** 9)}))"
ORACLE["replica_breakeven"] = f"""
SELECT source, threshold_usd, {rnd(_VGB, 1)} AS volume_gb, {rnd(f'{_VGB} / 1000', 3)} AS volume_tb,
       {rnd(_FACTOR, 1)} AS times_12m_volume,
       {rnd(f'CASE WHEN g > 0 THEN ln({_FACTOR}) / ln(1 + g) END', 1)} AS years_central,
       {rnd(f'CASE WHEN g_upper > 0 THEN ln({_FACTOR}) / ln(1 + g_upper) END', 1)} AS years_upper
FROM ({CAP_INPUTS}) i, (VALUES (100), (1000), (10000)) t(threshold_usd)"""

ORACLE["saving_levers"] = f"""
SELECT source, lever, {rnd('v12_gib / factor * R', 9)} AS physical_gib,
       {rnd('(1 - (v12_gib / factor * R) / (v12_gib * 3)) * 100', 1)} AS saving_pct
FROM ({CAP_INPUTS}) i, (VALUES ('csv_r3_base', 1.0::DOUBLE, 3), ('csv_r2', 1.0::DOUBLE, 2), ('csv_r1', 1.0::DOUBLE, 1),
  ('columnar_5x_r3', 5.0::DOUBLE, 3), ('columnar_10x_r3', 10.0::DOUBLE, 3)) l(lever, factor, R)"""

_EV_COLS = DRIVER_SCHEMAS["events"]
READINGS = f"""
SELECT e.source, e.rows, e.stored_bytes, CAST(e.memory_bytes AS DOUBLE) / e.stored_bytes AS k, s.entities, s.span_days
FROM ({expansion('SELECT * FROM events', _EV_COLS, 'events', group='event_type')}) e
JOIN (SELECT event_type AS source, COUNT(DISTINCT user_id) AS entities,
             CAST(epoch_us(MAX(ts)) - epoch_us(MIN(ts)) AS DOUBLE) / 8.64e10 AS span_days
      FROM events GROUP BY 1) s ON e.source = s.source
WHERE e.column_name = '*'"""
_S0Y = f"(stored_bytes / rows * (rows / span_days * 365) / {_GIB})"
ORACLE["annualized_need"] = f"""
SELECT source, entities, {rnd('stored_bytes / rows', 2)} AS bytes_per_row,
       {rnd('rows / span_days * 365', 2)} AS rows_per_year, {rnd(_S0Y, 9)} AS s0_year_gib,
       {rnd(f'{_S0Y} * k', 9)} AS memory_year_gib, {rnd(f'{_S0Y} * k / 12', 9)} AS memory_month_gib,
       {', '.join(f"{rnd(horizon_sql(D(ram * 0.65), 'k', _S0Y, D(g)), 2)} AS t_r{ram}_g{int(g * 100)}"
                  for ram in (8, 16, 32) for g in (0.10, 0.20, 0.40))}
FROM ({READINGS}) r"""

_NEED = f"(stored_bytes / rows * (rows / span_days * 365) / {_GIB} * k)"
_CHOSEN = ("COALESCE(CASE " + " ".join(f"WHEN {D(r * 0.65)} >= 2 * {_NEED} THEN {r}.0"
                                       for r in (16, 32, 64, 128, 256)) + " END, 256.0)")
ORACLE["capacity_choice"] = f"""
SELECT source, need_gib, ram_gib, {rnd('ram_gib * (1 - 0.35::DOUBLE)', 4)} AS usable_gib,
       ram_gib * (1 - 0.35::DOUBLE) >= 2 * n AS headroom_ok,
       CAST(floor(entities * (ram_gib * (1 - 0.35::DOUBLE)) / n) AS BIGINT) AS entity_limit,
       {rnd('CASE WHEN n > 0 THEN ln(ram_gib * (1 - 0.35::DOUBLE) / n) / ln(1.2::DOUBLE) END', 1)} AS years_at_growth
FROM (SELECT source, entities, {_NEED} AS n, {rnd(_NEED, 9)} AS need_gib, CAST({_CHOSEN} AS DOUBLE) AS ram_gib
      FROM ({READINGS}) r) x"""


# --- lake -------------------------------------------------------------------------

MANIFEST_SUFFIX = ".manifiesto.json"
KEY_PATTERN = r"^([a-z0-9_]+)/anio=(\d{4})/mes=(\d{2})/dia=(\d{2})/([^/]+)$"
FILE_PATTERN = r"^([a-z0-9_]+)_(\d{8})(_lote-(\d{2}))?\.([a-z0-9.]+)$"


def raw_key_sql(source: str, d: str, ext: str, lot: str = "1") -> str:
    base = f"{source} || '_' || strftime({d}, '%Y%m%d')"
    name = (f"CASE WHEN {lot} > 1 THEN {base} || '_lote-' || lpad(CAST({lot} AS VARCHAR), 2, '0') "
            f"ELSE {base} END || '.{ext}'")
    return (f"{source} || '/anio=' || strftime({d}, '%Y') || '/mes=' || strftime({d}, '%m') || "
            f"'/dia=' || strftime({d}, '%d') || '/' || {name}")


DOC_OBJECTS = ("SELECT doc_id, source, ingest_date, text AS content, "
               f"{raw_key_sql('source', 'ingest_date', 'txt')} AS object_key FROM ("
               "SELECT *, DATE '2024-01-01' + CAST(doc_id AS INTEGER) AS ingest_date FROM documents) d")

ORACLE["lake_path"] = f"""
SELECT doc_id, 'lake-raw' AS bucket, {raw_key_sql('source', 'ingest_date', 'txt', 'lot')} AS object_key,
       {raw_key_sql('source', 'ingest_date', 'txt', 'lot')} || '{MANIFEST_SUFFIX}' AS manifest_key
FROM (SELECT doc_id, source, DATE '2024-01-01' + CAST(doc_id AS INTEGER) AS ingest_date,
             CAST(doc_id % 3 + 1 AS INTEGER) AS lot FROM documents) d"""

BROKEN_KEYS = f"""
SELECT doc_id, CASE
  WHEN doc_id % 23 = 0 THEN replace(object_key, '/mes=', '/mes=0')
  WHEN doc_id % 29 = 0 THEN source || '/anio=2024/mes=02/dia=30/' || source || '_20240230.txt'
  WHEN doc_id % 31 = 0 THEN source || '/anio=2024/mes=01/dia=' || strftime(ingest_date, '%d') || '/' || source || '_20231231.txt'
  WHEN doc_id % 37 = 0 THEN upper(object_key)
  WHEN doc_id % 41 = 0 THEN replace(object_key, '.txt', '.TXT')
  ELSE object_key END AS object_key
FROM ({DOC_OBJECTS}) o"""

_SOURCES = ", ".join(f"'src{i}'" for i in range(18))
PATH_CHECK = f"""
SELECT object_key, CASE WHEN reason IS NULL THEN 'PASS' ELSE 'FAIL' END AS status, reason FROM (
  SELECT object_key, CASE
    WHEN NOT regexp_matches(object_key, '{KEY_PATTERN}') THEN 'pattern'
    WHEN regexp_extract(object_key, '{KEY_PATTERN}', 1) NOT IN ({_SOURCES}) THEN 'source'
    WHEN try_strptime(regexp_extract(object_key, '{KEY_PATTERN}', 2) || '-' || regexp_extract(object_key, '{KEY_PATTERN}', 3)
                      || '-' || regexp_extract(object_key, '{KEY_PATTERN}', 4), '%Y-%m-%d') IS NULL THEN 'calendar'
    WHEN NOT regexp_matches(regexp_extract(object_key, '{KEY_PATTERN}', 5), '{FILE_PATTERN}') THEN 'file_name'
    WHEN regexp_extract(regexp_extract(object_key, '{KEY_PATTERN}', 5), '{FILE_PATTERN}', 2)
         <> regexp_extract(object_key, '{KEY_PATTERN}', 2) || regexp_extract(object_key, '{KEY_PATTERN}', 3)
            || regexp_extract(object_key, '{KEY_PATTERN}', 4) THEN 'date_mismatch' END AS reason
  FROM ({BROKEN_KEYS}) k
  WHERE NOT starts_with(object_key, '_') AND NOT ends_with(object_key, '{MANIFEST_SUFFIX}')) x"""
ORACLE["path_check"] = PATH_CHECK

ORACLE["classify_object"] = f"""
SELECT doc_id, object_key, CASE WHEN object_key = '_LEEME.txt' THEN 'readme'
  WHEN starts_with(object_key, '_evidencia/') THEN 'probe' WHEN starts_with(object_key, '_') THEN 'lake_metadata'
  WHEN ends_with(object_key, '{MANIFEST_SUFFIX}') THEN 'manifest' ELSE 'data' END AS class
FROM (SELECT doc_id, CASE WHEN doc_id % 6 = 1 THEN object_key || '{MANIFEST_SUFFIX}'
  WHEN doc_id % 6 = 2 THEN '_evidencia/probe-' || CAST(doc_id AS VARCHAR) || '.txt'
  WHEN doc_id % 6 = 3 THEN '_meta/' || CAST(doc_id AS VARCHAR) || '.json'
  WHEN doc_id % 6 = 4 THEN '_LEEME.txt' ELSE object_key END AS object_key FROM ({DOC_OBJECTS}) o) k"""

ORACLE["largest_object"] = """
WITH c AS (SELECT source, lang AS period, source || '/' || lang || '/' || name AS path, name AS file_name,
                  strlen(text) AS bytes
           FROM (SELECT *, CASE WHEN doc_id % 50 = 0 THEN 'readme.txt'
                      ELSE 'doc_' || CAST(doc_id AS VARCHAR) || '.' || ['csv', 'txt', 'dta', 'json'][doc_id % 4 + 1] END AS name
                 FROM documents) d),
ok AS (SELECT * FROM c WHERE lower(file_name) NOT IN ('leeme.txt', 'readme.txt', 'leeme.md', '.gitkeep')
         AND (ends_with(lower(file_name), '.csv') OR ends_with(lower(file_name), '.txt')
              OR ends_with(lower(file_name), '.dta') OR ends_with(lower(file_name), '.sav'))
         AND bytes >= 8192),
best AS (SELECT source, path, bytes FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY bytes DESC, path DESC) AS rn FROM ok) r WHERE rn = 1),
agg AS (SELECT source, COUNT(*) AS candidates, list_sort(list(DISTINCT period)) AS p FROM ok GROUP BY source)
SELECT a.source, b.path AS chosen_path, b.bytes AS chosen_bytes, candidates,
       array_to_string(p, ',') AS periods, len(p) > 1 AS multi_period
FROM agg a JOIN best b ON a.source = b.source"""

ORACLE["raw_write_roundtrip"] = """
SELECT event_id, user_id, event_type, strftime(ts, '%Y') AS anio, strftime(ts, '%m') AS mes,
       strftime(ts, '%d') AS dia, '01' AS lote FROM events"""

ORACLE["reprocess_since"] = """
SELECT event_id, strftime(ts, '%Y') AS anio, strftime(ts, '%m') AS mes, strftime(ts, '%d') AS dia
FROM events WHERE strftime(ts, '%Y%m%d') >= '20240120'"""

_REST = "CASE WHEN strpos(content, chr(10)) > 0 THEN substr(content, strpos(content, chr(10)) + 1) ELSE '' END"
_HEADER = "regexp_replace(split_part(content, chr(10), 1), '\\r$', '')"
ORACLE["object_inventory"] = f"""
SELECT object_key, strlen(content) AS bytes, strlen(content) / 1048576.0::DOUBLE AS mib,
       strlen(content) / 1073741824.0::DOUBLE AS gib, strlen(content) / 1000000000.0::DOUBLE AS gb
FROM ({DOC_OBJECTS}) o"""

ORACLE["manifest"] = f"""
SELECT object_key, object_key || '{MANIFEST_SUFFIX}' AS manifest_key, 'raw' AS layer, true AS immutable, source,
       CAST(doc_id AS VARCHAR) AS dataset_id,
       strftime(ingest_date, '%Y-%m-%d') || 'T00:00:00+00:00' AS instant,
       'anio=' || strftime(ingest_date, '%Y') || '/mes=' || strftime(ingest_date, '%m') || '/dia=' || strftime(ingest_date, '%d') AS partition,
       'doc:' || doc_id AS urls,
       'txt' AS format, strlen(content) AS bytes, sha256(content) AS sha256,
       length({_REST}) - length(replace({_REST}, chr(10), ''))
         + CASE WHEN length({_REST}) > 0 AND NOT ends_with({_REST}, chr(10)) THEN 1 ELSE 0 END AS data_lines,
       len(string_split({_HEADER}, ',')) AS columns_n, {_HEADER} AS header,
       'text taken from its record' AS lineage
FROM ({DOC_OBJECTS}) o"""

ORACLE["lake_audit"] = f"""
WITH o AS ({DOC_OBJECTS}),
stored AS (
  SELECT object_key, CASE WHEN doc_id % 97 = 0 THEN content || '~' ELSE content END AS content, source,
         doc_id % 89 <> 0 AS described
  FROM o WHERE doc_id % 101 <> 0
  UNION ALL
  SELECT {raw_key_sql("(source || '_bis')", 'ingest_date', 'txt')}, content, source || '_bis', false
  FROM o WHERE doc_id % 103 = 0),
declared AS (SELECT object_key, content AS declared FROM o WHERE doc_id % 89 <> 0),
compared AS (
  SELECT object_key, CASE WHEN content IS NULL THEN 'object missing' WHEN declared IS NULL THEN 'no declared sha256'
           WHEN strlen(content) <> strlen(declared) THEN 'size mismatch'
           WHEN content <> declared THEN 'sha256 mismatch' END AS reason
  FROM stored FULL JOIN declared USING (object_key))
SELECT 3 AS "check", object_key, CASE WHEN source IN ({_SOURCES}) THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN source NOT IN ({_SOURCES}) THEN 'source' END AS reason FROM stored
UNION ALL
SELECT 4, object_key, CASE WHEN described THEN 'PASS' ELSE 'FAIL' END,
       CASE WHEN NOT described THEN 'no manifest' END FROM stored
UNION ALL
SELECT 5, object_key, CASE WHEN reason IS NULL THEN 'PASS' ELSE 'FAIL' END, reason FROM compared
UNION ALL
SELECT 9, object_key, 'FAIL', 'same content under another key'
FROM (SELECT object_key, min(object_key) OVER (PARTITION BY content) AS first_key FROM stored)
WHERE object_key > first_key"""

ORACLE["lot_resolution"] = f"""
WITH o AS (SELECT doc_id, source, CAST(doc_id % 28 + 1 AS INTEGER) AS day, text AS content FROM documents),
st0 AS (SELECT source, day, doc_id, sha256(content) AS sha,
               row_number() OVER (PARTITION BY source, day ORDER BY doc_id) AS lot FROM o WHERE doc_id % 2 = 0),
stored AS (SELECT * FROM st0 WHERE NOT (day % 6 = 0 AND lot = 2)),
s2 AS (SELECT *, row_number() OVER (PARTITION BY source, day ORDER BY lot) = lot AS prefix FROM stored),
inc AS (SELECT DISTINCT o.source, o.day,
               CASE WHEN o.doc_id % 3 = 0 AND l1.sha IS NOT NULL THEN l1.sha ELSE sha256(o.content) END AS sha
        FROM o LEFT JOIN (SELECT source, day, sha FROM stored WHERE lot = 1) l1
                      ON l1.source = o.source AND l1.day = o.day WHERE o.doc_id % 2 = 1),
g AS (SELECT i.source, i.day, i.sha, COUNT(*) FILTER (WHERE s2.prefix) + 1 AS n,
             MIN(s2.lot) FILTER (WHERE s2.prefix AND s2.sha = i.sha) AS same
      FROM inc i LEFT JOIN s2 ON s2.source = i.source AND s2.day = i.day GROUP BY 1, 2, 3),
r AS (SELECT source, day, sha, CASE WHEN same IS NOT NULL THEN 'skip' WHEN n > 99 THEN 'fail' ELSE 'load' END AS action,
             CAST(COALESCE(same, n) AS INTEGER) AS lot FROM g)
SELECT source, day, sha AS incoming_sha256, action, lot,
       CASE WHEN action <> 'fail' THEN {raw_key_sql('source', 'make_date(2024, 1, day)', 'txt', 'lot')} END AS object_key
FROM r"""

VERSION_LOG = """
SELECT ['raw', 'refined', 'curated'][user_id % 3 + 1] AS layer, 'obj-' || CAST(user_id AS VARCHAR) AS object_key,
       event_id AS version_id, ts AS instant,
       CASE WHEN event_type = 'error' THEN 'delete' ELSE 'write' END AS kind,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(trunc(value) AS BIGINT) END AS bytes
FROM events"""
_RANKED = f"""
SELECT *, row_number() OVER (PARTITION BY layer, object_key ORDER BY instant DESC, version_id DESC) AS rn,
       COUNT(*) OVER (PARTITION BY layer, object_key) AS events FROM ({VERSION_LOG}) l"""
_WRANK = f"""
SELECT *, row_number() OVER (PARTITION BY layer, object_key ORDER BY instant DESC, version_id DESC) AS wrn,
       COUNT(*) OVER (PARTITION BY layer, object_key) AS versions FROM ({VERSION_LOG}) l WHERE kind = 'write'"""

ORACLE["current_versions"] = f"""
SELECT layer, object_key, version_id, instant, bytes,
       CASE WHEN kind = 'delete' THEN 'deleted' ELSE 'live' END AS state, events
FROM ({_RANKED}) r WHERE rn = 1"""

ORACLE["restored_versions"] = f"""
SELECT r.layer, r.object_key, r.version_id AS marker_version_id, w.version_id AS restored_version_id,
       w.instant AS restored_instant, w.bytes AS restored_bytes
FROM ({_RANKED}) r JOIN ({_WRANK}) w ON r.layer = w.layer AND r.object_key = w.object_key AND w.wrn = 1
WHERE r.rn = 1 AND r.kind = 'delete'"""

ORACLE["previous_version"] = f"""
SELECT layer, object_key, versions, version_id AS previous_version_id, instant AS previous_instant,
       bytes AS previous_bytes FROM ({_WRANK}) w WHERE wrn = 2"""

IMMUTABILITY = f"""
SELECT layer, object_key, COUNT(*) AS versions, CASE WHEN COUNT(*) > 1 THEN 'FAIL' ELSE 'PASS' END AS status
FROM ({VERSION_LOG}) l WHERE kind = 'write' AND layer = 'raw' AND NOT starts_with(object_key, '_')
  AND NOT ends_with(object_key, '.manifiesto.json') GROUP BY 1, 2"""
ORACLE["immutability_audit"] = IMMUTABILITY

ORACLE["timeline"] = f"""
SELECT row_number() OVER (ORDER BY instant, object_key, version_id) AS seq, layer, object_key, version_id, instant,
       kind, bytes, rn AS key_rank, events AS key_events FROM ({_RANKED}) r"""

ORACLE["layer_summary"] = f"""
SELECT layer, COUNT(*) AS keys, CAST(SUM(events) AS BIGINT) AS events,
       CAST(SUM(CASE WHEN kind = 'write' THEN COALESCE(bytes, 0) ELSE 0 END) AS BIGINT) AS current_bytes
FROM ({_RANKED}) r WHERE rn = 1 GROUP BY layer"""

ORACLE["event_log_union"] = f"""
SELECT layer, object_key, version_id, instant, kind, bytes,
       CASE WHEN kind = 'write' THEN sha256(object_key || ':' || version_id) END AS sha256, rn = 1 AS is_current
FROM ({_RANKED}) r"""

ORACLE["read_version"] = f"""
WITH wanted AS (
  SELECT layer, object_key, version_id FROM ({_WRANK}) w WHERE wrn = 2
  UNION SELECT layer, object_key, -MAX(version_id) - 1 FROM ({VERSION_LOG}) l GROUP BY 1, 2
  UNION SELECT layer, object_key, version_id FROM ({_RANKED}) r WHERE rn = 1)
SELECT layer, object_key, version_id, instant, kind, bytes,
       CASE WHEN kind IS NULL THEN 'unknown' WHEN rn = 1 THEN 'current' ELSE 'previous' END AS state
FROM wanted LEFT JOIN ({_RANKED}) r USING (layer, object_key, version_id)"""

ORACLE["version_at"] = f"""
WITH asked AS (SELECT layer, object_key, version_id AS event, instant - INTERVAL 12 HOURS AS "at"
               FROM ({VERSION_LOG}) l),
found AS (
  SELECT a.layer, a.object_key, a.event, a."at", max({{'i': l.instant, 'v': l.version_id}}) AS last
  FROM asked a LEFT JOIN ({VERSION_LOG}) l
    ON l.layer = a.layer AND l.object_key = a.object_key AND l.instant <= a."at"
  GROUP BY ALL)
SELECT f.layer, f.object_key, event, "at", l.version_id, l.instant, l.bytes,
       CASE WHEN l.kind IS NULL THEN 'absent' WHEN l.kind = 'delete' THEN 'deleted' ELSE 'live' END AS state
FROM found f LEFT JOIN ({VERSION_LOG}) l
  ON l.layer = f.layer AND l.object_key = f.object_key AND l.version_id = last.v AND l.instant = last.i"""

_ORDER_MONTH = "strftime(o_orderdate, '%Y') AS anio, strftime(o_orderdate, '%m') AS mes"
ORACLE["rebuild_since"] = f"""
WITH o AS (
  SELECT o_orderkey, o_totalprice, {_ORDER_MONTH},
         date_trunc('quarter', o_orderdate)
           + CASE WHEN o_custkey % 3 = 0 THEN INTERVAL 6 MONTHS ELSE INTERVAL 3 MONTHS END AS ingested
  FROM orders),
affected AS (SELECT DISTINCT anio, mes FROM o WHERE ingested >= DATE '1998-07-01')
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CASE WHEN a.anio IS NULL THEN 1 ELSE 2 END
                        AS DOUBLE) AS price, o.anio, o.mes
FROM o LEFT JOIN affected a ON a.anio = o.anio AND a.mes = o.mes"""

ORACLE["curated_incremental"] = f"""
SELECT o_orderpriority AS category, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       COUNT(*) AS orders, MIN(o_totalprice) AS least, MAX(o_totalprice) AS greatest, {_ORDER_MONTH}
FROM orders GROUP BY ALL"""

ORACLE["missing_manifest"] = f"""
SELECT object_key FROM ({DOC_OBJECTS}) o WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""

DECLARED_VS_ACTUAL = """
WITH d AS (SELECT 'lake-' || lower(replace(n_name, ' ', '_')) AS bucket, n_regionkey IN (0, 2) AS vd
           FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)),
a AS (SELECT 'lake-' || lower(replace(n_name, ' ', '_')) AS bucket, COUNT(*) % 2 = 1 AS va, MAX(s_acctbal) > 5000 AS readme
      FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1),
j AS (SELECT COALESCE(d.bucket, a.bucket) AS bucket, d.bucket IS NOT NULL AS declared, a.bucket IS NOT NULL AS exists_,
             COALESCE(vd, false) AS vd, COALESCE(va, false) AS va, COALESCE(readme, false) AS readme
      FROM d FULL OUTER JOIN a ON d.bucket = a.bucket),
f AS (SELECT *, (declared AND NOT exists_) OR (declared AND vd AND NOT va) OR (declared AND exists_ AND NOT readme) AS fail
      FROM j)
SELECT bucket, declared, exists_ AS "exists", vd AS versioned_declared, va AS versioned_actual, readme AS has_readme,
       CASE WHEN fail THEN 'FAIL' WHEN NOT declared OR (NOT vd AND va) THEN 'NOTE' ELSE 'PASS' END AS status,
       CASE WHEN declared AND NOT exists_ THEN 'bucket missing' WHEN NOT declared THEN 'bucket not declared'
            WHEN vd AND NOT va THEN 'versioning missing' WHEN NOT readme THEN 'readme missing'
            WHEN NOT vd AND va THEN 'versioning not needed' END AS reason
FROM f"""
ORACLE["declared_vs_actual"] = DECLARED_VS_ACTUAL

_DECLARED_SHA = ("CASE WHEN doc_id % 19 = 0 THEN NULL WHEN doc_id % 17 = 0 THEN sha256(content || '#') "
                 "ELSE sha256(content) END")
INTEGRITY = f"""
SELECT object_key, CASE WHEN reason IS NULL THEN 'PASS' ELSE 'FAIL' END AS status, reason FROM (
  SELECT object_key, CASE WHEN {_DECLARED_SHA} IS NULL THEN 'no declared sha256'
    WHEN {_DECLARED_SHA} <> sha256(content) THEN 'sha256 mismatch' END AS reason FROM ({DOC_OBJECTS}) o) x"""
ORACLE["integrity_check"] = INTEGRITY

DUPLICATES = f"""
SELECT sha256(content) AS sha256, COUNT(*) AS objects, MIN(object_key) AS first_key
FROM ({DOC_OBJECTS}) o GROUP BY 1 HAVING COUNT(*) > 1"""
ORACLE["duplicate_content"] = DUPLICATES

_CHECKS = f"""
SELECT 1 AS chk, CASE WHEN "exists" THEN 'PASS' ELSE 'FAIL' END AS status FROM ({DECLARED_VS_ACTUAL}) x WHERE declared
UNION ALL SELECT 2, CASE WHEN versioned_declared AND NOT versioned_actual THEN 'FAIL' ELSE 'PASS' END
  FROM ({DECLARED_VS_ACTUAL}) x WHERE declared AND "exists"
UNION ALL SELECT 3, status FROM ({PATH_CHECK}) x
UNION ALL SELECT 4, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'PASS' ELSE 'FAIL' END FROM ({DOC_OBJECTS}) x
UNION ALL SELECT 5, status FROM ({INTEGRITY}) x
UNION ALL SELECT 6, CASE WHEN has_readme THEN 'PASS' ELSE 'FAIL' END FROM ({DECLARED_VS_ACTUAL}) x WHERE declared
UNION ALL SELECT 7, 'PASS' FROM ({_WRANK}) w WHERE wrn = 2 AND layer = 'raw'
UNION ALL SELECT 8, status FROM ({IMMUTABILITY}) x
UNION ALL SELECT 9, 'FAIL' FROM ({DUPLICATES}) x"""
ORACLE["criteria_rollup"] = f"""
WITH c AS ({_CHECKS}),
s AS (SELECT k.chk, COALESCE(f, 0) = 0 AND (COALESCE(n, 0) > 0 OR k.chk = 9) AS passed
      FROM range(1, 10) k(chk) LEFT JOIN (SELECT chk, COUNT(*) AS n, COUNT(*) FILTER (WHERE status = 'FAIL') AS f
                                         FROM c GROUP BY chk) g ON g.chk = k.chk),
crit AS (SELECT * FROM (VALUES (1, [1, 3, 5]), (2, [9]), (3, [2, 7]), (4, [3, 4, 6]), (5, [8]), (6, [1, 3, 4, 5, 6])) v(criterion, deps))
SELECT criterion, array_to_string(deps, ',') AS depends_on, bool_and(COALESCE(s.passed, false)) AS passed
FROM (SELECT criterion, deps, unnest(deps) AS chk FROM crit) x LEFT JOIN s ON s.chk = x.chk
GROUP BY criterion, depends_on"""


# --- S1, S2, S7, S11, P4, P5 ---------------------------------------------------------

ORACLE["src_delimited"] = "SELECT doc_id, text, lang, source FROM documents"

ORACLE["src_split_delimited"] = ORACLE["src_delimited"]

ORACLE["page_audit"] = """
WITH p AS (SELECT CAST(floor(event_id / 1500) AS BIGINT) AS page, COUNT(*) AS rows FROM events GROUP BY 1),
s AS (SELECT MIN(page) AS stop FROM p WHERE rows < 1500),
g AS (SELECT MIN(k) AS gap FROM (SELECT page + 1 AS k FROM p UNION ALL SELECT 0) c WHERE k NOT IN (SELECT page FROM p))
SELECT page, rows, rows < 1500 AS short, (stop IS NULL OR page <= stop) AND page < gap AS fetched FROM p, s, g"""

_RAW_ORDERS = f"""
SELECT o_orderkey, o_custkey, {dirty_number('o_totalprice', 'o_orderkey')} AS price_text,
       CASE WHEN o_orderkey % 61 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_text,
       {noisy_key('o_orderpriority', 'o_orderkey')} AS priority_raw FROM orders"""
_TYPED = f"""
SELECT DISTINCT o_custkey, o_orderkey, {parse_number('price_text')} AS price,
       CAST(try_strptime(date_text, '%Y-%m-%d') AS DATE) AS business_date, {norm_key('priority_raw')} AS category
FROM (SELECT * FROM ({_RAW_ORDERS}) a UNION ALL SELECT * FROM ({_RAW_ORDERS}) b WHERE o_orderkey % 10 = 0) r"""
_REASON = ("CASE WHEN price IS NULL THEN 'price not numeric' WHEN price <= 0 THEN 'price not positive' "
           "WHEN business_date IS NULL THEN 'date not parseable' END")
ORACLE["refined_build"] = f"""
SELECT o_custkey, o_orderkey, {rnd('price', 2)} AS price, business_date,
       CASE WHEN category = '(SIN DATO)' THEN 'UNSPECIFIED' ELSE category END AS category,
       strftime(business_date, '%Y') AS anio, strftime(business_date, '%m') AS mes
FROM ({_TYPED}) t WHERE {_REASON} IS NULL"""
ORACLE["refined_rejects"] = f"""
SELECT {_REASON} AS reject_reason, COUNT(*) AS records FROM ({_TYPED}) t WHERE {_REASON} IS NOT NULL GROUP BY 1"""

ORACLE["bounded_sample"] = """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders ORDER BY o_orderkey LIMIT 1000"""

_TS_TEXT = ("CASE WHEN event_id % 53 = 0 THEN 'not a date' WHEN event_id % 59 = 0 THEN '2024-02-30 10:00:00' "
            "ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END")
ORACLE["coerce_ts"] = f"""
SELECT event_id, {_TS_TEXT} AS ts_text, try_strptime({_TS_TEXT}, '%Y-%m-%d %H:%M:%S') AS ts_parsed FROM events"""

ORACLE["window_rate"] = f"""
SELECT event_type, COUNT(*) AS rows, {rnd('COUNT(*) / 24.0', 4)} AS rows_per_hour FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-06 00:00:00' GROUP BY 1"""

ORACLE["stream_refined_events"] = """
SELECT event_id, ts, user_id, event_type, strftime(ts, '%Y') AS anio, strftime(ts, '%m') AS mes FROM events"""
