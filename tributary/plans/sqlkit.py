"""SQL text builders for the independent DuckDB oracle.

They restate, in plain ANSI/DuckDB SQL, the fixture rules of
``tributary.plans.fixtures`` and the scalar functions of
``tributary.functions`` so that every registered query has a second,
engine-independent implementation.
"""

from __future__ import annotations

NUMERIC_TEXT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def rnd(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,{min(n + 3, 9)})), {n}) AS DOUBLE)"


def rnd_exact(x: str, n: int) -> str:
    """Round an exact DECIMAL expression directly."""
    return f"CAST(ROUND({x}, {n}) AS DOUBLE)"


def local(v: str) -> str:
    return f"translate(format('{{:,.2f}}', CAST({v} AS DOUBLE)), ',.', '.,')"


def noisy_key(k: str, rid: str) -> str:
    return (f"CASE WHEN {rid} % 50 = 0 THEN '   ' "
            f"WHEN {rid} % 2 = 1 THEN '  ' || lower({k}) || ' ' "
            f"WHEN {rid} % 3 = 0 THEN replace({k}, '-', ' - ') ELSE {k} END")


def dirty_number(v: str, rid: str) -> str:
    return (f"CASE WHEN {rid} % 97 = 0 THEN 'n/d' WHEN {rid} % 101 = 0 THEN '' "
            f"WHEN {rid} % 89 = 0 THEN NULL WHEN {rid} % 13 = 0 THEN '$ ' || {local(v)} "
            f"ELSE {local(v)} END")


def norm_key(k: str) -> str:
    x = f"upper(trim(regexp_replace({k}, '\\s+', ' ', 'g')))"
    return f"translate(CASE WHEN {x} IS NULL OR {x} = '' THEN '(SIN DATO)' ELSE {x} END, chr(9), ' ')"


def clean_number(t: str) -> str:
    return ("replace(replace(replace(replace(replace(trim(" + t +
            "), '$', ''), ' ', ''), '%', ''), '.', ''), ',', '.')")


def parse_number(t: str) -> str:
    c = clean_number(t)
    return (f"CASE WHEN regexp_matches({c}, '{NUMERIC_TEXT}') "
            f"AND abs(TRY_CAST({c} AS DOUBLE)) < 'inf'::DOUBLE THEN TRY_CAST({c} AS DOUBLE) END")


def java_hash(k: str) -> str:
    fold = (f"list_reduce(list_transform(range(1, length({k}) + 1), "
            f"lambda i: unicode(substr({k}, i, 1))::HUGEINT), "
            f"lambda a, x: (a * 31 + x) % 4294967296, 0::HUGEINT)")
    return (f"CASE WHEN {k} IS NULL THEN NULL WHEN {fold} >= 2147483648 "
            f"THEN CAST({fold} - 4294967296 AS INTEGER) ELSE CAST({fold} AS INTEGER) END")


def canonical(v: str) -> str:
    fixed = f"CAST(CAST(ROUND(CAST({v} AS DECIMAL(38,9)), 6) AS DECIMAL(38,6)) AS VARCHAR)"
    frac = f"regexp_replace(regexp_replace({fixed}, '0+$', ''), '\\.$', '')"
    return (f"CASE WHEN {v} IS NULL THEN NULL "
            f"WHEN CAST({v} AS DOUBLE) = floor(CAST({v} AS DOUBLE)) AND abs(CAST({v} AS DOUBLE)) < 1e15 "
            f"THEN CAST(CAST({v} AS BIGINT) AS VARCHAR) ELSE {frac} END")


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(28,6))"


# --- declared width model (A16) ------------------------------------------------

QUOTE_CLASS = "'[,\"' || chr(13) || chr(10) || ']'"


def csv_width(c: str, typ: str) -> str:
    if typ == "string":
        w = (f"strlen({c}) + CASE WHEN regexp_matches({c}, {QUOTE_CLASS}) "
             f"THEN 2 + (length({c}) - length(replace({c}, '\"', ''))) ELSE 0 END")
    elif typ in ("double", "float"):
        w = f"strlen({canonical(c)})"
    elif typ in ("int", "bigint"):
        w = f"length(CAST({c} AS VARCHAR))"
    elif typ.startswith("array<"):
        e = csv_width("e", typ[6:-1]).replace("strlen(e) + CASE", "strlen(e) + 0 * CASE")
        w = f"4 + greatest(len({c}) - 1, 0) + coalesce(list_sum(list_transform({c}, lambda e: {e})), 0)"
    elif typ.startswith("timestamp"):
        w = f"19 + CASE WHEN microsecond({c}) % 1000000 <> 0 THEN 7 ELSE 0 END"
    else:
        raise ValueError(typ)
    return f"CASE WHEN {c} IS NULL THEN 0 ELSE {w} END"


def memory_width(c: str, typ: str, deep: bool = True) -> str:
    if typ.startswith("array<") and deep:
        return f"CASE WHEN {c} IS NULL THEN 24 ELSE 64 + 8 * len({c}) END"
    if typ != "string" or not deep:
        return "8"
    return f"CASE WHEN {c} IS NULL THEN 24 ELSE 57 + strlen({c}) END"


def expansion(source_sql: str, cols: list[tuple[str, str]], label: str, group: str | None = None) -> str:
    """Per-column and total ('*') stored vs in-memory bytes."""
    sums = ", ".join(
        f"SUM({csv_width(c, t)} + 1) AS s{i}, SUM({memory_width(c, t)}) AS m{i}, "
        f"SUM({memory_width(c, t, False)}) AS h{i}" for i, (c, t) in enumerate(cols))
    src = group if group else f"'{label}'"
    gb = " GROUP BY 1" if group else ""
    one = f"SELECT {src} AS source, COUNT(*) AS rows, {sums} FROM ({source_sql}) t{gb}"
    parts = []
    for i, (c, _) in enumerate(cols):
        hdr = len(c.encode()) + 1
        parts.append(f"SELECT source, '{c}' AS column_name, rows, COALESCE(s{i}, 0) + {hdr} AS st, "
                     f"COALESCE(m{i}, 0) AS me, COALESCE(h{i}, 0) AS sh FROM one")
    st = " + ".join(f"COALESCE(s{i}, 0) + {len(c.encode()) + 1}" for i, (c, _) in enumerate(cols))
    me = " + ".join(f"COALESCE(m{i}, 0)" for i in range(len(cols)))
    sh = " + ".join(f"COALESCE(h{i}, 0)" for i in range(len(cols)))
    parts.append(f"SELECT source, '*' AS column_name, rows, {st} AS st, {me} AS me, {sh} AS sh FROM one")
    body = " UNION ALL ".join(parts)
    return (f"WITH one AS ({one}) SELECT source, column_name, rows, CAST(st AS BIGINT) AS stored_bytes, "
            f"CAST(me AS BIGINT) AS memory_bytes, {rnd('me / st', 4)} AS k, {rnd('sh / st', 4)} AS k_shallow "
            f"FROM ({body}) u")
