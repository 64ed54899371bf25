"""Scalar text functions (P1, P2, P7, P8) as JVM-side Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.contract import (KeyValueContract, REFERENCE_EMPTY_KEY,
                                REFERENCE_FIELD_SEPARATOR)

# A number after cleaning: optional sign, digits with optional fraction or a
# bare fraction, optional exponent. Guarding with it keeps both engines strict
# (Spark alone would accept "1d", other engines accept "1_000").
NUMERIC_TEXT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_key(c, enabled: bool = True, empty_key: str = REFERENCE_EMPTY_KEY,
                  separator: str = REFERENCE_FIELD_SEPARATOR) -> Column:
    """Trim, collapse inner whitespace, upper-case; empty -> placeholder.

    ``(?U)`` makes ``\\s`` Unicode-aware, so a no-break space collapses too.
    The field separator can never survive inside a key.
    """
    c = _col(c)
    if enabled:
        k = F.upper(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))
    else:
        k = F.trim(c)
    k = F.when(k.isNull() | (k == ""), F.lit(empty_key)).otherwise(k)
    return F.translate(k, separator, " ")


def clean_number_text(c, strip_symbols=("$", " ", "%"), thousands: str | None = ".",
                      decimal: str = ",") -> Column:
    t = F.trim(_col(c))
    for s in strip_symbols:
        t = F.replace(t, F.lit(s), F.lit(""))
    if thousands:
        t = F.replace(t, F.lit(thousands), F.lit(""))
    if decimal != ".":
        t = F.replace(t, F.lit(decimal), F.lit("."))
    return t


def parse_text_number(c, strip_symbols=("$", " ", "%"), thousands: str | None = ".",
                      decimal: str = ",") -> Column:
    """Cleaned text -> double when it is a plain number (may be infinite for
    overflowing exponents). The text expression is referenced once."""
    t = clean_number_text(c, strip_symbols, thousands, decimal)
    return F.regexp_extract(t, NUMERIC_TEXT, 0).try_cast("double")


def parse_local_number(c, strip_symbols=("$", " ", "%"), thousands: str | None = ".",
                       decimal: str = ",") -> Column:
    """Locale-formatted text -> double, NULL when not a finite number
    (overflowing exponents parse to infinity and are discarded)."""
    d = parse_text_number(c, strip_symbols, thousands, decimal)
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def canonical_number(c) -> Column:
    """Integral values below 1e15 without decimals, else at most six
    decimals with trailing zeros removed (goes through decimal, never through
    the double-to-text cast, which would print exponents)."""
    v = _col(c).cast("double")
    integral = (v == F.floor(v)) & (F.abs(v) < F.lit(1e15))
    as_int = v.cast("bigint").cast("string")
    fixed = F.round(v.try_cast("decimal(38,9)"), 6).cast("decimal(38,6)").cast("string")
    frac = F.regexp_replace(F.regexp_replace(fixed, r"0+$", ""), r"\.$", "")
    # beyond decimal(38,9) a double has no decimals left: its own text
    return (F.when(v.isNull(), F.lit(None)).when(integral, as_int)
            .otherwise(F.coalesce(frac, v.cast("string"))))


def render_local_number(c, decimals: int = 2) -> Column:
    """1234567.891 -> '1.234.567,89' (dot thousands, comma decimals)."""
    return F.translate(F.format_number(_col(c).cast("double"), decimals), ",.", ".,")
