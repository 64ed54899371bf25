"""Numeric helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Amounts of this size are out of range (reported, never summed).
MONEY_LIMIT = 1e21


def round_half_up(c: Column, decimals: int) -> Column:
    """Round a double through decimal, so ties (1.005) round the same in every
    engine (the value's shortest decimal text is rounded half-up, not its
    binary expansion). The intermediate keeps three guard digits (at most 9),
    which an engine scaling the binary value by 10^s still gets exactly for
    magnitudes up to ~10^(15-s)."""
    exact = F.round(c.try_cast(f"decimal(38,{min(decimals + 3, 9)})"), decimals).cast("double")
    return F.coalesce(exact, c.cast("double"))  # too large for the decimal: no decimals are held


def round_exact(c: Column, decimals: int) -> Column:
    """Round an exact decimal (e.g. a sum of money) directly, half-up, and
    only then convert to double: no binary round trip, so ties are exact."""
    return F.round(c, decimals).cast("double")


def money(c: Column) -> Column:
    """Exact summable money: sums of decimals do not depend on task order.
    NULL at MONEY_LIMIT and beyond, where the sum of many would not fit."""
    return F.when(F.abs(c) < F.lit(MONEY_LIMIT), c.try_cast("decimal(28,6)"))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is NULL or 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))
