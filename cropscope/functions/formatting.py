"""Presentation helpers (P27): a last, optional step; values stay numeric in
every operator. ``format_string`` runs JVM-side like any other expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .guards import col


_TWO_52 = 4503599627370496.0  # from here on every double is an integer


def _decimals(value: Column, decimals: int) -> Column:
    """Text of a double with ``decimals`` places, rounded by its binary value; an exact half
    goes to the even digit. ``nan`` and ``inf`` as words."""
    ten = 10.0 ** decimals
    a = F.abs(value)
    p = a * ten
    # what the product lost, from the two halves of the value's digits
    high = a * 134217729.0 - (a * 134217729.0 - a)
    lost = (high * ten - p) + (a - high) * ten
    low = F.floor(p).cast("double")
    up = (p - low > 0.5) | ((p - low == 0.5) & ((lost > 0) | ((lost == 0) & (low % 2 != 0))))
    rounded = F.when(p < _TWO_52, (low + up.cast("double")) / ten).otherwise(a)
    minus = F.when((value < 0) | (value.cast("string") == "-0.0"), F.lit("-")).otherwise(F.lit(""))
    return (F.when(value.isNull(), None).when(F.isnan(value), F.lit("nan"))
            .when(a == float("inf"), F.concat(minus, F.lit("inf")))
            .otherwise(F.concat(minus, F.format_string(f"%.{decimals}f", rounded))))


def fixed(x, decimals: int = 4) -> Column:
    """Fixed decimals, e.g. 0.1234 for the statistics table."""
    return _decimals(col(x).cast("double"), decimals)


def percent(x, decimals: int = 1) -> Column:
    """Share as percent text, e.g. 62.5% for 0.625."""
    return F.concat(_decimals(col(x).cast("double") * 100.0, decimals), F.lit("%"))


def money(x, decimals: int = 2) -> Column:
    """Amount with a dollar sign, e.g. $110.00."""
    return F.concat(F.lit("$"), _decimals(col(x).cast("double"), decimals))
