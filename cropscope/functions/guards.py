"""NULL / NaN guards shared by every rule.

Spark orders NaN above every number and `greatest`/`least` skip NULLs, so a
bare comparison chain or clip gives other answers than plain Python on
missing values. All rules go through these helpers instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_d(x) -> Column:
    """Double literal (a bare Python float can become DECIMAL in SQL text)."""
    return F.lit(x).cast("double") if not isinstance(x, Column) else x.cast("double")


def is_missing(c) -> Column:
    """NULL or NaN."""
    c = col(c)
    return c.isNull() | F.isnan(c)


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def clip(c, lo: float, hi: float) -> Column:
    """``np.clip`` semantics: NULL stays NULL, NaN stays NaN."""
    c = col(c)
    return F.when(is_missing(c), c).otherwise(
        F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), c)))


def classify(value, branches: Sequence[tuple[Column, str]], default: str) -> Column:
    """Python ``if/elif/else`` over ``value``.

    NULL gives NULL. NaN gives ``default`` (every Python comparison with NaN is
    false, so it falls to the last ``else``). ``branches`` are tested in order.
    """
    v = col(value)
    expr = F.when(v.isNull(), F.lit(None).cast("string")).when(F.isnan(v), F.lit(default))
    for cond, label in branches:
        expr = expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))
