"""Row-local amount ratios, severity, flags and logs as Column expressions."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def dbl(c: str) -> Column:
    return F.col(c).cast("double")


def flt(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("float")


def per_abs(num: str, den: str, eps: float) -> Column:
    """num / (|den| + eps) in double precision; NULL in -> NULL out."""
    return dbl(num) / (F.abs(dbl(den)) + F.lit(eps))


def weighted_sum(pairs: Iterable[tuple[str, int]]) -> Column:
    """sum(w * c) in double; a NULL term makes the sum NULL."""
    total = F.lit(0.0)
    for c, w in pairs:
        total = total + dbl(c) * F.lit(float(w))
    return total.cast("float")


def flag(cond: Column) -> Column:
    """0/1 tinyint where an unknown (NULL) condition counts as false."""
    return F.coalesce(cond, F.lit(False)).cast("tinyint")


def log1p_f(c) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.log1p(x.cast("double")).cast("float")


def finite_or_null(c: str) -> Column:
    """NaN and +/-inf become NULL (the one missing-value convention)."""
    x = F.col(c)
    bad = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(~bad, x)
