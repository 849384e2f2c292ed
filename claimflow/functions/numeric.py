"""Numeric helpers that behave identically on every engine run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def round_half_up(c, digits: int = 2) -> Column:
    """floor(x * 10^d + 0.5) / 10^d in plain IEEE arithmetic.

    Spark's ``round`` goes through a decimal representation and differs from
    other engines on representation edges; this form is the same arithmetic
    everywhere. NULL stays NULL. A double beyond 2^53 / 10^d has no such digits
    left to round (and its floor would not fit a long): it stays as it is, and
    so do infinities and NaN.
    """
    scale = float(10 ** digits)
    x = _col(c).cast("double")
    rounded = F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
    return F.when(F.abs(x) >= F.lit(2.0 ** 53 / scale), x).otherwise(rounded)


def round_cents(c) -> Column:
    return round_half_up(c, 2)


def ratio(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(_col(num).cast("double"), _col(den))


def ratio_or_zero(num, den) -> Column:
    """num / den when den > 0, else 0.0 (NULL den included)."""
    den_c = _col(den)
    return F.when(den_c > 0, ratio(num, den_c)).otherwise(F.lit(0.0))


def days_between(end, start) -> Column:
    return F.datediff(_col(end), _col(start))
