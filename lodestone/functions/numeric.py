"""Numeric column helpers that make results exact and engine-independent.

* Money and quantity sums are taken over DECIMAL so the result does not depend
  on the order partitions are combined in.
* Rounding goes through DECIMAL, which rounds half away from zero like
  PostgreSQL NUMERIC (DOUBLE rounding differs between engines at ties).
* Division is ``try_divide``: NULL instead of a divide-by-zero error, which is
  what every guarded ratio of the reports means.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c, n: int = 2) -> Column:
    """Round half away from zero to ``n`` places; DOUBLE result."""
    return F.round(_c(c).cast("decimal(28,8)"), n).cast("double")


def dsum(c, scale: int = 2) -> Column:
    """Exact sum of a 2-decimal measure; DOUBLE result."""
    return F.sum(_c(c).cast(f"decimal(18,{scale})")).cast("double")


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (``x / NULLIF(y, 0)``)."""
    return F.try_divide(_c(num), _c(den))


def int_div(num, den) -> Column:
    """Integer division truncating toward zero (``int / int`` in PostgreSQL);
    NULL when den is 0."""
    n, d = _c(num).cast("bigint"), _c(den).cast("bigint")
    return F.try_divide(n - F.try_mod(n, d), d).cast("bigint")


def pct(part, whole, n: int = 2) -> Column:
    """100 * part / whole rounded; NULL when whole is 0."""
    return rnd(safe_div(_c(part) * F.lit(100.0), _c(whole)), n)
