"""Date and time column helpers with PostgreSQL semantics.

The reference uses an integer date key ``YYYYMMDD`` and PostgreSQL date
functions; the helpers below give the same answers with Spark built-ins
(all JVM-side, codegen friendly).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts(s: str) -> Column:
    """A TIMESTAMP_NTZ literal (comparable with the fact timestamp columns and
    folded to a constant, so the filter is pushed into the parquet scan)."""
    return F.lit(s).cast("timestamp_ntz")


def d(s: str) -> Column:
    return F.lit(s).cast("date")


def date_key(c) -> Column:
    """``TO_CHAR(d, 'YYYYMMDD')::int`` — the integer surrogate date key."""
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def key_to_date(c) -> Column:
    """``TO_DATE(key::text, 'YYYYMMDD')``."""
    return F.to_date(_c(c).cast("string"), "yyyyMMdd")


def dow0(c) -> Column:
    """``EXTRACT(DOW)``: Sunday = 0 .. Saturday = 6 (Spark's dayofweek is 1-based)."""
    return F.dayofweek(_c(c)) - 1


def age_months(later, earlier) -> Column:
    """Whole months of ``AGE(later, earlier)``."""
    a, b = _c(later), _c(earlier)
    return ((F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)
            - F.when(F.dayofmonth(a) < F.dayofmonth(b), 1).otherwise(0))


def age_years(later, earlier) -> Column:
    """``EXTRACT(YEAR FROM AGE(later, earlier))`` (for later >= earlier)."""
    return F.floor(age_months(later, earlier) / 12).cast("int")


def age_day_part(later, earlier) -> Column:
    """``EXTRACT(DAY FROM AGE(later, earlier))``: the day remainder after whole
    months; a negative difference borrows the length of the earlier date's
    month (PostgreSQL's rule)."""
    a, b = _c(later), _c(earlier)
    diff = F.dayofmonth(a) - F.dayofmonth(b)
    return F.when(diff < 0, diff + F.dayofmonth(F.last_day(b))).otherwise(diff)


def month_name(month_number) -> Column:
    """English month name for 1..12 (``TO_CHAR(TO_DATE(m,'MM'),'FMMonth')``)."""
    return F.date_format(F.make_date(F.lit(2000), _c(month_number), F.lit(1)), "MMMM")
