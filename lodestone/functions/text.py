"""String helpers with PostgreSQL semantics.

* ``a || b`` propagates NULL: Spark ``concat`` does the same.
* ``CONCAT(a, b)`` treats NULL as empty text: Spark ``concat`` would return
  NULL, so it is ``concat_ws('', ...)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pipes(*parts) -> Column:
    """``a || b || ...`` (NULL if any part is NULL).  Python strings are
    literals; pass ``F.col(name)`` for columns."""
    return F.concat(*map(_lit_or_col, parts))


def concat_pg(*parts) -> Column:
    """``CONCAT(a, b, ...)``: NULL parts are skipped.  Python strings are
    literals; pass ``F.col(name)`` for columns."""
    return F.concat_ws("", *map(_lit_or_col, parts))


def _lit_or_col(p) -> Column:
    return p if isinstance(p, Column) else F.lit(p)


def initial(c) -> Column:
    """``UPPER(LEFT(c, 1))``."""
    return F.upper(F.left(_c(c), F.lit(1)))


def day_name_padded(c, upper: bool = False) -> Column:
    """``TO_CHAR(d, 'Day')`` / ``'DAY'``: English day name blank-padded to 9."""
    name = F.date_format(_c(c), "EEEE")
    return F.rpad(F.upper(name) if upper else name, 9, " ")
