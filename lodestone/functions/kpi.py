"""KPI column functions (the reference's scalar SQL/PL functions).

Each returns a ``Column`` built from built-in expressions, so it runs inside
whole-stage code generation; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.numeric import rnd


def _c(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)


def calc_oee(operating_hours, planned_hours, actual_tons, target_tons) -> Column:
    """OEE % = (operating / planned) * (actual / target) * 100, rounded to 1
    place; NULL when planned or target is 0.

    Evaluated as ``operating * actual * 100 / (planned * target)``: one
    division of exact products, so halfway cases round like NUMERIC.
    """
    op, pl, ac, tg = map(_c, (operating_hours, planned_hours, actual_tons, target_tons))
    val = (op * ac * 100) / (pl * tg)
    return F.when((pl == 0) | (tg == 0), F.lit(None).cast("double")).otherwise(rnd(val, 1))


# Downtime classes, upper bounds in minutes and their labels.
DOWNTIME_LABELS = ("micro stop", "short stop", "medium stop", "long stop", "critical stop")
DOWNTIME_BOUNDS = (15, 60, 240, 480)          # < 15, <= 60, <= 240, <= 480, else


def classify_downtime(minutes) -> Column:
    """Class of a downtime length; NULL falls through to the last class
    (CASE without a matching branch)."""
    m = _c(minutes)
    b0, b1, b2, b3 = DOWNTIME_BOUNDS
    l0, l1, l2, l3, l4 = DOWNTIME_LABELS
    return (F.when(m < b0, l0).when(m <= b1, l1).when(m <= b2, l2).when(m <= b3, l3).otherwise(l4))


def downtime_class_rank(label) -> Column:
    """Sort position of a class label (1..5)."""
    lab = _c(label)
    out = F.lit(len(DOWNTIME_LABELS))
    for i, name in reversed(list(enumerate(DOWNTIME_LABELS[:-1], start=1))):
        out = F.when(lab == name, i).otherwise(out)
    return out


def safe_production_rate(tons, hours) -> Column:
    """tons / hours: NULL if either is NULL, 0 when hours = 0."""
    t, h = _c(tons), _c(hours)
    return (F.when(t.isNull() | h.isNull(), F.lit(None).cast("double"))
            .when(h == 0, F.lit(0.0))
            .otherwise(F.try_divide(t, h).cast("double")))


# Valid range per sensor type (inclusive bounds) and unit.
SENSOR_RANGES = (
    ("temperature", -40, 200, "°C"),
    ("pressure", 0, 500, "bar"),
    ("vibration", 0, 100, "mm/s"),
    ("speed", 0, 50, "km/h"),
)
# Error codes of the reading check.
SENSOR_UNKNOWN_TYPE = "S0001"
SENSOR_OUT_OF_RANGE = "S0002"
