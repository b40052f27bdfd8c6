"""Aggregation operators: null profiles, labelled OLAP groupings, crosstabs,
Venn classification.

All of them are single hash aggregates (partial aggregation on the map side,
one shuffle on the grouping key), so a hot key is combined inside each task
before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.numeric import rnd


def null_profile(df: DataFrame, cols: Sequence[str], pct_digits: int = 1,
                 names: Sequence[str] | None = None) -> DataFrame:
    """One row: ``total_rows`` and, per column, ``<c>_filled``, ``<c>_null``
    and ``<c>_pct`` (fill percentage).  One pass over ``df``."""
    names = list(names or cols)
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    for c, n in zip(cols, names):
        aggs.append(F.count(c).alias(f"{n}_filled"))
    prof = df.agg(*aggs)
    out = [F.col("total_rows")]
    for n in names:
        filled = F.col(f"{n}_filled")
        out += [filled, (F.col("total_rows") - filled).alias(f"{n}_null"),
                rnd(F.try_divide(filled * 100.0, F.col("total_rows")), pct_digits).alias(f"{n}_pct")]
    return prof.select(*out)


def labelled_grouping(df: DataFrame, kind: str, keys: Sequence[str],
                      aggs: Sequence[Column], total_label: str = "TOTAL",
                      sets: Sequence[Sequence[str]] | None = None,
                      level_col: str = "grouping_level") -> DataFrame:
    """ROLLUP / CUBE / GROUPING SETS with subtotal labels.

    Each key column is replaced by its value or ``total_label`` where it was
    rolled up (``GROUPING(k) = 1``), and ``level_col`` is ``GROUPING_ID`` of
    the keys (bit mask, first key is the high bit).  Key values must not be
    NULL themselves (or must be labelled before calling).
    """
    if kind == "rollup":
        g = df.rollup(*keys)
    elif kind == "cube":
        g = df.cube(*keys)
    elif kind == "sets":
        g = df.groupingSets([[F.col(k) for k in s] for s in sets], *keys)
    else:
        raise ValueError(kind)
    flags = [F.grouping(k).alias(f"_g_{k}") for k in keys]
    res = g.agg(*aggs, *flags, F.grouping_id(*keys).alias(level_col))
    labelled = [F.when(F.col(f"_g_{k}") == 1, F.lit(total_label)).otherwise(F.col(k).cast("string")).alias(k)
                for k in keys]
    other = [c for c in res.columns if c not in keys and not c.startswith("_g_")]
    return res.select(*labelled, *other)


def venn_membership(df: DataFrame, key: str, side_a: Column, side_b: Column) -> DataFrame:
    """Per ``key``: whether any row satisfied ``side_a`` / ``side_b``.

    One pass over the facts instead of one scan per set operation; the
    result has one row per key that appears on at least one side.
    """
    return (df.groupBy(key)
            .agg(F.max(side_a.cast("int")).alias("_in_a"), F.max(side_b.cast("int")).alias("_in_b"))
            .filter((F.col("_in_a") == 1) | (F.col("_in_b") == 1))
            .select(key,
                    F.when((F.col("_in_a") == 1) & (F.col("_in_b") == 1), "both")
                    .when(F.col("_in_a") == 1, "only_a").otherwise("only_b").alias("membership")))


def pivot_by_values(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence,
                    value: Column, agg: str = "sum", names: Sequence[str] | None = None,
                    default=None) -> DataFrame:
    """Static pivot as conditional aggregates: one column per value of
    ``pivot_col`` (``SUM(CASE WHEN p = v THEN x END)``).  The list of values
    is a parameter, so the output schema is fixed before execution."""
    names = list(names or [str(v) for v in values])
    fn = {"sum": F.sum, "avg": F.avg, "count": F.count, "max": F.max, "min": F.min}[agg]
    cols = []
    for v, n in zip(values, names):
        c = fn(F.when(F.col(pivot_col) == F.lit(v), value))
        if default is not None:
            c = F.coalesce(c, F.lit(default))
        cols.append(c.alias(n))
    return df.groupBy(*keys).agg(*cols)
