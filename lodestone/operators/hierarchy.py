"""Calendars and parent-child hierarchies.

* ``calendar``: a dense day frame between two dates from ``sequence`` (the
  recursive date series of the reference).  Its size is the number of days
  in the requested range, independent of the fact volume.
* ``hierarchy_paths``: a recursive CTE over an adjacency list, computed by
  pointer doubling, so the driver loop runs once per doubling of the depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.dates import dow0


def calendar(spark: SparkSession, start: str | Column, end: str | Column,
             col: str = "full_date") -> DataFrame:
    """One row per day in [start, end] with date parts."""
    s = F.to_date(F.lit(start)) if isinstance(start, str) else start
    e = F.to_date(F.lit(end)) if isinstance(end, str) else end
    days = spark.range(1).select(F.explode(F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).alias(col))
    return days


def calendar_parts(df: DataFrame, col: str = "full_date") -> DataFrame:
    d = F.col(col)
    return df.select(
        "*",
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_id"),
        F.year(d).alias("year"), F.month(d).alias("month"), F.quarter(d).alias("quarter"),
        dow0(d).alias("day_of_week"), dow0(d).isin(0, 6).alias("is_weekend"))


def hierarchy_paths(nodes: DataFrame, id_col: str = "location_id", parent_col: str = "parent_id",
                    name_col: str = "location_name", sep: str = " > ", indent: str = "  ") -> DataFrame:
    """Expand an adjacency list from its roots (parent NULL).

    Output: every node column plus ``level`` (1 = root), ``indented_name``
    (name left-padded by ``indent`` per level below the root) and ``path``
    (names from the root joined by ``sep``).  A node below a parent that isn't
    in the table is left out; one that is its own ancestor is a cycle and raises.

    Pointer doubling: a node holds the names from just below some ancestor down
    to itself, and that ancestor.  A round joins each node with its ancestor's
    row, which doubles the stretch, so a hierarchy of depth d takes log2(d)
    rounds, each one join and one reliable checkpoint.  A node that hasn't
    reached a root when stretches are longer than the table hangs on a cycle.
    """
    from lodestone.session import checkpoint

    up, names = F.col(parent_col).cast("string").alias("_up"), F.array(F.col(name_col).cast("string")).alias("_names")
    state = checkpoint(nodes.select(F.struct(*nodes.columns).alias("_node"), F.col(id_col).cast("string").alias("_id"), up, names))
    rows, stretch = state.count(), 1
    while True:
        open_ = state.filter(F.col("_up").isNotNull())
        left = open_.select("_id").head(1)
        if not left:
            break
        if stretch > rows:
            raise RuntimeError(f"cycle in the hierarchy at {left[0][0]!r}")
        above = state.select(F.col("_id").alias("_at"), F.col("_up").alias("_above"), F.col("_names").alias("_before"))
        longer = (open_.join(above, F.col("_up") == F.col("_at"))
                  .select("_node", "_id", F.col("_above").alias("_up"), F.concat("_before", "_names").alias("_names")))
        state = checkpoint(state.filter(F.col("_up").isNull()).unionByName(longer))
        stretch *= 2
    level = F.size("_names")
    path = F.when(~F.exists("_names", lambda n: n.isNull()), F.array_join("_names", sep))     # a missing name leaves no path, as || would
    name = F.col("_node").getField(name_col)
    return state.select(*[F.col("_node").getField(c).alias(c) for c in nodes.columns], level.alias("level"), path.alias("path"),
                        F.concat(F.expr(f"repeat('{indent}', size(_names) - 1)"), name).alias("indented_name"))
