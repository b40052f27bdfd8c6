"""Window operators: running and moving statistics, ranking, Pareto classes,
record flags, threshold crossing, carried-forward values.

Partitioned windows are used on *aggregated* series (one row per key and
day or month), never on raw facts, so a window partition holds at most one
row per calendar step.  A window without PARTITION BY would put every row
in one task; the only global ordering needed (cumulative share over all
groups) goes through ``prefix_sum``, which is distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.operators.joins import bounded, partitions_for, scalar


def _w(partition: Sequence[str] | None, order: Sequence[Column]):
    w = Window.partitionBy(*partition) if partition else Window.partitionBy()
    return w.orderBy(*order)


def running_sum(df: DataFrame, partition: Sequence[str], order: Sequence[Column],
                value: str, out: str) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY p ORDER BY o ROWS UNBOUNDED PRECEDING)``."""
    w = _w(partition, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))


def moving(df: DataFrame, partition: Sequence[str] | None, order: Sequence[Column],
           value: str, rows: int, out: str, fn=F.avg) -> DataFrame:
    """``fn(value) OVER (... ROWS BETWEEN rows-1 PRECEDING AND CURRENT ROW)``.
    ROWS frames count rows, not days: gaps in the series shrink the span."""
    w = _w(partition, order).rowsBetween(-(rows - 1), Window.currentRow)
    return df.withColumn(out, fn(value).over(w))


def previous_avg(df: DataFrame, partition: Sequence[str] | None, order: Sequence[Column],
                 value: str, out: str) -> DataFrame:
    """Average of all earlier rows (``ROWS BETWEEN UNBOUNDED PRECEDING AND
    1 PRECEDING``); NULL on the first row."""
    w = _w(partition, order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.avg(value).over(w))


def carry_forward(df: DataFrame, partition: Sequence[str] | None, order: Sequence[Column],
                  value: str, out: str, include_current: bool = False) -> DataFrame:
    """Last non-NULL ``value`` before (or up to) the current row."""
    end = Window.currentRow if include_current else -1
    w = _w(partition, order).rowsBetween(Window.unboundedPreceding, end)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def _running_sum_type(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.DecimalType):
        return T.DecimalType(min(38, dtype.precision + 10), dtype.scale)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    return T.DoubleType()


def prefix_sum(df: DataFrame, key: str, ascending: bool, tie: Sequence[str],
               value: str, out: str, partitions: int | None = None) -> DataFrame:
    """Global running total of ``value`` ordered by ``key`` (then ``tie``),
    without a single-partition window and without a hot task on ties.

    1. Range-partition on the full order (``key``, ``tie``): Spark's range
       partitioner samples the composite key, so even a value shared by a
       third of the rows is split across partitions by the tie columns.
       The ranged frame is checkpointed (reliably) so its partition
       contents are fixed for the two reads below.
    2. Running sum inside each range partition (a window partitioned by the
       partition id; each window group is one balanced range).
    3. Each partition's total, summed over all earlier partitions (a table
       with one row per partition, broadcast), is added as an offset.

    Exact for DECIMAL / integer ``value``.
    """
    from lodestone.session import checkpoint

    n = max(1, partitions or partitions_for(df))
    order = [F.col(key).asc_nulls_last() if ascending else F.col(key).desc_nulls_last()] + \
        [F.col(c).asc_nulls_last() for c in tie]
    ranged = checkpoint(df.repartitionByRange(n, *order).sortWithinPartitions(*order))
    tagged = ranged.withColumn("_pp", F.spark_partition_id())
    sum_type = _running_sum_type(df.schema[value].dataType)

    # Running sum inside each range partition: a window partitioned by the
    # partition id (its groups are the balanced ranges, so no hot task).
    w = Window.partitionBy("_pp").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = tagged.withColumn("_local", F.sum(value).over(w))
    totals = tagged.groupBy("_pp").agg(F.sum(value).alias("_pt"))
    wt = Window.orderBy("_pp").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pp", F.coalesce(F.sum("_pt").over(wt), F.lit(0)).alias("_off"))
    return (local.join(bounded(offsets), "_pp")
            .withColumn(out, (F.col("_off") + F.col("_local")).cast(sum_type))
            .drop("_pp", "_local", "_off"))


def pareto_classes(df: DataFrame, key: str, value: str, a: float = 80.0, b: float = 95.0,
                   pct_col: str = "pct", cum_col: str = "cumulative_pct",
                   class_col: str = "pareto_category") -> DataFrame:
    """Share of the grand total, cumulative share in descending ``value``
    order (ties by ``key``) and an A/B/C class (cumulative <= a, <= b, rest).
    ``value`` should be exact (DECIMAL) so ties and shares are reproducible.

    The grouped input is materialised once (inside ``prefix_sum``); the
    grand total is a scalar over that result.
    """
    cum = prefix_sum(df, value, ascending=False, tie=[key], value=value, out="_cum")
    grand = scalar(F.sum(value), cum)
    pct = F.try_divide(F.col(value) * 100, grand)
    cpct = F.try_divide(F.col("_cum") * 100, grand)
    return (cum
            .withColumn(pct_col, pct.cast("double"))
            .withColumn(cum_col, cpct.cast("double"))
            .withColumn(class_col, F.when(cpct <= a, "A").when(cpct <= b, "B").otherwise("C"))
            .drop("_cum"))


def first_crossing(series: DataFrame, partition: Sequence[str], order_col: str,
                   cum_col: str, threshold: float) -> DataFrame:
    """Per partition: the first ``order_col`` where ``cum_col >= threshold``
    (NULL when never reached), the cumulative value on that row
    (``value_at_crossing``) and the final cumulative value — one aggregate,
    no join back to the series."""
    keys = list(partition)
    g = series.groupBy(*keys) if keys else series.groupBy()
    reached = F.when(F.col(cum_col) >= threshold, F.col(order_col))
    return g.agg(F.min(reached).alias("crossed_on"),
                 F.min_by(F.col(cum_col), reached).alias("value_at_crossing"),
                 F.max_by(F.col(cum_col), F.col(order_col)).alias("final_total"))
