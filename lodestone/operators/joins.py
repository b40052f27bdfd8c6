"""Join operators.

Broadcast policy: a side is hinted for broadcast only when its size is bounded
independently of the data volume (a fixed code table such as region/nation, a
one-row aggregate, a 12-month frame, a parameter list).  Every other join is
left to AQE, which measures the materialised side at runtime against
``spark.sql.autoBroadcastJoinThreshold`` and falls back to a shuffled
sort-merge join (with skew splitting) when it is larger.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Largest side (optimizer estimate, bytes) that ``bounded`` will hint for
# broadcast.  Overridable per session with ``lodestone.broadcast.maxBytes``.
BROADCAST_CAP_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (no job is run)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimates are best effort
        return None


def partitions_for(df: DataFrame) -> int:
    """Partition count for an explicit repartition of ``df``: its estimated
    size over the advisory partition size (AQE's target), at least 1 and at
    most ``spark.sql.shuffle.partitions``."""
    conf = df.sparkSession.conf
    cap = max(1, int(conf.get("spark.sql.shuffle.partitions")))
    target = conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    t = target.strip().lower().rstrip("b")
    target_bytes = int(float(t[:-1]) * units[t[-1]]) if t and t[-1] in units else int(t or 64 << 20)
    est = estimated_bytes(df)
    if est is None:
        return cap
    return max(1, min(cap, -(-est // max(1, target_bytes))))


def bounded(df: DataFrame, max_bytes: int | None = None, rows_of: DataFrame | None = None) -> DataFrame:
    """Broadcast hint for a side whose size is bounded by its domain (a code
    table, a one-row aggregate, one row per month / partition / class).

    The bound is also checked: if the size exceeds the cap, the hint is
    dropped and AQE decides at runtime from the materialised size
    (broadcast if small, shuffled join otherwise).  The size is the
    optimizer's estimate, or — when ``df`` has at most one row per row of a
    small dimension ``rows_of`` (e.g. one row per mine) — that dimension's
    row count times ``df``'s row width, a proven bound where join estimates
    are loose.
    """
    cap = max_bytes
    if cap is None:
        conf = df.sparkSession.conf.get("lodestone.broadcast.maxBytes", None)
        cap = int(conf) if conf else BROADCAST_CAP_BYTES
    if rows_of is not None and (estimated_bytes(rows_of) or cap + 1) <= cap:
        est = rows_of.count() * int(df._jdf.schema().defaultSize())
    else:
        est = estimated_bytes(df)
    if est is not None and est <= cap:
        return F.broadcast(df)
    return df


def broadcastable(df: DataFrame) -> bool:
    """Whether the optimizer's size estimate of ``df`` is under the cap for broadcasts (``lodestone.broadcast.maxBytes``)."""
    conf = df.sparkSession.conf.get("lodestone.broadcast.maxBytes", None)
    est = estimated_bytes(df)
    return est is not None and est <= (int(conf) if conf else BROADCAST_CAP_BYTES)


# ---------------------------------------------------------------- scalar values
def scalar(agg: Column, of: DataFrame) -> Column:
    """An uncorrelated scalar subquery ``(SELECT agg FROM of)`` as a Column.

    Spark evaluates it once, before the outer query, and uses it as a
    constant; several scalars over the same input are merged into one
    aggregate by the optimizer.  No join is planned, so the outer rows are
    never paired with anything.
    """
    return of.select(agg).scalar()


# ---------------------------------------------------------------- quantified
def compare_all(df: DataFrame, value: str, subquery: DataFrame, sub_col: str,
                op: str = ">") -> DataFrame:
    """``value op ALL (SELECT sub_col FROM subquery)`` with SQL three-valued
    semantics: TRUE on an empty set, never TRUE when the set holds a NULL.

    The set is reduced to scalars (count, non-null count, max or min), so the
    outer filter compares each row with constants whatever the set's size.
    """
    n = scalar(F.count(F.lit(1)), subquery)
    nn = scalar(F.count(sub_col), subquery)
    v = F.col(value)
    cmp = {
        ">": v > scalar(F.max(sub_col), subquery), ">=": v >= scalar(F.max(sub_col), subquery),
        "<": v < scalar(F.min(sub_col), subquery), "<=": v <= scalar(F.min(sub_col), subquery),
    }[op]
    return df.filter((n == 0) | ((n == nn) & cmp))


def compare_any(df: DataFrame, value: str, subquery: DataFrame, sub_col: str,
                op: str = ">") -> DataFrame:
    """``value op ANY (SELECT sub_col ...)``: FALSE on an empty set; NULLs in
    the set can only turn FALSE into NULL, which a filter drops anyway."""
    v = F.col(value)
    cmp = {
        ">": v > scalar(F.min(sub_col), subquery), ">=": v >= scalar(F.min(sub_col), subquery),
        "<": v < scalar(F.max(sub_col), subquery), "<=": v <= scalar(F.max(sub_col), subquery),
    }[op]
    return df.filter(cmp)


def compare_scalar_max(df: DataFrame, value: str, subquery: DataFrame,
                       sub_col: str) -> DataFrame:
    """``value > (SELECT MAX(sub_col) ...)``: NULL (row dropped) on an empty
    set, NULLs in the set ignored."""
    return df.filter(F.col(value) > scalar(F.max(sub_col), subquery))


# ---------------------------------------------------------------- anti / semi
def not_in(df: DataFrame, col: str, subquery: DataFrame, sub_col: str,
           null_aware: bool = True) -> DataFrame:
    """``col NOT IN (SELECT sub_col ...)``.

    ``null_aware=True`` keeps SQL semantics: an empty subquery keeps every
    row (NULL probes too); a NULL anywhere in the subquery empties the
    result; otherwise NULL probes are dropped.  Spark plans the native form
    only as a *broadcast* null-aware anti join and degrades to a nested loop
    when the subquery is large, so it is rebuilt here from two scalars of the
    subquery (row count, NULL count) and an ordinary equi anti join, which
    AQE may broadcast or shuffle as sizes dictate.

    ``null_aware=False`` is the guarded form (``WHERE sub_col IS NOT NULL``).
    """
    keys = subquery.select(F.col(sub_col).alias("_ni_k"))
    nonnull = keys.filter(F.col("_ni_k").isNotNull())
    anti = df.join(nonnull, F.col(col) == F.col("_ni_k"), "left_anti")
    if not null_aware:
        return anti.filter(F.col(col).isNotNull())
    n = scalar(F.count(F.lit(1)), keys)
    nulls = scalar(F.count(F.lit(1)) - F.count("_ni_k"), keys)
    return anti.filter((n == 0) | ((nulls == 0) & F.col(col).isNotNull()))


# ---------------------------------------------------------------- per-group picks
def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                    n: int, rank_col: str | None = None, dense: bool = False) -> DataFrame:
    """First ``n`` rows per group by ``order`` (which must be a total order).

    Planned as a ``WindowGroupLimit`` below the shuffle, so every map task
    keeps at most ``n`` rows per key before the exchange: a hot key costs
    ``n`` rows per task, not its full size.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    fn = F.dense_rank() if dense else F.row_number()
    name = rank_col or "_rn"
    out = df.withColumn(name, fn.over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def latest_per_key(df: DataFrame, key: str, order: Sequence[str],
                   cols: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple per ``key``, as columns
    ``cols``.  ``max_by`` over a struct is a hash aggregate with map-side
    partial aggregation: skew-safe, one row per key leaves each task."""
    ordering = F.struct(*[F.col(c) for c in order])
    payload = F.struct(*[F.col(c) for c in cols])
    return (df.groupBy(key)
            .agg(F.max_by(payload, ordering).alias("_latest"))
            .select(key, *[F.col(f"_latest.{c}").alias(c) for c in cols]))
