"""ROLLUP / CUBE / GROUPING SETS, static pivot and dynamic crosstab reports
(sixth lab block).

Spark expands each input row once per grouping set (``Expand``) and then
runs one partial + final hash aggregate, so every subtotal level is computed
in the same pass over the facts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions.dates import ts
from lodestone.functions.numeric import rnd, safe_div
from lodestone.operators.aggregate import labelled_grouping, pivot_by_values
from lodestone.operators.joins import bounded
from lodestone.plans.registry import query, rd
from lodestone.sources.tables import Tables

DEC = "CAST({} AS DECIMAL(18,2))"


def _range(col, lo, hi):
    return (F.col(col) >= ts(lo)) & (F.col(col) < ts(hi))


def _production(t, lo, hi):
    li = t.lineitem.filter(_range("l_shipdate", lo, hi))
    return (li.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(bounded(t.nation), F.col("s_nationkey") == F.col("n_nationkey")))


def _shift_name(col="l_linenumber"):
    return F.concat(F.lit("shift "), F.col(col).cast("string"))


# ---------------------------------------------------------------- A17 / A22 / O7
@query("rollup_report", f"""
SELECT CASE WHEN GROUPING(n_name) = 1 THEN 'Total' ELSE n_name END AS mine_name,
       CASE WHEN GROUPING(shift_name) = 1 THEN '-' ELSE shift_name END AS shift_name,
       CAST(SUM({DEC.format('l_quantity')}) AS DOUBLE) AS total_tons,
       COUNT(DISTINCT l_suppkey) AS equipment_count
FROM (SELECT *, 'shift ' || CAST(l_linenumber AS VARCHAR) AS shift_name FROM lineitem) l
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-02-01'
GROUP BY ROLLUP (n_name, shift_name)""")
def rollup_report(spark, sf):
    """Shift report with per-mine subtotals and a grand total.  The facts
    are first reduced to one row per (mine, shift, machine); the ROLLUP
    expansion and the distinct machine count then run over those rows."""
    t = Tables(spark, sf)
    p = _production(t, "1998-01-01", "1998-02-01").select(
        F.col("n_name").alias("mine_name"), _shift_name().alias("shift_name"), "l_quantity", "l_suppkey")
    fine = p.groupBy("mine_name", "shift_name", "l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("_t"))
    r = labelled_grouping(fine, "rollup", ["mine_name", "shift_name"],
                          [F.sum("_t").cast("double").alias("total_tons"),
                           F.countDistinct("l_suppkey").alias("equipment_count")],
                          total_label="Total")
    r = r.withColumn("shift_name", F.when((F.col("grouping_level") % 2) == 1, F.lit("-"))
                     .otherwise(F.col("shift_name")))
    return (r.select("mine_name", "shift_name", "total_tons", "equipment_count")
            .orderBy(F.asc_nulls_last("mine_name"), "shift_name"))


# ---------------------------------------------------------------- A19 / A22
@query("cube_report", f"""
SELECT CASE WHEN GROUPING(n_name) = 1 THEN 'All mines' ELSE n_name END AS mine_name,
       CASE WHEN GROUPING(p_type) = 1 THEN 'All types' ELSE p_type END AS type_name,
       CAST(SUM({DEC.format('l_quantity')}) AS DOUBLE) AS sum_tons,
       {rd(f"CAST(SUM({DEC.format('l_quantity')}) AS DOUBLE) / COUNT(DISTINCT l_suppkey)", 1)} AS avg_per_equipment,
       CAST(GROUPING(n_name, p_type) AS BIGINT) AS grouping_level
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-04-01'
GROUP BY CUBE (n_name, p_type)""")
def cube_report(spark, sf):
    """Mine x type matrix with all subtotals; ``grouping_level`` is the
    GROUPING bit mask (two-argument GROUPING = grouping_id).  CUBE expands
    each input row four times and COUNT(DISTINCT) adds its own expansion,
    so the facts are first reduced to one row per (mine, type, machine)."""
    t = Tables(spark, sf)
    p = (_production(t, "1998-01-01", "1998-04-01")
         .join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
         .select(F.col("n_name").alias("mine_name"), F.col("p_type").alias("type_name"), "l_quantity", "l_suppkey"))
    fine = p.groupBy("mine_name", "type_name", "l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("_t"))
    c = labelled_grouping(fine, "cube", ["mine_name", "type_name"],
                          [F.sum("_t").cast("double").alias("sum_tons"),
                           F.countDistinct("l_suppkey").alias("_n")])
    return (c.select(F.when(F.col("grouping_level").bitwiseAND(2) > 0, "All mines")
                     .otherwise(F.col("mine_name")).alias("mine_name"),
                     F.when(F.col("grouping_level").bitwiseAND(1) > 0, "All types")
                     .otherwise(F.col("type_name")).alias("type_name"),
                     "sum_tons", rnd(safe_div(F.col("sum_tons"), F.col("_n")), 1).alias("avg_per_equipment"),
                     F.col("grouping_level").cast("bigint").alias("grouping_level"))
            .orderBy("grouping_level", "mine_name", "type_name"))


# ---------------------------------------------------------------- A20 / F22
@query("grouping_sets_report", f"""
SELECT CASE WHEN GROUPING(n_name) = 0 THEN 'mine' WHEN GROUPING(shift_name) = 0 THEN 'shift'
            WHEN GROUPING(p_type) = 0 THEN 'equipment type' ELSE 'TOTAL' END AS dimension,
       COALESCE(n_name, shift_name, p_type, 'All') AS dimension_value,
       CAST(SUM({DEC.format('l_quantity')}) AS DOUBLE) AS total_tons,
       CAST(SUM(l_linenumber) AS BIGINT) AS total_trips,
       {rd(f"CAST(SUM({DEC.format('l_quantity')}) AS DOUBLE) / SUM(l_linenumber)")} AS avg_tons_per_trip
FROM (SELECT *, 'shift ' || CAST(l_linenumber AS VARCHAR) AS shift_name FROM lineitem) l
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-02-01'
GROUP BY GROUPING SETS ((n_name), (shift_name), (p_type), ())""")
def grouping_sets_report(spark, sf):
    """KPI summary over several independent slices in one aggregate, run
    over the facts pre-aggregated to (mine, shift, type)."""
    t = Tables(spark, sf)
    p = (_production(t, "1998-01-01", "1998-02-01")
         .join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
         .select("n_name", _shift_name().alias("shift_name"), "p_type", "l_quantity", "l_linenumber"))
    fine = p.groupBy("n_name", "shift_name", "p_type").agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("_t"), F.sum("l_linenumber").alias("_trips"))
    g = (fine.groupingSets([["n_name"], ["shift_name"], ["p_type"], []], "n_name", "shift_name", "p_type")
         .agg(F.sum("_t").cast("double").alias("total_tons"),
              F.sum("_trips").cast("bigint").alias("total_trips"),
              F.grouping("n_name").alias("g_m"), F.grouping("shift_name").alias("g_s"),
              F.grouping("p_type").alias("g_t")))
    dim = (F.when(F.col("g_m") == 0, "mine").when(F.col("g_s") == 0, "shift")
           .when(F.col("g_t") == 0, "equipment type").otherwise("TOTAL"))
    return (g.select(dim.alias("dimension"),
                     F.coalesce("n_name", "shift_name", "p_type", F.lit("All")).alias("dimension_value"),
                     "total_tons", "total_trips",
                     rnd(safe_div(F.col("total_tons"), F.col("total_trips")), 2).alias("avg_tons_per_trip"))
            .orderBy("dimension", "dimension_value"))


# ---------------------------------------------------------------- A21 / A23 / P12
_MONTH_COLS = ["m01", "m02", "m03", "m04", "m05", "m06"]


@query("pivot_months", f"""
SELECT CASE WHEN GROUPING(n_name) = 1 THEN 'TOTAL' ELSE n_name END AS mine_name,
  {", ".join(f"{rd(f'AVG(CASE WHEN EXTRACT(MONTH FROM o_orderdate) = {i + 1} THEN o_totalprice / 10000 END)')} AS {c}" for i, c in enumerate(_MONTH_COLS))},
  {rd('AVG(o_totalprice / 10000)')} AS period_avg
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderdate >= '1998-01-01' AND o_orderdate <= '1998-06-30'
GROUP BY GROUPING SETS ((n_name), ())""")
def pivot_months(spark, sf):
    """Month columns by conditional aggregation plus a grand-total row
    (GROUPING SETS ((mine), ()))."""
    t = Tables(spark, sf)
    o = (t.orders.filter((F.col("o_orderdate") >= ts("1998-01-01")) & (F.col("o_orderdate") <= ts("1998-06-30")))
         .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
         .join(bounded(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
         .select("n_name", F.month("o_orderdate").alias("m"), (F.col("o_totalprice") / 10000).alias("fe")))
    aggs = [rnd(F.avg(F.when(F.col("m") == i + 1, F.col("fe"))), 2).alias(c) for i, c in enumerate(_MONTH_COLS)]
    g = (o.groupingSets([["n_name"], []], "n_name")
         .agg(*aggs, rnd(F.avg("fe")).alias("period_avg"), F.grouping("n_name").alias("_g")))
    return (g.orderBy("_g", "n_name")
            .select(F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col("n_name")).alias("mine_name"),
                    *_MONTH_COLS, "period_avg"))


# ---------------------------------------------------------------- A24
CROSSTAB_N = 5
_CT_COLS = [f"reason_{i + 1}" for i in range(CROSSTAB_N)]
_CT_X = DEC.format("l_extendedprice")


@query("crosstab_top5", f"""
WITH src AS (
  SELECT s_name, p_brand, l_extendedprice
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-04-01'),
cats AS (
  SELECT p_brand, ROW_NUMBER() OVER (ORDER BY SUM({DEC.format('l_extendedprice')}) DESC, p_brand) AS rn
  FROM src GROUP BY p_brand ORDER BY rn LIMIT {CROSSTAB_N})
SELECT s_name AS equipment_name,
  {", ".join(f"{rd(f'SUM(CASE WHEN cats.rn = {i + 1} THEN {_CT_X} END) / 60.0', 1)} AS {c}" for i, c in enumerate(_CT_COLS))}
FROM src LEFT JOIN cats ON src.p_brand = cats.p_brand
GROUP BY s_name""")
def crosstab_top5(spark, sf):
    """Dynamic crosstab: the categories are the top-N brands by value in the
    period, found inside the plan — category totals, a distributed top-N
    (TakeOrderedAndProject), a rank over those N rows — and broadcast back
    to the facts; the pivot is on the rank 1..N, so the schema is fixed
    before execution and nothing is read on the driver.  Columns are
    positional (``reason_1`` = largest category)."""
    from pyspark.sql import Window

    t = Tables(spark, sf)
    src = (t.lineitem.filter(_range("l_shipdate", "1998-01-01", "1998-04-01"))
           .select("l_suppkey", "l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("_x"))
           .join(t.supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
           .join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")))
    # One pre-aggregate at (machine, category) grain feeds both the category
    # ranking and the pivot: both branches start with the same exchange,
    # which Spark reuses, so the facts are read once.
    cell = src.groupBy("s_name", "p_brand").agg(F.sum("_x").alias("_x"))
    order = [F.desc("_v"), F.asc("p_brand")]
    top = (cell.groupBy("p_brand").agg(F.sum("_x").alias("_v"))
           .orderBy(*order).limit(CROSSTAB_N)                      # N rows
           .select(F.col("p_brand").alias("_cat"), F.row_number().over(Window.orderBy(*order)).alias("_rank")))
    ranked = cell.join(bounded(top), F.col("p_brand") == F.col("_cat"), "left")
    pv = pivot_by_values(ranked, [F.col("s_name").alias("equipment_name")], "_rank",
                         list(range(1, CROSSTAB_N + 1)), F.col("_x"), agg="sum", names=_CT_COLS)
    return (pv.select("equipment_name", *[rnd(F.col(c) / 60.0, 1).alias(c) for c in _CT_COLS])
            .orderBy("equipment_name"))


# ---------------------------------------------------------------- A18 / U7
_Q1 = ("1998-01-01", "1998-04-01")


def _raw_sql(metric, expr, joins, date_col, div=""):
    m = f"EXTRACT(MONTH FROM {date_col})"
    return f"""
  SELECT n_name AS mine_name, '{metric}' AS metric,
    CAST(SUM(CASE WHEN {m} = 1 THEN {DEC.format(expr)} ELSE 0 END) AS DOUBLE){div} AS jan,
    CAST(SUM(CASE WHEN {m} = 2 THEN {DEC.format(expr)} ELSE 0 END) AS DOUBLE){div} AS feb,
    CAST(SUM(CASE WHEN {m} = 3 THEN {DEC.format(expr)} ELSE 0 END) AS DOUBLE){div} AS mar,
    CAST(SUM({DEC.format(expr)}) AS DOUBLE){div} AS q1_total,
    GROUPING(n_name) AS is_total
  FROM {joins}
  WHERE {date_col} >= TIMESTAMP '{_Q1[0]}' AND {date_col} < TIMESTAMP '{_Q1[1]}'
  GROUP BY ROLLUP (n_name)"""


@query("rollup_pivot_union", f"""
WITH raw AS (
{_raw_sql('production (tons)', 'l_quantity', 'lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey', 'l_shipdate')}
  UNION ALL
{_raw_sql('order value (k)', 'o_totalprice', 'orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey', 'o_orderdate', ' / 1000.0')})
SELECT CASE WHEN is_total = 1 THEN 'TOTAL' ELSE mine_name END AS mine_name, metric,
  {rd('jan', 1)} AS jan, {rd('feb', 1)} AS feb, {rd('mar', 1)} AS mar, {rd('q1_total', 1)} AS q1_total,
  CASE WHEN jan > 0 THEN {rd('(feb - jan) / jan * 100', 1)} ELSE 0 END AS diff_feb_jan_pct,
  CASE WHEN feb > 0 THEN {rd('(mar - feb) / feb * 100', 1)} ELSE 0 END AS diff_mar_feb_pct,
  CASE WHEN feb = 0 THEN 'no data' WHEN (mar - feb) / feb * 100 > 5 THEN 'growth'
       WHEN (mar - feb) / feb * 100 < -5 THEN 'decline' ELSE 'stable' END AS trend
FROM raw""")
def rollup_pivot_union(spark, sf):
    """Two ROLLUP(mine) pivots over different facts, stacked with UNION ALL,
    then month-over-month differences and a trend label."""
    t = Tables(spark, sf)

    def raw(df, date_col, value_col, metric, scale=None):
        m = F.month(date_col)
        v = F.col(value_col).cast("decimal(18,2)")

        def s(cond):
            x = F.sum(F.when(cond, v).otherwise(F.lit(0)) if cond is not None else v).cast("double")
            return x / scale if scale else x

        g = (df.rollup("n_name")
             .agg(s(m == 1).alias("jan"), s(m == 2).alias("feb"), s(m == 3).alias("mar"),
                  s(None).alias("q1_total"), F.grouping("n_name").alias("is_total")))
        return g.withColumn("metric", F.lit(metric))

    prod = _production(t, *_Q1)
    orders = (t.orders.filter(_range("o_orderdate", *_Q1))
              .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
              .join(bounded(t.nation), F.col("c_nationkey") == F.col("n_nationkey")))
    rr = raw(prod, "l_shipdate", "l_quantity", "production (tons)").unionByName(
        raw(orders, "o_orderdate", "o_totalprice", "order value (k)", 1000.0))
    jan, feb, mar = F.col("jan"), F.col("feb"), F.col("mar")
    chg = F.try_divide(mar - feb, feb) * 100
    return (rr.select(
        F.when(F.col("is_total") == 1, "TOTAL").otherwise(F.col("n_name")).alias("mine_name"), "metric",
        rnd(jan, 1).alias("jan"), rnd(feb, 1).alias("feb"), rnd(mar, 1).alias("mar"),
        rnd("q1_total", 1).alias("q1_total"),
        F.when(jan > 0, rnd(F.try_divide(feb - jan, jan) * 100, 1)).otherwise(F.lit(0.0)).alias("diff_feb_jan_pct"),
        F.when(feb > 0, rnd(chg, 1)).otherwise(F.lit(0.0)).alias("diff_mar_feb_pct"),
        F.when(feb == 0, "no data").when(chg > 5, "growth").when(chg < -5, "decline")
        .otherwise("stable").alias("trend"),
        "is_total")
        .orderBy("metric", "is_total", "mine_name").drop("is_total"))
