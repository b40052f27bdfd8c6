"""Scalar and table functions, procedures and dynamic SQL (eighth lab block).

* Scalar functions are Column expressions (``functions.kpi``).
* Table functions are Python functions returning DataFrames; optional
  parameters are Python keyword arguments, so an absent filter is simply not
  in the plan (no ``p IS NULL OR col = p`` residue).
* Dynamic SQL (a table name or grouping dimension chosen at run time) is a
  lookup in an explicit registry of allowed names -> Column expressions; no
  SQL text is assembled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.dates import ts
from lodestone.functions.kpi import DOWNTIME_BOUNDS, DOWNTIME_LABELS, calc_oee, classify_downtime, downtime_class_rank
from lodestone.functions.numeric import rnd, safe_div
from lodestone.operators.joins import bounded
from lodestone.plans.registry import query, rd
from lodestone.sources.tables import Tables

DEC = "CAST({} AS DECIMAL(18,2))"


def _range(col, lo, hi):
    return (F.col(col) >= ts(lo)) & (F.col(col) < ts(hi))


# ---------------------------------------------------------------- X1 / S4 / O6
@query("oee_by_row", """
SELECT CAST(l_shipdate AS DATE) AS full_date, s_name AS equipment_name, l_orderkey,
       CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CASE WHEN 12 = 0 OR 100 = 0 THEN NULL
            ELSE CAST(ROUND(CAST((l_tax * 100) * l_quantity * 100 / (12 * 100) AS DECIMAL(28,8)), 1) AS DOUBLE)
       END AS oee_pct
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1997-01-08'""")
def oee_by_row(spark, sf):
    """calc_oee applied to every production row of a week (the reference's
    unordered LIMIT preview is not reproduced: all rows, total order)."""
    t = Tables(spark, sf)
    li = t.lineitem.filter(_range("l_shipdate", "1997-01-01", "1997-01-08"))
    j = li.join(t.supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    return (j.select(F.to_date("l_shipdate").alias("full_date"), F.col("s_name").alias("equipment_name"),
                     "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
                     calc_oee(F.col("l_tax") * 100, 12, F.col("l_quantity"), 100).alias("oee_pct"))
            .orderBy("full_date", "l_orderkey", "l_linenumber"))


# ---------------------------------------------------------------- X2 / W13 / O2
_B = DOWNTIME_BOUNDS
_L = DOWNTIME_LABELS
_CLASS_SQL = (f"CASE WHEN value < {_B[0]} THEN '{_L[0]}' WHEN value <= {_B[1]} THEN '{_L[1]}' "
              f"WHEN value <= {_B[2]} THEN '{_L[2]}' WHEN value <= {_B[3]} THEN '{_L[3]}' ELSE '{_L[4]}' END")


@query("downtime_classes", f"""
WITH classified AS (SELECT {_CLASS_SQL} AS category, value FROM events
                    WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01')
SELECT category, COUNT(*) AS cnt, {rd('AVG(value)', 1)} AS avg_duration,
       CAST(ROUND(CAST(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER () AS DECIMAL(28,8)), 2) AS VARCHAR) || '%' AS pct_of_total
FROM classified GROUP BY category""")
def downtime_classes(spark, sf):
    """classify_downtime per row, counts per class, share of all rows as
    text, ordered by class rank.  The share's denominator is a window over
    the five class rows."""
    from pyspark.sql import Window
    t = Tables(spark, sf)
    ev = t.events.filter(_range("ts", "2024-01-01", "2024-02-01")).select("value")
    g = ev.groupBy(classify_downtime("value").alias("category")).agg(
        F.count(F.lit(1)).alias("cnt"), rnd(F.avg("value"), 1).alias("avg_duration"))
    share = F.round((F.col("cnt") * 100.0 / F.sum("cnt").over(Window.partitionBy())).cast("decimal(28,8)"), 2)
    return (g.select("category", "cnt", "avg_duration",
                     F.concat(share.cast("string"), F.lit("%")).alias("pct_of_total"))
            .orderBy(downtime_class_rank("category")))


# ---------------------------------------------------------------- X3 / J21
def equipment_summary(t: Tables, date_from: str, date_to: str, equipment_id=None, machines: DataFrame | None = None) -> DataFrame:
    """get_equipment_summary: per machine and day, totals and tons/hour.
    With ``machines`` (s_suppkey) it is the LATERAL form: the outer keys go
    sideways into the function, as a semi join on its scan, so only facts of
    these machines are aggregated."""
    li = t.lineitem.filter(F.col("l_shipdate").between(ts(date_from), ts(date_to)))
    if equipment_id is not None:
        li = li.filter(F.col("l_suppkey") == equipment_id)
    if machines is not None:
        li = li.join(machines.select("s_suppkey"), F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
    hours = (F.col("l_tax") * 100).cast("decimal(18,2)")
    g = li.groupBy("l_suppkey", F.to_date("l_shipdate").alias("report_date")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("_t"), F.sum("l_linenumber").alias("trips"),
        F.sum(hours).alias("_h"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("_f"))
    return g.select("l_suppkey", "report_date", rnd("_t").alias("tons_mined"), F.col("trips").cast("bigint").alias("trips"),
                    rnd("_h").alias("operating_hours"), rnd("_f").alias("fuel_liters"),
                    rnd(safe_div(F.col("_t").cast("double"), F.nullif(F.col("_h").cast("double"), F.lit(0))))
                    .alias("tons_per_hour"))


_ES_SQL = f"""SELECT l_suppkey, CAST(l_shipdate AS DATE) AS report_date,
  {rd(f"SUM({DEC.format('l_quantity')})")} AS tons_mined, CAST(SUM(l_linenumber) AS BIGINT) AS trips,
  {rd(f"SUM({DEC.format('l_tax * 100')})")} AS operating_hours, {rd(f"SUM({DEC.format('l_extendedprice')})")} AS fuel_liters,
  {rd(f"CAST(SUM({DEC.format('l_quantity')}) AS DOUBLE) / NULLIF(CAST(SUM({DEC.format('l_tax * 100')}) AS DOUBLE), 0)")} AS tons_per_hour
FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '{{lo}}' AND TIMESTAMP '{{hi}}' {{extra}}
GROUP BY 1, 2"""


@query("equipment_summary", _ES_SQL.format(lo="1997-01-01", hi="1997-01-31", extra="AND l_suppkey = 1"))
def equipment_summary_q(spark, sf):
    return equipment_summary(Tables(spark, sf), "1997-01-01", "1997-01-31", equipment_id=1)


@query("lateral_equipment_summary", f"""
SELECT s.s_name AS equipment_name, x.* EXCLUDE (l_suppkey)
FROM supplier s CROSS JOIN LATERAL (SELECT * FROM ({_ES_SQL.format(lo='1997-01-01', hi='1997-03-31', extra='')}) q
                                    WHERE q.l_suppkey = s.s_suppkey) x
WHERE s.s_nationkey = 1""")
def lateral_equipment_summary(spark, sf):
    """``dim CROSS JOIN LATERAL get_equipment_summary(dim.id, ...)``: the
    function over the facts of the mine's machines, joined to their names."""
    t = Tables(spark, sf)
    s = t.supplier.filter(F.col("s_nationkey") == 1).select("s_suppkey", F.col("s_name").alias("equipment_name"))
    rep = equipment_summary(t, "1997-01-01", "1997-03-31", machines=s)
    return (s.join(rep, F.col("s_suppkey") == F.col("l_suppkey")).drop("s_suppkey", "l_suppkey")
            .orderBy("equipment_name", "report_date"))


# ---------------------------------------------------------------- X4 / P10
def production_filtered(t: Tables, date_from: str, date_to: str, mine_id: int | None = None,
                        shift_id: int | None = None, equipment_type: str | None = None) -> DataFrame:
    """get_production_filtered: optional filters are added only when given."""
    li = t.lineitem.filter(F.col("l_shipdate").between(ts(date_from), ts(date_to)))
    if shift_id is not None:
        li = li.filter(F.col("l_linenumber") == shift_id)
    s = t.supplier.select("s_suppkey", "s_nationkey")
    if mine_id is not None:
        s = s.filter(F.col("s_nationkey") == mine_id)
    p = t.part.select("p_partkey", "p_type")
    if equipment_type is not None:
        p = p.filter(F.col("p_type") == equipment_type)
    j = (li.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(bounded(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
         .join(p, F.col("l_partkey") == F.col("p_partkey")))
    return (j.groupBy(F.col("n_name").alias("mine_name"),
                      F.concat(F.lit("shift "), F.col("l_linenumber").cast("string")).alias("shift_name"),
                      F.col("p_type").alias("equipment_type"))
            .agg(rnd(F.sum(F.col("l_quantity").cast("decimal(18,2)"))).alias("total_tons"),
                 F.sum("l_linenumber").cast("bigint").alias("total_trips"),
                 F.countDistinct("l_suppkey").alias("equip_count"))
            .orderBy("mine_name", "shift_name"))


_PF_SQL = f"""SELECT n_name AS mine_name, 'shift ' || CAST(l_linenumber AS VARCHAR) AS shift_name, p_type AS equipment_type,
  {rd(f"SUM({DEC.format('l_quantity')})")} AS total_tons, CAST(SUM(l_linenumber) AS BIGINT) AS total_trips,
  COUNT(DISTINCT l_suppkey) AS equip_count
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey
WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-01-31'
  AND ({{mine}} IS NULL OR s_nationkey = {{mine}}) AND ({{shift}} IS NULL OR l_linenumber = {{shift}})
GROUP BY 1, 2, 3"""


@query("production_filtered", _PF_SQL.format(mine="NULL", shift="NULL"))
def production_filtered_all(spark, sf):
    return production_filtered(Tables(spark, sf), "1997-01-01", "1997-01-31")


@query("production_filtered_mine", _PF_SQL.format(mine="1", shift="NULL"))
def production_filtered_mine(spark, sf):
    return production_filtered(Tables(spark, sf), "1997-01-01", "1997-01-31", mine_id=1)


@query("production_filtered_mine_shift", _PF_SQL.format(mine="1", shift="1"))
def production_filtered_mine_shift(spark, sf):
    return production_filtered(Tables(spark, sf), "1997-01-01", "1997-01-31", mine_id=1, shift_id=1)


# ---------------------------------------------------------------- X7 / T19
# The fact tables that may be counted, with their date column.
FACT_TABLES = {
    "fact_production": ("lineitem", "l_shipdate"),
    "fact_ore_quality": ("orders", "o_orderdate"),
    "fact_equipment_downtime": ("events", "ts"),
}


def count_fact_records(t: Tables, table_name: str, date_from: str, date_to: str) -> DataFrame:
    """Count rows of a named fact table in a date range.  Only names in the
    fact registry are accepted (the reference's ``LIKE 'fact_%'`` check,
    without ``_`` acting as a wildcard)."""
    if table_name not in FACT_TABLES:
        raise PermissionError(f"{table_name!r} is not a fact table")
    src, col = FACT_TABLES[table_name]
    df = t.get(src)
    return (df.filter(F.col(col).between(ts(date_from), ts(date_to)))
            .agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(table_name).alias("table_name"), "cnt"))


@query("count_by_table", """
SELECT 'fact_production' AS table_name, COUNT(*) AS cnt FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-01-31'
UNION ALL
SELECT 'fact_equipment_downtime', COUNT(*) FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31'""")
def count_by_table(spark, sf):
    t = Tables(spark, sf)
    return count_fact_records(t, "fact_production", "1997-01-01", "1997-01-31").unionByName(
        count_fact_records(t, "fact_equipment_downtime", "2024-01-01", "2024-01-31"))


# ---------------------------------------------------------------- X8 / A14
def _dims(t: Tables):
    """Allowed report dimensions: name -> (prepared facts, label column)."""
    li = t.lineitem
    sup = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    return {
        "mine": lambda d: (d.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
                           .join(bounded(t.nation), F.col("s_nationkey") == F.col("n_nationkey")), F.col("n_name")),
        "shift": lambda d: (d, F.concat(F.lit("shift "), F.col("l_linenumber").cast("string"))),
        "operator": lambda d: (d.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
                               .join(t.customer.select("c_custkey", "c_name", "c_mktsegment"),
                                     F.col("o_custkey") == F.col("c_custkey")),
                               F.concat(F.col("c_name"), F.lit(" "), F.col("c_mktsegment"))),
        "equipment": lambda d: (d.join(sup, F.col("l_suppkey") == F.col("s_suppkey")), F.col("s_name")),
        "equipment_type": lambda d: (d.join(t.part.select("p_partkey", "p_type"),
                                            F.col("l_partkey") == F.col("p_partkey")), F.col("p_type")),
    }, li


def build_production_report(t: Tables, group_by: str, date_from: str, date_to: str,
                            order_by: str = "total_tons DESC") -> DataFrame:
    dims, li = _dims(t)
    if group_by not in dims:
        raise ValueError(f"unknown dimension {group_by!r}; allowed: {', '.join(dims)}")
    facts = li.filter(F.col("l_shipdate").between(ts(date_from), ts(date_to)))
    joined, label = dims[group_by](facts)
    g = joined.groupBy(label.alias("dimension_name")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("_t"),
        F.sum("l_linenumber").cast("bigint").alias("total_trips"),
        F.sum((F.col("l_tax") * 100).cast("decimal(18,2)")).alias("_h"))
    out = g.select("dimension_name", rnd("_t").alias("total_tons"), "total_trips",
                   rnd(safe_div(F.col("_t").cast("double"), F.nullif(F.col("_h").cast("double"), F.lit(0))))
                   .alias("avg_productivity"))
    order = {"total_tons DESC": [F.desc("total_tons")], "total_tons ASC": [F.asc("total_tons")],
             "dimension_name ASC": [F.asc("dimension_name")]}.get(order_by, [F.desc("total_tons")])
    return out.orderBy(*order, "dimension_name")


_DYN_SQL = {
    "mine": ("n_name", "JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"),
    "shift": ("'shift ' || CAST(l_linenumber AS VARCHAR)", ""),
    "operator": ("c_name || ' ' || c_mktsegment",
                 "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"),
    "equipment": ("s_name", "JOIN supplier ON l_suppkey = s_suppkey"),
    "equipment_type": ("p_type", "JOIN part ON l_partkey = p_partkey"),
}


def _dyn_sql(dim):
    field, join = _DYN_SQL[dim]
    return f"""SELECT {field} AS dimension_name, {rd(f"SUM({DEC.format('l_quantity')})")} AS total_tons,
  CAST(SUM(l_linenumber) AS BIGINT) AS total_trips,
  {rd(f"CAST(SUM({DEC.format('l_quantity')}) AS DOUBLE) / NULLIF(CAST(SUM({DEC.format('l_tax * 100')}) AS DOUBLE), 0)")} AS avg_productivity
FROM lineitem {join}
WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-01-31'
GROUP BY 1"""


def _register_dynamic(dim, key, order_by="total_tons DESC"):
    @query(key, _dyn_sql(dim))
    def _q(spark, sf):
        return build_production_report(Tables(spark, sf), dim, "1997-01-01", "1997-01-31", order_by)
    _q.__name__ = key
    return _q


dynamic_report_mine = _register_dynamic("mine", "dynamic_report_mine")
dynamic_report_shift = _register_dynamic("shift", "dynamic_report_shift")
dynamic_report_operator = _register_dynamic("operator", "dynamic_report_operator")
dynamic_report_equipment = _register_dynamic("equipment", "dynamic_report_equipment")
dynamic_report_type = _register_dynamic("equipment_type", "dynamic_report_type", "dimension_name ASC")
