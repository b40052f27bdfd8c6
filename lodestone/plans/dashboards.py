"""Indexing-lab workload: the dashboard and lookup queries, and the index
work re-aimed at storage layout.

PostgreSQL indexes have no Spark counterpart; what they buy is rebuilt as
layout: a copy of the facts clustered by date and machine at once (range
partitioning + sort, so parquet min/max statistics skip files and row groups), and a pre-filtered
narrow projection (the partial covering index).  Every query's filters and
projections reach the parquet scan (``PushedFilters`` / ``ReadSchema``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions.dates import date_key, ts
from lodestone.functions.numeric import dsum, pct, rnd
from lodestone.operators.joins import bounded
from lodestone.plans.registry import dsum as sql_dsum
from lodestone.plans.registry import query, rd
from lodestone.sources.snapshots import interleaved_layout, layout_of, projection
from lodestone.sources.tables import Tables

MARCH = ("1997-03-01", "1997-04-01")


def _range(col, lo, hi):
    return (F.col(col) >= ts(lo)) & (F.col(col) < ts(hi))


_SQL_MARCH = f"l_shipdate >= TIMESTAMP '{MARCH[0]}' AND l_shipdate < TIMESTAMP '{MARCH[1]}'"


# ---------------------------------------------------------------- C9
@query("equipment_month_totals", f"""
SELECT s_name AS equipment_name, {sql_dsum('l_quantity')} AS total_tons,
       {sql_dsum('l_extendedprice')} AS total_fuel, {sql_dsum('l_tax * 100')} AS total_hours
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
WHERE {_SQL_MARCH}
GROUP BY s_name""")
def equipment_month_totals(spark, sf):
    """Month totals per machine: range filter pushed to the scan, partial
    aggregation before the shuffle, machine names joined after the
    aggregate (one row per machine instead of one per fact)."""
    t = Tables(spark, sf)
    agg = (t.lineitem.filter(_range("l_shipdate", *MARCH))
           .groupBy("l_suppkey")
           .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("_t"),
                F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("_f"),
                F.sum((F.col("l_tax") * 100).cast("decimal(18,2)")).alias("_h")))
    s = t.supplier.select("s_suppkey", "s_name")
    j = agg.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    # equipment_name is not unique in general: re-aggregate by name.
    return (j.groupBy(F.col("s_name").alias("equipment_name"))
            .agg(F.sum("_t").cast("double").alias("total_tons"), F.sum("_f").cast("double").alias("total_fuel"),
                 F.sum("_h").cast("double").alias("total_hours"))
            .orderBy(F.desc("total_tons"), "equipment_name"))


# ---------------------------------------------------------------- P14 (scan)
@query("fuel_threshold_scan", """
SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS date_id, s_name AS equipment_name,
       c_name AS last_name, l_extendedprice / 1000 AS fuel_consumed_l, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
WHERE l_extendedprice / 1000 > 80""")
def fuel_threshold_scan(spark, sf):
    t = Tables(spark, sf)
    li = t.lineitem.filter(F.col("l_extendedprice") > 80000).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice")
    j = (li.join(t.supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
         .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
         .join(t.customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")))
    return (j.select(date_key("l_shipdate").cast("bigint").alias("date_id"), F.col("s_name").alias("equipment_name"),
                     F.col("c_name").alias("last_name"), (F.col("l_extendedprice") / 1000).alias("fuel_consumed_l"),
                     "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"))
            .orderBy(F.desc("fuel_consumed_l"), "l_orderkey", "l_linenumber"))


# ---------------------------------------------------------------- P14 / A3 / A8
@query("filter_selectivity", f"""
SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE l_quantity > 40) AS matching_rows,
       {rd('COUNT(*) FILTER (WHERE l_quantity > 40) * 100.0 / COUNT(*)')} AS selectivity_pct
FROM lineitem""")
def filter_selectivity(spark, sf):
    """Share of rows a predicate keeps (decides whether an index / layout
    on that column pays off).  One global aggregate over one column."""
    t = Tables(spark, sf)
    c = t.lineitem.agg(F.count(F.lit(1)).alias("total_rows"),
                       F.count_if(F.col("l_quantity") > 40).alias("matching_rows"))
    return c.select("total_rows", "matching_rows", pct("matching_rows", "total_rows").alias("selectivity_pct"))


# ---------------------------------------------------------------- S12 / S13 / P4
@query("alarm_lookup", """
SELECT event_id, CAST(ts AS DATE) AS full_date, user_id, value FROM events
WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16' AND event_type = 'error'""")
def alarm_lookup(spark, sf):
    t = Tables(spark, sf)
    return (t.events.filter(_range("ts", "2024-01-15", "2024-01-16") & (F.col("event_type") == "error"))
            .select("event_id", F.to_date("ts").alias("full_date"), "user_id", "value"))


@query("alarm_projection", """
SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'error' AND value > 100""")
def alarm_projection(spark, sf):
    """The partial covering index, materialised: alarm rows only, four
    columns, written once and read back (later lookups scan this small
    dataset instead of the fact table)."""
    t = Tables(spark, sf)
    return projection(t.events, "alarm_projection", (F.col("event_type") == "error") & (F.col("value") > 100),
                      ["event_id", "ts", "user_id", "value"])


@query("layout_pruned_read", f"""
SELECT l_shipdate, l_suppkey, l_quantity FROM lineitem
WHERE l_suppkey = 5 AND {_SQL_MARCH}""")
def layout_pruned_read(spark, sf):
    """Composite/BRIN index intent: the facts lie clustered by the interleaved
    bits of ship date and machine, so that a filter on either skips files.  The
    layout is a job of its own (``fact_layout``); the read takes the one that is
    there for the table as it is."""
    li = spark.read.parquet(fact_layout(Tables(spark, sf)))
    return (li.filter((F.col("l_suppkey") == 5) & _range("l_shipdate", *MARCH))
            .select("l_shipdate", "l_suppkey", "l_quantity"))


def fact_layout(t: Tables, files: int | None = None) -> str:
    """Where the clustered copy of the facts lies; it is built if there is none."""
    return layout_of(t.spark, t.path("lineitem"), f"lineitem-date-machine-{files or 'sized'}",
                     lambda path: interleaved_layout(t.lineitem, path, ["l_shipdate", "l_suppkey"], files))


@query("covering_day_read", """
SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS date_id, l_suppkey AS equipment_id,
       l_quantity AS tons_mined, l_extendedprice AS fuel
FROM lineitem WHERE l_shipdate = TIMESTAMP '1997-03-15'""")
def covering_day_read(spark, sf):
    t = Tables(spark, sf)
    return (t.lineitem.filter(F.col("l_shipdate") == ts("1997-03-15"))
            .select(date_key("l_shipdate").cast("bigint").alias("date_id"), F.col("l_suppkey").alias("equipment_id"),
                    F.col("l_quantity").alias("tons_mined"), F.col("l_extendedprice").alias("fuel")))


# ---------------------------------------------------------------- P11
@query("case_insensitive_lookup", """
SELECT p_partkey, p_name, p_brand, p_type FROM part WHERE lower(p_name) = 'red widget'
UNION ALL
SELECT p_partkey, p_name, p_brand, p_type FROM part WHERE upper(p_brand) = 'BRAND#7'""")
def case_insensitive_lookup(spark, sf):
    t = Tables(spark, sf)
    p = t.part.select("p_partkey", "p_name", "p_brand", "p_type")
    return (p.filter(F.lower("p_name") == "red widget")
            .unionByName(p.filter(F.upper("p_brand") == "BRAND#7")))


# ---------------------------------------------------------------- C8 dashboard
@query("dash_mine", f"""
SELECT n_name AS mine_name, {sql_dsum('l_quantity')} AS total_tons, {sql_dsum('l_tax * 100')} AS total_hours
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
WHERE {_SQL_MARCH} GROUP BY n_name""")
def dash_mine(spark, sf):
    t = Tables(spark, sf)
    li = t.lineitem.filter(_range("l_shipdate", *MARCH)).select("l_suppkey", "l_quantity", "l_tax")
    j = (li.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
         .join(bounded(t.nation), F.col("s_nationkey") == F.col("n_nationkey")))
    return (j.groupBy(F.col("n_name").alias("mine_name"))
            .agg(dsum("l_quantity").alias("total_tons"),
                 F.sum((F.col("l_tax") * 100).cast("decimal(18,2)")).cast("double").alias("total_hours")))


@query("dash_grade", f"""
SELECT o_orderpriority AS grade_name, {rd('AVG(o_totalprice / 10000)', 4)} AS avg_fe,
       {rd('AVG(o_totalprice / 7000)', 4)} AS avg_sio2, COUNT(*) AS samples
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-04-01'
GROUP BY o_orderpriority""")
def dash_grade(spark, sf):
    t = Tables(spark, sf)
    o = t.orders.filter(_range("o_orderdate", "1997-01-01", "1997-04-01"))
    return (o.groupBy(F.col("o_orderpriority").alias("grade_name"))
            .agg(rnd(F.avg(F.col("o_totalprice") / 10000), 4).alias("avg_fe"),
                 rnd(F.avg(F.col("o_totalprice") / 7000), 4).alias("avg_sio2"),
                 F.count(F.lit(1)).alias("samples")))


@query("topk_groups", f"""
SELECT c_name AS equipment_name, {sql_dsum('value')} AS total_downtime_min, COUNT(*) AS incidents
FROM events JOIN customer ON user_id = c_custkey
WHERE event_type <> 'view' AND ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'
GROUP BY c_name ORDER BY total_downtime_min DESC, equipment_name LIMIT 5""")
def topk_groups(spark, sf):
    """Top 5 machines by unplanned downtime: grouped, then
    TakeOrderedAndProject (each task keeps its own top 5)."""
    t = Tables(spark, sf)
    ev = t.events.filter((F.col("event_type") != "view") & _range("ts", "2024-01-01", "2024-02-01"))
    agg = ev.groupBy("user_id").agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("_v"),
                                    F.count(F.lit(1)).alias("incidents"))
    j = agg.join(t.customer.select("c_custkey", "c_name"), F.col("user_id") == F.col("c_custkey"))
    g = j.groupBy(F.col("c_name").alias("equipment_name")).agg(
        F.sum("_v").cast("double").alias("total_downtime_min"), F.sum("incidents").alias("incidents"))
    return g.orderBy(F.desc("total_downtime_min"), "equipment_name").limit(5)


@query("latest_alarms", """
SELECT CAST(ts AS DATE) AS full_date, ts, event_id, value AS sensor_value, props AS quality_flag
FROM events WHERE user_id = 5 AND event_type = 'error'
ORDER BY ts DESC, event_id DESC LIMIT 20""")
def latest_alarms(spark, sf):
    t = Tables(spark, sf)
    ev = t.events.filter((F.col("user_id") == 5) & (F.col("event_type") == "error"))
    return (ev.orderBy(F.desc("ts"), F.desc("event_id")).limit(20)
            .select(F.to_date("ts").alias("full_date"), "ts", "event_id", F.col("value").alias("sensor_value"),
                    F.col("props").alias("quality_flag")))


@query("dash_operator_week", """
SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS date_id, s_name AS equipment_name, l_quantity AS tons_mined,
       CAST(l_linenumber AS BIGINT) AS trips_count, l_tax * 100 AS operating_hours, l_orderkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
WHERE o_custkey = 3 AND l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'""")
def dash_operator_week(spark, sf):
    t = Tables(spark, sf)
    o = t.orders.filter(F.col("o_custkey") == 3).select("o_orderkey")
    li = t.lineitem.filter(_range("l_shipdate", "1997-01-01", "1998-01-01"))
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
         .join(t.supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey")))
    return (j.select(date_key("l_shipdate").cast("bigint").alias("date_id"), F.col("s_name").alias("equipment_name"),
                     F.col("l_quantity").alias("tons_mined"), F.col("l_linenumber").cast("bigint").alias("trips_count"),
                     (F.col("l_tax") * 100).alias("operating_hours"), "l_orderkey")
            .orderBy("date_id", "l_orderkey"))
