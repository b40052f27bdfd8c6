"""Star-schema selects, joins and grouped summaries (first lab block).

Analogs on the test tables: nation = mine, supplier = equipment,
customer = operator, part type = equipment type, lineitem = production
(quantity = tons, extended price = fuel), events = downtime.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions.dates import ts
from lodestone.functions.numeric import dsum, rnd, safe_div
from lodestone.operators.joins import bounded
from lodestone.plans.registry import query, rd
from lodestone.plans.registry import dsum as sql_dsum
from lodestone.sources.tables import Tables


# ---------------------------------------------------------------- S1 / P1
@query("scan_project", """
SELECT s_name AS equipment_name, CAST(s_nationkey AS BIGINT) AS mine_id,
       s_acctbal AS balance
FROM supplier ORDER BY s_name""")
def scan_project(spark, sf):
    t = Tables(spark, sf)
    return (t.supplier
            .select(F.col("s_name").alias("equipment_name"),
                    F.col("s_nationkey").cast("bigint").alias("mine_id"),
                    F.col("s_acctbal").alias("balance"))
            .orderBy("equipment_name"))


# ---------------------------------------------------------------- P2 / P4
@query("filter_and", """
SELECT p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, has_recorder
FROM (SELECT *, p_retailprice > 950 AS has_recorder FROM part) p
WHERE p_size <= 19 AND has_recorder = TRUE AND p_type <> 'PROMO'""")
def filter_and(spark, sf):
    t = Tables(spark, sf)
    p = t.part.withColumn("has_recorder", F.col("p_retailprice") > 950)
    return (p.filter((F.col("p_size") <= 19) & F.col("has_recorder") & (F.col("p_type") != "PROMO"))
            .select("p_name", "p_brand", "p_type", F.col("p_size").cast("bigint").alias("p_size"),
                    "has_recorder")
            .orderBy("p_size", "p_name"))


# ---------------------------------------------------------------- P3
@query("filter_between", """
SELECT 'inclusive' AS range_kind, COUNT(*) AS n FROM orders
 WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate <= TIMESTAMP '1997-03-31'
UNION ALL
SELECT 'between', COUNT(*) FROM orders
 WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-31'
UNION ALL
SELECT 'exclusive', COUNT(*) FROM orders
 WHERE o_orderdate > TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-03-31'
UNION ALL
SELECT 'half_open', COUNT(*) FROM orders
 WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01'""")
def filter_between(spark, sf):
    """Four range forms in one scan: each is a conditional count (the scan
    carries the union of the ranges as its pushed filter)."""
    t = Tables(spark, sf)
    d = F.col("o_orderdate")
    lo, hi, nxt = ts("1997-03-01"), ts("1997-03-31"), ts("1997-04-01")
    counts = (t.orders.select("o_orderdate")
              .filter((d >= lo) & (d < nxt))
              .agg(F.count_if((d >= lo) & (d <= hi)).alias("inclusive"),
                   F.count_if(d.between(lo, hi)).alias("between"),
                   F.count_if((d > lo) & (d < hi)).alias("exclusive"),
                   F.count_if((d >= lo) & (d < nxt)).alias("half_open")))
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("range_kind"), F.col(k).alias("n"))
        for k in ("inclusive", "between", "exclusive", "half_open")])).alias("r")).select("r.*")


# ---------------------------------------------------------------- J1 / F1
@query("join_inner", """
SELECT c.c_name || ' ' || c.c_mktsegment || ' ' || n.n_name AS full_name,
       c.c_mktsegment AS position, c.c_acctbal AS balance
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE n.n_name = 'NATION_7' AND c.c_mktsegment = 'BUILDING'""")
def join_inner(spark, sf):
    t = Tables(spark, sf)
    n = t.nation.filter(F.col("n_name") == "NATION_7")
    c = t.customer.filter(F.col("c_mktsegment") == "BUILDING")
    return (c.join(bounded(n), c.c_nationkey == n.n_nationkey)
            .select(F.concat(c.c_name, F.lit(" "), c.c_mktsegment, F.lit(" "), n.n_name).alias("full_name"),
                    c.c_mktsegment.alias("position"), c.c_acctbal.alias("balance"))
            .orderBy("balance", "full_name"))


# ---------------------------------------------------------------- J2
@query("join_star", """
SELECT CAST(l.l_shipdate AS DATE) AS full_date, c.c_name AS operator_name,
       n.n_name AS mine_name, p.p_type AS type_name, l.l_quantity AS tons,
       l.l_returnflag = 'R' AS is_planned, l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_shipdate >= TIMESTAMP '1998-03-01' AND l.l_shipdate <= TIMESTAMP '1998-03-31'""")
def join_star(spark, sf):
    t = Tables(spark, sf)
    li = t.lineitem.filter((F.col("l_shipdate") >= ts("1998-03-01")) &
                           (F.col("l_shipdate") <= ts("1998-03-31")))
    out = (li.join(t.orders, li.l_orderkey == F.col("o_orderkey"))
           .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
           .join(bounded(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
           .join(t.part, F.col("l_partkey") == F.col("p_partkey")))
    return (out.select(F.to_date("l_shipdate").alias("full_date"),
                       F.col("c_name").alias("operator_name"),
                       F.col("n_name").alias("mine_name"),
                       F.col("p_type").alias("type_name"),
                       F.col("l_quantity").alias("tons"),
                       (F.col("l_returnflag") == "R").alias("is_planned"),
                       "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"))
            .orderBy(F.desc("tons"), "l_orderkey", "l_linenumber"))


# ---------------------------------------------------------------- J3 / A1
@query("agg_by_type", f"""
SELECT p.p_type AS type_name,
       {sql_dsum('l.l_quantity')} AS total_tons,
       {rd('AVG(l.l_quantity)', 4)} AS avg_per_shift,
       COUNT(*) AS shift_count,
       {sql_dsum('l.l_extendedprice')} AS total_fuel
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_type ORDER BY total_tons DESC""")
def agg_by_type(spark, sf):
    t = Tables(spark, sf)
    # sums by the fact's own key, so that one row a part meets the dimension
    by_part = t.lineitem.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("tons"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("fuel"))
    tons = F.sum("tons").cast("double")
    return (by_part.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
            .groupBy(F.col("p_type").alias("type_name"))
            .agg(tons.alias("total_tons"), rnd(tons / F.sum("n"), 4).alias("avg_per_shift"),
                 F.sum("n").alias("shift_count"), F.sum("fuel").cast("double").alias("total_fuel"))
            .orderBy(F.desc("total_tons")))


# ---------------------------------------------------------------- A2 (snowflake)
@query("agg_multi_key", f"""
SELECT n.n_name AS mine_name, CAST(l.l_linenumber AS BIGINT) AS shift_id,
       COUNT(*) AS sample_count,
       {rd('AVG(l.l_discount) * 100')} AS avg_fe,
       {rd('MIN(l.l_discount) * 100')} AS min_fe,
       {rd('MAX(l.l_discount) * 100')} AS max_fe
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY n.n_name, l.l_linenumber""")
def agg_multi_key(spark, sf):
    t = Tables(spark, sf)
    li = t.lineitem.groupBy("l_suppkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_discount").alias("total"), F.min("l_discount").alias("low"), F.max("l_discount").alias("high"))
    s = t.supplier.select("s_suppkey", "s_nationkey")
    j = (li.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(bounded(t.nation), F.col("s_nationkey") == F.col("n_nationkey")))
    return (j.groupBy(F.col("n_name").alias("mine_name"),
                      F.col("l_linenumber").cast("bigint").alias("shift_id"))
            .agg(F.sum("n").alias("sample_count"),
                 rnd(F.sum("total") / F.sum("n") * 100).alias("avg_fe"),
                 rnd(F.min("low") * 100).alias("min_fe"),
                 rnd(F.max("high") * 100).alias("max_fe"))
            .orderBy("mine_name", "shift_id"))


# ---------------------------------------------------------------- A28 / O3
@query("topk_months", f"""
SELECT strftime(l_shipdate, '%Y-%m') AS year_month,
       {sql_dsum('l_quantity')} AS total_tons,
       {rd('AVG(l_quantity)', 4)} AS avg_per_shift
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE s.s_nationkey = 1
GROUP BY 1 ORDER BY total_tons DESC, year_month LIMIT 3""")
def topk_months(spark, sf):
    """Top 3 months by production of one mine (nation 1)."""
    t = Tables(spark, sf)
    s = t.supplier.filter(F.col("s_nationkey") == 1).select("s_suppkey")
    li = t.lineitem.select("l_suppkey", "l_quantity", "l_shipdate")
    return (li.join(s, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
            .groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("year_month"))
            .agg(dsum("l_quantity").alias("total_tons"),
                 rnd(F.avg("l_quantity"), 4).alias("avg_per_shift"))
            .orderBy(F.desc("total_tons"), "year_month").limit(3))


# ---------------------------------------------------------------- A6
@query("having_filter", f"""
SELECT s.s_name AS equipment_name, COUNT(*) AS downtime_count,
       {sql_dsum('l.l_quantity')} AS total_duration,
       {rd('AVG(l.l_quantity)', 4)} AS avg_duration
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE l.l_returnflag = 'R'
GROUP BY s.s_name HAVING SUM(l.l_quantity) > 5200""")
def having_filter(spark, sf):
    t = Tables(spark, sf)
    by_machine = t.lineitem.filter(F.col("l_returnflag") == "R").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("total"))
    total = F.sum("total").cast("double")
    agg = (by_machine.join(t.supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
           .groupBy(F.col("s_name").alias("equipment_name"))
           .agg(F.sum("n").alias("downtime_count"), total.alias("total_duration"), rnd(total / F.sum("n"), 4).alias("avg_duration")))
    return agg.filter(F.col("total_duration") > 5200).orderBy(F.desc("total_duration"))


# ---------------------------------------------------------------- A9 / F22 / O7
@query("ratio_kpi", f"""
SELECT c.c_name || ' ' || c.c_mktsegment || ' ' || COALESCE(NULL, '') AS full_name,
       c.c_mktsegment AS position,
       COUNT(*) AS shift_count,
       {sql_dsum('l.l_quantity')} AS total_tons,
       {rd('AVG(l.l_quantity)', 4)} AS avg_tons_shift,
       {sql_dsum('l.l_tax')} AS total_hours,
       {rd('SUM(CAST(l.l_quantity AS DECIMAL(18,2))) / NULLIF(SUM(CAST(l.l_tax AS DECIMAL(18,2))), 0)', 4)} AS productivity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_name, c.c_mktsegment""")
def ratio_kpi(spark, sf):
    """Operator productivity: tons / NULLIF(hours, 0); NULL ratios sort first
    in a DESC order (PostgreSQL null placement)."""
    t = Tables(spark, sf)
    li = t.lineitem.select("l_orderkey", "l_quantity", "l_tax")
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    agg = (j.groupBy("c_name", "c_mktsegment")
           .agg(F.count(F.lit(1)).alias("shift_count"),
                F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("_t"),
                rnd(F.avg("l_quantity"), 4).alias("avg_tons_shift"),
                F.sum(F.col("l_tax").cast("decimal(18,2)")).alias("_h")))
    return (agg.select(
        F.concat(F.col("c_name"), F.lit(" "), F.col("c_mktsegment"), F.lit(" "),
                 F.coalesce(F.lit(None).cast("string"), F.lit(""))).alias("full_name"),
        F.col("c_mktsegment").alias("position"), "shift_count",
        F.col("_t").cast("double").alias("total_tons"), "avg_tons_shift",
        F.col("_h").cast("double").alias("total_hours"),
        rnd(safe_div(F.col("_t"), F.nullif(F.col("_h"), F.lit(0))), 4).alias("productivity"))
        .orderBy(F.desc_nulls_first("productivity"), "full_name"))


# ---------------------------------------------------------------- C1
@query("director_production", f"""
SELECT n.n_name AS mine_name,
       {sql_dsum('l.l_quantity')} AS total_tons,
       {rd('AVG(l.l_quantity)', 4)} AS avg_per_shift,
       COUNT(*) AS shift_count,
       {sql_dsum('l.l_extendedprice')} AS total_fuel,
       {rd('SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) / NULLIF(SUM(CAST(l.l_quantity AS DECIMAL(18,2))), 0)', 4)} AS fuel_per_ton
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
WHERE l.l_shipdate BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-01-31'
GROUP BY n.n_name""")
def director_production(spark, sf):
    t = Tables(spark, sf)
    li = (t.lineitem.filter(F.col("l_shipdate").between(ts("1999-01-01"), ts("1999-01-31")))
          .select("l_suppkey", "l_quantity", "l_extendedprice"))
    j = (li.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
         .join(bounded(t.nation), F.col("s_nationkey") == F.col("n_nationkey")))
    agg = (j.groupBy(F.col("n_name").alias("mine_name"))
           .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("_t"),
                rnd(F.avg("l_quantity"), 4).alias("avg_per_shift"),
                F.count(F.lit(1)).alias("shift_count"),
                F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("_f")))
    return (agg.select("mine_name", F.col("_t").cast("double").alias("total_tons"), "avg_per_shift",
                       "shift_count", F.col("_f").cast("double").alias("total_fuel"),
                       rnd(safe_div(F.col("_f"), F.nullif(F.col("_t"), F.lit(0))), 4).alias("fuel_per_ton"))
            .orderBy(F.desc("total_tons")))


# ---------------------------------------------------------------- C2
@query("downtime_by_category", f"""
SELECT event_type AS category, COUNT(*) AS downtime_count,
       {rd(f"{sql_dsum('value')} / 60.0", 4)} AS total_hours,
       {rd('AVG(value)', 4)} AS avg_minutes
FROM events
WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-16'
GROUP BY event_type""")
def downtime_by_category(spark, sf):
    t = Tables(spark, sf)
    ev = t.events.filter((F.col("ts") >= ts("2024-01-01")) & (F.col("ts") < ts("2024-01-16")))
    return (ev.groupBy(F.col("event_type").alias("category"))
            .agg(F.count(F.lit(1)).alias("downtime_count"),
                 rnd(dsum("value") / 60.0, 4).alias("total_hours"),
                 rnd(F.avg("value"), 4).alias("avg_minutes"))
            .orderBy(F.desc("total_hours")))


# ---------------------------------------------------------------- C3
@query("director_quality", f"""
SELECT n.n_name AS mine_name, o.o_orderpriority AS grade_name, COUNT(*) AS sample_count,
       {rd('AVG(o.o_totalprice) / 10000.0')} AS avg_fe,
       {rd('AVG(c.c_acctbal) / 1000.0')} AS avg_moisture
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_orderdate BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-01-31'
GROUP BY n.n_name, o.o_orderpriority""")
def director_quality(spark, sf):
    t = Tables(spark, sf)
    o = (t.orders.filter(F.col("o_orderdate").between(ts("1999-01-01"), ts("1999-01-31")))
         .select("o_custkey", "o_orderpriority", "o_totalprice"))
    j = (o.join(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"))
         .join(bounded(t.nation), F.col("c_nationkey") == F.col("n_nationkey")))
    return (j.groupBy(F.col("n_name").alias("mine_name"), F.col("o_orderpriority").alias("grade_name"))
            .agg(F.count(F.lit(1)).alias("sample_count"),
                 rnd(F.avg("o_totalprice") / 10000.0).alias("avg_fe"),
                 rnd(F.avg("c_acctbal") / 1000.0).alias("avg_moisture"))
            .orderBy("mine_name", "grade_name"))
