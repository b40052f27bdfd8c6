"""Subquery forms (scalar, IN, NOT IN, correlated, EXISTS, ANY/ALL) expressed
as joins Spark can distribute.

Rewrites used:
* uncorrelated scalar subquery  -> one-row aggregate, broadcast cross join
* correlated aggregate          -> grouped aggregate joined on the key
* IN / EXISTS                   -> left semi join
* NOT EXISTS                    -> left anti join
* NOT IN                        -> null-aware rewrite (``operators.joins.not_in``)
* > ALL / > ANY                 -> one-row (count, non-null count, max / min)
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions.dates import ts
from lodestone.functions.numeric import dsum, rnd
from lodestone.functions.text import concat_pg
from lodestone.operators.hierarchy import calendar, calendar_parts
from lodestone.operators.joins import (bounded, compare_all, compare_any,
                                       compare_scalar_max, not_in, scalar)
from lodestone.plans.registry import dsum as sql_dsum
from lodestone.plans.registry import query, rd
from lodestone.sources.tables import Tables

MONTH = ("1997-03-01", "1997-04-01")
QUARTER = ("1997-01-01", "1997-04-01")


def _between(col, rng):
    return (F.col(col) >= ts(rng[0])) & (F.col(col) < ts(rng[1]))


# ---------------------------------------------------------------- J13 / A32 / R4
@query("above_average", f"""
WITH base AS (
  SELECT CONCAT(c_name, ' ', LEFT(c_mktsegment, 1), '. ', LEFT(COALESCE(NULL, ''), 1), '.') AS full_name,
         {sql_dsum('l_quantity')} AS tonnage
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  WHERE l_shipdate >= TIMESTAMP '{MONTH[0]}' AND l_shipdate < TIMESTAMP '{MONTH[1]}'
  GROUP BY full_name)
SELECT full_name, tonnage, (SELECT {rd('AVG(tonnage)')} FROM base) AS avg_tonnage
FROM base WHERE tonnage > (SELECT {rd('AVG(tonnage)')} FROM base)""")
def above_average(spark, sf):
    """Groups above the (rounded) average group total: the average is an
    uncorrelated scalar subquery over the grouped result."""
    t = Tables(spark, sf)
    li = t.lineitem.filter(_between("l_shipdate", MONTH)).select("l_orderkey", "l_quantity")
    j = (li.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
         .join(t.customer.select("c_custkey", "c_name", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")))
    name = concat_pg(F.col("c_name"), " ", F.left("c_mktsegment", F.lit(1)), ". ",
                     F.left(F.coalesce(F.lit(None).cast("string"), F.lit("")), F.lit(1)), ".")
    base = j.groupBy(name.alias("full_name")).agg(dsum("l_quantity").alias("tonnage"))
    avg = scalar(rnd(F.avg("tonnage")), base)
    return (base.withColumn("avg_tonnage", avg).filter(F.col("tonnage") > F.col("avg_tonnage"))
            .select("full_name", "tonnage", "avg_tonnage"))


# ---------------------------------------------------------------- J8 / A15
@query("semi_in", f"""
SELECT s_name AS equipment_name, n_name AS mine_name, s_acctbal AS balance
FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE s_suppkey IN (SELECT DISTINCT l_suppkey FROM lineitem
                    WHERE l_shipdate >= TIMESTAMP '{QUARTER[0]}' AND l_shipdate < TIMESTAMP '{QUARTER[1]}'
                      AND l_quantity > 49)""")
def semi_in(spark, sf):
    t = Tables(spark, sf)
    used = (t.lineitem.filter(_between("l_shipdate", QUARTER) & (F.col("l_quantity") > 49))
            .select("l_suppkey"))
    s = t.supplier.join(used, F.col("s_suppkey") == F.col("l_suppkey"), "left_semi")
    return (s.join(bounded(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_name").alias("equipment_name"), F.col("n_name").alias("mine_name"),
                    F.col("s_acctbal").alias("balance")))


# ---------------------------------------------------------------- J12 / T1
_RECENT = "2000-01-01"


def _customers_with_nation(t):
    return (t.customer.join(bounded(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "c_name", "n_name", "c_mktsegment"))


@query("anti_not_in", f"""
SELECT c_custkey, c_name, n_name, c_mktsegment
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey NOT IN (SELECT DISTINCT o_custkey FROM orders
                        WHERE o_orderdate >= TIMESTAMP '{_RECENT}' AND o_custkey IS NOT NULL)""")
def anti_not_in(spark, sf):
    """Guarded NOT IN (subquery filtered on IS NOT NULL)."""
    t = Tables(spark, sf)
    recent = t.orders.filter(F.col("o_orderdate") >= ts(_RECENT)).select("o_custkey")
    return not_in(_customers_with_nation(t), "c_custkey", recent, "o_custkey", null_aware=False)


@query("anti_not_in_null_trap", f"""
SELECT c_custkey, c_name, n_name, c_mktsegment
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderkey % 1000 = 0 THEN NULL ELSE o_custkey END
                        FROM orders WHERE o_orderdate >= TIMESTAMP '{_RECENT}')""")
def anti_not_in_null_trap(spark, sf):
    """Unguarded NOT IN whose subquery contains NULLs: SQL returns no rows."""
    t = Tables(spark, sf)
    recent = (t.orders.filter(F.col("o_orderdate") >= ts(_RECENT))
              .select(F.when(F.col("o_orderkey") % 1000 == 0, F.lit(None))
                      .otherwise(F.col("o_custkey")).alias("o_custkey")))
    return not_in(_customers_with_nation(t), "c_custkey", recent, "o_custkey", null_aware=True)


@query("not_exists_customers", f"""
SELECT c_custkey, c_name, n_name, c_mktsegment
FROM customer c JOIN nation ON c_nationkey = n_nationkey
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
                  AND o.o_orderdate >= TIMESTAMP '{_RECENT}')""")
def not_exists_customers(spark, sf):
    t = Tables(spark, sf)
    recent = t.orders.filter(F.col("o_orderdate") >= ts(_RECENT)).select("o_custkey")
    return _customers_with_nation(t).join(recent, F.col("c_custkey") == F.col("o_custkey"), "left_anti")


# ---------------------------------------------------------------- J14 / O2 / O3
@query("below_group_average", f"""
WITH f AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, s_name, s_nationkey
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT n_name AS mine_name, CAST(l_shipdate AS DATE) AS full_date, s_name AS equipment_name,
       l_quantity AS tons_mined, CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       {rd('(SELECT AVG(l_quantity) FROM f f2 WHERE f2.s_nationkey = f.s_nationkey)')} AS mine_avg
FROM f JOIN nation ON s_nationkey = n_nationkey
WHERE l_quantity < (SELECT AVG(l_quantity) FROM f f2 WHERE f2.s_nationkey = f.s_nationkey)
ORDER BY ABS(l_quantity - (SELECT AVG(l_quantity) FROM f f2 WHERE f2.s_nationkey = f.s_nationkey)) DESC,
         l_orderkey, l_linenumber
LIMIT 20""")
def below_group_average(spark, sf):
    """Correlated AVG per mine, decorrelated: sums and counts per machine give
    the per-mine averages, one row per mine (bounded by the mine dimension),
    broadcast back to the facts, which are joined to the machines once; the top 20 by gap is a TakeOrderedAndProject
    (per-task top-k, then a final merge)."""
    t = Tables(spark, sf)
    f = (t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_suppkey")
         .join(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")))
    by_machine = t.lineitem.groupBy(F.col("l_suppkey").alias("_m")).agg(F.sum("l_quantity").alias("_q"), F.count("l_quantity").alias("_n"))
    avg = (by_machine.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("_m") == F.col("s_suppkey"))
           .groupBy(F.col("s_nationkey").alias("_k")).agg((F.sum("_q") / F.sum("_n")).alias("_avg")))
    j = (f.join(bounded(avg, rows_of=t.nation), F.col("s_nationkey") == F.col("_k"))
         .filter(F.col("l_quantity") < F.col("_avg"))
         .join(bounded(t.nation), F.col("s_nationkey") == F.col("n_nationkey")))
    return (j.orderBy(F.desc(F.abs(F.col("l_quantity") - F.col("_avg"))), "l_orderkey", "l_linenumber")
            .limit(20)
            .select(F.col("n_name").alias("mine_name"), F.to_date("l_shipdate").alias("full_date"),
                    F.col("s_name").alias("equipment_name"), F.col("l_quantity").alias("tons_mined"),
                    F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
                    F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
                    rnd("_avg").alias("mine_avg")))


# ---------------------------------------------------------------- J9 / J15 / T4
@query("semi_exists", """
SELECT c_name AS equipment_name, c_mktsegment AS type_name, n_name AS mine_name,
  (SELECT COUNT(*) FROM events e WHERE e.user_id = c.c_custkey AND e.event_type = 'error'
     AND e.ts >= TIMESTAMP '2024-01-01' AND e.ts < TIMESTAMP '2024-01-21') AS alarm_count
FROM customer c JOIN nation ON c_nationkey = n_nationkey
WHERE EXISTS (SELECT * FROM events e WHERE e.user_id = c.c_custkey AND e.event_type = 'error'
                AND e.ts >= TIMESTAMP '2024-01-01' AND e.ts < TIMESTAMP '2024-01-21')""")
def semi_exists(spark, sf):
    """EXISTS + correlated COUNT: one grouped count of the alarm rows, inner
    joined (EXISTS makes the join inner, so the count is never 0 here)."""
    t = Tables(spark, sf)
    alarms = (t.events.filter((F.col("event_type") == "error") & (F.col("ts") >= ts("2024-01-01"))
                              & (F.col("ts") < ts("2024-01-21")))
              .groupBy("user_id").agg(F.count(F.lit(1)).alias("alarm_count")))
    c = t.customer.join(bounded(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return (c.join(alarms, F.col("c_custkey") == F.col("user_id"))
            .select(F.col("c_name").alias("equipment_name"), F.col("c_mktsegment").alias("type_name"),
                    F.col("n_name").alias("mine_name"), "alarm_count")
            .orderBy(F.desc("alarm_count"), "equipment_name"))


# ---------------------------------------------------------------- J10 / P9 / P12 / Q6
@query("missing_days", """
WITH cal AS (SELECT CAST(d AS DATE) AS full_date FROM range(DATE '1997-03-01', DATE '1997-04-01', INTERVAL 1 DAY) t(d))
SELECT full_date, CAST(dayofweek(full_date) AS BIGINT) AS day_of_week,
       dayofweek(full_date) IN (0, 6) AS is_weekend
FROM cal
WHERE NOT (EXISTS (SELECT * FROM lineitem l WHERE CAST(l.l_shipdate AS DATE) = cal.full_date
                   AND l.l_suppkey = 5))
  AND CAST(strftime(full_date, '%Y%m%d') AS INTEGER) BETWEEN 19970301 AND 19970331""")
def missing_days(spark, sf):
    """Calendar days without any production of machine 5 (NOT EXISTS)."""
    t = Tables(spark, sf)
    cal = calendar(spark, "1997-03-01", "1997-03-31")
    used = (t.lineitem.filter((F.col("l_suppkey") == 5) & _between("l_shipdate", ("1997-03-01", "1997-04-01")))
            .select(F.to_date("l_shipdate").alias("d")))
    days = calendar_parts(cal.join(used, cal.full_date == F.col("d"), "left_anti"))
    return (days.select("full_date", F.col("day_of_week").cast("bigint").alias("day_of_week"), "is_weekend")
            .orderBy("full_date"))


# ---------------------------------------------------------------- J16 / J17 / J18
_PARTS_SQL = "SELECT p_name, p_type, p_brand, p_retailprice FROM part"
_REF = "SELECT p_retailprice FROM part WHERE p_brand = 'Brand#11'"


def _parts(t):
    return t.part.select("p_partkey", "p_name", "p_type", "p_brand", "p_retailprice")


def _ref(t):
    return t.part.filter(F.col("p_brand") == "Brand#11").select("p_retailprice")


@query("quantified_all", f"{_PARTS_SQL} WHERE p_retailprice > ALL ({_REF})")
def quantified_all(spark, sf):
    t = Tables(spark, sf)
    return (compare_all(_parts(t), "p_retailprice", _ref(t), "p_retailprice", ">")
            .drop("p_partkey").orderBy(F.desc("p_retailprice")))


@query("greater_than_max", f"{_PARTS_SQL} WHERE p_retailprice > (SELECT MAX(p_retailprice) FROM ({_REF}) r)")
def greater_than_max(spark, sf):
    t = Tables(spark, sf)
    return (compare_scalar_max(_parts(t), "p_retailprice", _ref(t), "p_retailprice")
            .drop("p_partkey").orderBy(F.desc("p_retailprice")))


@query("quantified_any", f"{_PARTS_SQL} WHERE p_retailprice > ANY ({_REF})")
def quantified_any(spark, sf):
    t = Tables(spark, sf)
    return (compare_any(_parts(t), "p_retailprice", _ref(t), "p_retailprice", ">")
            .drop("p_partkey").orderBy(F.desc("p_retailprice")))
