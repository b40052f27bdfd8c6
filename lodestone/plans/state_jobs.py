"""DML jobs over table state (the data-change lab block).

Each query returns the state a statement leaves behind (or its RETURNING
rows); the oracle is the equivalent SELECT (UNION ALL / CASE / anti join /
FULL JOIN) over the same base tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.dates import ts
from lodestone.operators.joins import bounded, scalar
from lodestone.operators.state import (insert, merge, tag_delete,
                                       row_index, update, update_where_in, upsert)
from lodestone.plans.registry import query
from lodestone.session import scratch_dir
from lodestone.sources.snapshots import empty_like, truncate
from lodestone.sources.tables import Tables


# ---------------------------------------------------------------- state builders
def equipment_state(t: Tables) -> DataFrame:
    """Equipment dimension derived from the supplier table."""
    return t.supplier.select(
        F.col("s_suppkey").cast("bigint").alias("equipment_id"), F.col("s_name").alias("equipment_name"),
        F.col("s_nationkey").cast("bigint").alias("mine_id"),
        (F.lit(2000) + F.col("s_suppkey") % 25).cast("bigint").alias("year_manufactured"),
        F.lit("active").alias("status"), (F.col("s_acctbal") > 2000).alias("has_navigation"))


_EQ_SQL = """SELECT CAST(s_suppkey AS BIGINT) AS equipment_id, s_name AS equipment_name,
  CAST(s_nationkey AS BIGINT) AS mine_id, CAST(2000 + s_suppkey % 25 AS BIGINT) AS year_manufactured,
  'active' AS status, s_acctbal > 2000 AS has_navigation FROM supplier"""

_EQ_SCHEMA = T.StructType([
    T.StructField("equipment_id", T.LongType()), T.StructField("equipment_name", T.StringType()),
    T.StructField("mine_id", T.LongType()), T.StructField("year_manufactured", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("has_navigation", T.BooleanType())])

# Machines added by the insert statements.
NEW_EQUIPMENT = [
    (-100200, "Haul truck 7529", 2, 2025, "active", True),
    (-100201, "Loader 1400", 1, 2025, "active", False),
    (-100202, "Skip hoist 12", 2, 2024, "active", True),
]


# ---------------------------------------------------------------- D1 / D2
@query("dml_insert", _EQ_SQL + "\nUNION ALL\nSELECT * FROM (VALUES " + ", ".join(
    f"(CAST({i} AS BIGINT), '{n}', CAST({m} AS BIGINT), CAST({y} AS BIGINT), '{s}', {str(h).upper()})"
    for i, n, m, y, s, h in NEW_EQUIPMENT) + ") v(equipment_id, equipment_name, mine_id, year_manufactured, status, has_navigation)")
def dml_insert(spark, sf):
    """INSERT one and several literal rows; the whole new state is returned."""
    t = Tables(spark, sf)
    rows = spark.createDataFrame(NEW_EQUIPMENT, _EQ_SCHEMA)
    return insert(equipment_state(t), rows)


# ---------------------------------------------------------------- S3
# Fixed values: (code, mine key) pairs given inline.
INLINE_CODES = [("INV-LHD-001", 1), ("INV-LHD-002", 1), ("INV-TRK-001", 2), ("INV-TRK-002", 3),
                ("INV-CRT-001", 5), ("INV-CRT-002", 8), ("INV-SKP-001", 13), ("INV-SKP-002", 21),
                ("INV-LHD-010", 24), ("INV-TRK-010", 99)]


@query("inline_values", "SELECT v.code, CAST(v.mine_id AS BIGINT) AS mine_id, n.n_name AS mine_name FROM (VALUES "
       + ", ".join(f"('{c}', {m})" for c, m in INLINE_CODES)
       + ") v(code, mine_id) JOIN nation n ON n.n_nationkey = v.mine_id")
def inline_values(spark, sf):
    """VALUES rows as a source, joined to a dimension (key 99 has no match)."""
    t = Tables(spark, sf)
    v = spark.createDataFrame(INLINE_CODES, "code string, mine_id bigint")
    return (v.join(bounded(t.nation), v.mine_id == F.col("n_nationkey"))
            .select("code", "mine_id", F.col("n_name").alias("mine_name")))


# ---------------------------------------------------------------- D4 / R5
_GRADE_SQL = """SELECT DISTINCT CAST(split_part(o_orderpriority, '-', 1) AS BIGINT) AS grade_id,
  split_part(o_orderpriority, '-', 2) AS grade_name, upper(left(split_part(o_orderpriority, '-', 2), 3)) AS grade_code
FROM orders"""


def grade_state(t: Tables) -> DataFrame:
    word = F.split_part("o_orderpriority", F.lit("-"), F.lit(2))
    return t.orders.select(F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).cast("bigint").alias("grade_id"),
                           word.alias("grade_name"), F.upper(F.left(word, F.lit(3))).alias("grade_code")).distinct()


@query("insert_with_log", f"""
WITH new_grade AS (SELECT CAST(300 AS BIGINT) AS grade_id, 'Export' AS grade_name, 'EXPORT' AS grade_code)
SELECT 'dim_ore_grade' AS table_name, grade_id, grade_name, grade_code, CAST(NULL AS VARCHAR) AS details
FROM ({_GRADE_SQL} UNION ALL SELECT * FROM new_grade) g
UNION ALL
SELECT 'equipment_log', CAST(0 AS BIGINT), 'INSERT', NULL,
       'Added ore grade: ' || grade_name || ' (' || grade_code || ')' FROM new_grade""")
def insert_with_log(spark, sf):
    """INSERT ... RETURNING feeding a log insert: the job returns the new
    grade table and the log rows built from the returned rows."""
    t = Tables(spark, sf)
    new = spark.createDataFrame([(300, "Export", "EXPORT")], "grade_id bigint, grade_name string, grade_code string")
    state = insert(grade_state(t), new)
    log = new.select(F.lit("equipment_log").alias("table_name"), F.lit(0).cast("bigint").alias("grade_id"),
                     F.lit("INSERT").alias("grade_name"), F.lit(None).cast("string").alias("grade_code"),
                     F.concat(F.lit("Added ore grade: "), "grade_name", F.lit(" ("), "grade_code", F.lit(")"))
                     .alias("details"))
    return (state.select(F.lit("dim_ore_grade").alias("table_name"), "*", F.lit(None).cast("string").alias("details"))
            .unionByName(log))


# ---------------------------------------------------------------- D5
@query("update_returning", f"""
SELECT equipment_id, equipment_name, mine_id, year_manufactured,
  CASE WHEN year_manufactured <= 2008 AND mine_id < 10 THEN 'maintenance' ELSE status END AS status,
  has_navigation, COALESCE(year_manufactured <= 2008 AND mine_id < 10, false) AS updated
FROM ({_EQ_SQL}) e""")
def update_returning(spark, sf):
    """UPDATE ... SET status WHERE ... RETURNING: new state with the
    RETURNING rows flagged."""
    t = Tables(spark, sf)
    e = equipment_state(t)
    return update(e, (F.col("year_manufactured") <= 2008) & (F.col("mine_id") < 10),
                  {"status": F.lit("maintenance")}, flag="updated")


# ---------------------------------------------------------------- D6 / J8 / P6
@query("update_by_semi", f"""
SELECT equipment_id, equipment_name, mine_id, year_manufactured, status,
  CASE WHEN equipment_id IN (SELECT l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey
                             WHERE p_type LIKE '%PROMO%' AND l_shipdate >= TIMESTAMP '1997-03-01'
                               AND l_shipdate < TIMESTAMP '1997-04-01')
            AND has_navigation = false THEN true ELSE has_navigation END AS has_navigation
FROM ({_EQ_SQL}) e""")
def update_by_semi(spark, sf):
    """UPDATE ... WHERE id IN (join subquery) AND flag = false."""
    t = Tables(spark, sf)
    keys = (t.lineitem.filter((F.col("l_shipdate") >= ts("1997-03-01")) & (F.col("l_shipdate") < ts("1997-04-01")))
            .join(t.part.filter(F.col("p_type").like("%PROMO%")), F.col("l_partkey") == F.col("p_partkey"),
                  "left_semi")
            .select("l_suppkey"))
    return update_where_in(equipment_state(t), "equipment_id", keys, "l_suppkey",
                           {"has_navigation": F.lit(True)}, extra=~F.col("has_navigation"))


# ---------------------------------------------------------------- D7 / R5 / F18
ARCHIVED_AT = "2024-02-01 00:00:00"


@query("delete_archive", f"""
SELECT event_id, ts, user_id, event_type, value, 'fact' AS destination, CAST(NULL AS TIMESTAMP) AS archived_at
FROM events WHERE NOT COALESCE(ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16' AND event_type = 'error', false)
UNION ALL
SELECT event_id, ts, user_id, event_type, value, 'archive', TIMESTAMP '{ARCHIVED_AT}'
FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16' AND event_type = 'error'""")
def delete_archive(spark, sf):
    """DELETE ... RETURNING * into an archive stamped with ``archived_at``;
    the result is the fact table after the delete plus the archive rows."""
    t = Tables(spark, sf)
    ev = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    tagged = tag_delete(ev, (F.col("ts") >= ts("2024-01-15")) & (F.col("ts") < ts("2024-01-16"))
                        & (F.col("event_type") == "error"))
    return tagged.withColumn("archived_at", F.when(F.col("destination") == "archive", ts(ARCHIVED_AT)))


# ---------------------------------------------------------------- D8 / W3
_CUST_TARGET = "SELECT c_custkey, c_name, c_mktsegment, c_acctbal, c_nationkey FROM customer WHERE c_acctbal < 7000"
_CUST_SOURCE = """SELECT c_name, lower(c_mktsegment) AS c_mktsegment,
  CASE WHEN c_nationkey = 3 THEN NULL ELSE c_acctbal + 1 END AS c_acctbal, c_nationkey
FROM customer WHERE c_acctbal > 5000"""


def _cust_target(t):
    return t.customer.filter(F.col("c_acctbal") < 7000).select("c_custkey", "c_name", "c_mktsegment", "c_acctbal",
                                                                  "c_nationkey")


def _cust_source(t):
    return t.customer.filter(F.col("c_acctbal") > 5000).select(
        "c_name", F.lower("c_mktsegment").alias("c_mktsegment"),
        F.when(F.col("c_nationkey") == 3, F.lit(None)).otherwise(F.col("c_acctbal") + 1).alias("c_acctbal"),
        "c_nationkey")


@query("merge_sync", f"""
WITH target AS ({_CUST_TARGET}),
source AS (SELECT *, ROW_NUMBER() OVER (ORDER BY c_name) + (SELECT COALESCE(MAX(c_custkey), 0) FROM target) AS new_id
           FROM ({_CUST_SOURCE}) s)
SELECT CASE WHEN t.c_name IS NOT NULL THEN t.c_custkey ELSE s.new_id END AS c_custkey,
       COALESCE(t.c_name, s.c_name) AS c_name,
       CASE WHEN t.c_name IS NOT NULL AND s.c_name IS NOT NULL THEN s.c_mktsegment
            WHEN t.c_name IS NOT NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment,
       CASE WHEN t.c_name IS NOT NULL AND s.c_name IS NOT NULL THEN s.c_acctbal
            WHEN t.c_name IS NOT NULL THEN t.c_acctbal ELSE s.c_acctbal END AS c_acctbal,
       CASE WHEN t.c_name IS NOT NULL THEN t.c_nationkey ELSE s.c_nationkey END AS c_nationkey
FROM target t FULL JOIN source s ON t.c_name = s.c_name""")
def merge_sync(spark, sf):
    """MERGE: matched rows take the source's segment and balance (a NULL
    source balance overwrites); unmatched source rows are inserted with
    ``max(id) + ROW_NUMBER() OVER (ORDER BY code)`` — numbered over all
    source rows, so ids of matched rows leave gaps, as in the original."""
    t = Tables(spark, sf)
    target = _cust_target(t)
    src = _cust_source(t)
    base = scalar(F.coalesce(F.max("c_custkey"), F.lit(0)), target)
    source = row_index(src, ["c_name"], out="_rn").withColumn("new_id", F.col("_rn") + base).drop("_rn")
    return merge(target, source, ["c_name"], ["c_mktsegment", "c_acctbal"], insert_values={"c_custkey": "new_id"})


# ---------------------------------------------------------------- D9
_OP_TARGET = """SELECT c_custkey AS operator_id, c_name AS tab_number, c_mktsegment AS position,
  'grade ' || CAST(c_nationkey % 5 AS VARCHAR) AS qualification, CAST(c_nationkey AS BIGINT) AS mine_id
FROM customer WHERE c_acctbal < 7000"""

def _op_target(t):
    return t.customer.filter(F.col("c_acctbal") < 7000).select(
        F.col("c_custkey").alias("operator_id"), F.col("c_name").alias("tab_number"),
        F.col("c_mktsegment").alias("position"),
        F.concat(F.lit("grade "), (F.col("c_nationkey") % 5).cast("string")).alias("qualification"),
        F.col("c_nationkey").cast("bigint").alias("mine_id"))


def _op_rows(t):
    return t.customer.filter(F.col("c_acctbal") > 5000).select(
        (-F.col("c_custkey")).alias("operator_id"), F.col("c_name").alias("tab_number"),
        F.lower("c_mktsegment").alias("position"),
        F.concat(F.lit("grade "), (F.col("c_nationkey") % 7).cast("string")).alias("qualification"),
        F.lit(99).cast("bigint").alias("mine_id"))


@query("upsert_partial", f"""
WITH target AS ({_OP_TARGET}),
rows AS (SELECT -c_custkey AS operator_id, c_name AS tab_number, lower(c_mktsegment) AS position,
                'grade ' || CAST(c_nationkey % 7 AS VARCHAR) AS qualification, CAST(99 AS BIGINT) AS mine_id
         FROM customer WHERE c_acctbal > 5000)
SELECT t.operator_id, t.tab_number,
       CASE WHEN r.tab_number IS NOT NULL THEN r.position ELSE t.position END AS position,
       CASE WHEN r.tab_number IS NOT NULL THEN r.qualification ELSE t.qualification END AS qualification,
       t.mine_id
FROM target t LEFT JOIN rows r ON t.tab_number = r.tab_number
UNION ALL
SELECT r.* FROM rows r WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.tab_number = r.tab_number)""")
def upsert_partial(spark, sf):
    """INSERT ... ON CONFLICT (tab_number) DO UPDATE SET position,
    qualification: conflicting rows change only those two columns, the rest
    are inserted whole."""
    t = Tables(spark, sf)
    return upsert(_op_target(t), _op_rows(t), ["tab_number"], ["position", "qualification"], primary_key=["operator_id"])


# ---------------------------------------------------------------- S9 / S11
@query("create_like", "SELECT supplier.*, 'negative balance' AS reject_reason FROM supplier WHERE s_acctbal < 0")
def create_like(spark, sf):
    """A reject table made like its source, with a reason, and then filled."""
    t = Tables(spark, sf)
    table = empty_like(t.supplier, [("reject_reason", "string")])
    bad = t.supplier.filter(F.col("s_acctbal") < 0).withColumn("reject_reason", F.lit("negative balance"))
    return insert(table, bad)


@query("truncate_reload", "SELECT * FROM nation WHERE n_regionkey < 2")
def truncate_reload(spark, sf):
    """A stored table emptied and loaded anew: only the second load is in it."""
    t = Tables(spark, sf)
    path = scratch_dir(spark, "reloaded")
    t.nation.write.parquet(path)
    truncate(spark, path, t.nation)
    t.nation.filter(F.col("n_regionkey") < 2).write.mode("append").parquet(path)
    return spark.read.schema(t.nation.schema).parquet(path)
