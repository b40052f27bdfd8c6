"""Validation, error logging, KPI upsert and transactional loads (the error
handling, daily load and transaction lab blocks).

Staging rows with planted faults are derived from the test tables by fixed
rules on their keys, identically in the Spark plan and the oracle, so every
rule of the reference fires on real rows at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.dates import date_key, ts
from lodestone.functions.kpi import (SENSOR_OUT_OF_RANGE, SENSOR_RANGES, SENSOR_UNKNOWN_TYPE,
                                     safe_production_rate)
from lodestone.functions.numeric import rnd
from lodestone.operators.joins import bounded, scalar
from lodestone.operators.quality import json_payload, range_check, tag
from lodestone.operators.state import merge, row_index
from lodestone.plans.registry import ORACLE, query, rd
from lodestone.session import checkpoint, scratch_dir
from lodestone.sources.snapshots import materialize
from lodestone.sources.tables import Tables

DEC = "CAST({} AS DECIMAL(18,2))"


def _range(col, lo, hi):
    return (F.col(col) >= ts(lo)) & (F.col(col) < ts(hi))


# ---------------------------------------------------------------- X10 / T14
@query("safe_rate", f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CASE WHEN tons IS NULL OR hours IS NULL THEN NULL WHEN hours = 0 THEN 0.0
       ELSE {rd('tons / hours', 4)} END AS rate
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS tons,
             CASE WHEN l_linenumber = 6 THEN NULL ELSE l_tax * 100 END AS hours
      FROM lineitem) x""")
def safe_rate(spark, sf):
    """safe_production_rate per row: NULL in -> NULL, zero hours -> 0."""
    t = Tables(spark, sf)
    li = t.lineitem.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_quantity")).alias("tons"),
        F.when(F.col("l_linenumber") == 6, F.lit(None)).otherwise(F.col("l_tax") * 100).alias("hours"))
    r = safe_production_rate("tons", "hours")
    return li.select("l_orderkey", "l_linenumber", F.when(F.col("hours") == 0, r).otherwise(rnd(r, 4)).alias("rate"))


# ---------------------------------------------------------------- X11 / Q3 / F27
# Which event type stands for which sensor type ("humidity"
# has no range and is reported as an unknown type).
EVENT_SENSOR_TYPE = {"click": "temperature", "view": "pressure", "purchase": "vibration",
                     "signup": "speed", "error": "humidity"}


def _sensor_type_col():
    c = F.lit(None).cast("string")
    for k, v in reversed(list(EVENT_SENSOR_TYPE.items())):
        c = F.when(F.col("event_type") == k, v).otherwise(c)
    return c


_ST_SQL = "CASE " + " ".join(f"WHEN event_type = '{k}' THEN '{v}'" for k, v in EVENT_SENSOR_TYPE.items()) + " END"
_RANGES_SQL = ", ".join(f"('{n}', {lo}, {hi}, '{u}')" for n, lo, hi, u in SENSOR_RANGES)


@query("validate_readings", f"""
WITH r AS (SELECT * FROM (VALUES {_RANGES_SQL}) v(rt, lo, hi, unit)),
x AS (SELECT event_id, {_ST_SQL} AS sensor_type,
             CASE WHEN user_id = 7 AND event_type = 'click' THEN NULL ELSE value END AS value FROM events),
j AS (SELECT x.*, r.* FROM x LEFT JOIN r ON x.sensor_type = r.rt)
SELECT event_id, sensor_type, value,
  CASE WHEN rt IS NULL OR COALESCE(value < lo OR value > hi, false) THEN 'ERROR' ELSE 'OK' END AS status,
  CASE WHEN rt IS NULL THEN '{SENSOR_UNKNOWN_TYPE}' WHEN COALESCE(value < lo OR value > hi, false) THEN '{SENSOR_OUT_OF_RANGE}' END AS error_code,
  CASE WHEN rt IS NULL THEN 'unknown sensor type: ' || sensor_type
       WHEN COALESCE(value < lo OR value > hi, false)
       THEN 'value ' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || ' out of range for type ' || sensor_type END AS message,
  CASE WHEN rt IS NOT NULL AND COALESCE(value < lo OR value > hi, false)
       THEN 'allowed range: ' || CAST(lo AS VARCHAR) || '..' || CAST(hi AS VARCHAR) || ' ' || unit END AS hint
FROM j""")
def validate_readings(spark, sf):
    """validate_sensor_reading on every reading: range table broadcast-joined
    by type; status / code / message / hint columns instead of exceptions."""
    t = Tables(spark, sf)
    ev = t.events.select("event_id", _sensor_type_col().alias("sensor_type"),
                         F.when((F.col("user_id") == 7) & (F.col("event_type") == "click"), F.lit(None))
                         .otherwise(F.col("value")).alias("value"))
    ranges = spark.createDataFrame(list(SENSOR_RANGES), "rt string, lo int, hi int, unit string")
    return range_check(ev, "sensor_type", "value", ranges, SENSOR_UNKNOWN_TYPE, SENSOR_OUT_OF_RANGE)


# ---------------------------------------------------------------- Q4 / F16 / F28
@query("fk_load_split", f"""
WITH src AS (
  SELECT event_id AS row_index,
         CASE WHEN event_type = 'signup' AND value > 300 THEN -1 ELSE user_id END AS equipment_id,
         ts AS start_time,
         CASE WHEN event_type = 'error' AND value < 20 THEN NULL ELSE ts + INTERVAL 45 MINUTE END AS end_time
  FROM events),
j AS (SELECT src.*, c.c_custkey FROM src LEFT JOIN customer c ON src.equipment_id = c.c_custkey)
SELECT row_index, equipment_id, start_time, end_time,
  CASE WHEN end_time IS NULL OR c_custkey IS NULL THEN 'logged' ELSE 'loaded' END AS status,
  CASE WHEN end_time IS NULL THEN 'null value in column "end_time" violates not-null constraint'
       WHEN c_custkey IS NULL THEN 'foreign key violation: equipment_id=' || CAST(equipment_id AS VARCHAR) END AS error_msg,
  CASE WHEN end_time IS NULL OR c_custkey IS NULL THEN CAST(to_json({{'row_index': row_index}}) AS VARCHAR) END AS payload
FROM j""")
def fk_load_split(spark, sf):
    """Fault-tolerant load: rows failing NOT NULL or the foreign key go to
    the error log (with a JSON payload), the rest load."""
    t = Tables(spark, sf)
    src = t.events.select(
        F.col("event_id").alias("row_index"),
        F.when((F.col("event_type") == "signup") & (F.col("value") > 300), F.lit(-1).cast("bigint"))
        .otherwise(F.col("user_id")).alias("equipment_id"),
        F.col("ts").alias("start_time"),
        F.when((F.col("event_type") == "error") & (F.col("value") < 20), F.lit(None))
        .otherwise(F.col("ts") + F.expr("INTERVAL 45 MINUTES")).alias("end_time"))
    dim = t.customer.select(F.col("c_custkey").alias("_fk"))
    j = src.join(dim, F.col("equipment_id") == F.col("_fk"), "left")
    rules = [(F.col("end_time").isNull(), F.lit('null value in column "end_time" violates not-null constraint')),
             (F.col("_fk").isNull(), F.concat(F.lit("foreign key violation: equipment_id="),
                                              F.col("equipment_id").cast("string")))]
    tg = tag(j, rules, ok="loaded", bad="logged")
    return tg.select("row_index", "equipment_id", "start_time", "end_time", "status", "error_msg",
                     F.when(F.col("status") == "logged", json_payload("row_index")).alias("payload"))


# ---------------------------------------------------------------- X12 / Q2 / T25
def lab_staging(t: Tables) -> DataFrame:
    """Lab results as untrusted text, faults planted by the order key."""
    o = (t.orders
         .join(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"))
         .join(bounded(t.nation), F.col("c_nationkey") == F.col("n_nationkey")))
    k = F.col("o_orderkey") % 10
    fe_txt = F.round(F.col("o_totalprice") / 10000, 1).cast("decimal(10,1)").cast("string")
    mo_txt = F.round(F.col("c_acctbal") / 1000, 1).cast("decimal(10,1)").cast("string")
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        F.when(k == 1, F.lit("Unknown mine")).otherwise(F.col("n_name")).alias("mine_name"),
        F.when(k == 2, F.date_format("o_orderdate", "dd-MM-yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("sample_date"),
        F.when(k == 3, F.lit("N/A")).when(k == 4, F.lit("150")).when(k == 7, F.lit("-10"))
        .otherwise(fe_txt).alias("fe_content"),
        F.when(k == 5, F.lit("NULL")).when(k == 8, F.lit("invalid")).otherwise(mo_txt).alias("moisture"))


def process_lab_import(staging: DataFrame, mines: DataFrame) -> DataFrame:
    """Parse and validate lab rows; first failing rule is the message:
    unknown mine -> bad date -> Fe not numeric -> Fe outside 0..100 ->
    moisture not numeric (the text 'NULL' means no value)."""
    j = staging.join(mines.select(F.col("n_name").alias("_mine")), F.col("mine_name") == F.col("_mine"), "left")
    date_ok = F.col("sample_date").rlike(r"^\d{4}-\d{2}-\d{2}$") & F.col("sample_date").try_cast("date").isNotNull()
    fe = F.col("fe_content").try_cast("decimal(10,2)")
    mo = F.col("moisture").try_cast("decimal(10,2)")
    rules = [
        (F.col("_mine").isNull(), F.format_string('mine "%s" not found', F.col("mine_name"))),
        (~date_ok, F.concat(F.lit("bad date format: "), F.col("sample_date"))),
        (fe.isNull(), F.concat(F.lit("Fe value is not a number: "), F.col("fe_content"))),
        ((fe < 0) | (fe > 100), F.format_string("Fe content (%s) outside 0-100", F.col("fe_content"))),
        ((F.col("moisture") != "NULL") & mo.isNull(), F.concat(F.lit("moisture is not a number: "), F.col("moisture"))),
    ]
    tg = tag(j, rules)
    return tg.select("row_id", "mine_name", "sample_date", "fe_content", "moisture", "status", "error_msg",
                     F.when(F.col("status") == "ERROR", json_payload("row_id")).alias("log_payload"))


@query("lab_import", f"""
WITH s AS (
  SELECT o_orderkey AS row_id,
    CASE WHEN o_orderkey % 10 = 1 THEN 'Unknown mine' ELSE n_name END AS mine_name,
    CASE WHEN o_orderkey % 10 = 2 THEN strftime(o_orderdate, '%d-%m-%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS sample_date,
    CASE o_orderkey % 10 WHEN 3 THEN 'N/A' WHEN 4 THEN '150' WHEN 7 THEN '-10'
         ELSE CAST(CAST(ROUND(o_totalprice / 10000, 1) AS DECIMAL(10,1)) AS VARCHAR) END AS fe_content,
    CASE o_orderkey % 10 WHEN 5 THEN 'NULL' WHEN 8 THEN 'invalid'
         ELSE CAST(CAST(ROUND(c_acctbal / 1000, 1) AS DECIMAL(10,1)) AS VARCHAR) END AS moisture
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
j AS (SELECT s.*, n.n_name AS mine, TRY_CAST(fe_content AS DECIMAL(10,2)) AS fe,
             TRY_CAST(moisture AS DECIMAL(10,2)) AS mo,
             regexp_full_match(sample_date, '\\d{{4}}-\\d{{2}}-\\d{{2}}') AND TRY_CAST(sample_date AS DATE) IS NOT NULL AS date_ok
      FROM s LEFT JOIN nation n ON s.mine_name = n.n_name),
m AS (SELECT *, CASE
        WHEN mine IS NULL THEN 'mine "' || mine_name || '" not found'
        WHEN NOT date_ok THEN 'bad date format: ' || sample_date
        WHEN fe IS NULL THEN 'Fe value is not a number: ' || fe_content
        WHEN fe < 0 OR fe > 100 THEN 'Fe content (' || fe_content || ') outside 0-100'
        WHEN moisture <> 'NULL' AND mo IS NULL THEN 'moisture is not a number: ' || moisture END AS error_msg
      FROM j)
SELECT row_id, mine_name, sample_date, fe_content, moisture,
       CASE WHEN error_msg IS NULL THEN 'VALID' ELSE 'ERROR' END AS status, error_msg,
       CASE WHEN error_msg IS NOT NULL THEN CAST(to_json({{'row_id': row_id}}) AS VARCHAR) END AS log_payload
FROM m""")
def lab_import(spark, sf):
    t = Tables(spark, sf)
    return process_lab_import(lab_staging(t), t.nation)


def _totals(rows: DataFrame, good: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(F.col("status") == good).alias("rows_good"),
                    F.count_if(F.col("status") != good).alias("rows_logged"))


def _totals_sql(key: str, good: str) -> str:
    return (f"SELECT count(*) AS rows_read, count(*) FILTER (WHERE status = '{good}') AS rows_good, "
            f"count(*) FILTER (WHERE status <> '{good}') AS rows_logged FROM ({ORACLE[key]}) r")


@query("lab_import_totals", _totals_sql("lab_import", "VALID"))
def lab_import_totals(spark, sf):
    """How many lab rows were read, imported and logged as errors."""
    return _totals(lab_import(spark, sf), "VALID")


@query("fk_load_totals", _totals_sql("fk_load_split", "loaded"))
def fk_load_totals(spark, sf):
    """How many rows the fault-tolerant load read, loaded and logged."""
    return _totals(fk_load_split(spark, sf), "loaded")


# ---------------------------------------------------------------- X13 / D10
KPI_DAY = "1998-01-15"        # production and quality day
KPI_DOWNTIME_DAY = "2024-01-15"   # the downtime table's day standing for the same date
KPI_DAY_ID = 19980115
# Declared precision and scale of the KPI columns.
KPI_WIDTHS = {"oee_percent": (5, 2), "downtime_hours": (6, 2), "quality_score": (5, 2)}


def _next_day(day: str) -> str:
    import datetime as _dt
    return (_dt.date.fromisoformat(day) + _dt.timedelta(days=1)).isoformat()


def daily_kpi(t: Tables, day: str, downtime_day: str) -> DataFrame:
    """recalculate_daily_kpi for one date."""
    return daily_kpis(t, [(day, downtime_day)])


def daily_kpis(t: Tables, days: list[tuple[str, str]]) -> DataFrame:
    """recalculate_daily_kpi for some dates (production day, downtime day) in one
    grouped pass over each fact: every mine's KPIs of every date, left-joined to
    the mine dimension (mines without rows get 0 tons, NULL OEE / quality, 0
    downtime)."""
    def of_days(col: str, which: list[str]):
        """Rows of the days, as ranges that reach the scan, and the day's number in the list."""
        hit = [(F.col(col) >= ts(day)) & (F.col(col) < ts(_next_day(day))) for day in which]
        number = F.coalesce(*[F.when(h, F.lit(i)) for i, h in enumerate(hit)])
        keep = hit[0]
        for h in hit[1:]:
            keep = keep | h
        return keep, number.alias("_day")

    produced, down_on = zip(*days)
    keep, number = of_days("l_shipdate", produced)
    prod = (t.lineitem.filter(keep)
            .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy(number, F.col("s_nationkey").cast("bigint").alias("_m"))
            .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("_tons"),
                 (F.sum((F.col("l_tax") * 100).cast("decimal(18,2)"))
                  * F.when(F.col("_m") % 4 == 3, 3600).otherwise(1)).alias("_hours")))   # planted: hours given in seconds
    of_customer = t.customer.select("c_custkey", "c_nationkey")
    keep, number = of_days("ts", down_on)
    down = (t.events.filter(keep).join(of_customer, F.col("user_id") == F.col("c_custkey"))
            .groupBy(number, F.col("c_nationkey").cast("bigint").alias("_m"))
            .agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("_down")))
    keep, number = of_days("o_orderdate", produced)
    qual = (t.orders.filter(keep).join(of_customer, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(number, F.col("c_nationkey").cast("bigint").alias("_m")).agg(F.avg(F.col("o_totalprice") / 10000).alias("_q")))
    # One row per mine and date on every side: bounded by the mine dimension
    # and the dates asked for, joined by broadcast (subject to the size check).
    dates = F.array(*[F.struct(F.lit(i).alias("_day"), F.lit(int(day.replace("-", ""))).cast("bigint").alias("date_id"), ts(f"{day} 23:59:00").alias("calculated_at"))
                      for i, (day, _) in enumerate(days)])
    j = t.nation.select(F.col("n_nationkey").cast("bigint").alias("_m"), F.explode(dates).alias("_d")).select("_m", "_d.*")
    for side in (prod, down, qual):
        j = j.join(bounded(side, rows_of=t.nation), ["_m", "_day"], "left")
    return j.select(
        F.col("_m").alias("mine_id"), "date_id",
        F.coalesce(F.col("_tons").cast("double"), F.lit(0.0)).alias("tons_mined"),
        rnd(F.col("_hours").cast("double") / 24.0 * 100, 2).alias("oee_percent"),
        rnd(F.coalesce(F.col("_down").cast("double"), F.lit(0.0)) / 60.0, 2).alias("downtime_hours"),
        rnd("_q", 2).alias("quality_score"), "calculated_at").select(
        "mine_id", "date_id", "tons_mined", "oee_percent", "downtime_hours", "quality_score", *_kpi_outcome(), "calculated_at")


def _kpi_outcome() -> list:
    """Status and detail: a figure that its NUMERIC(precision, scale) column can't hold fails its mine."""
    detail = F.coalesce(*[F.when(F.abs(F.col(c)) >= 10.0 ** (precision - scale), F.lit(f"numeric field overflow: {c}"))
                          for c, (precision, scale) in KPI_WIDTHS.items()])
    return [F.when(detail.isNull(), "SUCCESS").otherwise("ERROR").alias("status"), detail.alias("error_detail")]


def _kpi_figures(day: str, dday: str) -> str:
    did = day.replace("-", "")
    return f"""
  SELECT CAST(n_nationkey AS BIGINT) AS mine_id, CAST({did} AS BIGINT) AS date_id,
    COALESCE(CAST(p.tons AS DOUBLE), 0.0) AS tons_mined,
    {rd('CAST(p.hours AS DOUBLE) / 24.0 * 100')} AS oee_percent,
    {rd('COALESCE(CAST(d.down AS DOUBLE), 0.0) / 60.0')} AS downtime_hours,
    {rd('q.q')} AS quality_score, TIMESTAMP '{day} 23:59:00' AS calculated_at
  FROM nation
  LEFT JOIN (SELECT s_nationkey AS m, SUM({DEC.format('l_quantity')}) AS tons, SUM({DEC.format('l_tax * 100')}) * if(s_nationkey % 4 = 3, 3600, 1) AS hours
             FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
             WHERE CAST(l_shipdate AS DATE) = DATE '{day}' GROUP BY 1) p ON p.m = n_nationkey
  LEFT JOIN (SELECT c_nationkey AS m, SUM({DEC.format('value')}) AS down
             FROM events JOIN customer ON user_id = c_custkey
             WHERE CAST(ts AS DATE) = DATE '{dday}' GROUP BY 1) d ON d.m = n_nationkey
  LEFT JOIN (SELECT c_nationkey AS m, AVG(o_totalprice / 10000) AS q
             FROM orders JOIN customer ON o_custkey = c_custkey
             WHERE CAST(o_orderdate AS DATE) = DATE '{day}' GROUP BY 1) q ON q.m = n_nationkey"""


def _kpi_sql(day: str, dday: str) -> str:
    limits = [(c, 10 ** (precision - scale)) for c, (precision, scale) in KPI_WIDTHS.items()]
    wide = "list_filter([" + ", ".join(f"if(abs({c}) >= {n}, '{c}', NULL)" for c, n in limits) + "], lambda c: c IS NOT NULL)"
    return f"""SELECT *, if(len({wide}) = 0, 'SUCCESS', 'ERROR') AS status, 'numeric field overflow: ' || {wide}[1] AS error_detail
FROM ({_kpi_figures(day, dday)}) f"""


@query("kpi_recalc", f"""
SELECT COUNT(*) AS mines_processed, COUNT(*) FILTER (WHERE status = 'SUCCESS') AS mines_ok,
       COUNT(*) FILTER (WHERE status = 'ERROR') AS mines_error
FROM ({_kpi_sql(KPI_DAY, KPI_DOWNTIME_DAY)}) k""")
def kpi_recalc(spark, sf):
    k = daily_kpi(Tables(spark, sf), KPI_DAY, KPI_DOWNTIME_DAY)
    return k.agg(F.count(F.lit(1)).alias("mines_processed"),
                 F.count_if(F.col("status") == "SUCCESS").alias("mines_ok"),
                 F.count_if(F.col("status") == "ERROR").alias("mines_error"))


_KPI_FIGURES = ["tons_mined", "oee_percent", "downtime_hours", "quality_score"]
_KPI_COLS = [*_KPI_FIGURES, "status", "error_detail", "calculated_at"]


@query("kpi_upsert", f"""
WITH stored AS (
  SELECT row_number() OVER (ORDER BY date_id, mine_id) AS kpi_id, * FROM (
    SELECT * FROM ({_kpi_sql('1998-01-14', '2024-01-14')}) yesterday
    UNION ALL BY NAME
    SELECT n_nationkey::BIGINT AS mine_id, {KPI_DAY_ID}::BIGINT AS date_id, 7.0::DOUBLE AS tons_mined, 'STALE' AS status FROM nation WHERE n_regionkey < 3) rows_before),
new AS (SELECT *, (SELECT max(kpi_id) FROM stored) + row_number() OVER (ORDER BY mine_id) AS new_id
        FROM ({_kpi_sql(KPI_DAY, KPI_DOWNTIME_DAY)}) today)
SELECT coalesce(s.kpi_id, n.new_id) AS kpi_id, mine_id, date_id,
       {", ".join(f"CASE n.status WHEN 'SUCCESS' THEN n.{c} ELSE s.{c} END AS {c}" for c in _KPI_FIGURES)},
       coalesce(n.status, s.status) AS status, if(n.status IS NULL, s.error_detail, n.error_detail) AS error_detail,
       coalesce(n.calculated_at, s.calculated_at) AS calculated_at
FROM stored s FULL JOIN new n USING (mine_id, date_id)""")
def kpi_upsert(spark, sf):
    """UPSERT of a day's KPI rows into the KPI table keyed (mine, date): the
    day's rows are overwritten, other mines' rows get new serial ids, other
    days stay.  A mine whose calculation failed keeps its old figures and gets
    the status ERROR with the reason."""
    t = Tables(spark, sf)
    # Both days come from one grouped pass over the facts, written once: a few rows a mine.
    figures = materialize(daily_kpis(t, [("1998-01-14", "2024-01-14"), (KPI_DAY, KPI_DOWNTIME_DAY)]), "daily_kpi")
    prev, fresh = (figures.filter((F.col("date_id") == KPI_DAY_ID) == today) for today in (False, True))
    stale = t.nation.filter(F.col("n_regionkey") < 3).select(
        F.col("n_nationkey").cast("bigint").alias("mine_id"), F.lit(KPI_DAY_ID).cast("bigint").alias("date_id"),
        F.lit(7.0).alias("tons_mined"), F.lit("STALE").alias("status"))
    # the stored table has one row a mine and date
    stored = row_index(prev.unionByName(stale, allowMissingColumns=True), ["date_id", "mine_id"], out="kpi_id", bounded_rows=True)
    stored = stored.select("kpi_id", "mine_id", "date_id", *_KPI_COLS)
    old = stored.select("mine_id", "date_id", *[F.col(c).alias(f"_old_{c}") for c in _KPI_FIGURES])
    failed = F.col("status") == "ERROR"
    kept = fresh.join(bounded(old, rows_of=t.nation), ["mine_id", "date_id"], "left").select(
        "mine_id", "date_id", *[F.when(failed, F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) for c in _KPI_FIGURES], "status", "error_detail", "calculated_at")
    base = scalar(F.coalesce(F.max("kpi_id"), F.lit(0)), stored)
    src = row_index(kept, ["mine_id"], out="_rn", bounded_rows=True).withColumn("new_id", F.col("_rn") + base).drop("_rn")   # one row a mine
    return merge(stored, bounded(src, rows_of=t.nation), ["mine_id", "date_id"], _KPI_COLS,
                 insert_values={"kpi_id": "new_id"}, check_unique=False)


# ---------------------------------------------------------------- X14 / Q1 / D12 / T18
LOAD_DAY = "1997-03-15"
LOAD_DAY_ID = 19970315


def daily_staging(t: Tables, day: str) -> DataFrame:
    """Staged production rows of one day with planted faults by line number:
    2 negative tons, 3 unknown machine, 4 negative trips, 5 unknown
    operator, 6 missing machine id."""
    li = (t.lineitem.filter(F.col("l_shipdate") == ts(day))
          .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")))
    ln = F.col("l_linenumber")
    return li.select(
        date_key("l_shipdate").cast("bigint").alias("date_id"), "l_orderkey",
        F.when(ln == 3, -F.col("l_suppkey")).when(ln == 6, F.lit(None).cast("bigint"))
        .otherwise(F.col("l_suppkey")).alias("equipment_id"),
        ln.cast("bigint").alias("shift_id"),
        F.when(ln == 5, F.lit(-1).cast("bigint")).otherwise(F.col("o_custkey")).alias("operator_id"),
        F.when(ln == 2, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("tons_mined"),
        F.when(ln == 4, F.lit(-1)).otherwise(ln).cast("bigint").alias("trips_count"))


def process_daily_production(t: Tables, staging: DataFrame, date_id: int) -> DataFrame:
    """Validate a day's staging rows: the first failing rule is the reject
    reason; a day without staged rows is an error."""
    day = materialize(staging.filter(F.col("date_id") == date_id), "staged_day")     # staged once: looked at here, then validated
    if day.isEmpty():
        raise ValueError(f"no staged rows for date {date_id}")
    return tag_daily(day, t.supplier.select(F.col("s_suppkey").alias("id")),
                     t.customer.select(F.col("c_custkey").alias("id")))


def tag_daily(rows: DataFrame, equipment_ids: DataFrame, operator_ids: DataFrame,
              keep: tuple[str, ...] = ("l_orderkey",)) -> DataFrame:
    """Daily-load rules on staged rows (any number of days): negative tons
    -> negative trips -> unknown machine -> unknown operator; adds
    ``status`` (loaded / rejected) and ``reject_reason``."""
    e = equipment_ids.select(F.col("id").alias("_e"))
    o = operator_ids.select(F.col("id").alias("_o"))
    j = rows.join(e, F.col("equipment_id") == F.col("_e"), "left").join(o, F.col("operator_id") == F.col("_o"), "left")
    reason = (F.when(F.col("tons_mined") < 0, "negative tons").when(F.col("trips_count") < 0, "negative trips")
              .when(F.col("_e").isNull(), F.concat(F.lit("unknown equipment (ID="), F.col("equipment_id").cast("string"), F.lit(")")))
              .when(F.col("_o").isNull(), F.concat(F.lit("unknown operator (ID="), F.col("operator_id").cast("string"), F.lit(")")))
              .otherwise("business rule violation"))
    bad = (F.col("tons_mined") < 0) | (F.col("trips_count") < 0) | F.col("_e").isNull() | F.col("_o").isNull()
    extra = [c for c in keep if c in rows.columns]
    return j.select("date_id", *extra, "equipment_id", "shift_id", "operator_id", "tons_mined", "trips_count",
                    F.when(bad, "rejected").otherwise("loaded").alias("status"),
                    F.when(bad, reason).alias("reject_reason"))


def publish_day(loaded: DataFrame, path: str, date_id: int) -> None:
    """Replace this day's partition of the fact dataset, also where nothing
    was loaded; other days are untouched, a rerun is idempotent."""
    loaded.drop("date_id").write.mode("overwrite").parquet(f"{path}/date_id={date_id}")


@query("validate_daily_load", f"""
WITH s AS (
  SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS date_id, l_orderkey,
    CASE WHEN l_linenumber = 3 THEN -l_suppkey WHEN l_linenumber = 6 THEN NULL ELSE l_suppkey END AS equipment_id,
    CAST(l_linenumber AS BIGINT) AS shift_id,
    CASE WHEN l_linenumber = 5 THEN -1 ELSE o_custkey END AS operator_id,
    CASE WHEN l_linenumber = 2 THEN -l_quantity ELSE l_quantity END AS tons_mined,
    CAST(CASE WHEN l_linenumber = 4 THEN -1 ELSE l_linenumber END AS BIGINT) AS trips_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate = TIMESTAMP '{LOAD_DAY}'),
j AS (SELECT s.*, e.s_suppkey AS e_id, o.c_custkey AS o_id FROM s
      LEFT JOIN supplier e ON s.equipment_id = e.s_suppkey LEFT JOIN customer o ON s.operator_id = o.c_custkey)
SELECT date_id, l_orderkey, equipment_id, shift_id, operator_id, tons_mined, trips_count,
  CASE WHEN tons_mined < 0 OR trips_count < 0 OR e_id IS NULL OR o_id IS NULL THEN 'rejected' ELSE 'loaded' END AS status,
  CASE WHEN tons_mined < 0 OR trips_count < 0 OR e_id IS NULL OR o_id IS NULL THEN
    CASE WHEN tons_mined < 0 THEN 'negative tons' WHEN trips_count < 0 THEN 'negative trips'
         WHEN e_id IS NULL THEN 'unknown equipment (ID=' || CAST(equipment_id AS VARCHAR) || ')'
         WHEN o_id IS NULL THEN 'unknown operator (ID=' || CAST(operator_id AS VARCHAR) || ')'
         ELSE 'business rule violation' END END AS reject_reason
FROM j""")
def validate_daily_load(spark, sf):
    t = Tables(spark, sf)
    return process_daily_production(t, daily_staging(t, LOAD_DAY), LOAD_DAY_ID)


STALE_DAY = "1997-03-14"
_LOADED_COLS = ["date_id", "l_orderkey", "equipment_id", "shift_id", "operator_id", "tons_mined", "trips_count"]


def load_day(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The daily load as a job: (facts after it, reject table, counts).

    The fact dataset holds the valid rows of the day before and an earlier,
    wrong version of the loaded day (one ton a row); the load replaces that
    day's partition and no other, the rejected rows go to their own table, and
    the counts are of the rows that have landed in both.
    """
    spark = t.spark
    keys = (t.supplier.select(F.col("s_suppkey").alias("id")), t.customer.select(F.col("c_custkey").alias("id")))
    facts, rejects = scratch_dir(spark, "fact_production"), scratch_dir(spark, "rejected_production")
    before = tag_daily(daily_staging(t, STALE_DAY), *keys).filter("status = 'loaded'").select(*_LOADED_COLS)
    wrong = daily_staging(t, LOAD_DAY).withColumn("tons_mined", F.lit(1.0)).select(*_LOADED_COLS)
    before.unionByName(wrong).write.partitionBy("date_id").parquet(facts)
    tagged = process_daily_production(t, daily_staging(t, LOAD_DAY), LOAD_DAY_ID).persist()
    publish_day(tagged.filter("status = 'loaded'").select(*_LOADED_COLS), facts, LOAD_DAY_ID)
    tagged.filter("status = 'rejected'").select(*_LOADED_COLS, "reject_reason").write.parquet(rejects)
    tagged.unpersist()
    schema = tagged.select(*_LOADED_COLS, "reject_reason").schema
    loaded = spark.read.schema(tagged.select(*_LOADED_COLS).schema).parquet(facts)
    rejected = spark.read.schema(schema).parquet(rejects)
    landed = (loaded.filter(F.col("date_id") == LOAD_DAY_ID).select("tons_mined", F.lit("loaded").alias("kind"))
              .unionByName(rejected.select("tons_mined", F.lit("rejected").alias("kind"))))
    counts = landed.agg(F.count_if(F.col("kind") == "loaded").alias("rows_loaded"), F.count_if(F.col("kind") == "rejected").alias("rows_rejected"),
                        F.count(F.lit(1)).alias("rows_staged"))
    return loaded, rejected, counts.select(F.lit(LOAD_DAY_ID).cast("bigint").alias("date_id"), "*")


def _staged_sql(day: str) -> str:
    fault = "equipment_id NOT IN (SELECT s_suppkey FROM supplier)"
    return f"""
  SELECT *, CASE WHEN tons_mined < 0 THEN 'negative tons' WHEN trips_count < 0 THEN 'negative trips'
                 WHEN equipment_id IS NULL OR {fault} THEN 'unknown equipment (ID=' || CAST(equipment_id AS VARCHAR) || ')'
                 WHEN operator_id NOT IN (SELECT c_custkey FROM customer) THEN 'unknown operator (ID=' || CAST(operator_id AS VARCHAR) || ')' END AS reason,
         tons_mined >= 0 AND trips_count >= 0 AND equipment_id IS NOT NULL AND NOT ({fault})
           AND operator_id IN (SELECT c_custkey FROM customer) AS good
  FROM (SELECT CAST({day.replace('-', '')} AS BIGINT) AS date_id, l_orderkey,
               CASE l_linenumber WHEN 3 THEN -l_suppkey WHEN 6 THEN NULL ELSE l_suppkey END AS equipment_id,
               CAST(l_linenumber AS BIGINT) AS shift_id, CASE WHEN l_linenumber = 5 THEN -1 ELSE o_custkey END AS operator_id,
               CASE WHEN l_linenumber = 2 THEN -l_quantity ELSE l_quantity END AS tons_mined,
               CAST(CASE WHEN l_linenumber = 4 THEN -1 ELSE l_linenumber END AS BIGINT) AS trips_count
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE CAST(l_shipdate AS DATE) = DATE '{day}') staged"""


_LOADED_SQL = ", ".join(_LOADED_COLS)


@query("daily_load_fact", f"""
SELECT {_LOADED_SQL} FROM ({_staged_sql(STALE_DAY)}) d WHERE good
UNION ALL
SELECT {_LOADED_SQL} FROM ({_staged_sql(LOAD_DAY)}) d WHERE good""")
def daily_load_fact(spark, sf):
    """The fact table after the load: the other day kept, the loaded day replaced."""
    return load_day(Tables(spark, sf))[0]


@query("daily_load_rejected", f"""
SELECT {_LOADED_SQL}, reason AS reject_reason FROM ({_staged_sql(LOAD_DAY)}) d WHERE NOT good""")
def daily_load_rejected(spark, sf):
    """The reject table of the load, each row with the first rule that it breaks."""
    return load_day(Tables(spark, sf))[1]


@query("daily_load_counts", f"""
SELECT CAST({LOAD_DAY_ID} AS BIGINT) AS date_id, COUNT(*) FILTER (WHERE good) AS rows_loaded,
       COUNT(*) FILTER (WHERE NOT good) AS rows_rejected, COUNT(*) AS rows_staged
FROM ({_staged_sql(LOAD_DAY)}) d""")
def daily_load_counts(spark, sf):
    """How many rows the load has put into the fact and reject tables."""
    return load_day(Tables(spark, sf))[2]


# ---------------------------------------------------------------- D13
def balances(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("equipment_id"),
                             (F.col("s_acctbal") + 1000).cast("decimal(18,2)").alias("balance_tons"))


def apply_batch(state: DataFrame, deltas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Apply a batch of (equipment_id, delta) atomically under the CHECK
    balance >= 0: deltas are summed per key, and the new balances are used
    only if none is negative (a scalar aggregate evaluated once),
    else the state is returned unchanged.  Returns (state, status row)."""
    d = deltas.groupBy(F.col("equipment_id").alias("_k")).agg(F.sum("delta").alias("_d"))
    cand = checkpoint(state.join(d, F.col("equipment_id") == F.col("_k"), "left")     # read by the verdict and the new state
                      .withColumn("_new", F.col("balance_tons") + F.coalesce(F.col("_d"), F.lit(0))))
    status = cand.agg((F.min("_new") >= 0).alias("accepted"), F.min("_new").cast("double").alias("min_balance_after"))
    accepted = scalar(F.min("_new") >= 0, cand)
    out = (cand
           .select("equipment_id", F.when(accepted, F.col("_new")).otherwise(F.col("balance_tons"))
                   .cast("decimal(18,2)").alias("balance_tons")))
    return out, status


def _transfer(spark, src_id, dst_id, amount: DataFrame) -> DataFrame:
    """Two delta rows for a transfer of ``amount`` (one-row DataFrame)."""
    a = amount.select(F.col("amount"))
    return (a.select(F.lit(src_id).cast("bigint").alias("equipment_id"), (-F.col("amount")).alias("delta"))
            .unionByName(a.select(F.lit(dst_id).cast("bigint").alias("equipment_id"), F.col("amount").alias("delta"))))


def balance_job(spark, t: Tables):
    s0 = balances(t)
    a = _transfer(spark, 1, 2, spark.range(1).select(F.lit(200).cast("decimal(18,2)").alias("amount")))
    s1, st1 = apply_batch(s0, a)
    # Second batch: move more than supplier 2 holds back to supplier 1.
    amt = s1.filter(F.col("equipment_id") == 2).select((F.col("balance_tons") + 500).alias("amount"))
    b = _transfer(spark, 2, 1, amt)
    s2, st2 = apply_batch(s1, b)
    status = (st1.withColumn("batch", F.lit("transfer 200 from 1 to 2"))
              .unionByName(st2.withColumn("batch", F.lit("transfer balance+500 from 2 to 1"))))
    return s2, status


_BAL_SQL = f"""
WITH s0 AS (SELECT s_suppkey AS equipment_id, CAST(s_acctbal + 1000 AS DECIMAL(18,2)) AS balance_tons FROM supplier),
c1 AS (SELECT equipment_id, balance_tons,
              balance_tons + CASE equipment_id WHEN 1 THEN -200 WHEN 2 THEN 200 ELSE 0 END AS nb FROM s0),
a1 AS (SELECT MIN(nb) >= 0 AS ok, MIN(nb) AS mn FROM c1),
s1 AS (SELECT equipment_id, CASE WHEN (SELECT ok FROM a1) THEN nb ELSE balance_tons END AS balance_tons FROM c1),
amt AS (SELECT balance_tons + 500 AS amount FROM s1 WHERE equipment_id = 2),
c2 AS (SELECT equipment_id, balance_tons,
              balance_tons + CASE equipment_id WHEN 2 THEN -(SELECT amount FROM amt)
                                               WHEN 1 THEN (SELECT amount FROM amt) ELSE 0 END AS nb FROM s1),
a2 AS (SELECT MIN(nb) >= 0 AS ok, MIN(nb) AS mn FROM c2),
s2 AS (SELECT equipment_id, CASE WHEN (SELECT ok FROM a2) THEN nb ELSE balance_tons END AS balance_tons FROM c2)"""


@query("balance_batch", _BAL_SQL + "\nSELECT equipment_id, CAST(balance_tons AS DOUBLE) AS balance_tons FROM s2")
def balance_batch(spark, sf):
    s = balance_job(spark, Tables(spark, sf))[0]
    return s.select("equipment_id", F.col("balance_tons").cast("double").alias("balance_tons"))


@query("balance_batch_status", _BAL_SQL + """
SELECT ok AS accepted, CAST(mn AS DOUBLE) AS min_balance_after, 'transfer 200 from 1 to 2' AS batch FROM a1
UNION ALL
SELECT ok, CAST(mn AS DOUBLE), 'transfer balance+500 from 2 to 1' FROM a2""")
def balance_batch_status(spark, sf):
    return balance_job(spark, Tables(spark, sf))[1]


# ---------------------------------------------------------------- C16
@query("load_audit", f"""
SELECT l_linenumber::BIGINT AS shift_id, count(*) AS total_records, sum({DEC.format('l_quantity')})::DOUBLE AS total_tons
FROM lineitem WHERE l_shipdate::DATE = DATE '{LOAD_DAY}' GROUP BY 1""")
def load_audit(spark, sf):
    """Rows and tons of the loaded day by shift."""
    day = Tables(spark, sf).lineitem.filter(F.col("l_shipdate") == ts(LOAD_DAY))
    return (day.groupBy(F.col("l_linenumber").cast("bigint").alias("shift_id"))
            .agg(F.count(F.lit(1)).alias("total_records"),
                 F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("total_tons")))
