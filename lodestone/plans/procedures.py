"""Procedural blocks re-expressed as set operations (ninth lab block).

Loops over days, machines or months that run a query per iteration become
one grouped query; running values (cumulative totals, "average so far",
"previous non-empty month") become window frames over the aggregated series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.dates import age_years, d, date_key, ts
from lodestone.functions.numeric import int_div, rnd, safe_div
from lodestone.operators.hierarchy import calendar
from lodestone.operators.joins import bounded, scalar
from lodestone.operators.windows import carry_forward, first_crossing, previous_avg, running_sum
from lodestone.plans.registry import query, rd
from lodestone.sources.tables import Tables
from lodestone.sources.views import publish_dates

DEC = "CAST({} AS DECIMAL(18,2))"
AS_OF = "2002-01-01"


def _range(col, lo, hi):
    return (F.col(col) >= ts(lo)) & (F.col(col) < ts(hi))


# ---------------------------------------------------------------- C10 / A3
@query("company_summary", f"""
SELECT (SELECT COUNT(*) FROM nation) AS mine_count,
  (SELECT COALESCE(CAST(SUM({DEC.format('l_quantity')}) AS DOUBLE), 0) FROM lineitem
   WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-02-01') AS total_production,
  (SELECT {rd('AVG(o_totalprice / 10000)', 1)} FROM orders
   WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-02-01') AS avg_fe,
  (SELECT COUNT(*) FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01') AS downtime_count""")
def company_summary(spark, sf):
    """Four scalar aggregates in one row (each a separate scan with its own
    pushed filter, evaluated once as an uncorrelated scalar subquery)."""
    t = Tables(spark, sf)
    prod = t.lineitem.filter(_range("l_shipdate", "1998-01-01", "1998-02-01"))
    qual = t.orders.filter(_range("o_orderdate", "1998-01-01", "1998-02-01"))
    down = t.events.filter(_range("ts", "2024-01-01", "2024-02-01"))
    return t.nation.agg(F.count(F.lit(1)).alias("mine_count")).select(
        "mine_count",
        scalar(F.coalesce(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double"), F.lit(0.0)), prod)
        .alias("total_production"),
        scalar(rnd(F.avg(F.col("o_totalprice") / 10000), 1), qual).alias("avg_fe"),
        scalar(F.count(F.lit(1)), down).alias("downtime_count"))


# ---------------------------------------------------------------- C11 / F12 / F30
@query("age_classes", f"""
WITH e AS (
  SELECT c_custkey, f.first_day FROM customer
  LEFT JOIN (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS first_day FROM orders
             WHERE o_orderpriority <> '1-URGENT' GROUP BY o_custkey) f ON f.o_custkey = c_custkey),
a AS (SELECT *, date_part('year', age(DATE '{AS_OF}', first_day)) AS age_years FROM e)
SELECT CASE WHEN age_years IS NULL THEN 'unknown'
            WHEN age_years < 2 THEN 'new'
            WHEN age_years BETWEEN 2 AND 5 THEN 'working'
            WHEN age_years > 5 AND age_years <= 10 THEN 'needs attention'
            ELSE 'replace' END AS category,
       COUNT(*) AS cnt
FROM a GROUP BY 1""")
def age_classes(spark, sf):
    """Machines counted per age class.  A missing commissioning date gets
    its own class (the reference draws a random date instead)."""
    t = Tables(spark, sf)
    first = (t.orders.filter(F.col("o_orderpriority") != "1-URGENT")
             .groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("first_day")))
    e = t.customer.select("c_custkey").join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
    y = age_years(d(AS_OF), F.col("first_day"))
    cat = (F.when(y.isNull(), "unknown").when(y < 2, "new").when(y.between(2, 5), "working")
           .when((y > 5) & (y <= 10), "needs attention").otherwise("replace"))
    return e.groupBy(cat.alias("category")).agg(F.count(F.lit(1)).alias("cnt"))


# ---------------------------------------------------------------- C12 / W10 / W5 / T16
_DAYS = ("1998-01-01", "1998-01-15")
_DAILY_SQL = f"""SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS date_id,
  CAST(SUM({DEC.format('l_quantity')}) AS DOUBLE) AS total_tons
FROM lineitem WHERE l_shipdate >= TIMESTAMP '{_DAYS[0]}' AND l_shipdate < TIMESTAMP '{_DAYS[1]}'
GROUP BY 1"""


def _daily(t):
    li = t.lineitem.filter(_range("l_shipdate", *_DAYS))
    return li.groupBy(date_key("l_shipdate").cast("bigint").alias("date_id")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("total_tons"))


@query("daily_record_flag", f"""
WITH d AS ({_DAILY_SQL})
SELECT ROW_NUMBER() OVER (ORDER BY date_id) AS day_no, date_id, total_tons,
  SUM(total_tons) OVER (ORDER BY date_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_tons,
  {rd('AVG(total_tons) OVER (ORDER BY date_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)')} AS avg_prev,
  COALESCE(total_tons > AVG(total_tons) OVER (ORDER BY date_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS is_record
FROM d""")
def daily_record_flag(spark, sf):
    """Day-by-day production with running total, the average of all earlier
    days and a record flag (the first day has no earlier days: not a record).
    The window runs over one row per day."""
    t = Tables(spark, sf)
    daily = _daily(t)
    o = [F.col("date_id")]
    x = previous_avg(running_sum(daily, [], o, "total_tons", "cumulative_tons"), None, o, "total_tons", "_prev")
    return x.select(F.row_number().over(Window.orderBy("date_id")).cast("bigint").alias("day_no"), "date_id",
                    "total_tons", "cumulative_tons", rnd("_prev").alias("avg_prev"),
                    F.coalesce(F.col("total_tons") > F.col("_prev"), F.lit(False)).alias("is_record"))


@query("best_day", f"""
WITH d AS ({_DAILY_SQL}),
n AS (SELECT ROW_NUMBER() OVER (ORDER BY date_id) AS day_no, * FROM d)
SELECT (SELECT SUM(total_tons) FROM n) AS grand_total,
       (SELECT {rd('AVG(total_tons)')} FROM n WHERE day_no < (SELECT MAX(day_no) FROM n)) AS last_avg_prev,
       (SELECT day_no FROM n ORDER BY total_tons DESC, day_no LIMIT 1) AS best_day,
       (SELECT MAX(total_tons) FROM n) AS best_tons""")
def best_day(spark, sf):
    """Argmax over the days (earliest wins ties) as ``max_by`` over a
    (value, -day) struct, plus the loop's closing totals."""
    t = Tables(spark, sf)
    daily = _daily(t).withColumn("day_no", F.row_number().over(Window.orderBy("date_id")).cast("bigint"))
    last = scalar(F.max("day_no"), daily)
    agg = daily.agg(
        F.sum("total_tons").alias("grand_total"),
        rnd(F.avg(F.when(F.col("day_no") < last, F.col("total_tons")))).alias("last_avg_prev"),
        F.max_by("day_no", F.struct(F.col("total_tons"), -F.col("day_no"))).alias("best_day"),
        F.max("total_tons").alias("best_tons"))
    return agg


# ---------------------------------------------------------------- C13 / W16 / T24
THRESHOLD_HOURS = 2000.0


@query("threshold_crossing", f"""
WITH cal AS (SELECT CAST(d AS DATE) AS full_date FROM range(DATE '2024-01-01', DATE '2024-02-01', INTERVAL 1 DAY) t(d)),
daily AS (SELECT CAST(ts AS DATE) AS full_date, SUM({DEC.format('value')}) AS m FROM events
          WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' GROUP BY 1),
c AS (SELECT cal.full_date, SUM(COALESCE(m, 0)) OVER (ORDER BY cal.full_date ROWS UNBOUNDED PRECEDING) / 60.0 AS cum_hours
      FROM cal LEFT JOIN daily USING (full_date))
SELECT CAST({THRESHOLD_HOURS} AS DOUBLE) AS threshold_hours,
       MIN(full_date) FILTER (WHERE cum_hours >= {THRESHOLD_HOURS}) IS NOT NULL AS threshold_reached,
       MIN(full_date) FILTER (WHERE cum_hours >= {THRESHOLD_HOURS}) AS crossed_on,
       {rd(f'MIN(cum_hours) FILTER (WHERE cum_hours >= {THRESHOLD_HOURS})', 1)} AS hours_at_crossing,
       {rd('MAX(cum_hours)', 1)} AS total_hours
FROM c""")
def threshold_crossing(spark, sf):
    """First day the cumulative downtime reaches a threshold.  Days without
    rows add 0 (dense calendar); the cumulative series has one row per day."""
    t = Tables(spark, sf)
    cal = calendar(spark, "2024-01-01", "2024-01-31")
    daily = (t.events.filter(_range("ts", "2024-01-01", "2024-02-01"))
             .groupBy(F.to_date("ts").alias("d")).agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("m")))
    dense = cal.join(daily, cal.full_date == F.col("d"), "left").select(
        "full_date", F.coalesce("m", F.lit(0)).alias("m"))
    cum = running_sum(dense, [], [F.col("full_date")], "m", "_cm").withColumn(
        "cum_hours", F.col("_cm").cast("double") / 60.0)
    cross = first_crossing(cum, [], "full_date", "cum_hours", THRESHOLD_HOURS)
    return cross.select(F.lit(THRESHOLD_HOURS).alias("threshold_hours"),
                        F.col("crossed_on").isNotNull().alias("threshold_reached"), "crossed_on",
                        rnd("value_at_crossing", 1).alias("hours_at_crossing"),
                        rnd("final_total", 1).alias("total_hours"))


# ---------------------------------------------------------------- C14 / A29 / F26 / T8
@query("sensor_activity", """
WITH types AS (SELECT DISTINCT event_type FROM events),
sensors AS (SELECT event_type, COUNT(DISTINCT user_id) AS sensor_count FROM events GROUP BY 1),
tele AS (SELECT event_type, COUNT(*) AS telemetry_count FROM events
         WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-16' GROUP BY 1),
j AS (SELECT types.event_type AS type_name, COALESCE(sensor_count, 0) AS sensor_count,
             COALESCE(telemetry_count, 0) AS telemetry_count
      FROM types LEFT JOIN sensors USING (event_type) LEFT JOIN tele USING (event_type))
SELECT type_name, sensor_count, telemetry_count,
       telemetry_count // NULLIF(sensor_count, 0) AS avg_readings,
       CASE WHEN telemetry_count = 0 THEN 'no data'
            WHEN telemetry_count // NULLIF(sensor_count, 0) > 1000 THEN 'very active'
            WHEN telemetry_count // NULLIF(sensor_count, 0) BETWEEN 100 AND 1000 THEN 'normal'
            ELSE 'sparse' END AS status
FROM j""")
def sensor_activity(spark, sf):
    """Per sensor type: sensors, readings in the period, readings per sensor
    (integer division) and a status — the FOREACH over an id array, with
    two queries per id, becomes one grouped pass over the readings (the
    types are those present; both counts are conditional aggregates)."""
    t = Tables(spark, sf)
    in_period = _range("ts", "2024-01-01", "2024-01-16")
    j = (t.events.groupBy(F.col("event_type").alias("type_name"))
         .agg(F.countDistinct("user_id").alias("sensor_count"), F.count_if(in_period).alias("telemetry_count")))
    avg = int_div(F.col("telemetry_count"), F.col("sensor_count"))
    return j.select("type_name", "sensor_count", "telemetry_count", avg.alias("avg_readings"),
                    F.when(F.col("telemetry_count") == 0, "no data").when(avg > 1000, "very active")
                    .when(avg.between(100, 1000), "normal").otherwise("sparse").alias("status"))


# ---------------------------------------------------------------- S10 / C15
@query("shift_report", f"""
SELECT CAST(l_shipdate AS DATE) AS report_date, 'shift ' || CAST(l_linenumber AS VARCHAR) AS shift_name,
       n_name AS mine_name, CAST(SUM({DEC.format('l_quantity')}) AS DOUBLE) AS total_tons,
       COUNT(DISTINCT l_suppkey) AS equipment_used,
       {rd(f"CAST(SUM({DEC.format('l_tax * 100')}) AS DOUBLE) / NULLIF(COUNT(DISTINCT l_suppkey) * 8, 0) * 100", 1)} AS efficiency
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate <= TIMESTAMP '1998-01-15'
GROUP BY 1, 2, 3""")
def shift_report(spark, sf):
    """Per date x shift x mine report for a date range: one grouped query
    over the range instead of one insert per date."""
    return shift_report_of(Tables(spark, sf), "1998-01-01", "1998-01-15")


def shift_report_of(t: Tables, start: str, end: str) -> DataFrame:
    li = t.lineitem.filter(F.col("l_shipdate").between(ts(start), ts(end)))
    j = (li.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
         .join(bounded(t.nation), F.col("s_nationkey") == F.col("n_nationkey")))
    g = j.groupBy(F.to_date("l_shipdate").alias("report_date"),
                  F.concat(F.lit("shift "), F.col("l_linenumber").cast("string")).alias("shift_name"),
                  F.col("n_name").alias("mine_name")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("total_tons"),
        F.countDistinct("l_suppkey").alias("equipment_used"),
        F.sum((F.col("l_tax") * 100).cast("decimal(18,2)")).cast("double").alias("_h"))
    return g.select("report_date", "shift_name", "mine_name", "total_tons", "equipment_used",
                    rnd(safe_div(F.col("_h"), F.nullif(F.col("equipment_used") * 8, F.lit(0))) * 100, 1)
                    .alias("efficiency"))


def append_shift_report(df: DataFrame, path: str, dates: DataFrame | None = None) -> None:
    """Append report rows; a date of the run (``dates``, those of the rows if
    not given) that was reported before is replaced."""
    publish_dates(df, path, "report_date", df if dates is None else dates)


# ---------------------------------------------------------------- X9 / A31 / W17 / R6 / F31 / T17
def quality_trend(t: Tables, year: int, mine_id: int | None = None):
    """get_quality_trend: 12 rows (all months, empty ones included).

    * running average = sum(rounded monthly avg * count) / sum(count) over
      the non-empty months so far; an empty month shows the previous
      non-empty month's average instead;
    * trend compares with the previous non-empty month, dead band 0.1.
    """
    spark = t.spark
    o = t.orders.filter(_range("o_orderdate", f"{year}-01-01", f"{year + 1}-01-01"))
    if mine_id is not None:
        o = o.join(t.customer.filter(F.col("c_nationkey") == mine_id).select("c_custkey"),
                   F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    fe = F.col("o_totalprice") / 10000
    m = o.groupBy(F.month("o_orderdate").alias("_m")).agg(
        F.count(fe).alias("samples_count"), rnd(F.avg(fe)).alias("avg_fe"),
        rnd(F.min(fe)).alias("min_fe"), rnd(F.max(fe)).alias("max_fe"))
    months = spark.range(1, 13).select(F.col("id").cast("int").alias("month_num"))
    j = (months.join(bounded(m), F.col("month_num") == F.col("_m"), "left")
         .select("month_num", F.coalesce("samples_count", F.lit(0)).alias("samples_count"),
                 "avg_fe", "min_fe", "max_fe"))
    o_ = [F.col("month_num")]
    w = Window.orderBy("month_num").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = (j.withColumn("_ws", F.sum(F.col("avg_fe").cast("decimal(18,2)") * F.col("samples_count")).over(w))
         .withColumn("_wn", F.sum(F.when(F.col("samples_count") > 0, F.col("samples_count"))).over(w)))
    j = carry_forward(j, None, o_, "avg_fe", "_prev")
    running = F.when(F.col("samples_count") > 0, rnd(F.col("_ws") / F.col("_wn"))).otherwise(F.col("_prev"))
    trend = (F.when(F.col("_prev").isNull() | F.col("avg_fe").isNull(), "stable")
             .when(F.col("avg_fe") > F.col("_prev") + 0.1, "improving")
             .when(F.col("avg_fe") < F.col("_prev") - 0.1, "worsening").otherwise("stable"))
    from lodestone.functions.dates import month_name
    return (j.select(F.col("month_num").cast("bigint").alias("month_num"), month_name("month_num").alias("month_name"),
                     "samples_count", "avg_fe", "min_fe", "max_fe", running.alias("running_avg_fe"),
                     trend.alias("trend"))
            .orderBy("month_num"))


def _trend_sql(year: int, mine: str) -> str:
    return f"""
WITH months AS (SELECT CAST(range AS BIGINT) AS month_num FROM range(1, 13)),
agg AS (
  SELECT month(o_orderdate) AS m, COUNT(o_totalprice / 10000) AS samples_count,
         {rd('AVG(o_totalprice / 10000)')} AS avg_fe, {rd('MIN(o_totalprice / 10000)')} AS min_fe,
         {rd('MAX(o_totalprice / 10000)')} AS max_fe
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE year(o_orderdate) = {year} AND ({mine} IS NULL OR c_nationkey = {mine})
  GROUP BY 1),
j AS (SELECT month_num, COALESCE(samples_count, 0) AS samples_count, avg_fe, min_fe, max_fe
      FROM months LEFT JOIN agg ON month_num = m),
w AS (SELECT *,
        SUM(CAST(avg_fe AS DECIMAL(18,2)) * samples_count) OVER (ORDER BY month_num ROWS UNBOUNDED PRECEDING) AS ws,
        SUM(CASE WHEN samples_count > 0 THEN samples_count END) OVER (ORDER BY month_num ROWS UNBOUNDED PRECEDING) AS wn,
        LAST_VALUE(avg_fe IGNORE NULLS) OVER (ORDER BY month_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
      FROM j)
SELECT month_num, monthname(make_date(2000, CAST(month_num AS INTEGER), 1)) AS month_name, samples_count, avg_fe, min_fe, max_fe,
  CASE WHEN samples_count > 0 THEN {rd('ws / wn')} ELSE prev END AS running_avg_fe,
  CASE WHEN prev IS NULL OR avg_fe IS NULL THEN 'stable' WHEN avg_fe > prev + 0.1 THEN 'improving'
       WHEN avg_fe < prev - 0.1 THEN 'worsening' ELSE 'stable' END AS trend
FROM w"""


@query("quality_trend", _trend_sql(2001, "NULL"))
def quality_trend_all(spark, sf):
    return quality_trend(Tables(spark, sf), 2001)


@query("quality_trend_mine", _trend_sql(2000, "1"))
def quality_trend_mine(spark, sf):
    return quality_trend(Tables(spark, sf), 2000, mine_id=1)
