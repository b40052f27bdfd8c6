"""The daily production load run incrementally with Structured Streaming.

Staged rows for several days (derived from the line items with the planted
faults of ``validation.daily_staging``) arrive in a folder under the shared
scratch location, several files a day; the stream (``streaming.daily_load``)
validates each micro-batch of files and writes its loaded and rejected rows as
partitions of their own.  The query returns what landed: every staged row with
its outcome.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.plans.registry import query
from lodestone.plans.validation import daily_staging
from lodestone.session import scratch_dir
from lodestone.sources.tables import Tables
from lodestone.streaming.daily_load import STAGING_SCHEMA, landed, start_daily_load

FILES_PER_BATCH = 3
STREAM_DAYS = ("1997-03-14", "1997-03-15", "1997-03-16")

_STAGED_SQL = """
  SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS date_id,
    CASE WHEN l_linenumber = 3 THEN -l_suppkey WHEN l_linenumber = 6 THEN NULL ELSE l_suppkey END AS equipment_id,
    CAST(l_linenumber AS BIGINT) AS shift_id,
    CASE WHEN l_linenumber = 5 THEN -1 ELSE o_custkey END AS operator_id,
    CASE WHEN l_linenumber = 2 THEN -l_quantity ELSE l_quantity END AS tons_mined,
    CAST(CASE WHEN l_linenumber = 4 THEN -1 ELSE l_linenumber END AS BIGINT) AS trips_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_shipdate IN (""" + ", ".join(f"TIMESTAMP '{d}'" for d in STREAM_DAYS) + ")"


@query("streaming_daily_load", f"""
WITH s AS ({_STAGED_SQL}),
j AS (SELECT s.*, e.s_suppkey AS e_id, o.c_custkey AS o_id FROM s
      LEFT JOIN supplier e ON s.equipment_id = e.s_suppkey LEFT JOIN customer o ON s.operator_id = o.c_custkey)
SELECT date_id, equipment_id, shift_id, operator_id, tons_mined, trips_count,
  CASE WHEN tons_mined < 0 OR trips_count < 0 OR e_id IS NULL OR o_id IS NULL THEN 'rejected' ELSE 'loaded' END AS status,
  CASE WHEN tons_mined < 0 OR trips_count < 0 OR e_id IS NULL OR o_id IS NULL THEN
    CASE WHEN tons_mined < 0 THEN 'negative tons' WHEN trips_count < 0 THEN 'negative trips'
         WHEN e_id IS NULL THEN 'unknown equipment (ID=' || CAST(equipment_id AS VARCHAR) || ')'
         WHEN o_id IS NULL THEN 'unknown operator (ID=' || CAST(operator_id AS VARCHAR) || ')'
         ELSE 'business rule violation' END END AS reject_reason
FROM j""")
def streaming_daily_load(spark, sf):
    t = Tables(spark, sf)
    staging = scratch_dir(spark, "staging_daily_production")
    cols = [f.name for f in STAGING_SCHEMA.fields]
    for day in STREAM_DAYS:            # several files a day
        daily_staging(t, day).select(*cols).repartition(2).write.mode("errorifexists").parquet(f"{staging}/{day}")
    fact, rejected = scratch_dir(spark, "fact_production"), scratch_dir(spark, "staging_rejected")
    q = start_daily_load(spark, f"{staging}/*", fact, rejected,
                         t.supplier.select(F.col("s_suppkey").alias("id")),
                         t.customer.select(F.col("c_custkey").alias("id")),
                         scratch_dir(spark, "daily_load_stream_ckpt"), max_files_per_trigger=FILES_PER_BATCH)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"daily load stream failed: {q.exception()}")
    loaded = (landed(spark, fact)
              .withColumn("status", F.lit("loaded")).withColumn("reject_reason", F.lit(None).cast("string")))
    out = [*cols, "status", "reject_reason"]
    return loaded.select(*out).unionByName(landed(spark, rejected, rejected=True).withColumn("status", F.lit("rejected")).select(*out))
