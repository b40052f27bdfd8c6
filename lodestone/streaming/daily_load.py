"""Incremental daily production load with Structured Streaming.

The reference runs ``process_daily_production(date)`` by hand for each day.
Here staged files arriving in a folder are picked up by a file-source stream;
each micro-batch is validated with the same rules as the batch job
(``plans.validation.tag_daily``); loaded rows go to the fact dataset and
rejected rows to the reject dataset, partitioned by day and micro-batch
(``date_id``, ``load_batch``).  A micro-batch overwrites its own partitions
only, so replaying it after a failure rewrites the same rows, and a day may
arrive in any number of files and micro-batches.  The stream's checkpoint (in
the shared folder) records which files were consumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.plans.validation import tag_daily

STAGING_SCHEMA = T.StructType([
    T.StructField("date_id", T.LongType()),
    T.StructField("equipment_id", T.LongType()),
    T.StructField("shift_id", T.LongType()),
    T.StructField("operator_id", T.LongType()),
    T.StructField("tons_mined", T.DoubleType()),
    T.StructField("trips_count", T.LongType()),
])


LANDED_COLUMNS = [f.name for f in STAGING_SCHEMA.fields]


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("load_batch", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("date_id", "load_batch").parquet(path))


def landed(spark: SparkSession, path: str, rejected: bool = False) -> DataFrame:
    """What has landed at ``path``, which may hold no file yet: the staged columns (and the reason), ``load_batch``."""
    schema = T.StructType([*STAGING_SCHEMA.fields, *([T.StructField("reject_reason", T.StringType())] if rejected else []),
                           T.StructField("load_batch", T.LongType())])
    return spark.read.schema(schema).parquet(path)


def start_daily_load(spark: SparkSession, staging_dir: str, fact_path: str, rejected_path: str,
                     equipment_ids: DataFrame, operator_ids: DataFrame, checkpoint_location: str,
                     available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream; returns the ``StreamingQuery``.

    ``equipment_ids`` / ``operator_ids`` are one-column (``id``) DataFrames
    of the reference keys, joined as a stream-static left join (sized by
    AQE per micro-batch).
    """
    nothing = spark.createDataFrame([], STAGING_SCHEMA)
    for path in (fact_path, rejected_path):  # readable from the start, whatever lands
        _write_batch(nothing, path, -1)
    reader = spark.readStream.schema(STAGING_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    staged = reader.parquet(staging_dir)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        tagged = tag_daily(batch, equipment_ids, operator_ids).persist()
        try:
            _write_batch(tagged.filter(F.col("status") == "loaded").drop("status", "reject_reason"), fact_path, batch_id)
            _write_batch(tagged.filter(F.col("status") == "rejected").drop("status"), rejected_path, batch_id)
        finally:
            tagged.unpersist()

    writer = (staged.writeStream.foreachBatch(load_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
