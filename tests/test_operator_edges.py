"""Edge cases of the operators: size-checked broadcast, partition sizing,
NULL handling in validation rules, labelled grouping sets, calendar parts."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from lodestone.operators.aggregate import labelled_grouping
from lodestone.operators.hierarchy import calendar, calendar_parts
from lodestone.operators.joins import bounded, estimated_bytes, partitions_for
from lodestone.operators.quality import first_failure, json_payload, range_check, tag


def _hinted(df) -> bool:
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString() or \
        "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()


def test_bounded_hints_only_under_the_cap(spark):
    small = spark.range(10)
    assert estimated_bytes(small) is not None
    assert _hinted(bounded(small))
    assert not _hinted(bounded(small, max_bytes=1))          # over the cap: left to AQE


def test_partitions_for_is_sized_and_capped(spark):
    assert partitions_for(spark.range(10)) == 1
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
        n = partitions_for(spark.range(100000))
        assert 1 < n <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)


def test_rules_with_null_conditions_do_not_fire(spark):
    df = spark.createDataFrame([(1, None), (2, -5), (3, 7)], "id int, v int")
    rules = [(F.col("v") < 0, F.lit("negative")), (F.col("v") > 5, F.lit("too big"))]
    got = rows(tag(df, rules), "id", "status", "error_msg")
    assert got == [(1, "VALID", None), (2, "ERROR", "negative"), (3, "ERROR", "too big")]
    first = rows(df.select("id", first_failure(rules).alias("m")))
    assert first == [(1, None), (2, "negative"), (3, "too big")]


def test_null_reading_passes_the_range_check(spark):
    df = spark.createDataFrame([("temperature", None), ("temperature", 500.0)], "t string, v double")
    ranges = spark.createDataFrame([("temperature", -40, 200, "C")], "rt string, lo int, hi int, unit string")
    got = rows(range_check(df, "t", "v", ranges, "S0001", "S0002"), "v", "status", "error_code")
    assert got == [(500.0, "ERROR", "S0002"), (None, "OK", None)]     # rows() sorts NULLs last


def test_json_payload(spark):
    df = spark.createDataFrame([(7, "x")], "row_id int, s string")
    assert df.select(json_payload("row_id")).first()[0] == '{"row_id":7}'


def test_labelled_grouping_sets(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 4.0)], "m string, s string, v double")
    g = labelled_grouping(df, "sets", ["m", "s"], [F.sum("v").alias("t")], sets=[["m"], ["s"], []])
    got = rows(g, "m", "s", "t")
    assert got == [("TOTAL", "TOTAL", 7.0), ("TOTAL", "x", 5.0), ("TOTAL", "y", 2.0),
                   ("a", "TOTAL", 3.0), ("b", "TOTAL", 4.0)]


def test_calendar_parts(spark):
    r = calendar_parts(calendar(spark, "2024-03-01", "2024-03-03")).orderBy("full_date").collect()
    assert [(x["date_id"], x["day_of_week"], x["is_weekend"], x["quarter"]) for x in r] == \
        [(20240301, 5, False, 1), (20240302, 6, True, 1), (20240303, 0, True, 1)]
    assert r[0]["full_date"] == dt.date(2024, 3, 1)


def test_bounded_by_a_dimension_row_count(spark):
    """A per-key aggregate over a join has a loose estimate; bounded by the
    key dimension's row count it is hinted, and over the cap it is not."""
    facts = spark.range(200000).select((F.col("id") % 25).alias("k"), F.col("id").alias("v"))
    dim = spark.range(25).withColumnRenamed("id", "k")
    agg = facts.join(facts.select(F.col("k").alias("k2")).limit(1000), F.col("k") == F.col("k2")) \
        .groupBy("k").agg(F.sum("v").alias("s"))
    assert _hinted(bounded(agg, rows_of=dim))
    assert not _hinted(bounded(agg, max_bytes=10, rows_of=dim))
