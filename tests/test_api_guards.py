"""Behaviour of the parametric functions' guards and of the writers."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from lodestone.sources.tables import Tables


def test_count_fact_records_allow_list(spark):
    from lodestone.plans.routines import count_fact_records
    t = Tables(spark, SF_SMALL)
    assert count_fact_records(t, "fact_production", "1997-01-01", "1997-12-31").first()["cnt"] > 0
    for bad in ("dim_mine", "factXproduction", "fact_%"):
        with pytest.raises(PermissionError):
            count_fact_records(t, bad, "1997-01-01", "1997-12-31")


def test_dynamic_report_rejects_unknown_dimension(spark):
    from lodestone.plans.routines import build_production_report
    t = Tables(spark, SF_SMALL)
    with pytest.raises(ValueError):
        build_production_report(t, "colour", "1997-01-01", "1997-01-31")
    by_name = build_production_report(t, "equipment_type", "1997-01-01", "1997-12-31", "dimension_name ASC")
    names = [r[0] for r in by_name.collect()]
    assert names == sorted(names)


def test_daily_load_rejects_empty_day(spark):
    from lodestone.plans.validation import daily_staging, process_daily_production
    t = Tables(spark, SF_SMALL)
    with pytest.raises(ValueError):
        process_daily_production(t, daily_staging(t, "1997-03-15"), 20991231)


def test_shift_report_append_adds_only_new_dates(spark, scratch):
    from lodestone.plans.procedures import append_shift_report, shift_report
    rep = shift_report(spark, SF_SMALL)
    a = rep.filter(F.col("report_date") < F.lit("1998-01-08").cast("date"))
    b = rep.filter(F.col("report_date") >= F.lit("1998-01-08").cast("date"))
    append_shift_report(a, scratch + "/rep")
    append_shift_report(b, scratch + "/rep")
    back = spark.read.parquet(scratch + "/rep")
    assert back.count() == rep.count()


def test_empty_like_and_truncate(spark, scratch):
    from lodestone.sources.snapshots import empty_like, truncate
    staged = spark.createDataFrame([(1, 2.0)], "date_id long, tons double")
    rej = empty_like(staged, [("reject_reason", "string"), ("rejected_at", "timestamp")])
    assert rej.count() == 0 and rej.columns == ["date_id", "tons", "reject_reason", "rejected_at"]
    staged.write.parquet(scratch + "/t")
    truncate(spark, scratch + "/t", staged)
    back = spark.read.parquet(scratch + "/t")
    assert back.count() == 0 and back.columns == staged.columns


def test_upsert_cross_check_with_sql_merge_semantics(spark):
    """MERGE result equals the full-outer-join formulation written in SQL."""
    from lodestone.operators.state import merge
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id long, k string, v double")
    s = spark.createDataFrame([("b", None), ("c", 3.0)], "k string, v double").withColumn("nid", F.lit(9).cast("long"))
    got = rows(merge(t, s, ["k"], ["v"], insert_values={"id": "nid"}))
    t.createOrReplaceTempView("mt"); s.createOrReplaceTempView("ms")
    exp = rows(spark.sql("""SELECT CASE WHEN mt.k IS NOT NULL THEN mt.id ELSE ms.nid END AS id,
                                   COALESCE(mt.k, ms.k) AS k,
                                   CASE WHEN mt.k IS NOT NULL AND ms.k IS NOT NULL THEN ms.v
                                        WHEN mt.k IS NOT NULL THEN mt.v ELSE ms.v END AS v
                            FROM mt FULL JOIN ms ON mt.k = ms.k"""))
    assert got == exp == [(1, "a", 1.0), (2, "b", None), (9, "c", 3.0)]


def test_every_inventory_row_is_covered():
    from tools.coverage import main
    assert main() == 0


def test_scale_conf_sizes_partitions():
    from lodestone.session import scale_conf
    c = scale_conf(100 << 40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == (100 << 40) // (128 << 20)
    assert int(scale_conf(1 << 40, 100)["spark.sql.shuffle.partitions"]) == (1 << 40) // (128 << 20)
    assert int(scale_conf(1 << 20, 64)["spark.sql.shuffle.partitions"]) == 128
