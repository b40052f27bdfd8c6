"""Validation jobs on the reference's planted-fault fixtures, hierarchy and
calendar equivalences, and the streaming daily load."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from lodestone.operators.hierarchy import calendar, hierarchy_paths
from lodestone.operators.quality import batch_gate, range_check


def test_lab_import_reference_rows(spark):
    """The ten staged lab rows of the reference: rows 1, 6, 7, 10 valid
    (given a mine dimension holding the short names), 2,3,4,5,8,9 errors."""
    from lodestone.plans.validation import process_lab_import
    staged = spark.createDataFrame([
        (1, "North", "2025-01-10", "62.5", "5.2"), (2, "Nowhere", "2025-01-11", "60.0", "4.0"),
        (3, "West", "32-01-2025", "58.0", "3.5"), (4, "South", "2025-01-12", "N/A", "4.1"),
        (5, "East", "2025-01-13", "150", "2.0"), (6, "North", "2025-01-14", "61.2", "NULL"),
        (7, "Central", "2025-01-15", "59.8", "4.8"), (8, "West", "2025-01-16", "-10", "5.0"),
        (9, "East", "2025-01-17", "63.0", "invalid"), (10, "South", "2025-01-18", "55.5", "3.3"),
    ], "row_id int, mine_name string, sample_date string, fe_content string, moisture string")
    mines = spark.createDataFrame([(n,) for n in ["North", "South", "West", "East", "Central"]], "n_name string")
    out = {r["row_id"]: (r["status"], r["error_msg"]) for r in process_lab_import(staged, mines).collect()}
    assert sorted(k for k, v in out.items() if v[0] == "VALID") == [1, 6, 7, 10]
    assert out[2][1] == 'mine "Nowhere" not found'
    assert out[3][1] == "bad date format: 32-01-2025"
    assert out[4][1] == "Fe value is not a number: N/A"
    assert out[5][1] == "Fe content (150) outside 0-100"
    assert out[8][1] == "Fe content (-10) outside 0-100"
    assert out[9][1] == "moisture is not a number: invalid"


def test_daily_load_reference_rows(spark):
    """Three staged rows: 1 loaded, 2 rejected (negative tons; unknown operator)."""
    from lodestone.plans.validation import tag_daily
    staged = spark.createDataFrame([(20250120, 1, 1, 10, 500.5, 12), (20250120, 1, 2, 10, -50.0, 5),
                                    (20250120, 1, 1, 999999, 300.0, 8)],
                                   "date_id long, equipment_id long, shift_id long, operator_id long, "
                                   "tons_mined double, trips_count long")
    eq = spark.createDataFrame([(1,)], "id long")
    op = spark.createDataFrame([(10,)], "id long")
    got = rows(tag_daily(staged, eq, op), "operator_id", "tons_mined", "status", "reject_reason")
    assert got == [(10, -50.0, "rejected", "negative tons"), (10, 500.5, "loaded", None),
                   (999999, 300.0, "rejected", "unknown operator (ID=999999)")]


def test_sensor_reading_reference_calls(spark):
    from lodestone.functions.kpi import SENSOR_RANGES
    calls = [("temperature", 25.5), ("pressure", 350.0), ("speed", 120.0), ("humidity", 50.0),
             ("temperature", -40.0), ("vibration", 100.0)]
    df = spark.createDataFrame([(i, t, v) for i, (t, v) in enumerate(calls)], "i int, t string, v double")
    ranges = spark.createDataFrame(list(SENSOR_RANGES), "rt string, lo int, hi int, unit string")
    out = [(r["status"], r["error_code"], r["hint"]) for r in
           range_check(df, "t", "v", ranges, "S0001", "S0002").orderBy("i").collect()]
    assert out == [("OK", None, None), ("OK", None, None), ("ERROR", "S0002", "allowed range: 0..50 km/h"),
                   ("ERROR", "S0001", None), ("OK", None, None), ("OK", None, None)]


def test_savepoint_partial_load_counts(spark):
    """production 1 row ok, quality 1 row ok, telemetry with a bad sensor is
    dropped: loaded counts 1, 1, 0."""
    b = spark.createDataFrame([("production", True), ("quality", True), ("telemetry", False)], "t string, ok boolean")
    got = {r["t"]: (r["accepted"], r["batch_rows"] if r["accepted"] else 0) for r in batch_gate(b, "t", "ok").collect()}
    assert got == {"production": (True, 1), "quality": (True, 1), "telemetry": (False, 0)}


def test_hierarchy_matches_recursive_cte(spark):
    nodes = spark.createDataFrame([
        ("1", None, "Mine A"), ("2", "1", "Shaft 1"), ("3", "2", "Level -200"), ("4", "1", "Shaft 2"),
        ("5", None, "Mine B"), ("6", "5", "Pit"), ("7", "3", "Drift 7")], "id string, parent string, name string")
    nodes.createOrReplaceTempView("loc_nodes")
    native = spark.sql("""
        WITH RECURSIVE t AS (
          SELECT id, name, 1 AS level, CAST(name AS STRING) AS path FROM loc_nodes WHERE parent IS NULL
          UNION ALL
          SELECT c.id, c.name, t.level + 1, concat(t.path, '->', c.name)
          FROM loc_nodes c JOIN t ON c.parent = t.id)
        SELECT id, level, path FROM t""")
    mine = hierarchy_paths(nodes, "id", "parent", "name", sep="->").select("id", "level", "path")
    assert rows(mine) == rows(native)


def test_calendar_matches_recursive_series(spark):
    cal = rows(calendar(spark, "2024-02-01", "2024-02-29"))
    d0 = dt.date(2024, 2, 1)
    assert cal == [(d0 + dt.timedelta(days=i),) for i in range(29)]


def test_streaming_daily_load_is_idempotent(spark, scratch):
    from lodestone.streaming.daily_load import STAGING_SCHEMA, start_daily_load
    staging = scratch + "/staging"
    day1 = [(20250120, 1, 1, 10, 500.5, 12), (20250120, 1, 2, 10, -50.0, 5), (20250120, 1, 1, 999999, 300.0, 8)]
    day2 = [(20250121, 1, 1, 10, 100.0, 3)]
    spark.createDataFrame(day1, STAGING_SCHEMA).write.parquet(staging + "/f1")
    eq = spark.createDataFrame([(1,)], "id long")
    op = spark.createDataFrame([(10,)], "id long")

    def run():
        q = start_daily_load(spark, staging + "/*", scratch + "/fact", scratch + "/rejected", eq, op,
                             scratch + "/ckpt")
        q.awaitTermination(120)

    run()
    spark.createDataFrame(day2, STAGING_SCHEMA).write.parquet(staging + "/f2")
    run()
    fact = rows(spark.read.parquet(scratch + "/fact"), "date_id", "tons_mined")
    rej = rows(spark.read.parquet(scratch + "/rejected"), "date_id", "reject_reason")
    assert fact == [(20250120, 500.5), (20250121, 100.0)]
    assert rej == [(20250120, "negative tons"), (20250120, "unknown operator (ID=999999)")]


def test_streaming_daily_load_takes_a_day_in_several_files(spark, scratch):
    from lodestone.streaming.daily_load import STAGING_SCHEMA, landed, start_daily_load
    for i in range(4):                                  # one micro-batch each, all of one day, none rejected
        spark.createDataFrame([(20250120, 1, 1, 10, 100.0 + i, 3)], STAGING_SCHEMA).coalesce(1).write.parquet(f"{scratch}/staging/f{i}")
    ids = spark.createDataFrame([(1,)], "id long"), spark.createDataFrame([(10,)], "id long")
    q = start_daily_load(spark, scratch + "/staging/*", scratch + "/fact", scratch + "/rejected", *ids,
                         scratch + "/ckpt", max_files_per_trigger=1)
    q.awaitTermination(120)
    assert rows(landed(spark, scratch + "/fact"), "date_id", "tons_mined") == [(20250120, 100.0 + i) for i in range(4)]
    assert landed(spark, scratch + "/rejected", rejected=True).count() == 0


def test_layout_follows_its_source(spark, scratch):
    from lodestone.sources.snapshots import clustered_layout
    for n in (10, 25):
        spark.range(n).write.mode("append" if n == 25 else "error").parquet(scratch + "/source")
        path = clustered_layout(spark.read.parquet(scratch + "/source"), "layout_test", "id", ["id"])
        assert spark.read.parquet(path).count() == spark.read.parquet(scratch + "/source").count()


def test_table_schema_follows_its_files(spark, scratch):
    from lodestone.sources.tables import Tables
    path = scratch + "/region.parquet"
    spark.range(3).write.parquet(path)
    assert Tables(spark, scratch).region.columns == ["id"]
    spark.range(3).selectExpr("id", "id * 2 AS twice").write.mode("overwrite").parquet(path)
    assert Tables(spark, scratch).region.columns == ["id", "twice"]


def test_deep_hierarchy_checkpoints_and_stays_exact(spark):
    """A 20-level chain, one checkpoint a level."""
    chain = [("n0", None, "L0")] + [(f"n{i}", f"n{i - 1}", f"L{i}") for i in range(1, 20)]
    nodes = spark.createDataFrame(chain, "id string, parent string, name string")
    got = {r["id"]: (r["level"], r["path"]) for r in hierarchy_paths(nodes, "id", "parent", "name", sep="/").collect()}
    assert got["n19"] == (20, "/".join(f"L{i}" for i in range(20)))
    assert len(got) == 20


def test_hierarchy_cycle_is_reported(spark):
    import pytest
    # "a" hangs under the root and under "b", and "b" under "a": reachable cycle
    cyc = spark.createDataFrame([("r", None, "root"), ("a", "r", "a"), ("b", "a", "b"), ("a", "b", "a")],
                                "id string, parent string, name string")
    with pytest.raises(RuntimeError):
        hierarchy_paths(cyc, "id", "parent", "name").collect()
