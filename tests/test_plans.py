"""Plan assertions for the physical-execution claims."""

from conftest import SF_SMALL

from lodestone.plans import registry

registry.load_all()
Q = registry.QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scan_lines(p, table):
    return [ln for ln in p.splitlines() if "FileScan parquet" in ln and f"/{table}.parquet" in ln]


def test_date_range_reaches_the_scan(spark):
    p = _plan(Q["equipment_month_totals"](spark, SF_SMALL))
    li = _scan_lines(p, "lineitem")
    assert li and "GreaterThanOrEqual(l_shipdate" in li[0] and "LessThan(l_shipdate" in li[0]


def test_columns_are_pruned(spark):
    p = _plan(Q["equipment_month_totals"](spark, SF_SMALL))
    li = _scan_lines(p, "lineitem")[0]
    schema = li.split("ReadSchema: ")[1]
    assert "l_comment" not in schema and "l_orderkey" not in schema and "l_returnflag" not in schema
    assert "l_quantity" in schema and "l_shipdate" in schema


def test_derived_key_filter_still_prunes(spark):
    # the report filters on a yyyyMMdd key; the equivalent raw range is pushed
    p = _plan(Q["date_key_format"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(l_shipdate" in _scan_lines(p, "lineitem")[0]


def test_top_k_is_take_ordered(spark):
    p = _plan(Q["topk_deviation"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_lateral_top_n_uses_group_limit(spark):
    assert "WindowGroupLimit" in _plan(Q["topn_lateral"](spark, SF_SMALL))


def test_latest_per_key_is_an_aggregate_not_a_window(spark):
    p = _plan(Q["latest_per_key"](spark, SF_SMALL))
    assert "max_by" in p and "Window" not in p


def test_no_query_plans_a_cartesian_product(spark):
    bad = []
    for k, fn in Q.items():
        if k in ("layout_pruned_read", "alarm_projection", "mat_monthly_quality"):
            continue      # these write datasets when built; covered elsewhere
        p = fn(spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
        if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p:
            bad.append(k)
    assert bad == []


def test_bucketed_fact_tables_join_without_exchange(spark):
    from pyspark.sql import functions as F
    from lodestone.sources.snapshots import bucketed_table
    from lodestone.sources.tables import Tables
    t = Tables(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        li = bucketed_table(t.lineitem, "li_by_order", "l_orderkey", 8)
        o = bucketed_table(t.orders, "orders_by_order", "o_orderkey", 8)
        j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderpriority").agg(F.count(F.lit(1)))
        plan = j._jdf.queryExecution().executedPlan().toString()
        join_part = plan.split("SortMergeJoin")[1]
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning(l_orderkey" not in plan \
            and "Exchange hashpartitioning(o_orderkey" not in plan, join_part[:500]
        assert j.agg(F.sum("count(1)")).first()[0] == t.lineitem.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# Queries allowed a window without PARTITION BY, and why its frame is
# bounded independently of the data volume.
UNPARTITIONED_WINDOW_OK = {
    "downtime_categories": "one row per downtime class (4)",
    "sorted_positions": "one row per range partition (offsets of row_index)",
    "downtime_classes": "one row per class (5)",
    "moving_avg_7_14": "one row per day of a quarter",
    "moving_anomaly": "one row per day of a quarter",
    "monthly_trend": "one row per month (12)",
    "daily_record_flag": "one row per day of the range (14)",
    "best_day": "one row per day of the range (14)",
    "threshold_crossing": "one row per day of a month (dense calendar)",
    "quality_trend": "12 months",
    "quality_trend_mine": "12 months",
    "kpi_upsert": "one row per mine",
    "pareto_abc": "one row per range partition (offsets)",
    "merge_sync": "one row per range partition (offsets)",
    "crosstab_top5": "the N top categories (after a top-N)",
}


def _unpartitioned_windows(node, out):
    if node.nodeName() == "Window" and node.partitionSpec().isEmpty():
        out.append(node)
    ch = node.children()
    for i in range(ch.size()):
        _unpartitioned_windows(ch.apply(i), out)


def test_single_partition_windows_only_on_bounded_frames(spark):
    skip = {"layout_pruned_read", "alarm_projection", "mat_monthly_quality"}
    offenders = []
    for k, fn in Q.items():
        if k in skip:
            continue
        found = []
        _unpartitioned_windows(fn(spark, SF_SMALL)._jdf.queryExecution().sparkPlan(), found)
        if found and k not in UNPARTITIONED_WINDOW_OK:
            offenders.append(k)
    assert offenders == []
