"""The order of rows: each sorted report against its oracle sorted by SQL.

Row order is compared by the sort columns, so ties may fall either way."""

import datetime as dt
import os

import duckdb
import pytest

from conftest import SF_SMALL
from lodestone.plans import registry

# What each report is sorted by; NULLs stand last where descending, and last where said so.
ORDERS = {
    "scan_project": "equipment_name", "filter_and": "p_size, p_name", "join_inner": "balance, full_name",
    "join_star": "tons DESC, l_orderkey, l_linenumber", "agg_by_type": "total_tons DESC", "agg_multi_key": "mine_name, shift_id",
    "topk_months": "total_tons DESC, year_month", "having_filter": "total_duration DESC",
    "ratio_kpi": "productivity DESC NULLS FIRST, full_name", "director_production": "total_tons DESC",
    "downtime_by_category": "total_hours DESC", "director_quality": "mine_name, grade_name",
    "string_lengths": "all_chars DESC, p_partkey", "split_code": "type_code, o_orderkey", "operator_short_name": "surname_upper",
    "equipment_age": "commissioning_date, o_orderkey", "peak_hour": "cnt DESC, peak_hour",
    "math_rounding": "fe_rounded DESC, o_orderkey", "topk_deviation": "distance DESC, o_orderkey", "shift_stats": "shift_id",
    "reasons_by_equipment": "total_min DESC, equipment_id", "date_key_format": "date_id", "conditional_counts": "day",
    "safe_kpi": "tons_per_trip DESC NULLS FIRST, full_name", "downtime_categories": "total_hours DESC",
    "semi_exists": "alarm_count DESC, equipment_name", "missing_days": "full_date", "topn_lateral": "mine_name, duration_min, event_id",
    "share_of_total": "tons DESC, equipment_name", "running_total": "mine_name, full_date", "moving_avg_7_14": "full_date",
    "dense_rank_top5": "equipment_type, place, operator_name", "shift_share_of_day": "full_date, shift_id",
    "top3_records": "equipment_name, place", "pareto_abc": "total_hours DESC, brand", "rollup_report": "mine_name NULLS LAST, shift_name",
    "cube_report": "grouping_level, mine_name NULLS FIRST, type_name NULLS FIRST", "grouping_sets_report": "dimension, dimension_value",
    "crosstab_top5": "equipment_name", "top1_per_shift": "shift_name", "cte_efficiency": "availability", "hierarchy_paths": "full_path",
    "calendar_day_types": "full_date", "moving_anomaly": "full_date", "quality_stats": "avg_fe_content DESC NULLS FIRST, mine_name",
    "monthly_trend": "month", "equipment_month_totals": "total_tons DESC, equipment_name",
    "fuel_threshold_scan": "fuel_consumed_l DESC, l_orderkey, l_linenumber", "topk_groups": "total_downtime_min DESC, equipment_name",
    "latest_alarms": "ts DESC, event_id DESC", "dash_operator_week": "date_id, l_orderkey", "oee_by_row": "full_date, l_orderkey, l_linenumber",
    "lateral_equipment_summary": "equipment_name, report_date", "production_filtered": "mine_name, shift_name",
    "dynamic_report_mine": "total_tons DESC, dimension_name", "quality_trend": "month_num",
}


def plain(x):
    if isinstance(x, dt.datetime):
        return x.isoformat()
    if isinstance(x, dt.date):
        return x.isoformat()
    return round(float(x), 6) if isinstance(x, (int, float)) or hasattr(x, "as_tuple") else x


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF_SMALL}/{f}')")
    return con


@pytest.mark.parametrize("key", ORDERS)
def test_rows_come_in_the_order_of_the_sorted_oracle(spark, duck, key):
    registry.load_all()
    order = ORDERS[key]
    columns = [part.split()[0] for part in order.split(", ")]
    parts = ", ".join(p if "NULLS" in p else f"{p} NULLS LAST" if " DESC" in p else f"{p} NULLS FIRST" for p in order.split(", "))
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({registry.ORACLE[key].rstrip().rstrip(';')}) r ORDER BY {parts}").fetchall()
    got = registry.QUERIES[key](spark, SF_SMALL).collect()
    assert [tuple(plain(r[c]) for c in columns) for r in got] == [tuple(map(plain, r)) for r in want]
