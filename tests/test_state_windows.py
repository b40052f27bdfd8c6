"""Table-state operators and window operators against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lodestone.operators.state import (MergeCardinalityError, PrimaryKeyError, delete_returning, insert_new_only, merge,
                                       replace_partition, row_index, update, upsert)
from lodestone.operators.windows import first_crossing, pareto_classes, prefix_sum


# ---------------------------------------------------------------- state
def test_merge_matches_dict_brute_force(spark):
    target = [(1, "A", "old-a", 1.0), (2, "B", "old-b", 2.0), (3, "C", "old-c", 3.0)]
    source = [("B", "new-b", None), ("C", "new-c", 30.0), ("D", "new-d", 40.0), ("E", "new-e", 50.0)]
    t = spark.createDataFrame(target, "id long, code string, name string, val double")
    s = spark.createDataFrame(source, "code string, name string, val double")
    # new id = max(id) + row_number() over (order by code), over all source rows
    s_ids = row_index(s, ["code"], out="rn").withColumn("new_id", F.col("rn") + 3).drop("rn")
    got = rows(merge(t, s_ids, ["code"], ["name", "val"], insert_values={"id": "new_id"}))
    state = {c: (i, n, v) for i, c, n, v in target}
    for k, (code, name, val) in enumerate(sorted(source), start=1):
        if code in state:
            state[code] = (state[code][0], name, val)          # NULL source value overwrites
        else:
            state[code] = (3 + k, name, val)
    exp = sorted((i, c, n, v) for c, (i, n, v) in state.items())
    assert got == exp
    assert (2, "B", "new-b", None) in got                     # matched NULL overwrote 2.0
    assert {r[0] for r in got} == {1, 2, 3, 6, 7}              # ids of matched rows leave gaps


def test_merge_rejects_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, "A")], "id long, code string")
    s = spark.createDataFrame([("A",), ("A",)], "code string")
    with pytest.raises(MergeCardinalityError):
        merge(t, s, ["code"], []).collect()


def test_upsert_updates_only_listed_columns_and_raises_on_pk_clash(spark):
    # Reference fixture: two existing tab numbers updated (position, qualification), one inserted.
    target = spark.createDataFrame([(100, "TAB-200", "Sidorov", "driver", "3"), (101, "TAB-201", "Petrova", "op", "2")],
                                   "operator_id int, tab_number string, last_name string, position string, qualification string")
    new = spark.createDataFrame([(100, "TAB-200", "X", "loader", "4"), (101, "TAB-201", "Y", "skip op", "3"),
                                 (102, "TAB-NEW", "Volkov", "truck", "5"), (100, "TAB-ODD", "Z", "p", "1")],
                                "operator_id int, tab_number string, last_name string, position string, qualification string")
    with pytest.raises(PrimaryKeyError):
        upsert(target, new, ["tab_number"], ["position", "qualification"], primary_key=["operator_id"])
    new = new.filter("tab_number <> 'TAB-ODD'")
    state = upsert(target, new, ["tab_number"], ["position", "qualification"], primary_key=["operator_id"])
    assert rows(state) == [(100, "TAB-200", "Sidorov", "loader", "4"), (101, "TAB-201", "Petrova", "skip op", "3"),
                           (102, "TAB-NEW", "Volkov", "truck", "5")]


def test_delete_keeps_null_predicate_rows_and_update_flags(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, alarm boolean")
    kept, gone = delete_returning(df, F.col("alarm"))
    assert rows(kept, "id") == [(2,), (3,)] and rows(gone, "id") == [(1,)]
    up = update(df, F.col("alarm"), {"id": F.col("id") * 10}, flag="hit")
    assert rows(up) == [(2, False, False), (3, None, False), (10, True, True)]


def test_insert_new_only_is_idempotent(spark):
    state = spark.createDataFrame([(1, 1), (1, 2)], "d int, s int")
    staging = spark.createDataFrame([(1, 2), (1, 3), (2, 1)], "d int, s int")
    s1, new1 = insert_new_only(state, staging, ["d", "s"])
    s2, new2 = insert_new_only(s1, staging, ["d", "s"])
    assert rows(new1) == [(1, 3), (2, 1)] and new2.count() == 0 and s2.count() == 4


def test_row_index_is_a_dense_global_order(spark):
    r = random.Random(1)
    vals = r.sample(range(100000), 5000)
    df = spark.createDataFrame([(v,) for v in vals], "v long").repartition(7)
    got = {v: i for v, i in row_index(df, ["v"], out="i").collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(vals))}


def test_replace_partition(spark):
    st = spark.createDataFrame([(1, 10), (2, 20), (2, 21)], "d int, x int")
    new = spark.createDataFrame([(2, 99)], "d int, x int")
    assert rows(replace_partition(st, new, F.col("d") == 2)) == [(1, 10), (2, 99)]


def test_publish_day_overwrites_only_that_day(spark, scratch):
    from lodestone.plans.validation import publish_day
    base = spark.createDataFrame([(19970314, 1.0), (19970315, 2.0)], "date_id long, v double")
    base.write.partitionBy("date_id").parquet(scratch + "/fact")
    publish_day(spark.createDataFrame([(19970315, 9.0)], "date_id long, v double"), scratch + "/fact", 19970315)
    publish_day(spark.createDataFrame([(19970315, 9.0)], "date_id long, v double"), scratch + "/fact", 19970315)  # rerun
    assert rows(spark.read.parquet(scratch + "/fact"), "date_id", "v") == [(19970314, 1.0), (19970315, 9.0)]


def test_balance_batches_reference_fixture(spark):
    from lodestone.plans.validation import apply_batch
    s0 = spark.createDataFrame([(1, 1000), (2, 500)], "equipment_id long, balance_tons int") \
        .select("equipment_id", F.col("balance_tons").cast("decimal(18,2)").alias("balance_tons"))
    ok = spark.createDataFrame([(1, -200), (2, 200)], "equipment_id long, delta int")
    s1, st1 = apply_batch(s0, ok)
    assert [(a, float(b)) for a, b in rows(s1)] == [(1, 800.0), (2, 700.0)] and st1.first()["accepted"]
    bad = spark.createDataFrame([(2, -1500), (1, 1500)], "equipment_id long, delta int")
    s2, st2 = apply_batch(s1, bad)
    assert [(a, float(b)) for a, b in rows(s2)] == [(1, 800.0), (2, 700.0)] and not st2.first()["accepted"]


# ---------------------------------------------------------------- windows
def test_prefix_sum_matches_sequential_cumsum(spark):
    r = random.Random(11)
    data = [(f"k{i:04d}", r.randint(0, 40)) for i in range(3000)]   # many ties in the value
    df = spark.createDataFrame(data, "k string, v long")
    got = dict(prefix_sum(df, "v", ascending=False, tie=["k"], value="v", out="c", partitions=7)
               .select("k", "c").collect())
    acc, exp = 0, {}
    for k, v in sorted(data, key=lambda x: (-x[1], x[0])):
        acc += v
        exp[k] = acc
    assert got == exp


def test_prefix_sum_splits_a_hot_tie_across_tasks(spark):
    """A third of the rows share one value: the running sum is still exact,
    and the ranged frame spreads that value over several partitions."""
    from pyspark.sql import functions as F
    data = [(f"k{i:05d}", 7 if i % 3 == 0 else (i % 50)) for i in range(6000)]
    df = spark.createDataFrame(data, "k string, v long")
    out = prefix_sum(df, "v", ascending=False, tie=["k"], value="v", out="c", partitions=8)
    got = dict(out.select("k", "c").collect())
    acc, exp = 0, {}
    for k, v in sorted(data, key=lambda x: (-x[1], x[0])):
        acc += v
        exp[k] = acc
    assert got == exp
    hot = (df.repartitionByRange(8, F.col("v").desc(), F.col("k").asc())
           .withColumn("p", F.spark_partition_id())          # tagged before the filter
           .filter("v = 7").groupBy("p").count())
    sizes = [r["count"] for r in hot.collect()]
    assert len(sizes) >= 3 and max(sizes) < 2000               # the 2000 tied rows are split


def test_pareto_classes(spark):
    df = spark.createDataFrame([("a", 50), ("b", 30), ("c", 15), ("d", 5)], "k string, v long")
    got = {r["k"]: (r["cumulative_pct"], r["pareto_category"]) for r in pareto_classes(df, "k", "v").collect()}
    assert got == {"a": (50.0, "A"), "b": (80.0, "A"), "c": (95.0, "B"), "d": (100.0, "C")}


def test_first_crossing(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 12.0), (4, 20.0)], "d int, c double")
    r = first_crossing(df, [], "d", "c", 10.0).first()
    assert (r["crossed_on"], r["final_total"]) == (3, 20.0)
    r = first_crossing(df, [], "d", "c", 100.0).first()
    assert (r["crossed_on"], r["final_total"]) == (None, 20.0)


def _trend_loop(months):
    """The reference's PL/pgSQL loop, literally (months: 12 lists of fe)."""
    from decimal import ROUND_HALF_UP, Decimal

    def r2(x):
        return None if x is None else float(Decimal(str(x)).quantize(Decimal("0.01"), ROUND_HALF_UP))

    total_sum, total_n, prev, out = Decimal(0), 0, None, []
    for vals in months:
        n = len(vals)
        avg = r2(sum(vals) / n) if n else None
        if n > 0:
            total_sum += Decimal(str(avg)) * n
            total_n += n
            running = r2(float(total_sum / total_n))
        else:
            running = prev
        if prev is None or avg is None:
            trend = "stable"
        elif avg > prev + 0.1:
            trend = "improving"
        elif avg < prev - 0.1:
            trend = "worsening"
        else:
            trend = "stable"
        if avg is not None:
            prev = avg
        out.append((n, avg, running, trend))
    return out


def test_quality_trend_matches_procedural_loop(spark):
    from lodestone.plans.procedures import quality_trend
    from lodestone.sources.tables import Tables
    t = Tables(spark, "/root/testdata/sf0.01")
    got = [(r["samples_count"], r["avg_fe"], r["running_avg_fe"], r["trend"])
           for r in quality_trend(t, 2001).collect()]
    o = t.orders.filter("o_orderdate >= '2001-01-01' AND o_orderdate < '2002-01-01'") \
        .select(F.month("o_orderdate").alias("m"), (F.col("o_totalprice") / 10000).alias("fe")).collect()
    months = [[r["fe"] for r in o if r["m"] == i] for i in range(1, 13)]
    exp = _trend_loop(months)
    assert [g[0] for g in got] == [e[0] for e in exp]
    assert [g[3] for g in got] == [e[3] for e in exp]
    for g, e in zip(got, exp):
        assert (g[1] is None and e[1] is None) or abs(g[1] - e[1]) < 1e-9
        assert (g[2] is None and e[2] is None) or abs(g[2] - e[2]) < 1e-9
    assert got[-1][0] == 0 and got[-1][2] is not None     # empty month carries the previous average
