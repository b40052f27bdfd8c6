"""Jobs over stored facts: archive, keyed update, partial load, transfers, refreshed views, dated reports, layouts."""

import datetime as dt
import random
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from lodestone.operators.batches import archive_job, keyed_update, load_batches, transfer_batches
from lodestone.operators.hierarchy import hierarchy_paths
from lodestone.operators.membership import key_filter
from lodestone.operators.state import MergeCardinalityError, PrimaryKeyError, insert_new_only, merge, upsert
from lodestone.sources.snapshots import interleaved, interleaved_layout, layout_of
from lodestone.sources.tables import Tables
from lodestone.sources.views import AggregateView, publish_dates, published


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def unbroadcast(spark):
    """No side is small enough for a broadcast by size."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "lodestone.broadcast.maxBytes": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# ---------------------------------------------------------------- membership
def test_filter_never_misses_a_key(spark):
    keys = spark.range(5000).select((F.col("id") * 7).alias("a"), F.concat(F.lit("k"), "id").alias("b"))
    keys = keys.union(spark.createDataFrame([(None, "x")], "a long, b string"))
    probe = spark.range(35000).select(F.col("id").alias("a"), F.concat(F.lit("k"), (F.col("id") / 7).cast("long")).alias("b"))
    tagged = key_filter(keys, ["a", "b"]).tagged(probe.union(spark.createDataFrame([(None, "x")], "a long, b string")))
    got = tagged.groupBy((F.col("a") % 7 == 0).alias("there"), "_may").count().collect()
    n = {(r["there"], r["_may"]): r["count"] for r in got}
    assert n[(True, True)] == 5000 and (True, False) not in n
    assert n[(False, True)] < 30000 / 16 * 1.5      # one in sixteen passes
    assert n[(None, False)] == 1                    # a NULL never matches


def test_filter_is_not_built_beyond_the_cap(spark):
    assert key_filter(spark.range(10**6).toDF("a"), ["a"], max_bytes=1000) is None
    assert key_filter(spark.range(0).toDF("a"), ["a"]).tagged(spark.range(3).toDF("a")).filter("_may").count() == 0


@pytest.mark.parametrize("capped", [False, True])
def test_insert_new_only_with_and_without_filter(spark, capped):
    if capped:
        spark.conf.set("lodestone.broadcast.maxBytes", "1")
    try:
        state = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "c", 30)], "k long, s string, v int")
        staged = spark.createDataFrame([(1, "a", 99), (1, "b", 5), (2, "b", 6), (None, "c", 7), (3, None, 8)], "k long, s string, v int")
        new_state, new = insert_new_only(state, staged, ["k", "s"])
        assert {tuple(r) for r in new.collect()} == {(1, "b", 5), (None, "c", 7), (3, None, 8)}
        assert new_state.count() == 6
        again = insert_new_only(new_state.where("k IS NOT NULL AND s IS NOT NULL"), staged.where("k IS NOT NULL AND s IS NOT NULL"), ["k", "s"])[1]
        assert again.count() == 0
    finally:
        spark.conf.unset("lodestone.broadcast.maxBytes")


def test_only_possible_partners_are_shuffled(spark):
    """The staging side is tested against the broadcast bits before any exchange."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = Tables(spark, SF_SMALL)
        _, new = insert_new_only(t.lineitem.filter("l_linestatus = 'F'"), t.lineitem, ["l_orderkey", "l_linenumber"])
        lines = _plan(new).splitlines()
        anti = next(i for i, x in enumerate(lines) if "LeftAnti" in x)
        probe = lines[anti:next(i for i in range(anti + 1, len(lines)) if "FileScan" in lines[i])]
        assert any("Exchange hashpartitioning" in x for x in probe) and any("Filter" in x for x in probe)
        assert next(i for i, x in enumerate(probe) if "Exchange hashpartitioning" in x) < next(i for i, x in enumerate(probe) if "BroadcastHashJoin" in x)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# ---------------------------------------------------------------- archive, keyed update
def test_archive_keeps_every_row_once(spark):
    facts = spark.createDataFrame([(i, d, float(i)) for i, d in enumerate(["2024-01-01", "2024-03-01", None, "2023-01-01", "2023-01-01"])], "id int, day string, v double")
    job = archive_job(facts, F.col("day") < "2024-02-01", "t", {"v": F.col("v").cast("decimal(18,2)")})
    assert {r["id"] for r in job.archive.collect()} == {0, 3, 4} and {r["id"] for r in job.remaining.collect()} == {1, 2}
    assert job.counts == {"archived": 3, "remaining": 2, "archived_v": Decimal("7.00"), "remaining_v": Decimal("3.00")}
    assert job.archive.columns == facts.columns


def test_archive_of_nothing_and_of_an_empty_table(spark):
    facts = spark.createDataFrame([(1, "2024-01-01")], "id int, day string")
    job = archive_job(facts, F.col("day") < "2000", "t")
    assert job.archive.count() == 0 and job.remaining.count() == 1 and job.counts == {"archived": 0, "remaining": 1}
    job = archive_job(facts.limit(0), F.col("day") < "2000", "t")
    assert job.archive.count() == job.remaining.count() == 0


@pytest.mark.parametrize("capped", [False, True])
def test_keyed_update(spark, capped):
    if capped:
        spark.conf.set("lodestone.broadcast.maxBytes", "1")
    try:
        state = spark.createDataFrame([(1, 5.0, "x"), (2, 6.0, "x"), (2, 7.0, "y"), (None, 8.0, "z")], "k long, v double, w string")
        changes = spark.createDataFrame([(2, 9.0), (4, 1.0), (None, 3.0)], "k long, n double")
        new, touched = keyed_update(state, changes, "k", {"v": "n"}, {"at": F.lit("now")})
        assert rows(new) == rows(spark.createDataFrame([(1, 5.0, "x", None), (2, 9.0, "x", "now"), (2, 9.0, "y", "now"), (None, 8.0, "z", None)], "k long, v double, w string, at string"))
        assert sorted((r.k, r.v) for r in touched.collect()) == [(2, 6.0), (2, 7.0)]
        with pytest.raises(MergeCardinalityError):
            keyed_update(state, changes.union(changes), "k", {"v": "n"}, {})
    finally:
        spark.conf.unset("lodestone.broadcast.maxBytes")


def test_facts_without_a_change_are_not_shuffled(spark):
    from lodestone.plans.batch_jobs import update_production

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        apart = [part for part in _plan(update_production(Tables(spark, SF_SMALL))[0]).split("+- ") if "lineitem.parquet" in part]
        lines = _plan(update_production(Tables(spark, SF_SMALL))[0]).splitlines()
        scans = [i for i, x in enumerate(lines) if "FileScan" in x and "lineitem.parquet" in x]
        assert len(scans) == 2 and apart

        def above(i):
            """The operators above a line of the plan, from it upwards."""
            depth, out = len(lines[i]) - len(lines[i].lstrip(" :+-")), []
            for x in reversed(lines[:i]):
                d = len(x) - len(x.lstrip(" :+-"))
                if d < depth:
                    out.append(x)
                    depth = d
            return out

        ways = [above(i) for i in scans]
        assert sum(not any("Exchange hash" in x for x in way) for way in ways) == 1      # the untouched rows
        way = next(w for w in ways if any("Exchange hash" in x for x in w))
        first = next(i for i, x in enumerate(way) if "Exchange hash" in x)
        assert any("BroadcastHashJoin" in x for x in way[:first]) and any("Filter" in x for x in way[:first])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# ---------------------------------------------------------------- partial load
def test_batches_land_whole_or_not_at_all(spark):
    checked = spark.createDataFrame([("a", "d1", 1, True), ("a", "d1", 2, True), ("a", "d2", 3, True), ("a", "d2", 4, False), ("b", "d1", 5, None), ("b", None, 6, True)],
                                    "t string, d string, id int, ok boolean")
    verdicts, landed, counts = load_batches(checked, "t", "d", "ok", ["a", "b", "c"], "t")
    assert {(r.t, r.d, r.batch_rows, r.bad_rows, r.accepted) for r in verdicts.collect()} == {
        ("a", "d1", 2, 0, True), ("a", "d2", 2, 1, False), ("b", "d1", 1, 1, False), ("b", None, 1, 0, True)}
    assert {r.id for r in landed.collect()} == {1, 2, 6} and counts == {"a": 2, "b": 1, "c": 0}


# ---------------------------------------------------------------- transfers
def one_by_one(accounts, entries):
    held, verdicts = dict(accounts), []
    for b in sorted({e[0] for e in entries}):
        new, mine = dict(held), [e for e in entries if e[0] == b]
        for _, k, a in mine:
            if k in new:
                new[k] += a or 0
        known = [new[k] for _, k, _ in mine if k in new]
        ok = all(k in new for _, k, _ in mine) and min(known) >= 0
        verdicts.append((b, ok, min(known, default=None)))
        held = new if ok else held
    return sorted(held.items()), verdicts


@pytest.mark.parametrize("seed", range(4))
def test_transfers_against_one_by_one(spark, seed):
    rng = random.Random(seed)
    accounts = [(k, Decimal(rng.randint(0, 30))) for k in range(6)]
    entries = []
    for b in range(14):
        for _ in range(rng.randint(1, 3)):
            a, x, y = Decimal(rng.randint(1, 25)), rng.randrange(6), rng.randrange(6)
            entries += [(b, x, -a), (b, y, a)]
    if seed == 3:
        entries += [(5, 77, Decimal(1)), (14, 78, Decimal(1)), (8, 0, None)]
    final, verdicts = transfer_batches(spark.createDataFrame(accounts, "k long, held decimal(18,2)"),
                                       spark.createDataFrame(entries, "b int, k long, a decimal(18,2)"), "k", "held", "b", "a")
    held, want = one_by_one(accounts, entries)
    assert sorted((r.k, r.held) for r in final.collect()) == held
    assert sorted((r.b, r.accepted, r.lowest_after) for r in verdicts.collect()) == want


def _transferred(spark, accounts, entries):
    final, verdicts = transfer_batches(spark.createDataFrame(accounts, "k long, held decimal(18,2)"),
                                       spark.createDataFrame(entries, "b int, k long, a decimal(18,2)"), "k", "held", "b", "a")
    return sorted((r.k, r.held) for r in final.collect()), sorted(((r.b, r.accepted, r.lowest_after) for r in verdicts.collect()), key=lambda v: (v[0] is not None, v))


def test_refused_batches_do_not_cost_a_round_each(spark):
    accounts = [(0, Decimal(1)), (1, Decimal(500)), (2, Decimal(0))]
    entries = [x for b in range(40) for x in ((b, b % 2, Decimal(-30)), (b, 2, Decimal(30)))]       # even ones overdraw account 0, odd ones soon account 1
    spark.sparkContext.setJobGroup("refused", "many refused batches")
    try:
        got = _transferred(spark, accounts, entries)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("refused"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == one_by_one(accounts, entries)
    assert sum(not ok for _, ok, _ in got[1]) == 24 and jobs < 24


def test_one_refused_batch_before_a_chain_takes_two_rounds(spark, monkeypatch):
    from lodestone.operators import batches
    rounds, tried = [], batches._tried
    monkeypatch.setattr(batches, "_tried", lambda *a: rounds.append(1) or tried(*a))
    accounts = [(0, Decimal(10)), (1, Decimal(1)), *[(k, Decimal(0)) for k in range(2, 14)]]
    entries = [(1, 0, Decimal(-100)), (1, 1, Decimal(-1))]
    entries += [x for b in range(2, 14) for x in ((b, b - 1, Decimal(-1)), (b, b, Decimal(1)))]     # each needs what the one before has paid in
    assert _transferred(spark, accounts, entries) == one_by_one(accounts, entries)
    assert len(rounds) == 2


@pytest.mark.parametrize("seed", range(2))
def test_many_transfers_with_mixed_verdicts(spark, seed):
    rng = random.Random(seed)
    accounts = [(k, Decimal(rng.randint(0, 60))) for k in range(8)]
    entries = [(b, k, Decimal(rng.choice((-1, 1)) * rng.randint(1, 20))) for b in range(60) for k in rng.sample(range(8), 2)]
    got = _transferred(spark, accounts, entries)
    assert got == one_by_one(accounts, entries)
    assert {ok for _, ok, _ in got[1]} == {True, False}


def test_transfers_without_a_batch(spark):
    accounts = [(1, Decimal(10)), (2, Decimal(0))]
    entries = [(None, 1, Decimal(-4)), (None, 2, Decimal(4)), (1, 1, Decimal(-6)), (1, 2, Decimal(6))]
    assert _transferred(spark, accounts, entries) == ([(1, 0), (2, 10)], [(None, True, 4), (1, True, 0)])
    entries.append((2, 1, Decimal(-1)))
    assert _transferred(spark, accounts, entries) == ([(1, 4), (2, 6)], [(1, True, 0), (2, False, -1)])
    assert _transferred(spark, accounts, entries[:0]) == ([(1, 10), (2, 0)], [])


def test_transfers_of_an_account_that_comes_twice(spark):
    accounts = [(1, Decimal(10)), (1, Decimal(10)), (2, Decimal(0))]
    entries = [(b, k, a) for b in (1, 2, 3) for k, a in ((1, Decimal(-4)), (2, Decimal(4)))]
    assert _transferred(spark, accounts, entries) == ([(1, 2), (1, 2), (2, 4)], [(1, True, 2), (2, False, -6), (3, False, -6)])


# ---------------------------------------------------------------- merge in one pass
def _scans(plan, table):
    return sum("FileScan" in x and table in x for x in plan.splitlines())


def test_large_merge_is_one_full_outer_join(spark, scratch, unbroadcast):
    from lodestone.operators.state import merge_pass
    spark.range(100).selectExpr("id AS k", "id AS v").write.parquet(scratch + "/target")
    spark.range(50, 150).selectExpr("id AS k", "-id AS v", "id + 1000 AS fresh").write.parquet(scratch + "/source")
    target, source = spark.read.parquet(scratch + "/target"), spark.read.parquet(scratch + "/source")
    plan = _plan(merge_pass(target, source, ["k"], ["v"]))
    assert plan.count("FullOuter") == 1 and _scans(plan, "/target") == 1 and _scans(plan, "/source") == 1
    got = {r.k: r.v for r in merge(target, source, ["k"], ["v"]).collect()}
    assert got == {**{k: k for k in range(50)}, **{k: -k for k in range(50, 150)}}
    with pytest.raises(MergeCardinalityError):
        merge(target, source.union(source), ["k"], ["v"])


def test_large_merge_treats_nulls_as_the_small_one(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 3.0)], "id int, code string, v double").withColumn("code", F.when(F.col("code") != "n", F.col("code")))
    source = spark.createDataFrame([("a", None, 7), ("c", 5.0, 8), (None, 6.0, 9), (None, 6.5, 10)], "code string, v double, new_id int")
    small = merge(target, source, ["code"], ["v"], {"id": "new_id"}, check_unique=False)
    want = rows(small)
    spark.conf.set("lodestone.broadcast.maxBytes", "1")
    try:
        assert rows(merge(target, source, ["code"], ["v"], {"id": "new_id"})) == want
    finally:
        spark.conf.unset("lodestone.broadcast.maxBytes")


def test_large_upsert_checks_both_keys(spark, unbroadcast):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, code string, v string")
    new = spark.createDataFrame([(9, "a", "X"), (3, "c", "z")], "id int, code string, v string")
    assert rows(upsert(target, new, ["code"], ["v"], primary_key=["id"])) == [(1, "a", "X"), (2, "b", "y"), (3, "c", "z")]
    for bad in ([(2, "c", "z")], [(4, "c", "z"), (4, "d", "z")]):
        with pytest.raises(PrimaryKeyError):
            upsert(target, spark.createDataFrame(bad, target.schema), ["code"], ["v"], primary_key=["id"])
    with pytest.raises(MergeCardinalityError):
        upsert(target, new.union(new), ["code"], ["v"])


# ---------------------------------------------------------------- refreshed view
def _base(items):
    return [(i, g, m, None if v is None else Decimal(v)) for i, g, m, v in items]


def test_refreshed_view_equals_a_rebuild(spark, scratch):
    schema = "id int, g string, m string, v decimal(18,2)"
    rng = random.Random(1)
    items = _base([(i, rng.choice("abc") if i % 9 else None, rng.choice(["m1", "m2", "m3"]), rng.choice([None, *range(20)])) for i in range(200)])
    view = AggregateView(spark, scratch + "/view", ["g", "m"], ["v"], "m").build(spark.createDataFrame(items, schema))
    for step in range(4):
        gone = set(rng.sample([x[0] for x in items], 30)) if step != 3 else {x[0] for x in items if x[2] == "m2"}
        come = _base([(1000 * (step + 1) + i, rng.choice("abcd"), rng.choice(["m1", "m4"]), rng.choice([None, *range(-5, 30)])) for i in range(15)]) if step != 1 else []
        deleted = [x for x in items if x[0] in gone]
        items = [x for x in items if x[0] not in gone] + come
        frame = spark.createDataFrame(items, schema)
        view.refresh(frame, spark.createDataFrame(come, schema), spark.createDataFrame(deleted, schema))
        want = AggregateView(spark, f"{scratch}/full{step}", ["g", "m"], ["v"], "m").build(frame).read()
        assert rows(view.read(), *view._schema.names) == rows(want, *view._schema.names)


def test_refresh_computes_only_groups_that_lost_an_extreme(spark, scratch):
    schema = "g string, m string, v decimal(18,2)"
    data = [(g, m, Decimal(v)) for g in "ab" for m in ("m1", "m2") for v in (1, 2, 3)]
    view = AggregateView(spark, scratch + "/view", ["g", "m"], ["v"], "m").build(spark.createDataFrame(data, schema))
    import os
    files = {p: os.path.getmtime(p) for p in (os.path.join(d, f) for d, _, fs in os.walk(scratch + "/view/m=m2") for f in fs)}
    os.remove(next(p for p in files if p.endswith(".parquet")))      # nothing reads the other part either
    files = {p: t for p, t in files.items() if os.path.exists(p) and not p.endswith(".crc")}
    gone = [("a", "m1", Decimal(2)), ("b", "m1", Decimal(3))]      # the middle of one group, the largest of another
    after = [x for x in data if x not in gone]
    redo = view.refresh(spark.createDataFrame(after, schema), spark.createDataFrame([], schema), spark.createDataFrame(gone, schema))
    assert rows(redo) == [("b", "m1")]
    assert all(os.path.exists(p) and os.path.getmtime(p) == t for p, t in files.items())     # the other part isn't written
    assert {(r.g, r.m): (r.n_rows, int(r.v_min), int(r.v_max)) for r in view.read().collect()}[("b", "m1")] == (2, 1, 2)


# ---------------------------------------------------------------- dated report
def test_published_dates_are_replaced(spark, scratch):
    schema = "day date, who string, n int"
    day = [dt.date(2024, 1, i) for i in range(1, 6)]
    first = spark.createDataFrame([(day[0], "a", 1), (day[1], "a", 2), (day[2], "b", 3)], schema)
    publish_dates(first, scratch + "/r", "day", first)
    second = spark.createDataFrame([(day[1], "c", 9), (day[1], "d", 8), (day[3], "e", 7)], schema)
    publish_dates(second, scratch + "/r", "day", spark.createDataFrame([(d,) for d in day[1:4]], "day date"))     # day 3 has no rows any more
    assert rows(published(spark, scratch + "/r", first, "day")) == [(day[0], "a", 1), (day[1], "c", 9), (day[1], "d", 8), (day[3], "e", 7)]


# ---------------------------------------------------------------- lateral function
def test_keys_reach_the_function_before_it_aggregates(spark):
    from lodestone.plans.registry import QUERIES, load_all
    load_all()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["lateral_equipment_summary"](spark, SF_SMALL)
        lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
        assert any("Aggregate" in x for x in lines[:semi]) and not any("Aggregate" in x for x in lines[semi:])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# ---------------------------------------------------------------- hierarchy
def test_a_chain_of_a_thousand_takes_few_rounds(spark, monkeypatch):
    from lodestone import session
    rounds = []
    plain = session.checkpoint
    monkeypatch.setattr(session, "checkpoint", lambda df: rounds.append(1) or plain(df))
    chain = [("n0", None, "L0")] + [(f"n{i}", f"n{i - 1}", f"L{i}") for i in range(1, 1000)]
    got = {r["id"]: (r["level"], r["path"]) for r in hierarchy_paths(spark.createDataFrame(chain, "id string, parent string, name string"), "id", "parent", "name", sep="/").collect()}
    assert len(rounds) <= 12 and len(got) == 1000
    assert got["n999"] == (1000, "/".join(f"L{i}" for i in range(1000))) and got["n0"] == (1, "L0")


def test_hierarchy_odd_rows(spark):
    nodes = spark.createDataFrame([(1, None, "root"), (2, 1, None), (3, 2, "leaf"), (4, 99, "orphan"), (5, 4, "below")], "id int, parent int, name string")
    got = {r["id"]: (r["level"], r["path"], r["indented_name"]) for r in hierarchy_paths(nodes, "id", "parent", "name", sep=">").collect()}
    assert got == {1: (1, "root", "root"), 2: (2, None, None), 3: (3, None, "    leaf")}
    assert hierarchy_paths(nodes.limit(0), "id", "parent", "name").count() == 0
    with pytest.raises(RuntimeError):
        hierarchy_paths(spark.createDataFrame([(1, 2, "a"), (2, 1, "b"), (3, None, "r")], "id int, parent int, name string"), "id", "parent", "name")


# ---------------------------------------------------------------- layout
def test_interleaved_bits(spark):
    got = spark.createDataFrame([(0b101, 0b011), (0, 0), (7, 7)], "a int, b int").select(interleaved([F.col("a"), F.col("b")], 3).alias("z")).collect()
    assert [r.z for r in got] == [0b100111, 0, 63]


def _files_read(path, column, value):
    """Data files whose statistics don't rule out a value."""
    import glob
    n = 0
    for f in glob.glob(path + "/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            stats = next(c.statistics for c in (meta.row_group(g).column(i) for i in range(meta.num_columns)) if c.path_in_schema == column)
            if stats is None or stats.min <= value <= stats.max:
                n += 1
                break
    return n


def test_a_filter_on_either_column_skips_files(spark, scratch):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.randrange(1000), rng.randrange(1000)) for _ in range(20000)], "a int, b int").repartition(4)
    path = interleaved_layout(df, scratch + "/z", ["a", "b"], files=16)
    df.repartition(16).write.parquet(scratch + "/plain")
    assert spark.read.parquet(path).count() == 20000
    for column in ("a", "b"):
        assert _files_read(scratch + "/plain", column, 300) == 16
        assert _files_read(path, column, 300) <= 9      # 4, if files were cut just where the bits change


def test_layout_is_built_once_and_anew_when_the_data_change(spark, scratch):
    source, built = scratch + "/source", []

    def build(path):
        built.append(path)
        interleaved_layout(spark.read.parquet(source), path, ["id"], files=2)

    spark.range(100).write.parquet(source)
    first = layout_of(spark, source, "t", build)
    assert layout_of(spark, source, "t", build) == first and len(built) == 1
    spark.range(50).write.mode("append").parquet(source)
    assert layout_of(spark, source, "t", build) != first and spark.read.parquet(built[-1]).count() == 150


def test_facts_lie_by_date_and_machine(spark):
    from lodestone.plans.dashboards import fact_layout

    t = Tables(spark, SF_SMALL)
    path = fact_layout(t, files=12)
    assert fact_layout(t, files=12) == path and spark.read.parquet(path).count() == t.lineitem.count()
    assert _files_read(path, "l_suppkey", 7) <= 8
    assert _files_read(path, "l_shipdate", dt.datetime(1997, 3, 15)) <= 8


def test_null_and_empty_layouts(spark, scratch):
    df = spark.createDataFrame([(None, 1), (2, None), (None, None)], "a int, b int")
    assert spark.read.parquet(interleaved_layout(df, scratch + "/n", ["a", "b"], files=2)).count() == 3
    assert spark.read.schema(df.schema).parquet(interleaved_layout(df.limit(0), scratch + "/e", ["a", "b"], files=2)).count() == 0
