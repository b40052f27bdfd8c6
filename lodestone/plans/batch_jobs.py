"""Jobs that change stored facts: archive, load from staging, keyed update,
partial load, atomic transfers, refreshed views and appended reports.

Each job runs over its whole tables and returns rows that it has written;
counts come from those rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.dates import ts
from lodestone.operators.batches import archive_job, keyed_update, load_batches, transfer_batches
from lodestone.operators.hierarchy import calendar
from lodestone.operators.joins import bounded, scalar
from lodestone.operators.state import insert_new_only
from lodestone.plans.procedures import append_shift_report, shift_report_of
from lodestone.plans.registry import ORACLE, query
from lodestone.session import scratch_dir
from lodestone.sources.snapshots import materialize
from lodestone.sources.tables import Tables
from lodestone.sources.views import AggregateView, published

TONS = "decimal(18,2)"

# ---------------------------------------------------------------- D11
ARCHIVE_BEFORE = "1996-01-01"
TELEMETRY_BEFORE = "2024-01-15"
_OLD = f"coalesce(l_shipdate < TIMESTAMP '{ARCHIVE_BEFORE}', false)"


def archive_facts(t: Tables):
    return archive_job(t.lineitem, F.col("l_shipdate") < ts(ARCHIVE_BEFORE), "archive_lineitem",
                       {"tons": F.col("l_quantity").cast(TONS)})


@query("archive_split", f"""
SELECT side.destination, count(l_orderkey) AS row_count, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS tons
FROM (VALUES ('archive', true), ('fact', false)) side(destination, old) LEFT JOIN lineitem ON {_OLD} = side.old GROUP BY 1""")
def archive_split(spark, sf):
    """Rows and tons that the archive job has put on either side, counted by its writer."""
    c = archive_facts(Tables(spark, sf)).counts
    return spark.createDataFrame([("archive", c["archived"], c["archived_tons"]), ("fact", c["remaining"], c["remaining_tons"])],
                                 "destination string, row_count bigint, tons decimal(38,2)").withColumn("tons", F.col("tons").cast("double"))


@query("archive_rows", f"SELECT * FROM lineitem WHERE {_OLD}")
def archive_rows(spark, sf):
    """The archive that the job leaves."""
    return archive_facts(Tables(spark, sf)).archive


@query("archive_remaining", f"SELECT * FROM lineitem WHERE NOT {_OLD}")
def archive_remaining(spark, sf):
    """The fact table that the job leaves."""
    return archive_facts(Tables(spark, sf)).remaining


@query("archive_old_telemetry", f"""
SELECT count(*) FILTER (WHERE ts < TIMESTAMP '{TELEMETRY_BEFORE}') AS archived,
       count(*) FILTER (WHERE ts < TIMESTAMP '{TELEMETRY_BEFORE}') AS deleted,
       count(*) FILTER (WHERE NOT coalesce(ts < TIMESTAMP '{TELEMETRY_BEFORE}', false)) AS remaining
FROM events""")
def archive_old_telemetry(spark, sf):
    """Telemetry before a date goes to the archive; what isn't in the new fact table is deleted."""
    events = Tables(spark, sf).events
    job = archive_job(events, F.col("ts") < ts(TELEMETRY_BEFORE), "archive_events")
    archived, remaining = (F.lit(job.counts[side]).cast("bigint") for side in ("archived", "remaining"))
    return events.agg(archived.alias("archived"), (F.count(F.lit(1)) - remaining).alias("deleted"), remaining.alias("remaining"))


# ---------------------------------------------------------------- D3 / J11
_KEYS5 = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_orderkey"]
_STAGED_SQL = "SELECT l_orderkey * 10 + l_linenumber AS staging_id, *, l_returnflag <> 'R' AS is_validated FROM lineitem"
_NEW_SQL = f"""SELECT CAST(3000 + staging_id AS BIGINT) AS production_id, l_shipdate, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       l_partkey, l_suppkey, l_orderkey, l_quantity
FROM ({_STAGED_SQL}) s WHERE is_validated AND NOT EXISTS (
  SELECT 1 FROM {{target}} p WHERE p.l_shipdate = s.l_shipdate AND p.l_linenumber = s.l_linenumber
    AND p.l_partkey = s.l_partkey AND p.l_suppkey = s.l_suppkey AND p.l_orderkey = s.l_orderkey)"""


def _staging(t: Tables) -> DataFrame:
    """All line items as staged rows; returned goods aren't validated."""
    return (t.lineitem.withColumn("staging_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
            .withColumn("is_validated", F.col("l_returnflag") != "R"))


def _loaded_before(t: Tables) -> DataFrame:
    """The target of the load: what belongs to finished orders is there."""
    return t.lineitem.filter(F.col("l_linestatus") == "F")


@query("insert_new_only", _NEW_SQL.format(target="(SELECT * FROM lineitem WHERE l_linestatus = 'F')"))
def insert_new_only_q(spark, sf):
    """Load from staging: validated rows whose five-column key the target doesn't have; new id = 3000 + staging id."""
    t = Tables(spark, sf)
    _, new = insert_new_only(_loaded_before(t), _staging(t), _KEYS5, F.col("is_validated"))
    return new.select((F.lit(3000) + F.col("staging_id")).cast("bigint").alias("production_id"), "l_shipdate",
                      F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey", "l_orderkey", "l_quantity")


@query("insert_new_only_twice", f"""
SELECT 1::BIGINT AS run, count(*) AS inserted, (SELECT count(*) FROM lineitem WHERE l_linestatus = 'F') + count(*) AS target_rows
FROM ({_NEW_SQL.format(target="(SELECT * FROM lineitem WHERE l_linestatus = 'F')")}) n
UNION ALL
SELECT 2, 0, count(*) FROM lineitem WHERE l_linestatus = 'F' OR l_returnflag <> 'R'""")
def insert_new_only_twice(spark, sf):
    """The same staging loaded twice: the second run finds nothing new."""
    t = Tables(spark, sf)
    out, state = None, _loaded_before(t)
    for run in (1, 2):
        state, new = insert_new_only(state, _staging(t), _KEYS5, F.col("is_validated"))
        state = materialize(state, f"target_{run}")
        row = new.agg(F.lit(run).cast("bigint").alias("run"), F.count(F.lit(1)).alias("inserted"),
                      scalar(F.count(F.lit(1)), state).alias("target_rows"))
        out = row if out is None else out.unionByName(row)
    return out


# ---------------------------------------------------------------- D14 / F27
NEW_TONS, LOADED_AT = "150.75", "2024-02-01 00:00:00"
_CHANGES_SQL = "SELECT DISTINCT o_orderkey * 10 + line AS production_id FROM orders, (VALUES (1), (8)) v(line)"
_FACTS_SQL = "SELECT l_orderkey * 10 + l_linenumber AS production_id, l_suppkey, l_quantity FROM lineitem"


def update_production(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A change of the first line and one of a line that isn't there, for every order: (state, touched rows, changes)."""
    changes = (t.orders.select(F.explode(F.array(F.col("o_orderkey") * 10 + 1, F.col("o_orderkey") * 10 + 8)).alias("change_id"))
               .withColumn("new_tons", F.lit(float(NEW_TONS))))
    facts = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("production_id"), "l_suppkey", "l_quantity")
    changes = changes.withColumnRenamed("change_id", "production_id").distinct()
    state, touched = keyed_update(facts, changes, "production_id", {"l_quantity": "new_tons"}, {"loaded_at": ts(LOADED_AT)})
    return state, touched, changes


@query("keyed_update_state", f"""
SELECT f.production_id, f.l_suppkey, if(c.production_id IS NULL, f.l_quantity, {NEW_TONS}) AS l_quantity,
       if(c.production_id IS NULL, NULL, TIMESTAMP '{LOADED_AT}') AS loaded_at
FROM ({_FACTS_SQL}) f LEFT JOIN ({_CHANGES_SQL}) c USING (production_id)""")
def keyed_update_state(spark, sf):
    """The fact table after the update; changed rows are stamped."""
    return update_production(Tables(spark, sf))[0]


@query("keyed_update_status", f"""
SELECT production_id, if(f.l_quantity IS NULL, 'ERROR: record not found',
       'OK: tons_mined changed from ' || CAST(CAST(f.l_quantity AS DECIMAL(10,2)) AS VARCHAR) || ' to {NEW_TONS}') AS result,
       if(f.l_quantity IS NULL, NULL, {NEW_TONS}::DOUBLE) AS new_tons
FROM ({_CHANGES_SQL}) c LEFT JOIN ({_FACTS_SQL}) f USING (production_id)""")
def keyed_update_status(spark, sf):
    """What became of each change: old and new tons of the rows it touched, or that there is none."""
    _, touched, changes = update_production(Tables(spark, sf))
    old = touched.select(F.col("production_id").alias("_id"), F.col("l_quantity").alias("_old"))
    both = changes.join(old, F.col("production_id") == F.col("_id"), "left")
    found = F.col("_id").isNotNull()
    said = F.format_string("OK: tons_mined changed from %s to %s", F.col("_old").cast("decimal(10,2)").cast("string"), F.lit(NEW_TONS))
    return both.select("production_id", F.when(found, said).otherwise("ERROR: record not found").alias("result"),
                       F.when(found, F.col("new_tons")).alias("new_tons"))


# ---------------------------------------------------------------- D15
BATCH_TABLES = ("fact_production", "fact_ore_quality", "fact_equipment_telemetry")
_CHECKED_SQL = """
  SELECT 'fact_production' AS table_name, l_shipdate::DATE AS day, l_orderkey * 10 + l_linenumber AS row_id,
         if(l_linenumber = 7 AND l_quantity = 50, -1 - l_suppkey, l_suppkey) AS ref_id, l_quantity AS amount FROM lineitem
  UNION ALL
  SELECT 'fact_ore_quality', o_orderdate::DATE, o_orderkey, if(o_totalprice > 499000, -1 - o_custkey, o_custkey), o_totalprice FROM orders
  UNION ALL
  SELECT 'fact_equipment_telemetry', ts::DATE, event_id, if(value > 300, -1 - user_id, user_id), value FROM events"""
_BATCHES_SQL = f"""
WITH staged AS ({_CHECKED_SQL}),
known AS (SELECT 'fact_production' AS table_name, s_suppkey AS ref_id FROM supplier
          UNION ALL SELECT 'fact_ore_quality', c_custkey FROM customer
          UNION ALL SELECT DISTINCT 'fact_equipment_telemetry', user_id FROM events),
checked AS (SELECT s.*, k.ref_id IS NOT NULL AS ok FROM staged s LEFT JOIN known k ON s.table_name = k.table_name AND s.ref_id = k.ref_id),
verdict AS (SELECT table_name, day, count(*) AS batch_rows, count(*) FILTER (WHERE NOT ok) AS bad_rows FROM checked GROUP BY 1, 2)"""


def partial_load_job(t: Tables):
    """All days of three fact tables as batches, each row checked against its dimension; faults are planted by value."""
    def side(name, rows, day, row_id, ref, broken, amount, known):
        ref_id = F.when(broken, -1 - F.col(ref)).otherwise(F.col(ref))
        staged = rows.select(F.lit(name).alias("table_name"), F.to_date(day).alias("day"), row_id.alias("row_id"), ref_id.alias("ref_id"), F.col(amount).alias("amount"))
        return (staged.join(known.toDF("_k").withColumn("_known", F.lit(True)), F.col("ref_id") == F.col("_k"), "left")
                .select(*staged.columns, F.col("_known").isNotNull().alias("ok")))

    production = side("fact_production", t.lineitem, "l_shipdate", F.col("l_orderkey") * 10 + F.col("l_linenumber"), "l_suppkey",
                      (F.col("l_linenumber") == 7) & (F.col("l_quantity") == 50), "l_quantity", t.supplier.select("s_suppkey"))
    quality = side("fact_ore_quality", t.orders, "o_orderdate", F.col("o_orderkey"), "o_custkey", F.col("o_totalprice") > 499000,
                   "o_totalprice", t.customer.select("c_custkey"))
    telemetry = side("fact_equipment_telemetry", t.events, "ts", F.col("event_id"), "user_id", F.col("value") > 300,
                     "value", t.events.select("user_id").distinct())
    return load_batches(production.unionByName(quality).unionByName(telemetry), "table_name", "day", "ok", BATCH_TABLES, "partial_load")


@query("partial_load", _BATCHES_SQL + """
SELECT *, bad_rows = 0 AS accepted, if(bad_rows = 0, batch_rows, 0) AS loaded_rows FROM verdict""")
def partial_load(spark, sf):
    """Every batch's verdict and how many of its rows are in the fact tables now."""
    verdicts, landed, _ = partial_load_job(Tables(spark, sf))
    loaded = landed.groupBy(F.col("table_name").alias("_t"), F.col("day").alias("_d")).agg(F.count(F.lit(1)).alias("loaded"))
    both = verdicts.join(loaded, (F.col("table_name") == F.col("_t")) & F.col("day").eqNullSafe(F.col("_d")), "left")
    return both.select("table_name", "day", "batch_rows", "bad_rows", "accepted", F.coalesce("loaded", F.lit(0)).alias("loaded_rows"))


@query("partial_load_rows", _BATCHES_SQL + """
SELECT table_name, day, row_id, ref_id, amount FROM checked JOIN verdict USING (table_name, day) WHERE bad_rows = 0""")
def partial_load_rows(spark, sf):
    """The rows that have landed."""
    return partial_load_job(Tables(spark, sf))[1]


@query("partial_load_counts", _BATCHES_SQL + """
SELECT table_name, sum(if(bad_rows = 0, batch_rows, 0))::BIGINT AS landed_rows, count(*) FILTER (WHERE bad_rows > 0) AS refused_batches FROM verdict GROUP BY 1""")
def partial_load_counts(spark, sf):
    """Rows landed by table, counted by the writer, and batches refused."""
    verdicts, _, counts = partial_load_job(Tables(spark, sf))
    landed = F.create_map(*[x for name, n in counts.items() for x in (F.lit(name), F.lit(n).cast("bigint"))])
    return verdicts.groupBy("table_name").agg(F.count_if(~F.col("accepted")).alias("refused_batches")).select(
        "table_name", landed[F.col("table_name")].alias("landed_rows"), "refused_batches")


# ---------------------------------------------------------------- D13
_TRANSFERS_SQL = """
account AS (SELECT s_suppkey AS equipment_id, CAST(s_acctbal + 1000 AS DECIMAL(38,4)) AS balance,
                   row_number() OVER (ORDER BY s_suppkey) AS place FROM supplier),
entry AS (SELECT date_trunc('month', l_shipdate)::DATE AS batch, l_suppkey AS equipment_id, -CAST(l_quantity AS DECIMAL(18,4)) AS amount FROM lineitem
          UNION ALL
          SELECT date_trunc('month', l_shipdate)::DATE, l_partkey % (SELECT count(*) FROM supplier), CAST(l_quantity AS DECIMAL(18,4)) FROM lineitem),
net AS (SELECT batch, equipment_id, sum(amount) AS amount FROM entry GROUP BY 1, 2),
months AS (SELECT batch, row_number() OVER (ORDER BY batch) AS n FROM (SELECT DISTINCT batch FROM net)),
moves AS (SELECT m.n, m.batch, list(coalesce(net.amount, 0)::DECIMAL(38,4) ORDER BY a.place) AS amounts, list(net.amount IS NOT NULL ORDER BY a.place) AS moved
          FROM months m CROSS JOIN account a LEFT JOIN net ON net.batch = m.batch AND net.equipment_id = a.equipment_id GROUP BY 1, 2),
steps AS (
  SELECT 0::BIGINT AS n, NULL::DATE AS batch, list(balance ORDER BY place) AS balances, true AS accepted, NULL::DECIMAL(38,4) AS lowest FROM account
  UNION ALL
  SELECT n, batch, if(lowest < 0, balances, after), lowest >= 0, lowest FROM (
    SELECT *, list_min(list_transform(list_filter(list_zip(after, moved), lambda z: z[2]), lambda z: z[1])) AS lowest FROM (
      SELECT m.n, m.batch, m.moved, s.balances, list_transform(list_zip(s.balances, m.amounts), lambda z: (z[1] + z[2])::DECIMAL(38,4)) AS after
      FROM steps s JOIN moves m ON m.n = s.n + 1)))"""


def transfers(t: Tables):
    """A month's line items as one atomic batch: each moves its tons from its machine to another."""
    machines = scalar(F.count(F.lit(1)), t.supplier)
    moved = F.col("l_quantity").cast("decimal(18,4)")
    both = F.array(F.struct(F.col("l_suppkey").alias("equipment_id"), (-moved).alias("amount")),
                   F.struct((F.col("l_partkey") % machines).alias("equipment_id"), moved.alias("amount")))
    entries = t.lineitem.select(F.trunc("l_shipdate", "month").alias("batch"), F.explode(both).alias("e")).select("batch", "e.*")
    accounts = t.supplier.select(F.col("s_suppkey").alias("equipment_id"), (F.col("s_acctbal") + 1000).cast("decimal(38,4)").alias("balance"))
    return transfer_batches(accounts, entries, "equipment_id", "balance", "batch", "amount")


@query("transfer_batches", f"WITH RECURSIVE {_TRANSFERS_SQL} SELECT batch, accepted, lowest::DOUBLE AS lowest_after FROM steps WHERE n > 0")
def transfer_batches_q(spark, sf):
    """Which batches were taken, and the lowest balance each would leave on one of its accounts."""
    return transfers(Tables(spark, sf))[1].withColumn("lowest_after", F.col("lowest_after").cast("double"))


@query("transfer_balances", f"""WITH RECURSIVE {_TRANSFERS_SQL}
SELECT equipment_id, (SELECT arg_max(balances, n) FROM steps)[place]::DOUBLE AS balance FROM account""")
def transfer_balances(spark, sf):
    """The balances after all batches."""
    return transfers(Tables(spark, sf))[0].withColumn("balance", F.col("balance").cast("double"))


# ---------------------------------------------------------------- S8
VIEW_FROM, VIEW_UNTIL = "1996-01-01", "2001-01-01"


def _quality_rows(t: Tables, orders: DataFrame) -> DataFrame:
    """Orders as rows of the view: keys and measures."""
    j = (orders.join(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"))
         .join(bounded(t.nation), F.col("c_nationkey") == F.col("n_nationkey")))
    return j.select(F.col("n_name").alias("mine_name"), F.date_format("o_orderdate", "yyyy-MM").alias("year_month"),
                    (F.col("o_totalprice").cast("decimal(18,2)") / 10000).alias("fe"), F.col("c_acctbal").cast("decimal(18,2)").alias("sio2"))


@query("mat_refresh_quality", f"""
SELECT n_name AS mine_name, strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS samples,
       (sum(o_totalprice::DECIMAL(18,2)) / 10000)::DOUBLE AS fe_sum, (min(o_totalprice::DECIMAL(18,2)) / 10000)::DOUBLE AS fe_min,
       (max(o_totalprice::DECIMAL(18,2)) / 10000)::DOUBLE AS fe_max, sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS sio2_sum,
       min(c_acctbal)::DOUBLE AS sio2_min, max(c_acctbal)::DOUBLE AS sio2_max
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderdate >= TIMESTAMP '{VIEW_FROM}' AND NOT (o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '{VIEW_UNTIL}') GROUP BY 1, 2""")
def mat_refresh_quality(spark, sf):
    """The monthly quality view, built, then refreshed twice from the changes of
    its base: first the orders of 1995 go, then those of the last months come
    and pending ones go.  It equals a full rebuild."""
    t = Tables(spark, sf)
    day = F.col("o_orderdate")
    early, late = day < ts(VIEW_FROM), day >= ts(VIEW_UNTIL)
    pending = F.col("o_orderstatus") == "P"
    view = AggregateView(spark, scratch_dir(spark, "quality_view"), ["mine_name", "year_month"], ["fe", "sio2"], "year_month")
    view.build(_quality_rows(t, t.orders.filter(~late)))
    none = t.orders.limit(0)
    view.refresh(_quality_rows(t, t.orders.filter(~late & ~early)), _quality_rows(t, none), _quality_rows(t, t.orders.filter(early)))
    view.refresh(_quality_rows(t, t.orders.filter(~early & ~(pending & ~late))), _quality_rows(t, t.orders.filter(late)),
                 _quality_rows(t, t.orders.filter(pending & ~late & ~early)))
    return view.read().select("mine_name", "year_month", F.col("n_rows").alias("samples"), *[F.col(f"{m}_{a}").cast("double").alias(f"{m}_{a}")
                                                                                         for m in ("fe", "sio2") for a in ("sum", "min", "max")])


# ---------------------------------------------------------------- S10 / C15
REPORT_RANGES = [("1998-01-01", "1998-01-15"), ("1998-01-10", "1998-02-05")]
_WHOLE_RANGE = ("l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate <= TIMESTAMP '1998-01-15'",
                f"l_shipdate >= TIMESTAMP '{REPORT_RANGES[0][0]}' AND l_shipdate <= TIMESTAMP '{REPORT_RANGES[1][1]}'")


@query("shift_report_published", ORACLE["shift_report"].replace(*_WHOLE_RANGE))
def shift_report_published(spark, sf):
    """The report of two overlapping date ranges, appended one after the other and read back: no date is in it twice."""
    t = Tables(spark, sf)
    path = scratch_dir(spark, "shift_reports")
    for start, end in REPORT_RANGES:
        report = shift_report_of(t, start, end)
        append_shift_report(report, path, calendar(spark, start, end, "report_date"))
    return published(spark, path, report, "report_date")
