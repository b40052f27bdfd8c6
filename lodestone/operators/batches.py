"""Jobs that move rows in batches: archive, keyed update, partial load, atomic transfers.

Every count that a job reports is taken from the rows that it writes
(``DataFrame.observe`` on the frame that the writer consumes, with no shuffle
behind it, so a row is counted once), never derived from a predicate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lodestone.operators.joins import bounded
from lodestone.operators.membership import key_filter
from lodestone.operators.state import assert_unique, tag_delete
from lodestone.session import checkpoint, scratch_dir


# ---------------------------------------------------------------- archive
@dataclass
class Archived:
    """What an archive job has written: both datasets, and counts of their rows with sums of ``measures``."""
    archive: DataFrame
    remaining: DataFrame
    counts: dict


def archive_job(facts: DataFrame, older: Column, name: str, measures: Mapping[str, Column] | None = None) -> Archived:
    """Copy the rows that ``older`` holds for into an archive and keep the others: one scan and one write.

    Rows for which ``older`` is NULL stay, as in DELETE.  Both outputs lie under
    one new folder, parted by destination, so each is read back without the
    other; the source isn't touched, and publishing the folder is the commit.
    """
    spark, path = facts.sparkSession, scratch_dir(facts.sparkSession, name)
    tagged = tag_delete(facts, older, "_destination")
    sides = {"archived": F.col("_destination") == "archive", "remaining": F.col("_destination") == "fact"}
    seen = Observation(name)
    metrics = [F.count_if(side).alias(what) for what, side in sides.items()]
    metrics += [F.sum(F.when(side, m)).alias(f"{what}_{k}") for k, m in (measures or {}).items() for what, side in sides.items()]
    tagged.observe(seen, *metrics).write.partitionBy("_destination").parquet(path)
    read = spark.read.schema(tagged.schema).parquet(path)
    return Archived(read.filter("_destination = 'archive'").drop("_destination"),
                    read.filter("_destination = 'fact'").drop("_destination"), seen.get)


# ---------------------------------------------------------------- keyed update
def keyed_update(state: DataFrame, changes: DataFrame, key: str, assign: Mapping[str, str],
                 stamp: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """UPDATE of single rows by key: (new state, touched rows with their old values).

    ``assign`` names for each changed column the column of ``changes`` that
    fills it, ``stamp`` has further columns of an updated row (NULL on others,
    unless the state has them).  The changes' keys are a membership filter on the
    scan: rows that no change can meet go from the scan into the new state and
    are never shuffled; only the others are joined.  Two changes of one key
    raise ``MergeCardinalityError``.  Keys without a row change nothing.
    """
    assert_unique(changes, [key], "changed")
    known = key_filter(changes, [key])
    own = [F.col(f"c.{v}").alias(f"_new_{c}") for c, v in assign.items()]
    new = changes.alias("c").select(F.col(f"c.{key}").alias("_key"), *own, F.lit(True).alias("_hit"))

    def result(rows: DataFrame) -> DataFrame:
        hit = F.col("_hit").isNotNull()
        cols = [F.when(hit, F.col(f"_new_{c}").cast(state.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in assign
                else F.when(hit, stamp[c]).otherwise(F.col(c)).alias(c) if c in stamp else F.col(c) for c in state.columns]
        return rows.select(*cols, *[F.when(hit, v).alias(c) for c, v in stamp.items() if c not in state.columns])

    nothing = [F.lit(None).cast(changes.schema[v].dataType).alias(f"_new_{c}") for c, v in assign.items()]
    if known is None:
        met = state.join(new, F.col(key) == F.col("_key"), "left")
        return result(met), met.filter("_hit")
    tagged = known.tagged(state, [key])
    met = tagged.filter("_may").join(new, F.col(key) == F.col("_key"), "left")
    apart = tagged.filter("NOT _may").select(*state.columns, F.lit(None).cast(state.schema[key].dataType).alias("_key"), *nothing, F.lit(None).cast("boolean").alias("_hit"))
    return result(met).unionByName(result(apart)), met.filter("_hit")


# ---------------------------------------------------------------- partial load
def load_batches(checked: DataFrame, table: str, day: str, ok: str, tables: Sequence[str], name: str) -> tuple[DataFrame, DataFrame, dict]:
    """Land those batches (``table``, ``day``) of which every row is ``ok``; a batch with one bad row is dropped whole.

    The checked rows are written once, so their reference joins run once; the
    verdicts read three of their columns; the landing drops refused batches
    by a broadcast of the accepted ones (a row for each day and table, size
    checked) and counts what it writes.  Returns (verdicts, landed rows, rows
    landed by table).  A NULL day is a batch of its own; NULL ``ok`` is bad.
    """
    spark = checked.sparkSession
    staged_at, landed_at = scratch_dir(spark, f"{name}-staged"), scratch_dir(spark, f"{name}-landed")
    checked.write.partitionBy(table).parquet(staged_at)
    staged = spark.read.schema(checked.schema).parquet(staged_at)
    bad = F.count_if(~F.coalesce(F.col(ok), F.lit(False)))
    verdicts = checkpoint(staged.groupBy(table, day).agg(F.count(F.lit(1)).alias("batch_rows"), bad.alias("bad_rows"))
                          .withColumn("accepted", F.col("bad_rows") == 0))
    good = verdicts.filter("accepted").select(F.col(table).alias("_t"), F.col(day).alias("_d"))
    landing = staged.join(bounded(good), F.col(table).eqNullSafe(F.col("_t")) & F.col(day).eqNullSafe(F.col("_d")), "left_semi").drop(ok)
    seen = Observation(name)
    landing.observe(seen, *[F.count_if(F.col(table) == t).alias(t) for t in tables]).write.partitionBy(table).parquet(landed_at)
    return verdicts, spark.read.schema(landing.schema).parquet(landed_at), seen.get


# ---------------------------------------------------------------- atomic batches
AMOUNT = "decimal(38,4)"


def _moves(accounts: DataFrame, entries: DataFrame, key: str, balance: str, batch: str, amount: str) -> DataFrame:
    """A row for each batch and account that it moves (``_b``, ``_k``).

    ``_a`` is the sum of its entries, ``_open`` the opening balance (NULL: unknown
    account), ``_own`` ``_a`` itself (where the key stands for several rows of
    ``accounts``, the running sum over them), ``_undated`` what the NULL batch,
    which comes first, has moved before.
    """
    def nothing(c: Column) -> Column:
        return F.coalesce(c, F.lit(0)).cast(AMOUNT)

    net = entries.groupBy(F.col(batch).alias("_b"), F.col(key).alias("_k")).agg(nothing(F.sum(amount)).alias("_a"))
    held = accounts.select(F.col(key).alias("_k"), F.col(balance).cast(AMOUNT).alias("_open"))
    upto = (Window.unboundedPreceding, Window.currentRow)
    undated = F.sum(F.when(F.col("_b").isNull(), F.col("_a"))).over(Window.partitionBy("_k").orderBy("_b", "_open").rowsBetween(*upto))
    return checkpoint(net.join(held, "_k", "left").repartition("_k").select(
        "_k", "_b", "_open", "_a", F.sum("_a").over(Window.partitionBy("_k", "_b").orderBy("_open").rowsBetween(*upto)).cast(AMOUNT).alias("_own"),
        nothing(F.when(F.col("_b").isNotNull(), undated)).alias("_undated")))


def _tried(rows: DataFrame, guesses: Sequence[str], undated: Column) -> DataFrame:
    """What each batch would leave if the batches before it were taken as a guess says (boolean columns of ``rows``).

    A row for each batch: for each guess itself, ``low_`` the lowest balance and ``ok_``
    whether the batch can be taken.  All guesses share one window over the sums.
    """
    before = Window.partitionBy("_k").orderBy("_b", "_open").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0).cast(AMOUNT)
    opening = F.col("_open") + F.when(undated, F.col("_undated")).otherwise(zero)
    left = rows.select("_b", *guesses, *[
        (opening + F.coalesce(F.sum(F.when(F.col(g) & F.col("_b").isNotNull(), F.col("_a"))).over(before), zero)
         + F.when(F.col(g) & F.col("_b").isNotNull(), zero).otherwise(F.col("_own"))).alias(f"after_{g}") for g in guesses])
    return left.groupBy("_b").agg(*[c for g in guesses for c in (
        F.first(g).alias(g), F.min(f"after_{g}").alias(f"low_{g}"),
        (F.count_if((F.col(f"after_{g}") < 0) | F.col(f"after_{g}").isNull()) == 0).alias(f"ok_{g}"))])


def transfer_batches(accounts: DataFrame, entries: DataFrame, key: str, balance: str, batch: str, amount: str) -> tuple[DataFrame, DataFrame]:
    """Apply batches of entries in order, each whole or not at all: none may leave an account below zero.

    Entries are first summed by batch and account (map-side, so an account in
    a third of all entries is a row a batch).  A round guesses every verdict and works out each batch's
    from running balances of the batches before it that the guess takes.  Up to
    and with the first batch whose guess was wrong, these verdicts are final; they
    are the guess of the next round, and with no wrong guess all are.  Each round
    also tries the final ones followed by all taken and by all refused, and goes
    on from the guess that holds longest: so there is at most a round for each
    refused batch and one more, or a round for each one taken and two more, and
    mostly far fewer.  A round is one job over the sums; it writes its verdicts, a
    row for each batch, and the next round and the balances read them back.

    Returns (final balances, verdicts: batch, accepted, lowest balance that the
    batch would leave on one of its accounts).  Entries of unknown accounts refuse
    their batch, as a foreign key would (no lowest balance if it has no other);
    NULL amounts count as nothing.  The NULL batch comes first, is never refused,
    and goes without a verdict at the first refused one.
    """
    spark = accounts.sparkSession
    moves = _moves(accounts, entries, key, balance, batch, amount)
    guesses, undated, first = ["taken"], F.lit(True), None
    rows = moves.withColumn("taken", F.lit(True))
    while True:
        path, seen = scratch_dir(spark, "transfers"), Observation("transfers")
        tried = _tried(rows, guesses, undated)
        wrong = [F.min(F.when(F.col(g) != F.col(f"ok_{g}"), F.col("_b"))).alias(g) for g in guesses]
        tried.observe(seen, *wrong).write.parquet(path)
        holds = seen.get
        settled = next((g for g in guesses if holds[g] is None), None)
        best = settled or max(guesses, key=lambda g: holds[g])
        verdicts = spark.read.schema(tried.schema).parquet(path).select("_b", F.col(f"ok_{best}").alias("_ok"), F.col(f"low_{best}").alias("_low"))
        if settled:
            break
        if first is None:
            first, undated = holds[best], F.col("_b") <= F.lit(holds[best])
        final = F.col("_b") <= F.lit(holds[best])
        guesses = ["again", "taken", "refused"]
        guess = verdicts.select("_b", F.col("_ok").alias("again"), (F.col("_ok") | ~final).alias("taken"), (F.col("_ok") & final).alias("refused"))
        rows = moves.join(bounded(guess), "_b")
    live = moves.filter(F.col("_open").isNotNull())
    if first is None:
        verdicts = verdicts.withColumn("_ok", F.lit(True))
    else:
        verdicts = verdicts.filter(F.col("_b").isNotNull())
        live = live.join(bounded(verdicts.filter("_ok").select("_b")), "_b", "left_semi")
    total = live.groupBy(F.col("_k").alias("_key")).agg(F.sum("_a").alias("_sum"))
    final = (accounts.join(total, F.col(key) == F.col("_key"), "left")
             .withColumn(balance, (F.col(balance) + F.coalesce("_sum", F.lit(0))).cast(AMOUNT)).drop("_key", "_sum"))
    return final, verdicts.select(F.col("_b").alias(batch), F.col("_ok").alias("accepted"), F.col("_low").alias("lowest_after"))
