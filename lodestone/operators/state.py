"""Table-state operators: INSERT / UPDATE / DELETE / MERGE / UPSERT as pure
DataFrame functions.

Plain parquet tables have no row-level DML, so every verb takes the current
state (and a change set) and returns the new state, plus the rows a
``RETURNING`` clause would give.  A writer then publishes the new state as a
new snapshot (``sources.snapshots``) or replaces only the touched partitions
(dynamic partition overwrite) — the state being read is never overwritten in
place.

All joins here are key joins sized by AQE; none collects a table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.operators.joins import bounded, broadcastable, partitions_for


class MergeCardinalityError(ValueError):
    """A target row would be modified by more than one source row."""


class PrimaryKeyError(ValueError):
    """A row to insert has a primary key that is taken."""


# ---------------------------------------------------------------- ids
def row_index(df: DataFrame, order: Sequence[str], out: str = "row_index",
              start: int | Column = 1, bounded_rows: bool = False) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order) + start - 1`` without moving all
    rows into one task.

    The frame is range-partitioned on ``order`` and sorted inside each
    partition, then checkpointed (reliably, in the checkpoint folder) so
    the partition contents are fixed even if an executor is lost.  Each row's
    position is its offset inside its partition plus the row count of all
    earlier partitions (a table with one row per partition, broadcast).
    ``order`` must be a total order for the numbering to be deterministic.

    ``bounded_rows=True`` is for frames bounded by their domain (one row per
    mine and day, say): a plain ordered window, no checkpoint.
    """
    from lodestone.session import checkpoint

    base = start if isinstance(start, Column) else F.lit(start)
    if bounded_rows:
        w = Window.orderBy(*order)
        return df.withColumn(out, (base - 1 + F.row_number().over(w)).cast("bigint"))
    n = partitions_for(df)
    ranged = checkpoint(df.repartitionByRange(n, *order).sortWithinPartitions(*order))
    tagged = (ranged.withColumn("_ri_pid", F.spark_partition_id())
              .withColumn("_ri_local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    counts = tagged.groupBy("_ri_pid").agg(F.count(F.lit(1)).alias("_ri_n"))
    w = Window.orderBy("_ri_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_ri_pid", F.coalesce(F.sum("_ri_n").over(w), F.lit(0)).alias("_ri_off"))
    return (tagged.join(bounded(offsets), "_ri_pid")
            .withColumn(out, (base + F.col("_ri_off") + F.col("_ri_local")).cast("bigint"))
            .drop("_ri_pid", "_ri_local", "_ri_off"))


# ---------------------------------------------------------------- insert
def insert(state: DataFrame, rows: DataFrame) -> DataFrame:
    """INSERT rows (columns matched by name; missing ones NULL)."""
    return state.unionByName(rows, allowMissingColumns=True)


def insert_new_only(state: DataFrame, staging: DataFrame, keys: Sequence[str],
                    condition: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """INSERT ... SELECT ... WHERE NOT EXISTS (same natural key) [AND cond].
    Returns ``(new_state, inserted)``; rerunning with the same staging
    inserts nothing (idempotent).

    The target's keys are a membership filter on the staging scan: rows whose
    key it hasn't for certain are new and aren't shuffled; only the others go
    into the exact anti join.  Where the filter can't be broadcast, all do.
    """
    from lodestone.operators.membership import key_filter

    src = staging.filter(condition) if condition is not None else staging
    known = key_filter(state, keys)
    if known is None:
        new = src.join(state.select(*keys), list(keys), "left_anti")
    else:
        tagged = known.tagged(src)
        maybe = tagged.filter("_may").drop("_may").join(state.select(*keys), list(keys), "left_anti")
        new = tagged.filter("NOT _may").select(*src.columns).unionByName(maybe.select(*src.columns))
    return insert(state, new.select(*[c for c in state.columns if c in new.columns])), new


# ---------------------------------------------------------------- update
def update(state: DataFrame, predicate: Column, assignments: Mapping[str, Column],
           flag: str | None = None) -> DataFrame:
    """UPDATE state SET col = expr ... WHERE predicate.  A NULL predicate
    leaves the row unchanged.  ``flag`` adds a boolean column marking the
    updated rows (the RETURNING set)."""
    hit = F.coalesce(predicate, F.lit(False))
    out = state
    if flag:
        out = out.withColumn(flag, hit)
        hit = F.col(flag)
    cols = []
    for c in out.columns:
        if c in assignments:
            cols.append(F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return out.select(*cols)


def update_where_in(state: DataFrame, key: str, keys: DataFrame, key_col: str,
                    assignments: Mapping[str, Column], extra: Column | None = None,
                    flag: str | None = None) -> DataFrame:
    """UPDATE ... WHERE key IN (SELECT key_col ...) [AND extra]: the key set
    is reduced to distinct keys and left-joined as a membership flag."""
    ks = keys.select(F.col(key_col).alias("_uw_k")).distinct().withColumn("_uw_in", F.lit(True))
    j = state.join(ks, F.col(key) == F.col("_uw_k"), "left")
    pred = F.coalesce(F.col("_uw_in"), F.lit(False))
    if extra is not None:
        pred = pred & extra
    return update(j, pred, assignments, flag).drop("_uw_k", "_uw_in")


# ---------------------------------------------------------------- delete
def delete_returning(state: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """DELETE ... WHERE predicate RETURNING *: ``(kept, deleted)``.  Rows
    whose predicate is NULL are kept, as in SQL."""
    hit = F.coalesce(predicate, F.lit(False))
    return state.filter(~hit), state.filter(hit)


def tag_delete(state: DataFrame, predicate: Column, col: str = "destination",
               kept: str = "fact", deleted: str = "archive") -> DataFrame:
    """DELETE ... RETURNING as one tagged pass: every row labelled with where
    it ends up.  Persist the result and write each label to its sink, so the
    state is scanned once for both outputs."""
    hit = F.coalesce(predicate, F.lit(False))
    return state.withColumn(col, F.when(hit, F.lit(deleted)).otherwise(F.lit(kept)))


# ---------------------------------------------------------------- merge / upsert
def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "source") -> None:
    """Raise if ``keys`` repeat in ``df`` (one grouped count, nothing but a
    single offending key is brought to the driver)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise MergeCardinalityError(f"{what} key {dict(dup[0].asDict())} appears more than once")


def merge(target: DataFrame, source: DataFrame, on: Sequence[str],
          update_cols: Sequence[str], insert_values: Mapping[str, str] | None = None,
          check_unique: bool = True, insert_unmatched: bool = True) -> DataFrame:
    """MERGE INTO target USING source ON keys
    WHEN MATCHED THEN UPDATE SET update_cols = source.*
    WHEN NOT MATCHED THEN INSERT (all target columns).

    A match flag (not COALESCE) picks the side of every updated column, so a
    NULL in the source does overwrite.  Two ways, by the size of the source:

    * a change set that can be broadcast: updated target = target LEFT JOIN
      source, inserted rows = source LEFT ANTI target keys (a keys-only read),
      and the target isn't shuffled;
    * a larger one: a single FULL OUTER JOIN on the keys.  Target and source are
      scanned once; that source keys are unique is checked on the way, by the
      aggregation that brings the source to one row a key.

    ``insert_values`` maps a target column to the source column that fills
    it on insert (e.g. a generated id computed in the source beforehand).
    NULL keys never match (as in SQL): such target rows stay, such source
    rows are inserted.  ``insert_unmatched=False`` is MERGE without the
    NOT MATCHED branch (an UPDATE ... FROM).
    """
    if insert_unmatched and not broadcastable(source):
        return _state_of(merge_pass(target, source, on, update_cols, insert_values, check_unique), target)
    if check_unique:
        assert_unique(source, on)
    insert_values = dict(insert_values or {})
    tcols = target.columns
    s_cols = list(source.columns)
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in s_cols]).withColumn("_m_s", F.lit(True))
    cond = [F.col(k) == F.col(f"_s_{k}") for k in on]
    j = target.join(s, _and(cond), "left")
    matched = F.col("_m_s").isNotNull()
    updated = j.select(*[(F.when(matched, F.col(f"_s_{c}")).otherwise(F.col(c)) if c in update_cols
                          else F.col(c)).alias(c) for c in tcols])
    if not insert_unmatched:
        return updated

    tkeys = target.select(*[F.col(k).alias(f"_t_{k}") for k in on])
    new = source.join(tkeys, _and([F.col(k) == F.col(f"_t_{k}") for k in on]), "left_anti")

    def src(c):
        if c in insert_values:
            return F.col(insert_values[c])
        return F.col(c) if c in s_cols else F.lit(None)

    inserted = new.select(*[src(c).cast(target.schema[c].dataType).alias(c) for c in tcols])
    return updated.unionByName(inserted)


def merge_pass(target: DataFrame, source: DataFrame, on: Sequence[str], update_cols: Sequence[str],
               insert_values: Mapping[str, str] | None = None, check_unique: bool = True) -> DataFrame:
    """MERGE as one full outer join: the new state with ``_change`` (kept, updated or inserted) and ``_repeats``,
    the number of source rows of the row's key."""
    insert_values = dict(insert_values or {})
    keyed = source.withColumn("_alone", F.when(_and([F.col(k).isNotNull() for k in on]), F.lit(None).cast("bigint"))
                              .otherwise(F.monotonically_increasing_id()))     # NULL keys never match, nor each other
    if check_unique:
        row = F.struct(*source.columns)
        keyed = (keyed.select(*[F.col(k).alias(f"_k_{k}") for k in on], "_alone", row.alias("_row"))
                 .groupBy(*[f"_k_{k}" for k in on], "_alone").agg(F.first("_row").alias("_row"), F.count(F.lit(1)).alias("_n")))
        keyed = keyed.select(*[F.col(f"_k_{k}") for k in on], *[F.col("_row").getField(c).alias(f"_s_{c}") for c in source.columns], "_n", F.lit(True).alias("_m_s"))
    else:
        keyed = keyed.select(*[F.col(k).alias(f"_k_{k}") for k in on], *[F.col(c).alias(f"_s_{c}") for c in source.columns],
                             F.lit(1).cast("bigint").alias("_n"), F.lit(True).alias("_m_s"))
    j = target.withColumn("_m_t", F.lit(True)).join(keyed, _and([F.col(k) == F.col(f"_k_{k}") for k in on]), "full_outer")
    old, new = F.col("_m_t").isNotNull(), F.col("_m_s").isNotNull()

    def value(c: str) -> Column:
        kind = target.schema[c].dataType
        theirs = F.col(f"_s_{insert_values.get(c, c)}").cast(kind) if insert_values.get(c, c) in source.columns else F.lit(None).cast(kind)
        mine = F.when(new, F.col(f"_s_{c}").cast(kind)).otherwise(F.col(c)) if c in update_cols else F.col(c)
        return F.when(old, mine).otherwise(theirs).alias(c)

    change = F.when(~old, "inserted").when(new, "updated").otherwise("kept")
    return j.select(*[value(c) for c in target.columns], change.alias("_change"), F.coalesce("_n", F.lit(0)).alias("_repeats"))


def _state_of(merged: DataFrame, target: DataFrame) -> DataFrame:
    """The merged rows, once they are known to come from unique source keys: written, checked, read back."""
    from lodestone.sources.snapshots import materialize

    done = materialize(merged, "merged")
    twice = done.filter("_repeats > 1").limit(1).collect()
    if twice:
        raise MergeCardinalityError(f"the source key of {dict(twice[0].asDict())} appears more than once")
    return done.select(*target.columns)


def _and(cols):
    acc = cols[0]
    for c in cols[1:]:
        acc = acc & c
    return acc


def upsert(target: DataFrame, rows: DataFrame, conflict_key: Sequence[str],
           update_cols: Sequence[str], primary_key: Sequence[str] | None = None) -> DataFrame:
    """INSERT ... ON CONFLICT (conflict_key) DO UPDATE SET update_cols: the new state.

    A new row (no conflict) whose ``primary_key`` is in the target, or in
    another new row, violates the primary key: ``PrimaryKeyError``, and
    nothing of the batch is applied (as a failed statement).  As ``merge`` it
    has a way for change sets that can be broadcast and one full outer pass,
    whose result is checked before it is given out, for larger ones.
    """
    ck = list(conflict_key)
    if not broadcastable(rows):
        return _upsert_pass(target, rows, ck, update_cols, list(primary_key or []))
    assert_unique(rows, conflict_key, "upsert")
    fresh = rows.join(target.select(*ck), ck, "left_anti")
    if primary_key:
        pk = list(primary_key)
        clash = (fresh.join(target.select(*pk), pk, "left_semi").select(*pk)
                 .unionByName(fresh.groupBy(*pk).count().filter(F.col("count") > 1).select(*pk)).limit(1).collect())
        if clash:
            raise PrimaryKeyError(f"duplicate primary key {clash[0].asDict()}")
    # Conflicting rows update only ``update_cols``; rows without a conflict
    # are not touched by this join (insert_unmatched=False).
    upd = merge(target, rows.select(*ck, *update_cols), ck, update_cols, check_unique=False,
                insert_unmatched=False)
    return insert(upd, fresh.select(*[c for c in target.columns if c in fresh.columns]))


def _upsert_pass(target: DataFrame, rows: DataFrame, ck: list[str], update_cols: Sequence[str], pk: list[str]) -> DataFrame:
    """UPSERT by one full outer join; keys are checked on the rows that it has written."""
    from lodestone.sources.snapshots import materialize

    done = materialize(merge_pass(target, rows, ck, update_cols), "upserted")
    twice = done.filter("_repeats > 1").limit(1).collect()
    if twice:
        raise MergeCardinalityError(f"upsert key of {dict(twice[0].asDict())} appears more than once")
    if pk:
        clash = (done.groupBy(*pk).agg(F.count(F.lit(1)).alias("_n"), F.max(F.col("_change") == "inserted").alias("_new"))
                 .filter("_n > 1 AND _new").select(*pk).limit(1).collect())
        if clash:
            raise PrimaryKeyError(f"duplicate primary key {clash[0].asDict()}")
    return done.select(*target.columns)


# ---------------------------------------------------------------- partitions
def replace_partition(state: DataFrame, new_rows: DataFrame, predicate: Column) -> DataFrame:
    """Delete the rows of one slice (e.g. a day) and load its new rows.  On
    disk this is a dynamic partition overwrite of that slice only."""
    kept, _ = delete_returning(state, predicate)
    return insert(kept, new_rows)
