"""Stored results that are kept up to date: aggregate views and dated reports.

* ``AggregateView``: a materialized view that is refreshed from the changes of
  its base instead of being built anew;
* ``publish_dates``: a report table parted by date, in which a rerun of a date
  replaces that date and leaves the others alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.session import checkpoint, scratch_dir

_SUM = "decimal(38,6)"


class AggregateView:
    """COUNT, SUM, MIN and MAX of measures by group, stored in mergeable form.

    The state of a group is its rows and, for each measure, its values' count,
    exact sum, least and largest.  Inserts merge into it.  Deletes are taken off
    counts and sums; least and largest can only change in a group where a deleted
    value reaches one of them, and only such groups are computed again, from base
    rows that a semi join on their keys lets through.  The state is parted by one
    of the keys; a refresh rewrites the parts that hold a changed group and reads
    or writes no others.  A group without rows is kept as an empty state, which
    readers don't see, so that its part can be rewritten like any other.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], measures: Sequence[str], part: str):
        if part not in keys:
            raise ValueError(f"{part!r} must be one of the keys")
        self.spark, self.path, self.keys, self.measures, self.part = spark, path, list(keys), list(measures), part

    # state

    def _aggregated(self, rows: DataFrame) -> DataFrame:
        cols: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
        for m in self.measures:
            v = F.col(m)
            cols += [F.count(v).alias(f"{m}_n"), F.sum(v.cast(_SUM)).cast(_SUM).alias(f"{m}_sum"), F.min(v).alias(f"{m}_min"), F.max(v).alias(f"{m}_max")]
        return rows.groupBy(*self.keys).agg(*cols)

    def build(self, base: DataFrame) -> "AggregateView":
        """Compute the whole view (``base`` has the keys and the measures)."""
        state = self._aggregated(base)
        self._schema = state.schema
        state.write.partitionBy(self.part).parquet(self.path)
        return self

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(self._schema).parquet(self.path)

    def read(self) -> DataFrame:
        """The groups that have rows: keys, n_rows and the aggregates."""
        return self._stored().filter("n_rows > 0")

    def _same(self, a: str, b: str) -> Column:
        out = F.col(f"{a}.{self.keys[0]}").eqNullSafe(F.col(f"{b}.{self.keys[0]}"))
        for k in self.keys[1:]:
            out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
        return out

    # refresh

    def refresh(self, base_after: DataFrame, inserted: DataFrame, deleted: DataFrame) -> DataFrame:
        """Bring the view up to date with rows that came and went; returns the keys of the groups computed again.

        ``base_after`` is the base with the changes made; it is read for the
        groups computed again only.
        """
        plus, minus = checkpoint(self._aggregated(inserted)), checkpoint(self._aggregated(deleted))
        touched = plus.select(*self.keys).unionByName(minus.select(*self.keys)).distinct().alias("k")
        parts = [r[0] for r in touched.select(f"k.{self.part}").distinct().collect()]     # of the view's folders, those with a change
        known = F.col(self.part).isin([p for p in parts if p is not None])
        old = self._stored().filter(known | F.col(self.part).isNull() if None in parts else known)     # the others aren't listed or read
        given = (old.alias("o").join(touched, self._same("o", "k"), "full_outer")
                 .select(*[F.coalesce(f"o.{c}", f"k.{c}").alias(c) if c in self.keys else F.col(f"o.{c}").alias(c) for c in old.columns]))
        merged = given.alias("s").join(plus.alias("p"), self._same("s", "p"), "left").join(minus.alias("m"), self._same("s", "m"), "left")

        def count(c: str) -> Column:
            return F.coalesce(f"s.{c}", F.lit(0)) + F.coalesce(f"p.{c}", F.lit(0)) - F.coalesce(f"m.{c}", F.lit(0))

        cols, again = [F.col(f"s.{k}").alias(k) for k in self.keys], F.lit(False)
        cols.append(count("n_rows").alias("n_rows"))
        for m in self.measures:
            n = count(f"{m}_n")
            cols.append(n.alias(f"{m}_n"))
            cols.append(F.when(n > 0, count(f"{m}_sum")).cast(_SUM).alias(f"{m}_sum"))
            cols += [F.least(f"s.{m}_min", f"p.{m}_min").alias(f"{m}_min"), F.greatest(f"s.{m}_max", f"p.{m}_max").alias(f"{m}_max")]
            reaches = (F.col(f"m.{m}_min") <= F.least(f"s.{m}_min", f"p.{m}_min")) | (F.col(f"m.{m}_max") >= F.greatest(f"s.{m}_max", f"p.{m}_max"))
            again = again | F.coalesce(reaches, F.lit(False))
        out = scratch_dir(self.spark, "refreshed")      # frozen before a part of the view is replaced
        merged.select(*cols, again.alias("_again")).write.parquet(out)
        frozen = self.spark.read.parquet(out)
        redo = frozen.filter("_again").select(*self.keys)
        fresh = self._aggregated(base_after.alias("b").join(redo.alias("r"), self._same("b", "r"), "left_semi"))
        kept = frozen.filter("NOT _again").drop("_again")
        gone = redo.alias("r").join(fresh.alias("f"), self._same("r", "f"), "left_anti").withColumn("n_rows", F.lit(0).cast("long"))
        state = kept.unionByName(fresh).unionByName(gone, allowMissingColumns=True).select(*[F.col(f.name).cast(f.dataType) for f in self._schema])
        state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.part).parquet(self.path)
        return redo


def publish_dates(rows: DataFrame, path: str, date: str, dates: DataFrame) -> None:
    """Append a report's rows; a date that is in ``dates`` is replaced, if it is there already.

    One dynamic partition overwrite.  A date of the run for which the report has
    no rows must lose its old ones too, so it gets a row of NULLs, which
    ``published`` leaves out.
    """
    days = dates.select(F.col(date)).distinct()
    marked = days.join(rows.withColumn("_row", F.lit(True)), date, "left")
    # each task would open a file for every date that it holds
    marked.repartition(date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path)


def published(spark: SparkSession, path: str, like: DataFrame, date: str) -> DataFrame:
    """The report as it stands, with the columns of ``like``."""
    schema = like.withColumn("_row", F.lit(True)).schema
    return spark.read.schema(schema).parquet(path).filter("_row").select(*like.columns)
