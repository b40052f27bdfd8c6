"""Derived datasets written to the shared scratch folder.

* ``materialize``: a materialized view — the aggregate is written once as
  parquet and read back (``sources.views`` has the one that is refreshed).
* ``clustered_layout``: the re-aimed index work — facts range-partitioned
  by a date key and sorted within files, so parquet row-group min/max
  statistics prune date-range reads; ``interleaved_layout`` clusters by
  several columns at once, and ``layout_of`` finds a layout that is there;
  ``projection`` writes a pre-filtered,
  narrow dataset (the intent of a partial covering index).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.joins import partitions_for
from lodestone.session import scratch_dir


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Write ``df`` as a parquet snapshot under the checkpoint folder; return
    the DataFrame reading it back."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if partition_by:
        return spark.read.parquet(path)
    return spark.read.schema(df.schema).parquet(path)     # schema known: no footer inference


def clustered_layout(df: DataFrame, name: str, cluster_col: str, sort_cols: Sequence[str],
                     files: int | None = None) -> str:
    """Range-partition ``df`` on ``cluster_col`` and sort each file by
    ``sort_cols``; returns the path.  Each output file then covers a narrow
    key range, so a range filter on ``cluster_col`` skips whole files and
    row groups using parquet statistics (what a BRIN / clustered index buys).

    A layout is a job of its own: the caller keeps the path and reads it as
    often as it likes; every call writes a new one from the data as they are.
    """
    spark = df.sparkSession
    n = files or partitions_for(df)
    path = scratch_dir(spark, name)
    (df.repartitionByRange(n, cluster_col)
       .sortWithinPartitions(*sort_cols)
       .write.mode("errorifexists").parquet(path))
    return path


def interleaved(columns: Sequence[Column], bits: int) -> Column:
    """Bits of several whole numbers (below 2^bits) by turns, highest first: rows near each other in the result are near in all."""
    out = F.lit(0).cast("long")
    for b in reversed(range(bits)):
        for c in columns:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(c.cast("long"), b).bitwiseAND(1))
    return out


def interleaved_layout(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, bits: int = 8) -> str:
    """Write ``df`` to ``path`` clustered on several columns at once.

    A column's values are ranked by 2^bits quantiles (an approximate sketch, a
    few numbers), the ranks' bits interleaved, and rows range-partitioned and
    sorted in that order.  A file then covers a narrow range of *each* column, so
    parquet statistics skip files and row groups for a filter on any of them.
    NULLs rank first.  Columns are numbers, dates or times.
    """
    n = files or partitions_for(df)
    kinds = dict(df.dtypes)

    def number(column: str) -> Column:
        timed = kinds[column] in ("date", "timestamp", "timestamp_ntz")
        return (F.col(column).cast("timestamp") if timed else F.col(column)).cast("double")

    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(number(c), shares, 20 << bits).alias(f"_q{i}") for i, c in enumerate(columns)]).first()

    def rank(column: str, cuts: list) -> Column:
        """How many of the cuts a value has reached."""
        value = number(column)
        edges = F.array(*[F.lit(x) for x in cuts]).cast("array<double>")
        return F.when(value.isNull(), 0).otherwise(F.size(F.filter(edges, lambda e: e <= value)))

    ranks = [rank(c, sorted(set(found[i] or []))) for i, c in enumerate(columns)]
    ranged = df.withColumn("_z", interleaved(ranks, bits)).repartitionByRange(n, "_z").sortWithinPartitions("_z", *columns)
    ranged.drop("_z").write.mode("errorifexists").parquet(path)
    return path


def layout_of(spark, source: str, name: str, build: Callable[[str], object]) -> str:
    """The path of a layout of the data at ``source``: the one that is there for the files as they are, else one built now.

    The layout lies in the shared folder under a name that stands for the source's
    files (names, sizes, times).  ``build(path)`` writes it; only a finished one
    (with the writer's ``_SUCCESS``) is used, and a half-written one, left by a
    job that was lost, is passed over for a new name.
    """
    import hashlib

    from lodestone.session import shared_dir
    from lodestone.sources.tables import files_of

    mark = hashlib.sha256(repr(files_of(spark, source)).encode()).hexdigest()[:16]
    root = f"{shared_dir(spark)}/layouts"
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for turn in range(1 << 30):
        path = f"{root}/{name}-{mark}-{turn}"
        if fs.exists(jvm.Path(f"{path}/_SUCCESS")):
            return path
        if not fs.exists(jvm.Path(path)):
            build(path)
            return path


def projection(df: DataFrame, name: str, predicate, cols: Sequence[str]) -> DataFrame:
    """Pre-filtered narrow dataset: rows matching ``predicate``, columns
    ``cols`` only (a partial + covering index, materialised)."""
    return materialize(df.filter(predicate).select(*cols), name)


def empty_like(df: DataFrame, extra: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """CREATE TABLE ... (LIKE t) [+ extra columns]: an empty DataFrame with
    ``df``'s schema plus ``extra`` (name, DDL type) fields — e.g. a reject
    table = staging columns + reason + rejected_at."""
    out = df.limit(0)
    for name, ddl in extra:
        out = out.withColumn(name, F.lit(None).cast(ddl))
    return out


def truncate(spark, path: str, like: DataFrame) -> None:
    """TRUNCATE: replace the dataset at ``path`` with an empty one of the same
    schema (readers of an earlier snapshot path are unaffected)."""
    like.limit(0).write.mode("overwrite").parquet(path)


def bucketed_table(df: DataFrame, name: str, key: str, buckets: int, sort: bool = True) -> DataFrame:
    """Write ``df`` as an external table bucketed (and sorted) by ``key``
    under the shared folder and return it from the catalog.

    Two tables bucketed on their join key with the same bucket count join
    bucket-to-bucket: the sort-merge join needs no exchange on either side,
    which removes the largest shuffle of a fact-to-fact join (e.g. line
    items to orders on the order key) from every query that joins them.
    """
    import uuid as _uuid

    spark = df.sparkSession
    table = f"{name}_{_uuid.uuid4().hex[:8]}"
    w = df.write.bucketBy(buckets, key)
    if sort:
        w = w.sortBy(key)
    w.option("path", scratch_dir(spark, name)).mode("errorifexists").format("parquet").saveAsTable(table)
    return spark.table(table)
