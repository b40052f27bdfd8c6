"""Whitening of embeddings with MLlib's BlockMatrix.

Vectors become whole numbers x, whose sums are exact.  Centred rows get numbers
without gaps and are cut into the distributed blocks of a ``BlockMatrix`` A.
The scatter is Aᵀ A, its middle dimension split so that no task gets more than
a few blocks; its eigenvectors are found locally (the scatter is as small as
the square of the dimension), and A W, again a product of block matrices,
projects the rows on the components.  How far the covariance of what comes out
is from the identity is measured on all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.operators.joins import bounded
from lodestone.session import scratch_dir

from . import common

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
ROWS_PER_BLOCK, BLOCKS_PER_TASK = 1024, 8
#: An eigenvalue not above this share of the trace is nothing but rounding: its component has no whitened values.
NOTHING = 1e-13
_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whole(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of vectors without missing or infinite entries."""
    entry = F.col("embedding").cast("array<double>")
    fine = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long"), entry.alias("embedding")).where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.coalesce(fine, F.lit(False)))
    return rows.select("vec_id", F.transform("embedding", lambda c: F.floor(SCALE * c) + SHIFT).alias("x"))


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` written with their ``place``: the part and the number in it."""
    folder = scratch_dir(rows.sparkSession, "whole-vectors")
    rows.withColumn("place", F.monotonically_increasing_id()).write.parquet(folder)
    return rows.sparkSession.read.parquet(folder)


def _sums(rows: DataFrame) -> DataFrame:
    """(d, n, sums): partial sums of the vectors of each length, one row a task and length."""
    schema = pa.schema([("d", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            x = batch.column(0)
            lengths = pa.compute.list_value_length(x).to_numpy()
            for d in np.unique(lengths).tolist():
                own = x.filter(pa.array(lengths == d)).flatten().to_numpy().reshape(-1, d)
                n, sums = found.setdefault(d, [0, np.zeros(d, np.int64)])
                found[d] = [n + len(own), sums + own.sum(axis=0)]
        yield pa.RecordBatch.from_pylist([{"d": d, "n": n, "sums": s.tolist()} for d, (n, s) in found.items()], schema)

    return rows.select("x").mapInArrow(run, "d int, n long, sums array<long>")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` as written, with ``index`` from 0 without gaps: the place in its part and the sizes of the parts before."""
    counts = rows.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over a row for each part of the table
    offsets = common.checkpoint(counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")))
    return (rows.withColumn("part", F.shiftright("place", 33)).join(bounded(offsets), "part")
            .withColumn("index", F.col("offset") + F.col("place").bitwiseAND((1 << 33) - 1)).drop("part", "offset", "place"))


def _scatter(blocks: BlockMatrix, n: int) -> np.ndarray:
    """Aᵀ A; PySpark's ``multiply`` leaves out the number of splits of the middle dimension, by which the sum is shared out."""
    splits = max(1, -(-n // (ROWS_PER_BLOCK * BLOCKS_PER_TASK)))
    product = blocks.transpose()._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    scatter = BlockMatrix(product, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()
    return (scatter + scatter.T) / 2


def _projected(blocks: BlockMatrix, whitening: np.ndarray, folder: str) -> None:
    """Writes (index, values) of A W."""
    spark_context = SparkContext.getOrCreate()
    d, kept = whitening.shape
    factor = BlockMatrix(spark_context.parallelize([((0, 0), DenseMatrix(d, kept, whitening.ravel(order="F").tolist()))], 1), d, kept)

    def rows(block):
        (i, _), values = block
        return [(i * ROWS_PER_BLOCK + r, row) for r, row in enumerate(values.toArray().tolist())]

    blocks.multiply(factor).blocks.flatMap(rows).toDF("index long, values array<double>").write.parquet(folder)


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row a vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Entries c count as x = floor(1024 c) + 100000.  NULL and empty vectors, and
    such with NULL or non-finite entries, take no part, nor do vectors of
    another length than most have (of lengths equally common, the longest).
    There are as many components as dimensions if these are fewer.  A component
    without variance has NULL whitened values and isn't judged; deviation is
    NULL beyond the range of long.  Rows that repeat are rows of their own; an
    empty table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = _placed(_whole(vectors))
    sums = common.checkpoint(_sums(rows))
    most = sums.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if most is None:
        return spark.createDataFrame([], _RESULT)
    d, n = most
    totals = sums.where(F.col("d") == d).select(F.posexplode("sums").alias("at", "part")).groupBy("at").agg(F.sum("part").alias("total")).orderBy("at")
    s = [r.total for r in totals.collect()]  # one number a dimension
    if sums.where(F.col("d") != d).head(1):
        rows = _placed(rows.where(F.size("x") == d).drop("place"))
    given = _numbered(rows)
    centred = F.zip_with("x", F.array(*[F.lit(float(t) / n) for t in s]), lambda x, m: x - m)
    indexed = MLUtils.convertVectorColumnsFromML(given.select("index", array_to_vector(centred).alias("vector")), "vector")
    blocks = IndexedRowMatrix(indexed, n, d).toBlockMatrix(ROWS_PER_BLOCK, d)
    blocks.persist(StorageLevel.DISK_ONLY)  # read by both products; lost blocks are computed again
    with common.one_blas_thread():
        values, vectors_of = np.linalg.eigh(_scatter(blocks, n) / n)
    order = np.argsort(-values, kind="stable")[:components]
    trace, e = float(values.sum()), values[order]
    real = e > NOTHING * max(trace, 0)
    scale = np.where(real, 1 / np.sqrt(np.where(real, e, 1)), 0)
    out = scratch_dir(spark, "projected")
    _projected(blocks, vectors_of[:, order] * scale, out)
    projected = spark.read.parquet(out)
    identity_error = _identity_error(projected, np.flatnonzero(real).tolist(), n)
    each = F.array(*[F.struct(F.lit(k + 1).alias("component"), (F.col("values")[k] if real[k] else F.lit(None).cast("double")).alias("whitened"),
                              F.lit(float(e[k]) / trace if trace > 0 else None).cast("double").alias("explained")) for k in range(len(e))])
    return (given.select("index", "vec_id", _deviation(s, n).alias("deviation")).join(projected, "index")
            .select("vec_id", "deviation", F.explode(each).alias("c"))
            .select("vec_id", "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained",
                    F.lit(identity_error).cast("double").alias("identity_error")))


def _deviation(s: list[int], n: int) -> Column:
    """Sum of (n x - S)² in whole numbers."""
    differences = F.zip_with("x", F.array(*[F.lit(t).cast("long") for t in s]), lambda x, t: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), x), t))
    return F.aggregate(differences, F.lit(0).cast("long"), lambda total, v: F.try_add(total, F.try_multiply(v, v)))


def _identity_error(projected: DataFrame, real: list[int], n: int) -> float | None:
    """The largest entry of the covariance of all projected rows minus the identity, centred before multiplying."""
    if not real:
        return None
    means = projected.agg(*[F.avg(F.col("values")[k]).alias(f"m{k}") for k in real]).first()
    part = {k: F.col("values")[k] - F.lit(means[f"m{k}"]) for k in real}
    pairs = [(i, j) for i in real for j in real if i <= j]
    found = projected.agg(*[(F.sum(part[i] * part[j]) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
