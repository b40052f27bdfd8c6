"""Exact top-k by inner product with pivot-table elimination.

Vectors are rounded to whole numbers, so scores are exact.  A table holds each
vector's distance to a set of pivots; for a query q and a candidate x the
triangle inequality gives |q - x| >= max over pivots p of ||q - p| - |x - p||,
and with it score(q, x) = (|q|^2 + |x|^2 - |q - x|^2) / 2 at most.

Candidates are packed into blocks around their nearest pivot (a crowded pivot
has many blocks), queries likewise.  First each query meets the block that it
lies in itself, which gives a k-th score to beat.  Then the outlines of blocks
(ranges of pivot distances, the largest norm, the least score to beat) say which
pairs of a block of queries and one of candidates can matter; only these are
shipped.  In a task a query leaves a block that can't reach its own k-th score,
the rest of the block is put in order of the bound and evaluated until no bound
can reach it.  The queries are a stated set, so the pairs of blocks are their
work against all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.operators.joins import bounded

from . import common

#: Pivots; rows from which they are chosen (a sample by hash, the only part that is sampled).
PIVOTS, SAMPLE = 48, 2000
BLOCK_ROWS, QUERY_ROWS, STEP = 4096, 512, 512
_INT32 = 1 << 31


def whole_vectors(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component; vectors that are NULL, empty or hold a NULL or non-finite value are left out."""
    rows = common.narrow(vectors, vec_id="long", embedding="array<double>")
    fine = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return rows.where(fine).select("vec_id", F.transform("embedding", lambda x: F.floor(x * scale)).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of one length as a matrix of float64 (whole numbers, exact up to 2**53)."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _scorer(q: np.ndarray, x: np.ndarray):
    """Exact inner products of query i with some rows of x: in floating point where that is exact, else in Python's whole numbers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[-1]
    if most < 1 << 53:
        kind = np.float32 if most < 1 << 24 else np.float64
        a, b = q.astype(kind), x.astype(kind)
        return lambda i, some: (b[some] @ a[i]).astype(np.int64)
    whole = [[int(v) for v in row] for row in x]

    def exact(i: int, some: np.ndarray) -> np.ndarray:  # beyond a long: an error
        own = [int(v) for v in q[i]]
        return np.array([sum(u * v for u, v in zip(own, whole[k])) for k in some.tolist()], np.int64)

    return exact


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


def choose_pivots(rows: DataFrame, count: int = PIVOTS, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Per vector length: up to ``count`` distinct vectors, each as far as can be from those before."""
    # of the vectors with the least hashes, a few times as many as are wanted, before any of them is moved
    share = min(1.0, 4 * sample / max(1, rows.count()))
    low = F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < int(share * (1 << 30))
    picked = rows.select("v").where(low).distinct().orderBy(F.xxhash64("v")).limit(sample).collect() or rows.select("v").limit(1).collect()
    by_length: dict[int, list] = {}
    for r in picked:
        by_length.setdefault(len(r.v), []).append(r.v)
    out = {}
    for n, vs in by_length.items():
        x = np.array(vs, np.float64)
        chosen = [0]
        near = distances(x, x[:1])[:, 0]
        while len(chosen) < min(count, len(x)) and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, distances(x, x[chosen[-1:]])[:, 0])
        out[n] = x[chosen]
    return out


def _pivot_table(pivots: dict[int, np.ndarray]):
    """(vec_id, v) to (vec_id, v, dim, cell, d): the length, the nearest pivot and the distances to all pivots."""

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = pa.compute.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                d = distances(_matrix(part.column(1)), pivots.get(int(dim), np.zeros((1, int(dim)))))
                cell = d.argmin(1).astype(np.int32)
                ends = pa.array(np.arange(0, d.size + 1, d.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.full(part.num_rows, dim, np.int32)), pa.array(cell),
                                                  pa.ListArray.from_arrays(ends, pa.array(d.astype(np.float32).ravel()))],
                                                 names=["vec_id", "v", "dim", "cell", "d"])

    return run


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: high scores first, ties to the smaller id."""
    if len(score) > 4 * k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= edge)
        return some[np.lexsort((ids[some], -score[some]))[:k]]
    return np.lexsort((ids, -score))[:k]


def _compare(dq: np.ndarray, dx: np.ndarray, q_ids, q, beat, ids, x, k: int):
    """Per query: the best candidates of a block with at least ``beat``, in bound order with an exact stop; dq and dx are distances to the pivots."""
    dx = np.ascontiguousarray(dx.T)
    nq, nx = (q * q).sum(1), (x * x).sum(1)
    low, high = dx.min(1), dx.max(1)
    scores, gaps = _scorer(q, x), np.empty_like(dx)
    for i in range(len(q)):
        slack = 1e-3 * (1 + dq[i].max()) + 1e-6 * np.sqrt(max(nq[i], nx.max()))  # rounded distances: bounds stay bounds
        gap = max(0.0, float(np.maximum(low - dq[i], dq[i] - high).max()) - slack)
        if beat[i] is not None and (nq[i] + nx.max() - gap * gap) / 2 < beat[i]:
            continue
        np.subtract(dx, dq[i][:, None], out=gaps)
        np.abs(gaps, out=gaps)
        far = np.maximum(gaps.max(axis=0) - slack, 0).astype(np.float64)
        bound = (nq[i] + nx - far * far) / 2 + 1e-6 * (nq[i] + nx + 1)
        least = -np.inf if beat[i] is None else beat[i]
        order = np.flatnonzero((bound >= least) & (ids != q_ids[i]))
        order = order[np.argsort(-bound[order], kind="stable")]
        kept_score, kept = np.empty(0, np.int64), np.empty(0, np.int64)
        for at in range(0, len(order), STEP):
            if bound[order[at]] < least:
                break  # no later candidate can reach the k-th score
            some = order[at:at + STEP]
            found = scores(i, some)
            good = found >= least
            if not good.any():
                continue
            kept_score, kept = np.concatenate([kept_score, found[good]]), np.concatenate([kept, some[good]])
            best = _best(kept_score, ids[kept], k)
            kept_score, kept = kept_score[best], kept[best]
            if len(kept) >= k:
                least = max(least, kept_score[-1])
        good = kept_score >= (-np.inf if beat[i] is None else beat[i])
        yield i, ids[kept[good]], kept_score[good]


def _meet(k: int):
    """Rows of (query ids, vectors, scores to beat, distances; candidates' ids, vectors, distances) to (query_id, vec_id, score)."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                q_ids, ids = (row.column(c).flatten().to_numpy(zero_copy_only=False) for c in (0, 4))
                q, x = (_matrix(row.column(c).flatten()) for c in (1, 5))
                dq, dx = (_matrix(row.column(c).flatten()).astype(np.float32) for c in (3, 6))
                beat = row.column(2).flatten().to_pylist()
                out = [(np.full(len(found), q_ids[i]), found, score) for i, found, score in _compare(dq, dx, q_ids, q, beat, ids, x, k)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)

    return run


def _numbered(rows: DataFrame, size: int) -> DataFrame:
    """Rows with the number of their block, from 0 within a length; blocks have about ``size`` rows of one cell, a large cell has many."""
    before = Window.partitionBy("dim").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # one row a pivot
    sizes = rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / size).cast("long").alias("blocks"))
    sizes = common.checkpoint(sizes.withColumn("first", F.coalesce(F.sum("blocks").over(before), F.lit(0)).cast("long")))
    return rows.join(sizes, ["dim", "cell"]).withColumn("block", F.col("first") + F.pmod(F.xxhash64("place"), "blocks")).drop("blocks", "first")


def _packed(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy("dim", "block").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("rows"))


def _outlines(blocks: DataFrame, beat: bool) -> DataFrame:
    """(dim, block, low, high, most, beat): of the vectors of packed blocks the ranges of distances to pivots, the
    largest square norm, and the least score to beat (NULL if a query has none)."""
    kinds = [("dim", pa.int32()), ("block", pa.int64()), ("low", pa.list_(pa.float32())), ("high", pa.list_(pa.float32())), ("most", pa.float64()), ("beat", pa.int64())]

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                v, d = (_matrix(row.column(c).flatten()) for c in (2, 3))
                known = row.column(4).flatten().to_pylist() if beat else [None]
                out.append((row.column(0)[0].as_py(), row.column(1)[0].as_py(), d.min(0).astype(np.float32), d.max(0).astype(np.float32),
                            float((v * v).sum(1).max()), None if None in known else min(known)))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, (_, kind) in enumerate(kinds)], names=[n for n, _ in kinds])

    columns = ["dim", "block", F.col("rows.v"), F.col("rows.d"), *[F.col("rows.beat")] * beat]
    return blocks.select(*columns).mapInArrow(run, "dim int, block long, low array<float>, high array<float>, most double, beat long")


def _pairs(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """(dim, asked, block): which block of queries may find something in which block of candidates, by their outlines."""
    q = _outlines(queries, True).select("dim", F.col("block").alias("asked"), *[F.col(c).alias(f"q_{c}") for c in ("low", "high", "most", "beat")])
    x = common.checkpoint(_outlines(candidates, False).drop("beat"))
    both = common.checkpoint(q).join(bounded(x), "dim")
    apart = F.zip_with(F.zip_with("low", "q_high", lambda a, b: a - b), F.zip_with("q_low", "high", lambda a, b: a - b), lambda a, b: F.greatest(a, b))
    slack = 1e-3 * (1 + F.array_max("q_high")) + 1e-6 * F.sqrt(F.greatest("q_most", "most"))  # rounded distances: bounds stay bounds
    gap = F.greatest(F.array_max(apart) - slack, F.lit(0.0))
    bound = (F.col("q_most") + F.col("most") - gap * gap) / 2 + 1e-6 * (F.col("q_most") + F.col("most") + 1)
    return both.where(F.col("q_beat").isNull() | (bound >= F.col("q_beat"))).select("dim", "asked", "block")


def top_k(vectors: DataFrame, k: int = 20, query_step: int = 20, scale: int = 64, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Each query's k best vectors: query_id, rank, vec_id, score.

    Queries are the vectors whose vec_id is divisible by ``query_step``,
    candidates all but the query's own; the score is the inner product of the
    rounded vectors, ties go to the smaller vec_id, and with fewer than k
    candidates all come back.  Vectors of different lengths aren't compared.
    A NULL vec_id and a vector that is NULL, empty or holds a NULL or
    non-finite component take no part.  Rows that repeat a vec_id are
    candidates of their own for other queries; a repeated query is asked once,
    by its smallest vector.  Scores beyond a long raise an error.  An empty
    table gives an empty result; other columns are ignored.
    """
    rows = common.checkpoint(whole_vectors(vectors, scale))
    table = choose_pivots(rows, pivots)
    rows = common.checkpoint(rows.mapInArrow(_pivot_table(table), "vec_id long, v array<long>, dim int, cell int, d array<float>"))
    rows = common.checkpoint(_numbered(rows.withColumn("place", F.monotonically_increasing_id()), block_rows))
    blocks = common.checkpoint(_packed(rows, "vec_id", "v", "d"))
    asked = rows.where(F.col("vec_id") % query_step == 0).groupBy("vec_id").agg(F.min(F.struct("dim", "v", "cell", "block", "place", "d")).alias("q")).select("vec_id", "q.*")

    def met(queries: DataFrame) -> DataFrame:
        """Blocks of queries (dim, block, rows), each with the block of candidates of that number."""
        q = queries.select("dim", "block", *[F.col(f"rows.{c}").alias(f"q_{c}") for c in ("vec_id", "v", "beat", "d")])
        pairs = q.join(blocks, ["dim", "block"]).select("q_vec_id", "q_v", "q_beat", "q_d", "rows.vec_id", "rows.v", "rows.d")
        return pairs.mapInArrow(_meet(k), "query_id long, vec_id long, score long")

    # a first score to beat, from the query's own block
    near = met(_packed(asked.withColumn("beat", F.lit(None).cast("long")), "vec_id", "v", "beat", "d"))
    near = near.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
    beat = near.select(F.col("query_id").alias("vec_id"), F.when(F.size("s") >= k, F.element_at("s", k)).alias("beat"))
    # blocks of queries against those blocks of candidates of the same length that may have a better score
    asked = common.checkpoint(_packed(_numbered(asked.drop("block").join(beat, "vec_id", "left"), QUERY_ROWS), "vec_id", "v", "beat", "d"))
    queries = asked.select("dim", F.col("block").alias("asked"), "rows")
    found = met(_pairs(asked, blocks).join(queries, ["dim", "asked"]).select("dim", "block", "rows"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
