import math
import random

import pytest

from lodestone.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=20, step=20):
    import numpy as np

    fine = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in sorted(fine):
        if q % step == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in fine if c != q and len(a) == len(b))
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    return sorted(map(tuple, topk.top_k(frame, **options).select("query_id", "rank", "vec_id", "score").collect()))


def test_random_vectors_in_small_blocks(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(400)]
    rows += [(i, rows[40][1]) for i in range(400, 460)]  # many copies of a query
    assert run(spark, rows, k=20, block_rows=50) == plain(rows)


@pytest.mark.parametrize("rows", [
    [], [(0, [1.0, 2.0])], [(0, None), (1, [1.0])],
    [(0, [1.0, None]), (20, [1.0, float("nan")]), (40, [1.0, 0.5]), (41, [float("inf"), 1.0]), (42, [0.0, 0.0]), (43, [-1.0, 3.0]), (44, [1.0]), (60, []), (None, [1.0, 1.0])],
    [(i, [0.5, 0.5, 0.5]) for i in range(50)],
    [(i, [float(i * 10003), 3.0e6 * (i % 7)]) for i in range(60)],
])
def test_odd_tables(spark, rows):
    assert run(spark, rows) == plain(rows)


def test_fewer_bounds_evaluated_than_rows():
    import numpy as np

    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(0, 1, (3000, 4)) + 40 * rng.integers(0, 6, (3000, 1)))
    seen = []
    real = topk._scorer

    def counted(q, y):
        score = real(q, y)
        return lambda i, some: (seen.append(len(some)), score(i, some))[1]

    topk._scorer = counted
    try:
        d = topk.distances(x, x[:8]).astype(np.float32)
        list(topk._compare(d[:5], d, np.arange(5), x[:5], [None] * 5, np.arange(3000), x, 20))
    finally:
        topk._scorer = real
    assert sum(seen) < 5 * 3000


def test_only_blocks_that_may_matter_are_shipped(spark):
    """Clusters far from each other: a block of queries meets the blocks of its own cluster, not all."""
    from pyspark.sql import functions as F

    rng = random.Random(5)
    centres = [[rng.choice([-1.0, 1.0]) * 2 for _ in range(16)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, 0.02) for c in centres[i % 12]]) for i in range(1200)]
    shipped = []
    real = topk._pairs

    def counted(queries, candidates):
        pairs = real(queries, candidates)
        shipped.append((pairs.count(), queries.count() * candidates.count()))
        assert pairs.groupBy("dim", "asked", "block").count().where(F.col("count") > 1).isEmpty()
        return pairs

    topk._pairs = counted
    try:
        assert run(spark, rows, k=5, block_rows=40, query_step=5) == plain(rows, k=5, step=5)
    finally:
        topk._pairs = real
    (pairs, every), = shipped
    assert pairs < every / 3
