import math
import random

import numpy as np

from lodestone.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n string"


def run(spark, rows, **options):
    return whitening.whitened(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3), **options).collect()


def plain(rows, most=8):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.floor(1024 * np.array([v for _, v in kept], np.float32).astype(float)) + 100_000
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:most]
    exact = x.astype(object).astype(int).astype(object)
    deviations = [sum((n * a - t) ** 2 for a, t in zip(row, exact.sum(axis=0))) for row in exact]
    return [i for i, _ in kept], deviations, centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def check(got, rows, most=8):
    ids, deviations, white, explained = plain(rows, most)
    k = white.shape[1]
    assert len(got) == len(ids) * k and {r.n for r in got} == {len(ids)}
    assert {r.identity_error for r in got}.__len__() == 1 and got[0].identity_error < 1e-9
    table = {}
    for r in got:
        table.setdefault((r.vec_id, r.component), []).append((r.deviation, r.whitened, r.explained))
    sign = None
    for c in range(k):
        mine = sorted((i, d, w) for i in set(ids) for d, w, _ in table[(i, c + 1)])
        for sign in (1, -1):
            want = sorted((i, d, sign * float(w)) for i, d, w in zip(ids, deviations, white[:, c]))
            if all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-7 for a, b in zip(mine, want)):
                break
        else:
            raise AssertionError(f"component {c + 1}")
        assert abs(table[(ids[0], c + 1)][0][2] - explained[c]) < 1e-9


def vectors(n, d, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1 + k % 5) / 5 for k in range(d)]) for i in range(n)]


def test_against_numpy(spark):
    rows = vectors(300, 12)
    odd = [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf"), *[0.0] * 11]), (904, []), (905, [1.0, 2.0])]
    check(run(spark, rows + odd), rows)


def test_more_rows_than_a_block_and_repeats(spark):
    rows = vectors(2600, 5)
    rows += [rows[7]] * 40
    check(run(spark, rows), rows)


def test_fewer_dimensions_than_components(spark):
    rows = vectors(50, 3)
    check(run(spark, rows), rows)


def test_empty_table_and_nothing_left(spark):
    assert run(spark, []) == [] and run(spark, [(1, None), (2, [])]) == []
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).columns[:4] == ["vec_id", "component", "n", "deviation"]


def test_no_variance(spark):
    got = run(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (None, [0.5, 0.25])])
    assert len(got) == 6 and {(r.whitened, r.explained, r.identity_error, r.deviation) for r in got} == {(None, None, None, 0)}


def test_a_component_without_variance_has_no_values(spark):
    rows = [(i, [v[0], 2 * v[0], v[1]]) for i, v in vectors(60, 2)]
    rows = [(i, [math.floor(c * 8) / 8 for c in v[:1]] + [2 * math.floor(v[0] * 8) / 8, v[2]]) for i, v in rows]
    got = run(spark, rows)
    assert {r.component for r in got if r.whitened is None} == {3} and got[0].identity_error < 1e-9


def test_query_over_its_table(spark):
    from lodestone.llm import queries

    got = queries.QUERIES["op12_embedding_whitening"](spark, "/root/testdata/sf0.001").collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(got, rows)
