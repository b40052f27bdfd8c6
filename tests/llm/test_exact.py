import hashlib
import random

import pytest

from lodestone.llm import exact

SCHEMA = "doc_id long, text string, recipe string"


def plain(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for t, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        left = 1
        for d in ids:
            kept = d == keep and left > 0
            left -= kept
            out.append((d, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **options):
    return sorted(map(tuple, exact.exact_groups(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3), **options).collect()), key=str)


def documents():
    rng = random.Random(6)
    long = ["".join(rng.choice("abcdé \n") for _ in range(rng.randint(0, 60000))) for _ in range(12)]
    rows = [(i, rng.choice(long)) for i in range(40)]
    rows += [(50, None), (51, ""), (52, None), (53, long[0] + "x"), (54, "x" + long[0]), (55, "a"), (55, "a"), (None, "a"), (None, "only"), (56, "x" * 100000), (57, "x" * 100000)]
    return rows


def test_against_brute_force(spark):
    assert run(spark, documents()) == plain(documents())


def test_empty_table(spark):
    assert run(spark, []) == []


def test_wider_identifiers_where_narrow_ones_clash(spark):
    rows = [(i, f"text number {i % 300}") for i in range(600)]
    assert run(spark, rows, widths=(1, 2, 16)) == plain(rows)
    with pytest.raises(RuntimeError):
        run(spark, rows, widths=(1,))


def test_cuts_follow_content():
    rng = random.Random(2)
    text = bytes(rng.randrange(97, 123) for _ in range(200000))
    ends = exact.cut_points(text)
    assert ends[-1] == len(text) and all(0 < b - a <= exact.MOST for a, b in zip([0, *ends], ends))
    shifted = exact.cut_points(b"some words before " + text)
    assert len({e - 18 for e in shifted} & set(ends)) > len(ends) / 2
