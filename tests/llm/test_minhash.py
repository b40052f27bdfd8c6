import random

import numpy as np
import pytest

from lodestone.llm import minhash

SCHEMA = "doc_id long, text string, kept string"


def sets_of(text):
    w = text.encode().lower().split()
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()


def plain(rows):
    sets = [sets_of(t or "") for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = []
    for i, (d, _) in enumerate(rows):
        least = min((rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None), default=None)
        out.append((d, len(sets[i]), least, d == least))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, minhash.near_duplicates(df, **options).collect()), key=str)


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        i = rng.randrange(len(words))
        words[i:i + rng.randint(0, 1)] = [rng.choice("pqrst") * rng.randint(1, 9)] * rng.randint(0, 2)
    return " ".join(words)


def documents(seed=5, groups=12, copies=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([5, 20, 60, 150, 150, 400]))]
        rows += [(len(rows) + k, changed(rng, base, rng.randint(0, max(1, len(base) // 15)))) for k in range(copies)]
    odd = [None, "", " \t\n", "a", "A", "a b", "b a", "A  b", "a b c", "a b c a b c", "É é", "x\x0by\x0cz\x1c"]
    rows += [(10_000 + i, t) for i, t in enumerate(odd)]
    return rows + [(None, "a b"), (None, "lonely words of no one"), (3, rows[3][1]), rows[4], rows[4]]


def test_against_brute_force(spark):
    rows = documents()
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("options", [{"most_in_group": 6}, {"most_words": 300, "levels": 0}])
def test_large_groups_are_posted_again_by_their_differences(spark, options):
    """One base with variants at all distances, in groups that may hold only a few documents; then all in pairs of blocks."""
    rng = random.Random(1)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = [(i, changed(rng, base, rng.randint(0, 7))) for i in range(90)]
    second = changed(rng, base, 9).split()  # many of these are linked with each other, none with the first base
    rows += [(200 + i, changed(rng, second, rng.randint(0, 2))) for i in range(30)]
    assert run(spark, rows, **options) == plain(rows)


def test_members_far_from_the_centre_are_not_lost(spark):
    """Chains of texts, each like the next and none like the one after: the centre of a group is far from most of it."""
    rng, rows = random.Random(4), []
    words = [f"w{rng.randrange(2000)}" for _ in range(200)]
    for i in range(60):
        rows.append((i, " ".join(words)))
        at = rng.randrange(180)
        words[at:at + 9] = [f"n{i}x{k}" for k in range(9)]
    want = plain(rows)
    assert run(spark, rows, most_in_group=4, levels=1) == want


def test_copies_are_one_class(spark):
    rows = [(i, "the same words " * 20) for i in range(500)] + [(600, "The  same\nwords " * 20), (601, "the same words " * 20 + "more")]
    assert run(spark, rows) == plain(rows)


def test_a_very_long_text(spark):
    rng = random.Random(8)
    long = [f"w{rng.randrange(3000)}" for _ in range(300_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:290_000])), (3, " ".join(long[:200_000])), (4, " ".join(long[1000:]))]
    assert run(spark, rows) == plain(rows)


def test_sets_are_made_of_words():
    texts = [b"a b c a b c", b"b c a", b"a b", b"a b", b"a", b"", b"A B c", b"x y z w"]
    sets = minhash.Sets(texts)
    want = [sets_of(t.decode()) for t in texts]
    assert sets.sizes.tolist() == [len(w) for w in want]
    for i, w in enumerate(want):
        assert sets.shared(i, np.arange(len(texts))).tolist() == [len(w & o) for o in want]


def test_lower_similarities_are_refused(spark):
    with pytest.raises(ValueError):
        run(spark, [(1, "a b c")], least=80)
