import random

import numpy as np
import pytest
import xxhash

from lodestone.llm import common, simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, most=3):
    fps = {d: plain_fingerprint(t) for d, t in rows}
    distinct = sorted(set(fps.values()))
    up = {f: f for f in distinct}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= most:
                up[root(a)] = root(b)
    least = {}
    for d, f in fps.items():
        least[root(f)] = min(d, least.get(root(f), d))
    return {d: (f"{f:016x}", least[root(f)]) for d, f in fps.items()}


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = plain_groups([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == want
    assert len({c for _, c in got.values()}) < len(got)


def test_links_with_crowded_buckets(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    codes = set(base)
    for b in base[:6]:
        for _ in range(120):
            codes.add(b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(1, 5))))
    codes = sorted(codes)
    signed = [simhash._signed(c) for c in codes]
    found = simhash.links(frame(spark, [(c,) for c in signed], "fp long"), 3, most_in_bucket=20).collect()
    mask = (1 << 64) - 1

    def parts(edges):
        up = {c: c for c in signed}

        def root(c):
            while up[c] != c:
                c = up[c]
            return c

        for a, b in edges:
            up[root(a)] = root(b)
        groups = {}
        for c in signed:
            groups.setdefault(root(c), set()).add(c)
        return sorted(map(sorted, groups.values()))

    every = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & mask).bit_count() <= 3]
    assert parts([(r.u, r.v) for r in found]) == parts(every)


def test_index_prunes_and_finds_all():
    rng = np.random.default_rng(5)
    codes = np.sort(rng.integers(0, 1 << 12, 400, dtype=np.uint64))
    index = simhash.GrayIndex(codes, np.zeros(400, np.int64))
    q, leaf = index.search(np.arange(400), np.zeros(400, np.int64), 2)
    want = {(i, j) for i in range(400) for j in range(i + 1, 400) if int(codes[i] ^ codes[j]).bit_count() <= 2}
    assert set(zip(q.tolist(), leaf.tolist())) == want


@pytest.mark.parametrize("text", [None, "", "one", "One two", "a b c", "\x1c a\x0bb c d", "x " * 5000])
def test_fingerprint_of_odd_texts(text):
    assert simhash.fingerprint((text or "").encode()) & ((1 << 64) - 1) == plain_fingerprint(text)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(5, None, 1), (3, "", 2), (9, " \n", 3), (4, "alpha beta gamma delta", 4), (4, "alpha beta gamma delta", 4), (7, "ALPHA beta  gamma delta", 5), (None, "lonely text of its own kind", 6)]
    docs = frame(spark, rows, "doc_id long, text string, component_id int")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (4, 4), (4, 4), (7, 4), (None, None)], key=str)
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(201, 200), (201, 201)]
    got = {r.node: r.component for r in common.components(frame(spark, edges, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(5)
    a, b, c, d, e = (" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(60)) for _ in range(5))
    long = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(2000)]
    near = " ".join(["other", *long[1:]])
    long = " ".join(long)
    assert 0 < (plain_fingerprint(long) ^ plain_fingerprint(near)).bit_count() <= 3
    rows = [(1, a), (1, a), (None, b), (None, b), (None, b.upper()), (5, c), (2, c), (5, d), (None, d), (7, e), (None, long), (None, near), (8, None), (None, ""), (None, None)]
    got = sorted((r.doc_id or 0, r.text or "") for r in simhash.keep_one(frame(spark, rows)).collect())
    of_b, of_long = [t for i, t in got if t in (b, b.upper())], [t for i, t in got if t in (long, near)]
    assert len(of_b) == len(of_long) == 1
    assert got == sorted([(1, a), (0, of_b[0]), (2, c), (5, d), (7, e), (0, of_long[0]), (8, "")])
    assert simhash.keep_one(frame(spark, [])).count() == 0
