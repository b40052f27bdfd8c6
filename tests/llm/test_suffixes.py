import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lodestone.llm import queries, suffixes


def plain(rows, length):
    seen = Counter()
    data = [(d, (t or "").encode()) for d, t in rows]
    for _, b in data:
        seen.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, length=200, **options):
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, anchor string").repartition(3)
    return sorted(map(tuple, suffixes.remove_repeats(frame, length, **options).collect()), key=str)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.QUERIES["op8_suffix_array_dedup"](spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == plain(rows, 200)
    assert sum(r[2] for r in got) > 0


def mixed(seed, alphabet="abcé \0"):
    rng = random.Random(seed)
    passages = ["".join(rng.choice(alphabet) for _ in range(rng.randint(10, 60))) for _ in range(6)]
    return [(i, "".join(rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(0, 12)))) for i in range(60)]


@pytest.mark.parametrize("options", [{}, {"most_kinds": 2}, {"shard_bytes": 60}, {"shard_bytes": 500, "most_kinds": 8}])
def test_short_strings_in_all_paths(spark, options):
    rows = mixed(1) + [(100, "xy" * 40), (101, None), (102, ""), (102, ""), (103, "z" * 90), (104, "twin text of some length"), (104, "twin text of some length"), (None, "z" * 30)]
    assert run(spark, rows, 20, anchors=(8, 16, 20), **options) == plain(rows, 20)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_suffix_array_and_common_prefixes():
    rng = random.Random(2)
    found = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(20, 60))) for _ in range(15)]
    text = np.frombuffer(b"".join(found), np.uint8)
    sizes = np.array(list(map(len, found)))
    first = np.cumsum(sizes) - sizes
    ends = np.repeat(first + sizes, sizes)
    order, _, word = suffixes.suffix_array(text, ends, 64)
    whole = [text[i:ends[i]].tobytes() for i in range(len(text))]
    assert [whole[i] for i in order] == sorted(whole)
    shared = suffixes.common_prefixes(order, word, ends, first, sizes, 64)
    for before, i in zip(order, order[1:]):
        a, b = whole[before], whole[i]
        assert shared[i] == next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))


def test_merge_of_two_shards():
    one = suffixes.Shard([b"0123456789abcdef", b"qqqqwwwweeeerrrr"], np.array([9, 9]), 8)
    two = suffixes.Shard([b"zz456789abzzzzyy", b"wwwweeeeXXXXYYYY"], np.array([9, 9]), 8)
    suffixes.merge(one, np.array([0, 1]), two, np.array([0, 1]))
    assert one.ranges(0) == [(4, 5)] and one.ranges(1) == [(4, 5)]
    assert two.ranges(0) == [(2, 3)] and two.ranges(1) == [(0, 1)]


@pytest.mark.parametrize("copies", [1, 3])
def test_a_hot_passage_makes_no_more_rows_than_pieces(spark, copies):
    """One passage in ever changing surroundings, with whole copies beside it, dealt through all levels of anchors."""
    rng = random.Random(12)
    passage = "".join(rng.choices("abcdefgh ", k=150))
    texts = ["".join(rng.choices("abcdefgh ", k=60)) + passage + "".join(rng.choices("abcdefgh ", k=60)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts * copies)] + [(1000 + i, texts[0]) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    options = {"length": 100, "anchors": (20, 60, 100), "most_kinds": 8, "shard_bytes": 4000}
    got = sorted(map(tuple, suffixes.remove_repeats(docs, **options).collect()))
    assert got == sorted(plain(rows, 100))
    found = suffixes.repeated_starts(docs, **options)
    assert found.count() <= suffixes.pieces(docs, 100, 20).count()


def test_a_very_long_text(spark):
    """Longer than what is anchored at a time: a passage far apart in one text."""
    rng = random.Random(4)
    passage = "P" + "".join(rng.choices("abcdefghij", k=500)) + "Q"
    far = "".join(rng.choices("klmnopqrstuvwxyz", k=2_600_000))
    text = far[:1_300_000] + "1" + passage + "2" + far[1_300_000:] + "3" + passage + "4"
    got, = suffixes.remove_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string"), with_text=True).collect()
    assert (got.n_bytes, got.n_removed, got.n_spans) == (len(text), 2 * len(passage), 2)
    assert bytes(got.kept).decode() == text.replace(passage, "")
