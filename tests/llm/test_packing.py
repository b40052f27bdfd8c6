import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from lodestone.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(pieces, docs, capacity):
    """Every id in one piece, sequences gapless and of an allowed size; returns the padding."""
    library = tokenizers.Tokenizer.from_file(PATH)
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 1] for d, t in docs}
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        of_doc[p.doc_id].append((p.start, p.length))
        of_sequence[p.sequence_id].append((p.offset, p.length))
        own = ids[p.doc_id][p.start:p.start + p.length]
        assert p.length == len(own) > 0 and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
    for d, found in of_doc.items():
        at = 0
        for start, n in sorted(found):
            assert start == at
            at += n
        assert at == len(ids[d])
    assert set(of_doc) == set(ids)
    padding = 0
    for found in of_sequence.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    pieces = queries.QUERIES["op7_packing"](spark, "/root/testdata/sf0.01").collect()
    assert check(pieces, docs, 2048) == 0
    assert len(pieces) < 1.6 * sum(1 for _ in docs) + sum(p.doc_tokens // 2048 for p in pieces if p.start == 0)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, ""), (2, "a b c"), (3, "word " * 100)], [(i, "same text") for i in range(40)], [(7, "x " * 15), (8, "y " * 31), (9, "z " * 64)]])
def test_small_tables(spark, rows):
    frame = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, length int").repartition(3)
    assert check(packing.pack(frame, PATH, capacity=16).collect(), rows, 16) == 0


def test_repeated_and_null_ids(spark):
    frame = spark.createDataFrame([(1, "a b")] * 3 + [(None, "c d e")] * 2, "doc_id long, text string")
    pieces = packing.pack(frame, PATH, capacity=8, with_ids=True).collect()
    assert sum(p.length for p in pieces) == 3 * 3 + 2 * 4
    assert all(len(p.ids) == 4 * p.length for p in pieces)
    assert len({(p.sequence_id, p.offset) for p in pieces}) == len(pieces)


def test_prices_against_brute_force():
    lengths, value = np.array([3, 4, 7]), np.array([0.3, 0.45, 0.7])
    best, _ = packing.price(value, lengths, 15)
    for c in range(16):
        assert best[c] == pytest.approx(max(a * 0.3 + b * 0.45 + d * 0.7 for a in range(6) for b in range(4) for d in range(3) if 3 * a + 4 * b + 7 * d <= c))


def test_linear_program_reaches_the_optimum():
    # 9 of length 5, 9 of length 7, 9 of length 4 in 16: 5+7+4 fills it, so 9 sequences
    found, bound = packing.column_generation(np.array([4, 5, 7]), np.array([9.0, 9, 9]), 16)
    assert sum(v for _, v in found) == pytest.approx(9, rel=1e-4) and bound == pytest.approx(9, rel=1e-4)
    for n in (4, 5, 7):
        assert sum(p.get(n, 0) * v for p, v in found) == pytest.approx(9, rel=1e-4)


@pytest.mark.parametrize("capacity,documents,seed", [(64, 500, 1), (256, 3000, 2), (2048, 900, 3)])
def test_most_remainders_come_through_patterns(capacity, documents, seed):
    """Nearly all remainders are placed whole, every place is used once, and there are hardly more sequences than tokens need."""
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.lognormal(np.log(capacity / 6), 0.9, documents).astype(int) + 1, capacity - 1)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    layout, cover = packing.plan(histogram, capacity), defaultdict(list)
    for length, n in histogram.items():
        for rank in range(n):
            pieces = layout.place(length, rank)
            assert sum(p[1] for p in pieces) == length
            for _, size, sequence, offset in pieces:
                cover[sequence].append((offset, size))
    for own in cover.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at == capacity or at & (at - 1) == 0 and at < capacity
    assert len(cover) == layout.sequences <= lengths.sum() / capacity + capacity.bit_length()
    assert layout.placed.sum() >= 0.95 * documents


def test_first_basis_is_inverted_by_substitution():
    rng = np.random.default_rng(5)
    lengths = np.unique(rng.integers(1, 200, 60))
    patterns, _, order = packing.first_patterns(lengths, rng.integers(1, 50, len(lengths)).astype(float), 256)
    row = {int(n): i for i, n in enumerate(lengths)}
    basis = np.zeros((len(lengths), len(lengths)))
    for k, p in enumerate(patterns):
        basis[[row[n] for n in p], k] = list(p.values())
    assert np.allclose(packing._inverse(patterns, row, order) @ basis, np.eye(len(lengths)))


def test_a_very_long_text(spark):
    rows = [(1, "many words of a long text " * 60_000), (2, "short")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert check(packing.pack(frame, PATH).collect(), rows, 2048) == 0
