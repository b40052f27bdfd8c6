import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from lodestone.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, " \n\t", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>C", "İstanbul ΣΑΣ ΟΔΥΣΣΕΥΣ", "é x y",
       "日本語 テスト 😀😀", "it's we'll I'M o'clock", "\x1c a\x85b\x0bc", "1234 ½ ²", "ﬁ ǅ ẞ ß", "x" * 5000, "na " * 40000]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def plain(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def encode(text):
    (ids,) = bpe.encoder(bpe.vocabulary(PATH)).encode([text])
    return ids.tolist()


def test_random_texts_as_the_library(library):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é'<|>sStTreE1 \n日😀́Σς İ\x1f") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    for text in texts:
        assert encode(text) == plain(library, text)[0]
    own = bpe.encoder(bpe.vocabulary(PATH))
    for text, ids in zip(texts, own.encode(texts)):
        assert (ids.tolist(), own.tokenizer.decode(ids)) == plain(library, text)


def test_words_one_by_one_and_many(library):
    own, rng = bpe.tokenizer(bpe.vocabulary(PATH)).automaton, random.Random(2)
    words = ["".join(rng.choice("thereandingxyzéß7") for _ in range(rng.randint(1, 20))).encode() for _ in range(800)]
    ids, ends = own.encode_many(words)
    assert [f.tolist() for f in np.split(ids, ends[:-1])] == [own.encode(w) for w in words]


def test_tables_may_be_emptied(library, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_STATES", 50)
    monkeypatch.setattr(bpe, "MOST_RUNS", 4)
    own = bpe.Encoder(bpe.Tokenizer(bpe.vocabulary(PATH)))
    texts = ["the quick brown foxes jumped", "over thoroughly unreasonable", "the hedgerows it's", "the quick"] * 2
    assert [own.encode([t])[0].tolist() for t in texts] == [plain(library, t)[0] for t in texts]


def test_long_texts_in_pieces(library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 30)
    text = "it's a long text <|endoftext|> cut é anywhere\nat white space, " * 20 + "y" * 100 + " 日本 end"
    assert encode(text) == plain(library, text)[0]


def test_a_small_automaton_by_hand():
    marks = {c: i for i, c in enumerate(bpe._byte_chars())}
    vocab = {**marks, "aa": 256, "aab": 257}
    automaton = bpe.Automaton(vocab, [("a", "a"), ("aa", "b")])
    a, b = marks["a"], marks["b"]
    assert not automaton.arc(a, a) and automaton.arc(256, a) and not automaton.arc(256, b) and automaton.arc(257, 256)
    assert automaton.encode(b"aaaab") == [256, 257] and automaton.encode(b"aaab") == [256, a, b]


def test_query_and_round_trip(spark, library):
    got = {r.doc_id: r for r in queries.QUERIES["op5_bpe_tokenization"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, text = plain(library, d.text)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_odd_rows(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, "no id", "x"), (0, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = bpe.encode(docs, PATH)
    got = sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=str)
    assert got == sorted(((d, plain(library, t)[0]) for d, t, _ in rows), key=str)
    back = sorted(((r.doc_id, r.text) for r in bpe.decode(encoded, PATH).collect()), key=str)
    assert back == sorted(((d, plain(library, t)[1]) for d, t, _ in rows), key=str)
    digests = sorted(((r.doc_id, r.n_tokens, r.ids_sha256) for r in bpe.digests(docs, PATH).collect()), key=str)
    assert digests == sorted(((d, len(i := plain(library, t)[0]), hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest()) for d, t, _ in rows), key=str)
    assert bpe.digests(docs.limit(0), PATH).count() == 0
