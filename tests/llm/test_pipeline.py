import random
import re

import corpus_pipeline
import pytest

from . import test_lines, test_packing, test_simhash, test_suffixes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        kept = spark.read.parquet(f"{folder}/{name}")
        out.append((docs, kept))
        docs = kept
    return dict(zip([name for name, _ in corpus_pipeline.STAGES], out))


def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def test_columns(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    for name, (_, kept) in list(stages.items())[:-1]:
        assert kept.columns == columns, name
        assert kept.where("n_chars <> length(text)").count() == 0


def test_language_id_keeps_what_has_a_language(stages):
    before, after = map(texts, stages["language_id"])
    gone = set(before) - set(after)
    assert all(after[d] == before[d] for d in after) and len(gone) <= 0.01 * len(before)


def test_duplicate_lines(stages):
    before, after = map(texts, stages["line_dedup"])
    kept = test_lines.plain(list(before.items()))
    want = {}
    for d, t in before.items():
        split = t.split("\n")
        stay = [line for i, line in enumerate(split) if i in kept[d] or not test_lines.words(line)]
        if kept[d] or not t.strip():
            want[d] = "\n".join(stay)
    assert after == want


def test_simhash_near_dedup(stages):
    before, after = map(texts, stages["simhash_near_dedup"])
    groups = test_simhash.plain_groups(list(before.items()))
    assert after == {d: t for d, t in before.items() if groups[d][1] == d}


def test_repeated_bytes(stages):
    before, after = map(texts, stages["suffix_array_dedup"])
    removed = {r[0]: r for r in test_suffixes.plain(list(before.items()), 200)}
    for d, t in before.items():
        _, _, n_removed, _, digest = removed[d]
        if not n_removed:
            assert after[d] == t
        elif d in after:
            assert len(after[d].encode()) <= len(t.encode()) - n_removed
            if len(after[d].encode()) == len(t.encode()) - n_removed:
                import hashlib
                assert hashlib.sha256(after[d].encode()).hexdigest() == digest
        else:
            assert n_removed > 0


def test_all_ids_are_packed(stages):
    before, pieces = stages["packing"]
    assert test_packing.check(pieces.collect(), list(texts(before).items()), 2048) == 0


def test_run_is_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages["packing"][1].columns
    total = "sum(length) AS n, count(DISTINCT doc_id) AS d"
    assert got.selectExpr(*re.split(", (?=count)", total)).first() == stages["packing"][1].selectExpr(*re.split(", (?=count)", total)).first()


def test_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a text without an id", "en", "s", 20), (3, "some english words here", "en", "s", 23), (3, "some english words here", "en", "s", 23)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert {r.doc_id for r in docs.collect()} == ({None, 3} if data else set())


def test_repeated_rows_and_ids(spark):
    rng = random.Random(9)
    a, b, c, d = (" ".join("".join(rng.choices("etaoinshrdlu", k=7)) for _ in range(50)) for _ in range(4))
    rows = [(1, a), (1, a), (None, b), (None, b), (5, c), (5, d)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert sorted((r.doc_id or 0, r.text) for r in docs.collect()) == sorted([(1, a), (0, b), (5, c), (5, d)])


def test_clashing_names_and_a_very_long_text(spark):
    """Further columns named like the stages' own come through; a text longer than any batch is handled whole."""
    rng = random.Random(2)
    long = "\n".join(" ".join(rng.choices(["some", "english", "words", "that", "differ", str(rng.random())], k=12)) for _ in range(30_000))
    rows = [(1, long, 1, "a", 2, "x"), (2, "a short english text about words", 3, "b", 4, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int, row string, component_id int, text_hash string")
    from lodestone.llm import langid, lines, simhash, suffixes

    train = spark.createDataFrame([(i, "some english words that differ about a short text", "en") for i in range(10)], "doc_id long, text string, lang string")
    model = langid.train(train)
    for stage in (lambda d: langid.identified(d, model), lines.without_duplicates, simhash.keep_one, suffixes.without_repeats):
        after = stage(docs)
        assert after.columns == docs.columns
        assert sorted(after.drop("text").collect()) == sorted(docs.drop("text").collect())
        assert stage(docs.limit(0)).count() == 0
    assert {r.doc_id: len(r.text) for r in langid.identified(docs, model).collect()} == {1: len(long), 2: len(rows[1][1])}
