import zlib

import numpy as np
from pyspark.sql import functions as F

from lodestone.llm import queries, toxicity

DOCS, LABELS = "doc_id long, text string, grade int", "doc_id long, quality int, toxic int"


def test_gradient_against_differences():
    rng = np.random.default_rng(3)
    sizes = rng.integers(0, 4, 30)
    flat, grade, weight = rng.integers(0, 5, sizes.sum()), rng.integers(0, 4, 30), rng.random(30)
    w, t = rng.normal(size=5), np.array([-1.0, 0.2, 1.5])

    def value(w, t):
        return toxicity.gradient(toxicity.Model(np.arange(5), w, t), flat, sizes, grade, weight)[2]

    by_weight, by_threshold, _ = toxicity.gradient(toxicity.Model(np.arange(5), w, t), flat, sizes, grade, weight)
    for i in range(5):
        e = 1e-5 * np.eye(5)[i]
        assert abs((value(w + e, t) - value(w - e, t)) / 2e-5 - by_weight[i]) < 1e-6
    for i in range(3):
        e = 1e-5 * np.eye(3)[i]
        assert abs((value(w, t + e) - value(w, t - e)) / 2e-5 - by_threshold[i]) < 1e-6


def test_probabilities_are_ordered():
    model = toxicity.Model(np.sort(toxicity.features("bad worse")), np.array([1.0, 2.0]), np.array([0.5, 1.0, 2.0]))
    p = model.probabilities(["", "bad", "bad worse", "fine words"])
    assert (np.diff(p, axis=1) < 0).all() and np.allclose(p[0], p[3]) and (p[2] > p[1]).all()


def test_long_texts_are_read_whole(monkeypatch):
    monkeypatch.setattr(toxicity, "PIECE", 7)
    text = "one twoandmore three four " * 3 + "last"
    assert set(toxicity.features(text)) == set(np.concatenate([toxicity.features(w) for w in set(text.split())]))


def test_labelled_documents(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op4_toxicity_severity"](spark, "/root/testdata/sf0.01").collect()}
    docs = {r.doc_id: r.text.lower() for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()}
    assert set(got) == set(docs)
    insults = ("idiot", "moron", "scum", "worthless", "trash")
    insulting = {d for d, t in docs.items() if sum(w in t for w in insults) >= 2}
    flagged = {d for d, r in got.items() if r.toxic}
    assert insulting and len(insulting - flagged) <= 0.1 * len(insulting)
    clean = {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("toxic = 0").collect()}
    assert len(clean & flagged) <= 0.02 * len(clean)
    for r in got.values():
        assert 0 <= r.expected_severity <= 2 and r.grade in (0, 1, 2) and r.toxic == (r.toxic_probability >= 0.5) == (r.grade > 0)


def test_odd_rows(spark):
    clean = [(i, f"plain words number of text {i} here", 7) for i in range(400, 800)]
    toxic = [(100 + i, f"you vile wretch of text {i}" + " and nasty fool" * (i % 2), 7) for i in range(60)]
    odd = [(300, None, 7), (301, "", 7), (302, "vile nasty wretch fool", 7), (302, "vile nasty wretch fool", 7), (None, "vile nasty wretch fool", 7), (303, "word " * 30000, 7)]
    docs = spark.createDataFrame(clean + toxic + odd, DOCS)
    labels = spark.createDataFrame([(d, 1, 0) for d, _, _ in clean] + [(d, 0, 1) for d, _, _ in toxic] + [(400, None, None), (None, 1, 1), (999, 1, 1), (405, 1, 7), (300, 1, 1)], LABELS)
    model = toxicity.fit(docs, labels)
    rows = toxicity.severity(docs, model).collect()
    assert len(rows) == 466
    by = {r.doc_id: r for r in rows}
    assert by[302].toxic and by[None].toxic and not by[300].toxic and not by[301].toxic and not by[303].toxic
    assert by[302].expected_severity > by[100].expected_severity > by[400].expected_severity
    assert toxicity.severity(docs.limit(0), model).count() == 0
    for none in (labels.limit(0), labels.where("toxic = 0")):
        blank = toxicity.fit(docs, none, steps=2)
        assert not any(r.toxic for r in toxicity.severity(docs, blank).collect())


def test_beginnings_and_repeated_words():
    def hashed(*names):
        return {zlib.crc32(n.encode()) for n in names}

    got = set(toxicity.all_features("Vilest vilely no no").tolist())
    assert got == hashed("vilest", "vilely", "no", "no+", "^vil", "^vil+", "^vile", "^vile+", "^viles", "^vilel", "^vilest", "^vilely")


def test_words_that_never_recur_are_told_by_their_beginnings(spark):
    def word(i):
        return "".join(chr(97 + i // 26**k % 26) for k in range(4))

    # toxic: two words that begin alike, none of them ever again; clean: one of them at most
    docs = spark.createDataFrame([(i, f"texte simple {word(i)} réeux{word(i)}" + (f" réeux{word(i + 5000)}" if i % 5 == 0 else f" autre{word(i)}"), 0) for i in range(800)], DOCS)
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(0, 400)], LABELS)
    got = {r.doc_id: r.toxic for r in toxicity.severity(docs, toxicity.fit(docs, labels)).collect()}
    assert {i for i in range(400, 800) if got[i]} == set(range(400, 800, 5))


def test_held_out_documents_by_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = toxicity.fit(docs, labels.where(~held))
    rest = docs.join(labels.where(held).select("doc_id", F.col("toxic").alias("label")), "doc_id")
    found = toxicity.severity(rest, model).select("doc_id", F.col("toxic").alias("flagged")).join(rest.select("doc_id", "lang", "label"), "doc_id")
    by = {(r.lang, r.label): (r.n, r.flagged) for r in found.groupBy("lang", "label").agg(F.count("*").alias("n"), F.count_if("flagged").alias("flagged")).collect()}
    for lang in ("en", "fr", "de", "es"):
        (n, right), (clean, wrong) = by[lang, 1], by[lang, 0]
        assert right >= 0.75 * n and wrong <= 0.02 * clean, (lang, by)
    print(sorted(by.items()))


def test_severity_against_plain_python(spark):
    """Features, scores and expected grades of every text, computed word by word."""
    import math
    import re

    texts = [None, "", "Bad bad WORDS badly said", "fine words here", "worse worst worsen", "bad worse", "a b c", "ünfein Bad-bad"]

    def named(text):
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        out = set(words) | {w + "+" for w in words if words.count(w) > 1}
        for k in (3, 4, 5, 6):
            starts = [w[:k] for w in set(words) if len(w) >= k]
            out |= {"^" + p for p in starts}
            out |= {"^" + p + "+" for p in starts if starts.count(p) > 1 or any(w[:k] == p and words.count(w) > 1 for w in words)}
        return out

    weights = {"bad": 1.5, "bad+": 0.7, "^wor": 0.4, "^wor+": 0.9, "^worse": -0.3, "fine": -1.0, "ünfein": 0.2}
    hashes = {zlib.crc32(w.encode()): v for w, v in weights.items()}
    order = sorted(hashes)
    thresholds = [0.5, 1.25, 3.0]
    model = toxicity.Model(np.array(order), np.array([hashes[h] for h in order]), np.array(thresholds))
    got = {r.doc_id: r for r in toxicity.severity(spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], DOCS), model).collect()}
    for i, t in enumerate(texts):
        score = sum(v for w, v in weights.items() if w in named(t))
        p = [1 / (1 + math.exp(c - score)) for c in thresholds]
        assert abs(got[i].expected_severity - sum(p)) < 1e-9 and abs(got[i].toxic_probability - p[0]) < 1e-9
        assert got[i].grade == sum(x >= 0.5 for x in p) and got[i].toxic == (p[0] >= 0.5)


def test_fit_against_a_search_of_all_parameters(spark):
    """One feature and two thresholds: the fitted likelihood is that of the best point of a fine grid."""
    rng = np.random.default_rng(6)
    held = rng.random(600) < 0.4
    chance = np.where(held, 0.8, 0.2)
    grade = (rng.random(600) < chance).astype(int) + (rng.random(600) < chance * 0.5).astype(int)
    rows = spark.createDataFrame([(int(g), 1.0, [0] if h else []) for g, h in zip(grade, held)], "grade int, weight double, at array<long>").repartition(2)
    model = toxicity.descend(rows, np.array([7]), [float((grade == g).sum()) for g in range(3)])

    def loss(w, t):
        sizes = held.astype(int)
        return toxicity.gradient(toxicity.Model(np.array([7]), np.array([w]), np.array(t)), np.zeros(sizes.sum(), int), sizes, grade, np.ones(600))[2]

    best = min(loss(w, (a, a + d)) for w in np.arange(0, 5, 0.25) for a in np.arange(-1, 3, 0.2) for d in np.arange(0.2, 4, 0.2))
    assert loss(float(model.weights[0]), model.thresholds) <= best * 1.002 and (np.diff(model.thresholds) > 0).all()
