import itertools
import zlib

import numpy as np

from lodestone.llm import langid, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
RU, EL = "это предложение на русском языке", "αυτή είναι μια ελληνική πρόταση"
EN, DE = "this is the english sentence that we want", "dieser satz ist auf deutsch und nicht lang"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in rows], SCHEMA)


def taught():
    lines = [(RU, "ru"), (EL, "el"), (EN, "en"), (DE, "de")]
    return [(i, lines[i % 4][0], lines[i % 4][1]) for i in range(80)]


def test_held_out_accuracy(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op1_language_id"](spark, "/root/testdata/sf0.01").collect()}
    rows = frame.select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if got[r.doc_id].held_out]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark):
    rows = taught()
    changed = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else lang) for i, t, lang in rows]
    a, b = (sorted(map(tuple, langid.identify(docs(spark, x)).collect())) for x in (rows, changed))
    assert a == b


def test_viterbi_against_every_path():
    rng = np.random.default_rng(4)
    text = np.repeat([0, 1, 2, 3], [5, 1, 6, 3])
    score = rng.normal(0, 2, (len(text), 3)).astype(np.float32)
    label = langid.viterbi(score, text, 1.5)

    def value(path, rows):
        return sum(rows[i][k] for i, k in enumerate(path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:]))

    for t in range(4):
        rows = score[text == t].astype(float)
        best = max(value(p, rows) for p in itertools.product(range(3), repeat=len(rows)))
        assert abs(value(label[text == t], rows) - best) < 1e-5


def test_spans_of_mixed_text(spark):
    model = langid.train(docs(spark, taught()))
    text = f"{EN}. {RU}! {DE}"
    (lang,), (score,), (spans,) = langid.predict([text], model, 3.0, spans=True)
    assert [s["lang"] for s in spans] == ["en", "ru", "de"]
    assert text[spans[1]["start"]:spans[1]["end"]] == RU
    assert lang in ("en", "de") and 0.3 < score < 0.5


def test_odd_rows(spark):
    model_rows = taught()
    odd = [(900, None, "en"), (901, "", None), (902, "12 34 !!", "en"), (903, "語", None), (904, EN, None), (904, EN, None), (None, DE, "de"), (905, (EN + " ") * 20000, None), (906, RU + " 123", "en")]
    got = langid.identify(docs(spark, model_rows + odd)).collect()
    assert len(got) == len(model_rows) + len(odd)
    by = {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id is None or r.doc_id >= 900}
    assert by[900] == by[901] == by[902] == ("und", 0.0)
    assert by[904] == by[905] == ("en", 1.0) and by[None] == ("de", 1.0) and by[906] == ("ru", 1.0)
    assert by[903][0] != "und"
    assert langid.identify(docs(spark, [])).count() == 0
    nothing = langid.identify(docs(spark, [(1, EN, None), (2, DE, None)])).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_rejected_rows_go(spark):
    frame = docs(spark, taught() + [(900, None, "en"), (901, "...", None), (902, EN, None)])
    kept = langid.identified(frame, langid.train(frame))
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {*range(80), 902}


def test_scripts_that_nothing_was_learned_of(spark):
    """Their letters speak for no language: the score tells it, and the pipeline's form drops such texts."""
    latin = [(i, EN if i % 2 else DE, "en" if i % 2 else "de") for i in range(80)]
    odd = [(900, RU, None), (901, "語 中文 日本", None), (902, f"{EN} {RU} {RU} {RU}", None), (903, f"{EN} {EN} 語", None)]
    frame = docs(spark, latin + odd)
    model = langid.train(frame)
    got = {r.doc_id: r for r in langid.identify(frame, model).collect()}
    assert got[900].score == got[901].score == 0 and got[900].lang_pred in ("en", "de")
    share = sum(map(str.isalpha, EN)) / sum(map(str.isalpha, f"{EN}{RU}{RU}{RU}"))
    assert got[902].lang_pred == "en" and abs(got[902].score - share) < 1e-9 and got[903].score > 0.9
    assert {r.doc_id for r in langid.identified(frame, model).collect()} == {*range(80), 903}


def test_predictions_against_plain_counting(spark):
    """Trigram counts, script shares, word scores and the best path of every text, all in plain Python."""
    import math
    import unicodedata

    rows = [(i, t, lang) for i, (t, lang) in enumerate([(EN, "en"), (DE, "de"), (RU, "ru"), (EN[5:], "en"), (DE[7:], "de")] * 8)]
    rows += [(500 + i, t, None) for i, t in enumerate(["the satz is", "dieser english", f"we {RU}", "nicht want lang it", "Das IST english"])]
    frame = docs(spark, rows)
    model = langid.train(frame)

    def split(text):
        out, word = [], ""
        for c in text + " ":
            if unicodedata.category(c).startswith("L"):
                word += c.lower()
            elif word:
                out.append(word)
                word = ""
        return out

    def bucket(gram):  # as the model hashes three letters (0 outside a word)
        x = sum(ord(c) * m if c else 0 for c, m in zip(gram, (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))) & 0xFFFFFFFF
        x ^= x >> 15
        return (x * 0x2C1B3C6D & 0xFFFFFFFF) >> (32 - langid.BUCKETS.bit_length() + 1)

    def grams(word):
        padded = ["", *word, ""]
        return [bucket(padded[i:i + 3]) for i in range(len(word))]

    counts = {}
    for i, t, lang in rows:
        if lang and zlib.crc32(str(i).encode()) % 5:
            for w in split(t):
                for g in grams(w):
                    counts.setdefault(lang, {}).setdefault(g, 0)
                    counts[lang][g] += 1
    names = sorted(counts)
    script = {"en": "latin", "de": "latin", "ru": "cyrillic"}

    def score(word, lang):
        total = sum(counts[lang].values()) + langid.SMOOTHING * langid.BUCKETS
        return sum(math.log((counts[lang].get(g, 0) + langid.SMOOTHING) / total) for g in grams(word))

    got = {r.doc_id: r for r in langid.identify(frame, model).collect()}
    for i, t, _ in rows:
        words = split(t)
        kind = ["cyrillic" if "а" <= w[0] <= "я" else "latin" for w in words]
        best = None
        for path in itertools.product(*[[n for n in names if script[n] == k] for k in kind]) if len(words) < 12 else []:
            value = sum(score(w, n) for w, n in zip(words, path)) - langid.SWITCH_PENALTY * sum(a != b for a, b in zip(path, path[1:]))
            if best is None or value > best[0] + 1e-6:
                best = (value, path)
        if best:
            letters = {n: sum(len(w) for w, p in zip(words, best[1]) if p == n) for n in names}
            assert got[i].score == max(letters.values()) / sum(letters.values()) and letters[got[i].lang_pred] == max(letters.values()), t
