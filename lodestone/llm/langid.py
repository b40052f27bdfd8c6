"""Language identification of whole texts, with labelled spans for mixed ones.

*Model.*  Per language, smoothed log-probabilities of letter trigrams inside
words (hashed into ``BUCKETS``), counted on a sample of the labelled training
rows of at most about ``SAMPLE`` rows a language, and the scripts that hold at
least ``SCRIPT_SHARE`` of the language's letters.

*Prediction.*  A word's script narrows its candidates to the languages that use
the script; their scores are the sums of the word's trigrams.  Viterbi over the
words, with a fixed penalty for a switch of language, labels each word; runs of
one label are spans.  The text's language has the most letters, and the score
is its share of them.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

BUCKETS, SAMPLE, SCRIPT_SHARE = 1 << 16, 4000, 0.02
SWITCH_PENALTY, SMOOTHING = 12.0, 0.5
FOLDS = 5
UNKNOWN = "und"

# Code ranges of scripts in the Unicode standard (first, last, script).
SCRIPTS = [
    (0x0041, 0x024F, "Latin"), (0x0250, 0x02AF, "Latin"), (0x1E00, 0x1EFF, "Latin"), (0x2C60, 0x2C7F, "Latin"), (0xA720, 0xA7FF, "Latin"),
    (0xFF21, 0xFF5A, "Latin"), (0x0370, 0x03FF, "Greek"), (0x1F00, 0x1FFF, "Greek"), (0x0400, 0x052F, "Cyrillic"), (0x1C80, 0x1C8F, "Cyrillic"),
    (0x2DE0, 0x2DFF, "Cyrillic"), (0xA640, 0xA69F, "Cyrillic"), (0x0530, 0x058F, "Armenian"), (0x0590, 0x05FF, "Hebrew"), (0x0600, 0x06FF, "Arabic"),
    (0x0750, 0x077F, "Arabic"), (0x08A0, 0x08FF, "Arabic"), (0xFB50, 0xFDFF, "Arabic"), (0xFE70, 0xFEFF, "Arabic"), (0x0900, 0x097F, "Devanagari"),
    (0x0980, 0x09FF, "Bengali"), (0x0A00, 0x0A7F, "Gurmukhi"), (0x0A80, 0x0AFF, "Gujarati"), (0x0B00, 0x0B7F, "Oriya"), (0x0B80, 0x0BFF, "Tamil"),
    (0x0C00, 0x0C7F, "Telugu"), (0x0C80, 0x0CFF, "Kannada"), (0x0D00, 0x0D7F, "Malayalam"), (0x0D80, 0x0DFF, "Sinhala"), (0x0E00, 0x0E7F, "Thai"),
    (0x0E80, 0x0EFF, "Lao"), (0x0F00, 0x0FFF, "Tibetan"), (0x1000, 0x109F, "Myanmar"), (0x10A0, 0x10FF, "Georgian"), (0x1100, 0x11FF, "Hangul"),
    (0x3130, 0x318F, "Hangul"), (0xAC00, 0xD7AF, "Hangul"), (0x1200, 0x139F, "Ethiopic"), (0x1780, 0x17FF, "Khmer"), (0x1800, 0x18AF, "Mongolian"),
    (0x3040, 0x309F, "Kana"), (0x30A0, 0x30FF, "Kana"), (0x31F0, 0x31FF, "Kana"), (0x2E80, 0x2FDF, "Han"), (0x3400, 0x4DBF, "Han"),
    (0x4E00, 0x9FFF, "Han"), (0xF900, 0xFAFF, "Han"), (0x20000, 0x323AF, "Han"),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(s for _, _, s in SCRIPTS)]


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each code point: whether it is a letter, its one-character lower case, its script."""
    letter = np.zeros(0x110000, bool)
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x32400):
        c = chr(i)
        if c.isalpha():
            letter[i] = True
            small = c.lower()
            if len(small) == 1:
                lower[i] = ord(small)
    script = np.zeros(0x110000, np.uint8)
    for first, last, name in SCRIPTS:
        script[first:last + 1] = SCRIPT_NAMES.index(name)
    return letter, lower, script


@dataclass
class Words:
    """The words (runs of letters) of a batch of texts."""

    bucket: np.ndarray  # of each letter's trigram
    start: np.ndarray  # of each word, in letters
    length: np.ndarray
    place: np.ndarray  # of each word, in code points of the joined texts
    script: np.ndarray
    text: np.ndarray  # the text of each word
    offset: np.ndarray  # of each text, in code points


def words_of(texts: list[str]) -> Words:
    letter, lower, script = _tables()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    offset = np.cumsum(sizes + 1) - sizes - 1
    code = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
    is_letter = letter[code]
    at = np.flatnonzero(is_letter)
    small = np.where(is_letter, lower[code], np.uint32(0))
    padded = np.concatenate([[np.uint32(0)], small, [np.uint32(0)]])
    bucket = padded[at] * np.uint32(0x9E3779B1) + padded[at + 1] * np.uint32(0x85EBCA77) + padded[at + 2] * np.uint32(0xC2B2AE3D)
    bucket ^= bucket >> np.uint32(15)
    bucket = (bucket * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    begins = np.flatnonzero(padded[at] == 0)
    length = np.diff(np.append(begins, len(at)))
    place = at[begins]
    return Words(bucket, begins, length, place, script[code[place]] if len(place) else np.empty(0, np.uint8),
                 np.searchsorted(offset, place, side="right") - 1, offset)


@dataclass
class Model:
    languages: list[str]
    score: np.ndarray  # (languages, BUCKETS) float32
    allowed: np.ndarray  # (scripts, languages) bool

    def word_scores(self, w: Words) -> np.ndarray:
        if not len(w.start):
            return np.empty((0, len(self.languages)), np.float32)
        found = np.stack([np.add.reduceat(row[w.bucket], w.start) for row in self.score], axis=1)
        allowed = self.allowed[w.script]
        narrowed = allowed.any(axis=1)
        out = np.where(allowed, found, np.float32(-1e6))
        out[~narrowed] = 0  # no language uses the script: the words around decide
        return out


def train_fold(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the rows with text and lang whose fold isn't 0."""
    rows = common.narrow(docs, doc_id="long", text="string", lang="string").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (train_fold() != 0))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    languages = sorted(counts)
    if not languages:
        return Model([], np.empty((0, BUCKETS), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool))
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(int((1 << 30) * min(1.0, sample / n))))])
    some = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("lang")])

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for small in common.slices(iter([batch]), "text"):
                lang = np.array(small.column(0).to_pylist(), object)
                for one in set(lang):
                    w = words_of([t for t, k in zip(small.column(1).to_pylist(), lang) if k == one])
                    n = np.bincount(w.bucket, minlength=BUCKETS + len(SCRIPT_NAMES)).astype(np.int64)
                    n[BUCKETS:] += np.bincount(w.script, weights=w.length, minlength=len(SCRIPT_NAMES)).astype(np.int64)
                    total[one] = total.get(one, 0) + n
        for one, n in total.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([one] * len(some), pa.string()), pa.array(some), pa.array(n[some])], names=["lang", "bucket", "n"])

    found = some.select("lang", "text").mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((len(languages), BUCKETS + len(SCRIPT_NAMES)))
    number = {lang: i for i, lang in enumerate(languages)}
    table[[number[x] for x in found.column(0).to_pylist()], found.column(1).to_numpy()] = found.column(2).to_numpy()
    grams, scripts = table[:, :BUCKETS] + SMOOTHING, table[:, BUCKETS:]
    score = np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32)
    allowed = (scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=1, keepdims=True))).T
    return Model(languages, score, allowed)


def viterbi(score: np.ndarray, text: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word: all texts go forward in step, the longest first."""
    words, languages = score.shape
    if not words:
        return np.empty(0, np.int64)
    begin = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    length = np.diff(np.r_[begin, words])
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    steps = int(length[0])
    active = np.searchsorted(-length, -np.arange(steps), side="left")  # texts that have a word at each step
    first = np.concatenate([[0], np.cumsum(active)])
    step = np.repeat(np.arange(steps), active)
    source = begin[np.arange(words) - first[step]] + step
    score = score[source]
    back = np.empty((words, languages), np.uint16)
    last = np.empty((len(begin), languages))
    best = score[:active[0]].astype(np.float64)
    keep = np.arange(languages, dtype=np.uint16)
    for t in range(1, steps):
        n = active[t]
        last[n:len(best)] = best[n:]
        best = best[:n]
        top = best.argmax(axis=1)
        moved = best[np.arange(n), top][:, None] - penalty
        stay = best >= moved
        back[first[t]:first[t + 1]] = np.where(stay, keep, top[:, None].astype(np.uint16))
        best = np.where(stay, best, moved) + score[first[t]:first[t + 1]]
    last[:len(best)] = best
    label = np.empty(words, np.int64)
    now = last.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        label[first[t]:first[t + 1]] = now[:n]
        if t:
            now[:n] = back[first[t]:first[t + 1]][np.arange(n), now[:n]]
    out = np.empty(words, np.int64)
    out[source] = label
    return out


def predict(texts: list[str], model: Model, penalty: float = SWITCH_PENALTY, spans: bool = False):
    """Per text: language, score and, if asked for, spans (start, end, language) in characters."""
    w = words_of(texts)
    k = len(model.languages)
    letters, total = np.zeros((len(texts), max(k, 1))), np.zeros(len(texts))
    if k and len(w.start):
        label = viterbi(model.word_scores(w), w.text, penalty)
        learned = w.length * model.allowed[w.script].any(axis=1)  # letters of other scripts speak for no language
        letters = np.bincount(w.text * k + label, weights=learned, minlength=len(texts) * k).reshape(-1, k)
        total = np.bincount(w.text, weights=w.length, minlength=len(texts))
    most = letters.argmax(axis=1)
    lang = [model.languages[m] if n else UNKNOWN for m, n in zip(most, total)]
    score = letters.max(axis=1) / np.maximum(total, 1)
    if not spans:
        return lang, score, None
    found: list[list[dict]] = [[] for _ in texts]
    if k and len(w.start):
        new = np.flatnonzero(np.r_[True, (w.text[1:] != w.text[:-1]) | (label[1:] != label[:-1])])
        end = np.r_[new[1:], len(label)] - 1
        for a, b in zip(new, end):
            t = w.text[a]
            found[t].append({"start": int(w.place[a] - w.offset[t]), "end": int(w.place[b] + w.length[b] - w.offset[t]), "lang": model.languages[label[a]]})
    return lang, score, found


def identify(docs: DataFrame, model: Model | None = None, penalty: float = SWITCH_PENALTY, spans: bool = False) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score (and spans).

    Only the text decides a prediction.  held_out says that the row's fold is
    0 (false for a NULL doc_id, which trains nothing either).  A text that is
    NULL or has no letter, and any text if nothing could be learned, is ``und``
    with score 0.  The score is the language's share of all letters; those of a
    script that no learned language uses count for none, so a text in such a
    script alone has score 0.  Equal shares go to the language first in order of
    its name.
    Repeated rows all come back; an empty table gives an empty result; other
    columns are ignored.
    """
    model = train(docs) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS numbers, whatever the corpus
    kinds = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            lang, score, found = predict([t or "" for t in batch.column(2).to_pylist()], shared.value, penalty, spans)
            more = [pa.array(found, kinds)] if spans else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), *more],
                                             names=["doc_id", "held_out", "lang_pred", "score", *["spans"] * spans])

    rows = common.narrow(docs, doc_id="long", text="string").select("doc_id", F.coalesce(train_fold() == 0, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double" + ", spans array<struct<start:int,end:int,lang:string>>" * spans)


def identified(docs: DataFrame, model: Model, least: float = 0.4, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """The rows of ``docs`` with an identified language: not ``und``, and its share of the letters at least ``least``.

    Texts without letters go, and texts mostly in scripts that nothing was
    learned of; NULL texts go; repeated rows are judged alike; all columns stay,
    whatever their names; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            lang, score, _ = predict([t or "" for t in texts], shared.value, penalty)
            yield batch.filter(pa.array([x != UNKNOWN and s >= least for x, s in zip(lang, score)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
