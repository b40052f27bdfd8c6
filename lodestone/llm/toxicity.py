"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

A document's features are the words it holds and their first three to six
letters, hashed: that it holds one, and that it holds one more than once.  A
model keeps those whose share of documents differs clearly between grades, by
more than the best of as many features would by chance.
Weights are shared by all thresholds: with score s = w.x and ordered thresholds
t_1 < t_2 < ..., P(grade >= j) = logistic(s - t_j).  The expected severity is
the sum of these probabilities, the predicted grade the number of them that
are at least one half.

The weights are fitted by full-batch gradient steps (Adam) on the training
rows.  Their features are written once; each step is one pass in which every
task adds up the gradient of its rows, and only the sums, whose size doesn't
depend on the rows, come to the driver.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import scratch_dir

from . import common

#: Training rows of each grade at most (about, a sample by hash); gradient steps; what a feature's z-score must reach.
SAMPLE, STEPS, LEAST_Z = 4000, 80, 5.0
#: Letters of the beginnings of words that are features; features expected to pass by chance.
BEGINNINGS, CHANCE = (3, 4, 5, 6), 1.0
RATE, SHRINK = 0.3, 1e-4
#: Texts are split into words in pieces of about so many characters.
PIECE = 1 << 20
_WORD = re.compile(r"[^\W\d_]+")


def _words(text: str) -> Counter[str]:
    """The words of a text and how often it holds them."""
    words: Counter[str] = Counter()
    at = 0
    while at < len(text):
        to = at + PIECE
        while to < len(text) and _WORD.match(text, to):
            to += 1
        words.update(_WORD.findall(text[at:to].lower()))
        at = to
    return words


def _hashed(found: set[str]) -> np.ndarray:
    return np.unique(np.fromiter((zlib.crc32(w.encode()) for w in found), np.int64, len(found)))


def features(text: str) -> np.ndarray:
    """The hashed words of a text, each once."""
    return _hashed(set(_words(text)))


def all_features(text: str) -> np.ndarray:
    """The hashed words of a text, their beginnings, and those of both that it holds more than once."""
    words = _words(text)
    found = set(words)
    found.update([w + "+" for w, n in words.items() if n > 1])
    for k in BEGINNINGS:
        several = Counter([w[:k] for w in words if len(w) >= k])  # of different words
        again = {w[:k] for w, n in words.items() if n > 1 and len(w) >= k}
        again.update([p for p, n in several.items() if n > 1])
        found.update(["^" + p for p in several])
        found.update(["^" + p + "+" for p in again])
    return _hashed(found)


@dataclass
class Model:
    words: np.ndarray  # hashes in order
    weights: np.ndarray
    thresholds: np.ndarray

    def places(self, found: np.ndarray) -> np.ndarray:
        """The model's words among a text's features."""
        return np.flatnonzero(np.isin(self.words, found, assume_unique=True))

    def probabilities(self, texts: list[str]) -> np.ndarray:
        """P(grade >= j) of each text, j from 1."""
        score = np.array([self.weights[self.places(all_features(t))].sum() for t in texts])
        return _logistic(score[:, None] - self.thresholds[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def gradient(model: Model, flat: np.ndarray, sizes: np.ndarray, grade: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Of the weighted negative log-likelihood: by features, by thresholds, and the value.

    P(grade = j) = P(>= j) - P(>= j + 1) with P(>= 0) = 1 and P(>= last + 1) = 0.
    """
    row = np.repeat(np.arange(len(sizes)), sizes)
    score = np.bincount(row, weights=model.weights[flat], minlength=len(sizes))
    at_least = np.concatenate([np.ones((len(score), 1)), _logistic(score[:, None] - model.thresholds), np.zeros((len(score), 1))], axis=1)
    slope = at_least * (1 - at_least)
    n = np.arange(len(score))
    p = np.maximum(at_least[n, grade] - at_least[n, grade + 1], 1e-12)
    by_score = -weight * (slope[n, grade] - slope[n, grade + 1]) / p
    by_threshold = np.zeros(len(model.thresholds) + 2)
    np.add.at(by_threshold, grade, weight * slope[n, grade] / p)
    np.add.at(by_threshold, grade + 1, -weight * slope[n, grade + 1] / p)
    return np.bincount(flat, weights=by_score[row], minlength=len(model.weights)), by_threshold[1:-1], float(-(weight * np.log(p)).sum())


def training_rows(docs: DataFrame, graded: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(grade, weight, features) of a sample of the documents that have a grade; a row weighs as many as it stands for."""
    grades = graded.where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.max("grade").alias("grade"))
    counts = {r.grade: r.n for r in grades.groupBy("grade").agg(F.count("*").alias("n")).collect()}  # one row a grade
    keep = F.coalesce(*[F.when(F.col("grade") == g, F.lit(int((1 << 30) * min(1.0, sample / n)))) for g, n in counts.items()], F.lit(0))
    some = grades.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < keep)
    # the sample has about 2 * ``sample`` rows of two numbers whatever the corpus, so texts needn't move to meet it
    rows = common.narrow(docs, doc_id="long", text="string").where("text IS NOT NULL").join(F.broadcast(some), "doc_id").select(
        "grade", F.coalesce(*[F.when(F.col("grade") == g, F.lit(max(1.0, n / sample))) for g, n in counts.items()], F.lit(1.0)).alias("weight"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            found = [all_features(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["grade", "weight", "features"])

    return rows.mapInArrow(run, "grade int, weight double, features array<long>")


def telling_words(rows: DataFrame, counts: list[int], least_z: float = LEAST_Z) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of features that tell grades apart at one threshold or more, and whether they lean to the higher ones.

    Their shares of documents differ by ``least_z`` standard errors, and by so
    much that of all features only ``CHANCE`` is expected to pass by chance
    (Chernoff's bound, which holds for rare ones too).
    """
    of_grade = [F.count_if(F.col("grade") == g).cast("double").alias(f"n{g}") for g in range(len(counts))]
    words = common.checkpoint(rows.select("grade", F.explode("features").alias("word")).groupBy("word").agg(*of_grade))
    least = float(np.log(max(1, words.count()) / CHANCE))
    clear = leans = F.lit(False)
    for j in range(1, len(counts)):
        low, high = sum(counts[:j]), sum(counts[j:])
        if low and high:
            a, b = (sum((F.col(f"n{g}") for g in part), F.lit(0.0)) for part in (range(j), range(j, len(counts))))
            share = (a + b + 1) / (low + high + 2)
            error = F.sqrt(share * (1 - share) * (1 / low + 1 / high))
            surprise = sum(F.when(n > 0, n * F.log(n / (a + b) * ((low + high) / m))).otherwise(0.0) for n, m in ((a, low), (b, high)))
            here = (F.abs(b / high - a / low) >= least_z * error) & (surprise >= least)
            clear, leans = clear | here, leans | here & (b / high > a / low)
    found = words.where(clear).select("word", leans.alias("leans")).orderBy("word").toArrow()  # of a bounded sample
    return found.column(0).to_numpy(), found.column(1).to_numpy()


def descend(rows: DataFrame, words: np.ndarray, counts: list[float], steps: int = STEPS) -> Model:
    """A model from (grade, weight, at): grades, weights of rows and the places of their features in ``words``."""
    size, grades = len(words), len(counts)
    total = sum(counts) or 1.0
    odds = [min(max(sum(counts[j:]) / total, 1e-4), 1 - 1e-4) for j in range(1, grades)]
    model = Model(words, np.zeros(size), np.sort(-np.log(np.array(odds) / (1 - np.array(odds)))))
    if sum(n > 0 for n in counts) < 2:
        return model
    first, second = (np.zeros(size + grades - 1) for _ in range(2))
    for step in range(1, steps + 1):
        now = model

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(size + grades - 1)
            for batch in batches:
                grade, weight, lists = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
                sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
                by_weight, by_threshold, _ = gradient(now, lists.flatten().to_numpy(), sizes, grade, weight / total)
                sums += np.concatenate([by_weight, by_threshold])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], names=["at", "g"])

        sums = rows.mapInArrow(run, "at long, g double").toArrow()  # one gradient a task, of a few tasks
        g = np.concatenate([SHRINK * model.weights, np.zeros(grades - 1)])
        np.add.at(g, sums.column(0).to_numpy(), sums.column(1).to_numpy())
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        model = Model(words, model.weights - move[:size], np.sort(model.thresholds - move[size:]))
    return model


def fit(docs: DataFrame, labels: DataFrame, steps: int = STEPS, sample: int = SAMPLE, least_z: float = LEAST_Z) -> Model:
    """A model of severity from (doc_id, toxic).

    Grades: 0 not toxic, 1 toxic, 2 toxic with at least the median number of
    features leaning to toxic that toxic documents with any have.  Labels that are NULL, or
    neither 0 nor 1, and those without a document are passed over; of several
    for one document the largest counts.  Without labels of both kinds the
    model has no words.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "features")
    graded = common.narrow(labels, doc_id="long", toxic="int").where("toxic IN (0, 1)").select("doc_id", F.col("toxic").alias("grade"))
    training_rows(docs, graded, sample).write.parquet(folder)
    rows = spark.read.parquet(folder)
    found = {r.grade: (r.n, r.w) for r in rows.groupBy("grade").agg(F.count("*").alias("n"), F.first("weight").alias("w")).collect()}
    words, leans = telling_words(rows, [found.get(g, (0, 0.0))[0] for g in (0, 1)], least_z)
    places = Model(words, np.zeros(len(words)), np.zeros(1)).places

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [places(np.array(f, np.int64)) for f in batch.column(2).to_pylist()]
            telling = pa.array([int(leans[a].sum()) for a in at], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at, pa.list_(pa.int64())), telling], names=["grade", "weight", "at", "telling"])

    sparse = common.checkpoint(rows.mapInArrow(known, "grade int, weight double, at array<long>, telling int").coalesce(4))  # a bounded sample
    some = F.when((F.col("grade") == 1) & (F.col("telling") > 0), F.col("telling"))
    middle = max(2, sparse.agg(F.percentile_approx(some, 0.5).alias("m")).first().m or 2)
    ordered = common.checkpoint(sparse.withColumn("grade", F.when((F.col("grade") == 1) & (F.col("telling") >= middle), 2).otherwise(F.col("grade"))).drop("telling"))
    weights = {r.grade: r.w for r in ordered.groupBy("grade").agg(F.sum("weight").alias("w")).collect()}
    return descend(ordered, words, [weights.get(g, 0.0) for g in range(3)], steps)


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """One row per input row: doc_id, grade, expected_severity, toxic and toxic_probability.

    ``toxic`` says that a grade above 0 is at least as likely as grade 0.  NULL
    and empty texts have no words and are scored by the thresholds alone;
    repeated rows all come back; an empty table gives an empty result; other
    columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "grade", "expected_severity", "toxic", "toxic_probability"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in common.slices(batches, "text"):
            p = model.probabilities([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((p >= 0.5).sum(axis=1).astype(np.int32)), pa.array(p.sum(axis=1)),
                                              pa.array(p[:, 0] >= 0.5), pa.array(p[:, 0])], names=names)

    return common.narrow(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, grade int, expected_severity double, toxic boolean, toxic_probability double")
