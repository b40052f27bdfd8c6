"""The corpus pipeline: documents of an identified language, without duplicate
lines, near duplicates and repeated passages, packed into sequences.

Each stage takes all that the one before kept, written as Parquet and read
again; all but the last return the columns of ``documents`` (``n_chars`` says
the length of the text as it is then).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import langid, lines, packing, simhash, suffixes
from lodestone.session import scratch_dir


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter, or no language with 0.4 of their letters."""
    return langid.identified(docs, langid.train(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go that an earlier document or line has, but for one word edit at most."""
    return _measured(lines.without_duplicates(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, that with the smallest doc_id (NULL last)."""
    return simhash.keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes go that a string of 200 bytes covers which starts anywhere else too."""
    return _measured(suffixes.without_repeats(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as pieces of sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("packing", pack),
]
#: Suffix arrays, fingerprints and tokens aren't SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
