"""The document pipeline: classify, remove near copies, replace personal data, mix, pack.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table that is written
as Parquet before the next stage reads it.  All but the last return the columns
of ``documents``, whatever these are called.  An empty table passes through all
stages.  Rows without text are rejected by the first stage; null ids pass, equal
rows are one near copy, so one of them stays; long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textquarry.llm import mixing, ngram_join, packing, pii, quality
from textquarry.storage import forget, written

#: Words of a shingle and similarity in percent for near copies.
SHINGLE_WORDS, SIMILARITY = 5, 80
#: The setting with the key of the surrogates, and the key of trial runs that set none.
KEY_SETTING, TRIAL_KEY = "spark.textquarry.pii.key", "trial run"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, the document with the smallest id stays; rows without shingles or id all stay.

    Where rows share an id and a component, one of them stays: the first by text.
    """
    return ngram_join.keep_first(docs, words=SHINGLE_WORDS, percent=SIMILARITY)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents, personal data replaced by surrogates."""
    return pii.replace(docs, key=spark.conf.get(KEY_SETTING, TRIAL_KEY)).select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, repeated as often as it takes them."""
    return mixing.mixed_documents(docs)


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's pieces with their windows."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_each_group),
    ("PII surrogates", without_personal_data),
    ("source mix", mixed_sources),
    ("packing", packed_windows),
]

#: Surrogates and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, "stage")
            forget(before)  # the tables of the stages, not the input
    return docs
