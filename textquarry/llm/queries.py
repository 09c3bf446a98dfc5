"""The registered queries over the synthetic tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.llm import covertree, lm, mixing, mtree, ngram_join, packing, pii, quality, urlfilter, warc
from textquarry.llm.sql import ORACLES

#: Surrogates of the registered query only: fixed, so that reruns agree.
QUERY_KEY = "registered query"
#: Words and pairs: longer n-grams move more than the disk that the query's budget allows (see README).
QUERY_ORDER = 2
Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents"), key=QUERY_KEY).select("doc_id", "text", "n_entities")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"))


def op4_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), order=QUERY_ORDER)


def op5_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_index(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_copies(table(spark, sf_dir, "embeddings"))


def op8_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op9_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_packed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_source_mix, op2_surrogates, op3_quality, op4_backoff_scores, op5_top_products, op6_capture_index, op7_near_vectors, op8_shingle_join, op9_url_verdicts, op10_packed_windows)}
ORACLE_SQL: dict[str, str] = {k: v for k, v in ORACLES.items() if k in QUERIES}
