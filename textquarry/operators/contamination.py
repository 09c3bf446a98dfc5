"""Documents that hold evaluation items: exact, as a substring, by shingles, short ones between word boundaries.

A document with any hit is contaminated; all hits are returned.  Long items are
met through shared shingles only, short ones through their first word, so no
document is held against every item.  A null text has no hits; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions import hashing
from textquarry.functions import text as T
from textquarry.operators.marks import marks
from textquarry.storage import written

#: Keys of items that a task may hold.
KEYS_HELD = 200_000
WIDTH, SHORT_CHARS, SHORT_WORDS, LEAST_SHINGLES, SHARE = 5, 40, 6, 4, 0.8


def _prepared(df: DataFrame, key: Column, text: Column, label: str) -> DataFrame:
    out = df.select(key.alias("key"), T.word_folded(text).alias("norm")).where("norm is not null")
    return written(out, label).withColumn("words", F.split("norm", " "))


def _of(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``doc, norm`` of the documents that stand in ``found``, and perhaps a few more: others need not move to a join."""
    return docs.where(marks(found.select(F.xxhash64("doc").alias("at")).distinct(), "at").column(F.xxhash64("doc"))).select("doc", "norm")


def hits(docs: DataFrame, items: DataFrame, *, doc: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """``doc, item, method, overlap`` for every document and item that meet."""
    d, q = _prepared(docs, F.col(doc), F.col(text), "documents"), _prepared(items, F.col(item), F.col(text), "items")
    q = q.select(F.col("key").alias("item"), F.col("norm").alias("q"), F.col("words").alias("q_words")).where("q <> ''")
    d = d.select(F.col("key").alias("doc"), "norm", "words")
    same = d.where(marks(q.select(F.xxhash64("q").alias("at")).distinct(), "at").column(F.xxhash64("norm")))
    exact = same.join(q, F.col("norm") == F.col("q")).select("doc", "item", F.lit("exact_field_fingerprint").alias("method"), F.lit(1.0).alias("overlap"))

    is_short = (F.length("q") < SHORT_CHARS) | (F.size("q_words") < SHORT_WORDS)
    short = q.where(is_short).select("item", "q", F.element_at("q_words", 1).alias("word"))
    if short.isEmpty():
        brief = exact.limit(0)
    else:
        wanted = short.select("word").distinct()
        some = d.select("doc", F.explode(F.array_distinct("words")).alias("word")).join(wanted, "word")
        pairs = written(some.join(short, "word").select("doc", "item", "q"), "short-pairs")
        pairs = pairs.join(_of(d, pairs), "doc")
        brief = pairs.where(T.contains_words(F.col("norm"), F.col("q"))).select("doc", "item", F.lit("short_exact_word_sequence_requires_manual_audit").alias("method"), F.lit(1.0).alias("overlap"))

    long = written(q.where(~is_short).withColumn("keys", hashing.shingle_hashes(F.col("q"), WIDTH)), "long-items")
    theirs = long.select("item", F.explode("keys").alias("key"))
    wanted = written(theirs.select("key").distinct(), "item-keys")
    if wanted.count() <= KEYS_HELD:  # a bounded list, held by every task; more keys are met by a join
        among = np.sort(np.array([r["key"] for r in wanted.collect()], dtype=np.int64))
        found = d.select("doc", hashing.shingle_hashes(F.col("norm"), WIDTH, among).alias("keys")) if len(among) else d.limit(0).select("doc", F.array().cast("array<long>").alias("keys"))
        ours = found.select("doc", F.explode("keys").alias("key"))
    else:
        ours = d.select("doc", F.explode(hashing.shingle_hashes(F.col("norm"), WIDTH)).alias("key")).join(wanted, "key", "left_semi")
    shared = written(ours.join(theirs, "key").groupBy("doc", "item").agg(F.count(F.lit(1)).alias("shared")), "shared")
    met = shared.join(long.select("item", "q", F.size("keys").alias("n")), "item").join(_of(d, shared), "doc")
    inside = F.col("norm").contains(F.col("q"))
    much = (F.col("n") >= LEAST_SHINGLES) & (F.col("shared") / F.col("n") >= SHARE)
    method = F.when(inside, "normalized_exact_substring").when(much, "five_word_shingle_containment")
    overlap = met.select("doc", "item", method.alias("method"), (F.col("shared") / F.col("n")).alias("overlap")).where("method is not null")
    return exact.unionByName(brief).unionByName(overlap)


def partition(docs: DataFrame, found: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """``docs`` with ``status`` clean or contaminated and the number of hits: one non-null column, so the parts are complementary."""
    n = found.groupBy(F.col("doc").alias("__doc")).agg(F.count(F.lit(1)).alias("n_hits"))
    out = docs.join(n, F.col(doc) == F.col("__doc"), "left").drop("__doc").withColumn("n_hits", F.coalesce("n_hits", F.lit(0)))
    return out.withColumn("status", F.when(F.col("n_hits") > 0, "contaminated").otherwise("clean"))
