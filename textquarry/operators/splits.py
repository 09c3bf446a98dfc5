"""Leakage-free train / validation / test splits of linked groups."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions import text as T
from textquarry.operators.components import connected_components


def key_edges(rows: DataFrame, key: Column, id_col: str = "id") -> DataFrame:
    """Edges from each row to the smallest id that shares its key; null keys link nothing."""
    keyed = rows.select(F.col(id_col).alias("left_id"), key.alias("__key")).where("__key is not null")
    return keyed.join(keyed.groupBy("__key").agg(F.min("left_id").alias("right_id")), "__key").select("left_id", "right_id")


def groups(rows: DataFrame, edges: DataFrame, id_col: str = "id") -> DataFrame:
    """``id, group_id``: components of the edges, named by their smallest id."""
    found = connected_components(edges.where(F.col("left_id") != F.col("right_id")), "left_id", "right_id")
    return rows.select(F.col(id_col).alias("id")).join(found, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("group_id"))


def split_of(group: Column, *, seed: int = 1729, train: float = 0.9, validation: float = 0.05) -> Column:
    """The split that a group's hash falls in."""
    u = T.unit_hash(F.lit(seed), group)
    return F.when(u < train, "train").when(u < train + validation, "validation").otherwise("test")


def capped_groups(counts: DataFrame, caps: dict[str, int]) -> DataFrame:
    """``group_id, kept``: groups in order of id; one goes as a whole if any domain would exceed its cap, and then uses no quota.

    ``counts`` has ``group_id, domain, n``.  What a group may use depends on all
    decisions before it, so this is one fold over narrow rows, sorted by Spark,
    with a state of one number a capped domain; groups without a capped domain
    do not enter it.
    """
    capped = counts.where(F.col("domain").isin(list(caps)))
    ordered = capped.groupBy("group_id").agg(F.map_from_entries(F.collect_list(F.struct("domain", "n"))).alias("n")).orderBy("group_id").coalesce(1)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = dict.fromkeys(caps, 0)
        for batch in batches:
            kept = []
            for n in batch.column(1).to_pylist():
                fits = all(used[d] + k <= caps[d] for d, k in n)
                kept.append(fits)
                if fits:
                    for d, k in n:
                        used[d] += k
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.bool_())], names=["group_id", "kept"])

    decided = ordered.mapInArrow(fold, "group_id string, kept boolean")
    free = counts.select("group_id").distinct().join(capped.select("group_id"), "group_id", "left_anti").withColumn("kept", F.lit(True))
    return decided.unionByName(free)


def leakage(assigned: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row of three counts that must be 0: near pairs across splits, exact copies left, groups in two splits.

    ``assigned`` has ``id, group_id, split, h``; ``pairs`` has ``left_id, right_id``.
    """
    a, b = assigned.select(F.col("id").alias("left_id"), F.col("split").alias("ls")), assigned.select(F.col("id").alias("right_id"), F.col("split").alias("rs"))
    across = pairs.join(a, "left_id").join(b, "right_id").where("ls <> rs").agg(F.count(F.lit(1)).alias("cross_split_near_pairs"))
    copies = assigned.groupBy("h").count().where("count > 1").agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("exact_duplicates"))
    torn = assigned.groupBy("group_id").agg(F.count_distinct("split").alias("k")).where("k > 1").agg(F.count(F.lit(1)).alias("groups_across_splits"))
    named = [t.select(F.lit(c).alias("measure"), F.col(c).cast("long").alias("n")) for t, c in ((across, "cross_split_near_pairs"), (copies, "exact_duplicates"), (torn, "groups_across_splits"))]
    return named[0].union(named[1]).union(named[2])


def require_no_leakage(measures: DataFrame) -> None:
    """Raise if any measure of :func:`leakage` is above 0."""
    bad = measures.where("n > 0").collect()  # three rows at most
    if bad:
        raise ValueError("leakage: " + ", ".join(f"{r['measure']}={r['n']}" for r in bad))


def removal_rates(rows: DataFrame, removed: DataFrame, domain: str, *, protected: tuple[str, ...] = (), most: float = 0.2) -> DataFrame:
    """By domain the rows that entered, those removed, the rate and whether the removal calls for a look by hand."""
    gone = removed.where("removed").select("id", F.lit(1).alias("gone"))
    out = rows.join(gone, "id", "left").groupBy(F.col(domain).alias("domain")).agg(F.count(F.lit(1)).alias("entering"), F.sum(F.coalesce("gone", F.lit(0))).alias("removed"))
    rate = F.col("removed") / F.col("entering")
    return out.withColumns({"rate": rate, "audit": (F.col("domain").isin(list(protected)) & (F.col("removed") > 0)) | (rate > most)})


def fertility(rows: DataFrame, words: str, tokens: str, most: float = 3.0) -> DataFrame:
    """Tokens a word over all rows with words (a ratio of sums) and whether packing is blocked; unresolved without rows."""
    out = rows.where(F.col(words) > 0).agg(F.sum(tokens).alias("tokens"), F.sum(words).alias("words"))
    ratio = F.col("tokens") / F.col("words")
    return out.select("tokens", "words", ratio.alias("mean_fertility"), F.when(F.col("words").isNull(), "unresolved").otherwise("measured").alias("status"), F.coalesce(ratio > most, F.lit(False)).alias("blocks_packing"))
